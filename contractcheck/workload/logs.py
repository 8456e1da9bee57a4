"""Result logs and readiness, with ``events`` as the log of check results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractcheck.operators import distincts, readiness, reports, storage
from contractcheck.workload.base import AS_OF, query, table

DAY = "2024-01-30"


def _key(prefix: str, col: str):
    return F.concat(F.lit(prefix), F.col(col).cast("string"))


def result_log(spark: SparkSession, d: str) -> DataFrame:
    """Every event is the outcome of one test of one agreement."""
    status = F.when(F.col("event_type") == "error", "fail").when(F.col("event_type") == "view", "skipped").otherwise("pass")
    return table(spark, d, "events").select(
        F.col("event_id").cast("string").alias("id"),
        F.concat(F.lit("run_"), F.date_format("ts", "yyyyMMdd")).alias("run_id"),
        F.concat(_key("c", "user_id"), F.lit("/"), (F.col("event_id") % 7).cast("string")).alias("test_id"),
        _key("c", "user_id").alias("contract_id"),
        F.concat(F.lit("m"), (F.col("user_id") % 40).cast("string")).alias("model_name"),
        F.concat(F.lit("col"), (F.col("event_id") % 7).cast("string")).alias("column_name"),
        F.when(F.col("event_id") % 3 == 0, "not_null").when(F.col("event_id") % 3 == 1, "unique").otherwise("generic").alias("test_type"),
        status.alias("status"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("failure_message"),
        F.floor("value").cast("bigint").alias("execution_time_ms"),
        F.col("ts").alias("run_timestamp"),
    ).withColumn("test_name", F.concat_ws("_", "test_type", "model_name", "column_name"))


RESULTS_SQL = """
results AS (
  SELECT CAST(event_id AS VARCHAR) AS id, 'run_' || strftime(ts, '%Y%m%d') AS run_id,
         'c' || CAST(user_id AS VARCHAR) || '/' || CAST(event_id % 7 AS VARCHAR) AS test_id, 'c' || CAST(user_id AS VARCHAR) AS contract_id,
         'm' || CAST(user_id % 40 AS VARCHAR) AS model_name, 'col' || CAST(event_id % 7 AS VARCHAR) AS column_name,
         CASE event_id % 3 WHEN 0 THEN 'not_null' WHEN 1 THEN 'unique' ELSE 'generic' END AS test_type,
         CASE event_type WHEN 'error' THEN 'fail' WHEN 'view' THEN 'skipped' ELSE 'pass' END AS status,
         CASE WHEN event_type = 'error' THEN props END AS failure_message,
         CAST(floor(value) AS BIGINT) AS execution_time_ms, ts AS run_timestamp,
         CASE event_id % 3 WHEN 0 THEN 'not_null' WHEN 1 THEN 'unique' ELSE 'generic' END || '_m' || CAST(user_id % 40 AS VARCHAR)
           || '_col' || CAST(event_id % 7 AS VARCHAR) AS test_name
  FROM events)"""

LATEST_SQL = f"""
WITH {RESULTS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY test_id ORDER BY run_timestamp DESC, id DESC) AS rn FROM results)
SELECT test_name, model_name, column_name, status, failure_message, execution_time_ms, run_timestamp FROM r WHERE rn = 1"""


@query("latest_result", LATEST_SQL)
def latest_result(spark, d):
    return reports.latest_test_results(result_log(spark, d))


@query("latest_result_by_max", LATEST_SQL)
def latest_result_by_max(spark, d):
    return reports.latest_by_max(result_log(spark, d), ["test_id"], ["run_timestamp", "id"]).select(
        "test_name", "model_name", "column_name", "status", "failure_message", "execution_time_ms", "run_timestamp"
    )


@query(
    "distinct_tests_range",
    f"""
WITH {RESULTS_SQL}
SELECT model_name, count(*) AS rows, count(DISTINCT test_id) AS distinct_values FROM results
WHERE run_timestamp >= TIMESTAMP '2024-01-05' AND run_timestamp < TIMESTAMP '2024-01-26' GROUP BY 1""",
)
def distinct_tests_range(spark, d):
    return distincts.distinct_in_range(result_log(spark, d), "run_timestamp", "2024-01-05", "2024-01-25", ["model_name"], "test_id")


@query(
    "contract_health",
    """
WITH tests AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem),
runs AS (SELECT l_orderkey, l_linenumber, l_shipdate AS ts, CASE l_returnflag WHEN 'A' THEN 'fail' WHEN 'R' THEN 'skipped' ELSE 'pass' END AS status,
                row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC,
                  concat_ws('-', CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR)) DESC) AS rn
         FROM lineitem),
x AS (SELECT o_custkey, status, ts FROM tests JOIN runs USING (l_orderkey, l_linenumber) JOIN orders ON o_orderkey = l_orderkey WHERE rn = 1),
a AS (SELECT o_custkey, count(*) AS n, count(*) FILTER (status = 'pass') AS p, count(*) FILTER (status = 'fail') AS f,
             count(*) FILTER (status = 'skipped') AS s, max(ts) AS last FROM x GROUP BY 1)
SELECT c_name AS name, c_mktsegment AS domain, coalesce(n, 0) AS total_tests, coalesce(p, 0) AS passing_tests, coalesce(f, 0) AS failing_tests,
       coalesce(s, 0) AS skipped_tests, last AS last_test_run, CASE WHEN n > 0 THEN CAST((20000*p + n) // (2*n) AS DOUBLE) / 100 END AS pass_rate
FROM customer LEFT JOIN a ON o_custkey = c_custkey""",
)
def contract_health(spark, d):
    """Customers are agreements, their orders models, the order lines tests; every
    delivery of a line is one result."""
    lines = table(spark, d, "lineitem")
    test_id = F.concat_ws("/", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    contracts = table(spark, d, "customer").select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("domain")
    )
    models = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"), F.col("o_custkey").cast("string").alias("contract_id")
    )
    tests = lines.select(test_id.alias("id"), F.col("l_orderkey").cast("string").alias("model_id")).distinct()
    status = F.when(F.col("l_returnflag") == "A", "fail").when(F.col("l_returnflag") == "R", "skipped").otherwise("pass")
    results = lines.select(
        test_id.alias("test_id"),
        status.alias("status"),
        F.col("l_shipdate").alias("run_timestamp"),
        F.concat_ws("-", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"), F.floor("l_quantity").cast("string")).alias("id"),
    )
    return reports.contract_health(contracts, models, tests, results)


def day_logs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Test results, measurements, issues and models, all out of ``events``."""
    log = result_log(spark, d)
    events = table(spark, d, "events")
    slos = events.filter(F.col("event_id") % 5 == 1).select(
        F.col("event_id").cast("string").alias("id"),
        _key("c", "user_id").alias("contract_id"),
        F.lit("freshness").alias("metric_type"),
        F.when(F.col("value") > 20, "fail").when(F.col("value") > 15, "unknown").otherwise("pass").alias("status"),
        F.col("ts").alias("measurement_ts"),
    )
    issues = events.filter(F.col("event_id") % 5 == 2).select(
        _key("m", "user_id").alias("model_id"),
        F.when(F.col("value") > 40, "critical").when(F.col("value") > 15, "high").otherwise("medium").alias("severity"),
        (F.col("event_id") % 3 == 0).alias("reviewed_flag"),
        F.col("ts").alias("detected_at"),
    )
    models = events.select(_key("m", "user_id").alias("id"), _key("c", "user_id").alias("contract_id")).distinct()
    return log, slos, issues, models


STATUS_SQL = f"""
{RESULTS_SQL},
t AS (SELECT contract_id, count(*) AS n, count(*) FILTER (status = 'pass') AS p, count(*) FILTER (status = 'fail') AS f
      FROM results WHERE CAST(run_timestamp AS DATE) = DATE '{DAY}' GROUP BY 1),
s AS (SELECT 'c' || CAST(user_id AS VARCHAR) AS contract_id, count(*) AS n, count(*) FILTER (value <= 15) AS p, count(*) FILTER (value > 20) AS f
      FROM events WHERE event_id % 5 = 1 AND CAST(ts AS DATE) = DATE '{DAY}' GROUP BY 1),
q AS (SELECT 'c' || CAST(user_id AS VARCHAR) AS contract_id, count(*) AS n, count(*) FILTER (value > 40) AS c,
             count(*) FILTER (value > 15 AND value <= 40) AS h
      FROM events WHERE event_id % 5 = 2 AND event_id % 3 <> 0 AND CAST(ts AS DATE) = DATE '{DAY}' GROUP BY 1),
k AS (SELECT contract_id FROM t UNION SELECT contract_id FROM s UNION SELECT contract_id FROM q),
counts AS (
  SELECT contract_id, coalesce(t.n, 0) AS total_tests, coalesce(t.p, 0) AS passing_tests, coalesce(t.f, 0) AS failing_tests,
         coalesce(s.n, 0) AS total_slos, coalesce(s.p, 0) AS passing_slos, coalesce(s.f, 0) AS failing_slos,
         coalesce(q.n, 0) AS total_issues, coalesce(q.c, 0) AS critical_issues, coalesce(q.h, 0) AS high_issues
  FROM k LEFT JOIN t USING (contract_id) LEFT JOIN s USING (contract_id) LEFT JOIN q USING (contract_id)),
status AS (
  SELECT *, CASE WHEN failing_tests = 0 THEN 'pass' ELSE 'fail' END AS test_status,
         CASE WHEN failing_slos = 0 THEN 'pass' ELSE 'fail' END AS slo_status,
         CASE WHEN critical_issues > 0 THEN 'fail' WHEN high_issues > 0 THEN 'warning' ELSE 'pass' END AS dq_status,
         failing_tests = 0 AND failing_slos = 0 AND critical_issues = 0 AS ready,
         CASE WHEN failing_tests = 0 AND failing_slos = 0 AND critical_issues = 0 THEN 'All checks passed' ELSE
           concat_ws('; ', CASE WHEN failing_tests > 0 THEN 'Tests failing: ' || CAST(failing_tests AS VARCHAR) || ' failures' END,
                           CASE WHEN failing_slos > 0 THEN 'SLOs failing: ' || CAST(failing_slos AS VARCHAR) || ' failures' END,
                           CASE WHEN critical_issues > 0 THEN 'Data quality issues: ' || CAST(critical_issues AS VARCHAR) || ' critical' END) END AS reason
  FROM counts)"""


@query(
    "test_status",
    f"""WITH {STATUS_SQL} SELECT contract_id, n AS total_tests, p AS passing_tests, f AS failing_tests,
CASE WHEN f = 0 THEN 'pass' ELSE 'fail' END AS status FROM t""",
)
def test_status(spark, d):
    counts = readiness.test_counts(day_logs(spark, d)[0], DAY)
    return counts.select(
        "contract_id", "total_tests", "passing_tests", "failing_tests", readiness.verdict(F.col("failing_tests")).alias("status")
    )


@query(
    "slo_status",
    f"""WITH {STATUS_SQL} SELECT contract_id, n AS total_slos, p AS passing_slos, f AS failing_slos,
CASE WHEN f = 0 THEN 'pass' ELSE 'fail' END AS status FROM s""",
)
def slo_status(spark, d):
    counts = readiness.slo_counts(day_logs(spark, d)[1], DAY)
    return counts.select(
        "contract_id", "total_slos", "passing_slos", "failing_slos", readiness.verdict(F.col("failing_slos")).alias("status")
    )


@query(
    "dq_status",
    f"""WITH {STATUS_SQL} SELECT contract_id, n AS total_issues, c AS critical_issues, h AS high_issues,
CASE WHEN c > 0 THEN 'fail' WHEN h > 0 THEN 'warning' ELSE 'pass' END AS status FROM q""",
)
def dq_status(spark, d):
    _, _, issues, models = day_logs(spark, d)
    counts = readiness.issue_counts(issues, models, DAY)
    return counts.select(
        "contract_id", "total_issues", "critical_issues", "high_issues",
        readiness.issue_verdict(F.col("critical_issues"), F.col("high_issues")).alias("status"),
    )


@query(
    "ready_flag",
    f"""WITH {STATUS_SQL} SELECT contract_id, total_tests, passing_tests, failing_tests, total_slos, passing_slos, failing_slos,
total_issues, critical_issues, high_issues, test_status, slo_status, dq_status, ready, reason FROM status""",
)
def ready_flag(spark, d):
    return readiness.contract_status(*day_logs(spark, d), DAY)


def subscribers(spark: SparkSession, d: str) -> DataFrame:
    """Every customer watches three agreements; some lists are broken or absent."""
    k = F.col("c_custkey")

    def quoted(expr):
        return F.concat(F.lit('"c'), expr.cast("string"), F.lit('"'))

    watched = F.concat(
        F.lit("["), quoted(k % 150), F.lit(", "), quoted(k * 7 % 150), F.lit(", "), quoted((k + F.col("c_nationkey")) % 150), F.lit("]")
    )
    return table(spark, d, "customer").select(
        k.cast("string").alias("id"),
        F.col("c_name").alias("subscriber_name"),
        F.when(k % 11 == 0, "not json").when(k % 13 == 0, F.lit(None)).when(k % 17 == 0, "[]").otherwise(watched).alias("watching_contract_ids_json"),
        (k % 2 == 0).alias("ready_for_consumption"),
        F.lit("old").alias("ready_for_consumption_reason"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("daily_slo_check_ts"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("_updated_ts"),
    )


SUBSCRIBERS_SQL = f"""
{STATUS_SQL},
subs AS (SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS subscriber_name, c_custkey % 2 = 0 AS old_flag,
                CASE WHEN c_custkey % 11 = 0 THEN 'not json' WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 17 = 0 THEN '[]'
                     ELSE '["c' || CAST(c_custkey % 150 AS VARCHAR) || '", "c' || CAST(c_custkey * 7 % 150 AS VARCHAR) || '", "c'
                          || CAST((c_custkey + c_nationkey) % 150 AS VARCHAR) || '"]' END AS watch,
                [c_custkey % 150, c_custkey * 7 % 150, (c_custkey + c_nationkey) % 150] AS ids FROM customer),
items AS (SELECT id, i AS pos, 'c' || CAST(ids[i] AS VARCHAR) AS contract_id FROM subs, generate_series(1, 3) g(i) WHERE starts_with(watch, '["')),
lines AS (SELECT id, pos, coalesce(ready, true) AS ok, contract_id || ': ' || CASE WHEN coalesce(ready, true) THEN 'Ready' ELSE reason END AS line
          FROM items LEFT JOIN status USING (contract_id)),
verdicts AS (SELECT id, bool_and(ok) AS ready, string_agg(line, '; ' ORDER BY pos) AS reason, count(*) AS watched FROM lines GROUP BY 1),
flagged AS (
  SELECT s.id, subscriber_name, watch AS watching_contract_ids_json, old_flag, coalesce(v.ready, old_flag) AS ready_for_consumption,
         coalesce(v.reason, 'old') AS ready_for_consumption_reason,
         CASE WHEN v.id IS NULL THEN TIMESTAMP '2024-01-01 00:00:00' ELSE TIMESTAMP '{AS_OF}' END AS moment
  FROM subs s LEFT JOIN verdicts v ON v.id = s.id)"""


def flagged(spark: SparkSession, d: str) -> DataFrame:
    status = readiness.contract_status(*day_logs(spark, d), DAY)
    return readiness.readiness(status, subscribers(spark, d), AS_OF)


@query(
    "subscriber_readiness",
    f"""WITH {SUBSCRIBERS_SQL} SELECT id, subscriber_name, watching_contract_ids_json, ready_for_consumption, ready_for_consumption_reason,
moment AS daily_slo_check_ts, moment AS _updated_ts FROM flagged""",
)
def subscriber_readiness(spark, d):
    return flagged(spark, d)


@query("watch_items", f"WITH {SUBSCRIBERS_SQL} SELECT id, CAST(pos - 1 AS BIGINT) AS pos, contract_id FROM items")
def watch_items(spark, d):
    return readiness.watch_items(subscribers(spark, d)).withColumn("pos", F.col("pos").cast("bigint"))


@query(
    "subscriber_verdicts", f"WITH {SUBSCRIBERS_SQL} SELECT id, ready, reason, watched FROM verdicts"
)
def subscriber_verdicts(spark, d):
    status = readiness.contract_status(*day_logs(spark, d), DAY)
    return readiness.subscriber_verdicts(status, subscribers(spark, d))


@query(
    "readiness_view",
    f"""WITH {SUBSCRIBERS_SQL} SELECT subscriber_name, ready_for_consumption, ready_for_consumption_reason,
moment AS daily_slo_check_ts, moment AS _updated_ts FROM flagged ORDER BY moment DESC, subscriber_name""",
)
def readiness_view(spark, d):
    return reports.subscriber_readiness(flagged(spark, d))


@query(
    "notifications",
    f"""WITH {SUBSCRIBERS_SQL} SELECT id AS subscriber_id, 'readiness' AS event_type, TIMESTAMP '{AS_OF}' AS created_at,
'{{"subscriber_id":"' || id || '","subscriber_name":"' || subscriber_name || '","ready_for_consumption":' || CAST(ready_for_consumption AS VARCHAR)
|| ',"reason":"' || ready_for_consumption_reason || '","timestamp":"2024-02-01T00:00:00"'
|| CASE WHEN watching_contract_ids_json IS NULL THEN '' ELSE ',"watched_contracts":"' || replace(watching_contract_ids_json, '"', '\\"') || '"' END
|| '}}' AS payload FROM flagged""",
)
def notifications(spark, d):
    return readiness.notifications(flagged(spark, d), AS_OF)


@query(
    "flag_changes",
    f"""WITH {SUBSCRIBERS_SQL} SELECT id, old_flag AS previous_flag, ready_for_consumption AS current_flag
FROM flagged WHERE old_flag IS DISTINCT FROM ready_for_consumption""",
)
def flag_changes(spark, d):
    return readiness.flag_changes(subscribers(spark, d), flagged(spark, d))


@query(
    "breaches",
    f"""WITH {RESULTS_SQL}
SELECT CAST(event_id AS VARCHAR) AS id, 'c' || CAST(user_id AS VARCHAR) AS contract_id, 'slo_breach' AS event_type, 'freshness' AS subject
FROM events WHERE event_id % 5 = 1 AND value > 20 AND CAST(ts AS DATE) = DATE '{DAY}'
UNION ALL
SELECT id, contract_id, 'test_failure', test_id FROM results WHERE status = 'fail' AND CAST(run_timestamp AS DATE) = DATE '{DAY}'""",
)
def breaches(spark, d):
    results, slos, _, _ = day_logs(spark, d)
    return readiness.breaches(slos, results, DAY, test_failure=True)


@query(
    "retention_keep",
    f"""WITH {RESULTS_SQL} SELECT id, test_id, status, run_timestamp FROM results
WHERE run_timestamp >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY""",
)
def retention_keep(spark, d):
    return storage.retain(result_log(spark, d), "run_timestamp", 7, AS_OF).select("id", "test_id", "status", "run_timestamp")


@query(
    "archive_split",
    f"""WITH {RESULTS_SQL} SELECT CASE WHEN run_timestamp >= TIMESTAMP '{AS_OF}' - INTERVAL 20 DAY THEN 'keep' ELSE 'archive' END AS side,
CAST(run_timestamp AS DATE) AS day, count(*) AS n FROM results GROUP BY 1, 2""",
)
def archive_split(spark, d):
    keep, old = storage.archive_split(result_log(spark, d), "run_timestamp", 20, AS_OF)
    both = keep.withColumn("side", F.lit("keep")).unionByName(old.withColumn("side", F.lit("archive")))
    return both.groupBy("side", F.to_date("run_timestamp").alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "find_results",
    f"""WITH {RESULTS_SQL} SELECT id, model_name, test_type, status, run_timestamp FROM results
WHERE test_type = 'unique' AND status = 'fail' AND CAST(run_timestamp AS DATE) = DATE '2024-01-12'""",
)
def find_results(spark, d):
    hits = reports.find_results(result_log(spark, d), test_type="unique", status="fail", day="2024-01-12")
    return hits.select("id", "model_name", "test_type", "status", "run_timestamp")


@query(
    "severity_totals",
    """SELECT CASE WHEN value > 40 THEN 'critical' WHEN value > 15 THEN 'high' ELSE 'medium' END AS severity, event_id % 3 = 0 AS reviewed_flag, count(*) AS n
FROM events WHERE event_id % 5 = 2 GROUP BY 1, 2""",
)
def severity_totals(spark, d):
    return reports.totals(day_logs(spark, d)[2], ["severity", "reviewed_flag"])


@query(
    "run_summary",
    f"""WITH {RESULTS_SQL}, c AS (SELECT run_id, count(*) FILTER (status = 'pass') AS passed, count(*) FILTER (status = 'fail') AS failed,
count(*) FILTER (status = 'skipped') AS skipped, count(*) FILTER (status = 'fail' AND test_type IN ('unique', 'not_null')) AS critical_failed
FROM results GROUP BY 1)
SELECT *, CASE WHEN critical_failed > 0 THEN 2 WHEN failed > 0 THEN 1 ELSE 0 END AS level FROM c""",
)
def run_summary(spark, d):
    return reports.run_summary(result_log(spark, d))
