"""Service levels over the test tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from contractcheck.operators import keys, slo
from contractcheck.operators.counters import Check, null_profile, profile_from_counts
from contractcheck.operators.lookups import union_all
from contractcheck.plans.shared_scan import Probe, measured, table_probes
from contractcheck.sources.tables import fused_metrics, run_metrics
from contractcheck.workload.base import AS_OF, query, sql_pct2, table
from contractcheck.workload.columns import ORDER_COLUMNS, ORDERS_SQL, _per_column, orders_with_gaps

HOURS_SQL = "CAST((200 * date_diff('microsecond', latest, TIMESTAMP '{as_of}') + 3600000000) // 7200000000 AS DOUBLE) / 100"

FRESHNESS_SQL = f"""
latest AS (
  SELECT 1 AS i, max(ts) AS latest, 24 AS max_hours FROM events
  UNION ALL SELECT 2, max(ts), 24 FROM events WHERE event_type = 'error' AND user_id % 2 = 0
  UNION ALL SELECT 3, max(greatest(o_orderdate, o_orderdate + to_days(CAST(o_orderkey % 9 AS INTEGER)))), 240000 FROM orders
  UNION ALL SELECT 4, NULL, 24),
ages AS (SELECT *, {HOURS_SQL.format(as_of=AS_OF)} AS age FROM latest),
fresh AS (
  SELECT i, 'freshness' AS metric_type, CAST(max_hours AS DOUBLE) AS expected_value, age AS actual_value,
         CASE WHEN age IS NULL THEN 'unknown' WHEN age <= max_hours THEN 'pass' ELSE 'fail' END AS status,
         CASE WHEN age > max_hours THEN 'high' ELSE 'info' END AS severity,
         CASE WHEN age IS NULL THEN 'no timestamp found' ELSE 'latest data is ' || CAST(age AS VARCHAR) || ' hours old' END AS details
  FROM ages)"""


def _fresh(spark, d):
    events, orders = table(spark, d, "events"), table(spark, d, "orders")
    late = F.col("o_orderdate") + F.make_dt_interval((F.col("o_orderkey") % 9).cast("int"))
    frames = [
        slo.freshness(events, ["ts"], 24, AS_OF),
        slo.freshness(events.filter("event_type = 'error' AND user_id % 2 = 0"), ["ts"], 24, AS_OF),
        slo.freshness(orders.withColumn("updated_at", late), ["o_orderdate", "updated_at"], 240000, AS_OF),
        slo.freshness(table(spark, d, "part"), slo.DEFAULT_TIMESTAMP_COLUMNS, 24, AS_OF),
    ]
    return [f.withColumn("i", F.lit(i).cast("bigint")) for i, f in enumerate(frames, 1)]


@query(
    "freshness_slo",
    f"WITH {FRESHNESS_SQL} SELECT CAST(i AS BIGINT) AS i, metric_type, expected_value, actual_value, status, severity, details FROM fresh",
)
def freshness_slo(spark, d):
    return union_all(_fresh(spark, d))


@query(
    "availability_slo",
    """
SELECT 'availability' AS metric_type, 99.9::DOUBLE AS expected_value, 100.0::DOUBLE AS actual_value, 'pass' AS status,
       'info' AS severity, 'table is accessible with ' || CAST(count(*) AS VARCHAR) || ' rows' AS details FROM lineitem
UNION ALL
SELECT 'availability', 99.9::DOUBLE, 0.0::DOUBLE, 'fail', 'critical', 'table not accessible: AnalysisException'""",
)
def availability_slo(spark, d):
    return slo.availability(spark, f"{d}/lineitem.parquet").unionByName(slo.availability(spark, f"{d}/no_such_table.parquet"))


@query(
    "accuracy_recon",
    """
WITH s AS (
  SELECT sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS b,
         sum(CAST(l_extendedprice + CASE WHEN l_orderkey % 1000 = 0 THEN 1 ELSE 0 END AS DECIMAL(18,2))) AS a FROM lineitem)
SELECT 'accuracy' AS metric_type, CAST(b AS DOUBLE) AS expected_value, CAST(a AS DOUBLE) AS actual_value,
       CASE WHEN abs(a - b) <= abs(b) * 0.0001 THEN 'pass' ELSE 'fail' END AS status,
       CASE WHEN abs(a - b) <= abs(b) * 0.0001 THEN 'info' ELSE 'high' END AS severity,
       'difference ' || CAST(abs(a - b) AS VARCHAR) AS details
FROM s""",
)
def accuracy_recon(spark, d):
    lines = table(spark, d, "lineitem")
    shifted = F.col("l_extendedprice") + F.when(F.col("l_orderkey") % 1000 == 0, 1).otherwise(0)
    return slo.reconcile(lines, shifted.cast("decimal(18,2)"), lines, F.col("l_extendedprice").cast("decimal(18,2)"), 0.01)


@query(
    "accuracy_recon_small",
    """
WITH s AS (
  SELECT sum(CAST(l_quantity AS DECIMAL(18,0)) * CAST(0.000000000004 AS DECIMAL(14,12))) AS a,
         sum(CAST(l_quantity AS DECIMAL(18,0)) * CAST(0.000000000001 AS DECIMAL(14,12))) AS b FROM lineitem)
SELECT 'accuracy' AS metric_type, CAST(b AS DOUBLE) AS expected_value, CAST(a AS DOUBLE) AS actual_value, 'fail' AS status, 'high' AS severity,
       'difference ' || CAST(a - b AS VARCHAR) AS details
FROM s""",
)
def accuracy_recon_small(spark, d):
    """Sums far below a ten-billionth are compared as they are."""
    lines = table(spark, d, "lineitem")

    def part(share: str):
        return F.col("l_quantity").cast("decimal(18,0)") * F.lit(share).cast("decimal(14,12)")

    return slo.reconcile(lines, part("0.000000000004"), lines, part("0.000000000001"), 0.01)


TARGETS = [
    ("sales/events", "events", 0.5, 0.99999),
    ("sales/events", "events", 1000000.0, 1e-05),
    ("sales/open", "events", None, None),
    ("sales/lines", "lines", 0.25, 0.5),
    ("sales/ghost", "ghost", 1.0, 0.5),
]


@query(
    "run_levels",
    f"""
WITH t(contract_id, model_name, hours, share) AS (VALUES ('sales/events', 'events', 0.5::DOUBLE, 99.999::DOUBLE), ('sales/events', 'events', 1000000, 0.001),
       ('sales/open', 'events', 24, 99), ('sales/lines', 'lines', 0.25, 50)),
f AS (SELECT 'events' AS model_name, max(ts) AS latest, count(*) AS n, 2 AS columns,
        (20000 * count(*) FILTER (user_id % 7 <> 0) + count(*)) // (2 * count(*)) + (20000 * count(value) + count(*)) // (2 * count(*)) AS points FROM events
      UNION ALL SELECT 'lines', NULL, count(*), 0, 0 FROM lineitem),
m AS (SELECT t.*, n, columns, CAST((200 * date_diff('microsecond', latest, TIMESTAMP '{AS_OF}') + 3600000000) // 7200000000 AS DOUBLE) / 100 AS age,
        CASE WHEN columns = 0 THEN 100.0 ELSE CAST((2 * CAST(points AS BIGINT) + columns) // (2 * columns) AS DOUBLE) / 100 END AS pct FROM t JOIN f USING (model_name)),
r AS (
  SELECT contract_id, model_name, 'freshness' AS metric_type, hours AS expected_value, age AS actual_value,
         CASE WHEN age IS NULL THEN 'unknown' WHEN age <= hours THEN 'pass' ELSE 'fail' END AS status FROM m
  UNION ALL SELECT contract_id, model_name, 'completeness', share, pct, CASE WHEN columns = 0 THEN 'unknown' WHEN pct >= share THEN 'pass' ELSE 'fail' END FROM m
  UNION ALL SELECT DISTINCT contract_id, model_name, 'availability', 99.9::DOUBLE, 100.0::DOUBLE, 'pass' FROM m
  UNION ALL SELECT 'sales/ghost', 'ghost', 'availability', 99.9::DOUBLE, 0.0::DOUBLE, 'fail')
SELECT * FROM r""",
)
def run_levels(spark, d):
    """All levels of several agreements out of one scan per table; levels left open take the defaults."""
    events = table(spark, d, "events").select(F.col("ts").alias("updated_at"), F.when(F.col("user_id") % 7 != 0, F.col("user_id")).alias("user_id"), "value")
    probes = [*table_probes("events"), *table_probes("lines")]
    probes += [Probe("events", f"required/{c}", Check(c, "not_null", severity="required")) for c in ("user_id", "value")]
    probes += [replace(p, reason="table is not mapped or readable") for p in table_probes("ghost")]
    counts = measured(spark, {"events": events, "lines": table(spark, d, "lineitem")}, probes, slo.DEFAULT_TIMESTAMP_COLUMNS)
    targets = spark.createDataFrame(TARGETS, "contract_id string, model_name string, freshness_slo_hours double, completeness_slo double")
    profile = profile_from_counts(counts.filter(F.col("severity") == "required"), ("table_name",))
    return slo.levels(slo.filled_targets(targets), counts, profile, AS_OF).drop("severity", "details")


@query(
    "slo_run",
    f"""
WITH {ORDERS_SQL}, {FRESHNESS_SQL},
n AS ({_per_column(ORDER_COLUMNS, "orders_gaps")}),
b AS (SELECT (20000*CAST(rows_total - null_rows AS BIGINT) + rows_total) // (2*rows_total) AS bp FROM n),
c AS (SELECT CAST((2*CAST(sum(bp) AS BIGINT) + count(*)) // (2*count(*)) AS DOUBLE) / 100 AS pct FROM b),
m AS (
  SELECT metric_type, expected_value, actual_value, status, severity, details FROM fresh WHERE i = 3
  UNION ALL SELECT 'completeness', 90.0::DOUBLE, pct, CASE WHEN pct >= 90 THEN 'pass' ELSE 'fail' END,
         CASE WHEN pct >= 90 THEN 'info' ELSE 'high' END, 'mean over 6 required columns' FROM c
  UNION ALL SELECT 'availability', 99.9::DOUBLE, 100.0::DOUBLE, 'pass', 'info', 'table is accessible with ' || CAST(count(*) AS VARCHAR) || ' rows' FROM orders)
SELECT sha256('sales/orders||' || metric_type || '|' || CAST(expected_value AS VARCHAR) || '|{AS_OF}') AS id, 'sales/orders' AS contract_id, metric_type, expected_value,
       actual_value, status, severity, '{{"details":"' || details || '"}}' AS measurement_details_json,
       TIMESTAMP '{AS_OF}' AS measurement_ts, TIMESTAMP '{AS_OF}' AS _inserted_ts
FROM m""",
)
def slo_run(spark, d):
    """All measurements of one agreement as they go to the log."""
    orders = orders_with_gaps(spark, d)
    metrics = union_all(
        [
            _fresh(spark, d)[2].drop("i"),
            slo.completeness(null_profile(orders, ORDER_COLUMNS), 0.9),
            slo.availability(spark, f"{d}/orders.parquet"),
        ]
    )
    return slo.measured(metrics, "sales/orders", AS_OF)


@query(
    "uptime",
    f"""
WITH n AS (SELECT 'c' || CAST(user_id AS VARCHAR) AS contract_id, count(*) AS measurements,
                  count(*) FILTER (event_type <> 'error') AS passing FROM events GROUP BY 1),
p AS (SELECT *, {sql_pct2("passing", "measurements")} AS uptime_pct FROM n)
SELECT contract_id, measurements, passing, uptime_pct, CASE WHEN uptime_pct >= 80 THEN 'pass' ELSE 'fail' END AS status FROM p""",
)
def uptime(spark, d):
    log = table(spark, d, "events").select(
        F.concat(F.lit("c"), F.col("user_id").cast("string")).alias("contract_id"),
        F.lit("availability").alias("metric_type"),
        F.when(F.col("event_type") == "error", "fail").otherwise("pass").alias("status"),
    )
    return slo.uptime(log, 0.80)


METRICS = {
    "large_orders_pct": "SELECT 100.0D * count_if(o_totalprice > 100000) / count(*) AS actual_value FROM sales_orders",
    "priorities": "SELECT CAST(count(DISTINCT o_orderpriority) AS DOUBLE) AS actual_value FROM sales_orders;",
}


@query(
    "custom_metrics",
    """
WITH m AS (
  SELECT 'large_orders_pct' AS metric_type, 100.0::DOUBLE * count(*) FILTER (o_totalprice > 100000) / count(*) AS actual_value FROM orders
  UNION ALL SELECT 'priorities', CAST(count(DISTINCT o_orderpriority) AS DOUBLE) FROM orders)
SELECT metric_type, 50.0::DOUBLE AS expected_value, actual_value, CASE WHEN actual_value >= 50 THEN 'pass' ELSE 'fail' END AS status,
       CASE WHEN actual_value >= 50 THEN 'info' ELSE 'high' END AS severity, 'custom query' AS details FROM m""",
)
def custom_metrics(spark, d):
    table(spark, d, "orders").createOrReplaceTempView("sales_orders")
    return slo.custom_metric(run_metrics(spark, METRICS), 50)


FUSED = METRICS | {
    "average": "SELECT round(avg(CAST(o_totalprice AS DECIMAL(15,2))), 2) AS actual_value FROM sales_orders",
    "open_orders": "SELECT count(*) FILTER (WHERE o_orderstatus = 'O') AS actual_value -- all days\nFROM sales_orders",
    "largest_open": "SELECT max(o_totalprice) AS actual_value FROM sales_orders WHERE o_orderstatus = 'O'",
}


@query(
    "custom_metrics_fused",
    """
SELECT 'large_orders_pct' AS metric_type, 100.0::DOUBLE * count(*) FILTER (o_totalprice > 100000) / count(*) AS actual_value FROM orders
UNION ALL SELECT 'priorities', CAST(count(DISTINCT o_orderpriority) AS DOUBLE) FROM orders
UNION ALL SELECT 'average', (CAST(200 * sum(CAST(o_totalprice AS DECIMAL(15,2))) AS HUGEINT) + count(*)) // (2 * count(*)) / 100.0::DOUBLE FROM orders
UNION ALL SELECT 'open_orders', CAST(count(*) FILTER (o_orderstatus = 'O') AS DOUBLE) FROM orders
UNION ALL SELECT 'largest_open', max(o_totalprice) FROM orders WHERE o_orderstatus = 'O'""",
)
def custom_metrics_fused(spark, d):
    table(spark, d, "orders").createOrReplaceTempView("sales_orders")
    return fused_metrics(spark, FUSED)


@query(
    "entity_coverage",
    f"""
WITH c AS (SELECT count(*) AS rows_total, count(*) FILTER (EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)) AS covered
           FROM customer WHERE c_acctbal > 0),
p AS (SELECT *, {sql_pct2("covered", "rows_total")} AS actual_value FROM c)
SELECT rows_total, covered, 99.0::DOUBLE AS expected_value, actual_value, CASE WHEN actual_value >= 99 THEN 'pass' ELSE 'fail' END AS status FROM p""",
)
def entity_coverage(spark, d):
    active = table(spark, d, "customer").filter("c_acctbal > 0")
    return keys.coverage(active, ["c_custkey"], table(spark, d, "orders"), ["o_custkey"], 99)


@query(
    "latest_moment",
    "SELECT event_type, max(greatest(ts, ts + to_hours(CAST(user_id % 5 AS INTEGER)))) AS latest FROM events GROUP BY 1",
)
def latest_moment(spark, d):
    later = F.col("ts") + F.make_dt_interval(hours=(F.col("user_id") % 5).cast("int"))
    events = table(spark, d, "events").withColumn("updated_at", later)
    newest = slo.newest(events, ["ts", "updated_at", "_updated_ts"])
    return events.groupBy("event_type").agg(newest.alias("latest"))


