"""One agreement from scan to readiness."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractcheck.functions.lineage import settled
from contractcheck.functions.numbers import ntz
from contractcheck.operators import readiness, slo
from contractcheck.operators.counters import column_counters, null_spike, profile_from_counts, to_results
from contractcheck.operators.lookups import union_all
from contractcheck.schemas import RESULT, conform
from contractcheck.workload.base import AS_OF, query, table
from contractcheck.workload.columns import ORDER_CHECKS, ORDER_COLUMNS, ORDERS_SQL, _per_column, orders_with_gaps

CONTRACT = "sales/orders"
DAY = AS_OF[:10]


def result_rows(spark: SparkSession, d: str) -> DataFrame:
    """Checks, null spikes and completeness of ``orders`` in the result layout.

    The table is read once; the few counter rows are kept and feed everything else.
    """
    counts = settled(column_counters(orders_with_gaps(spark, d), ORDER_CHECKS))
    profile = profile_from_counts(counts)
    base = {"contract_id": CONTRACT, "model_id": CONTRACT, "table_name": "orders"}
    fixed = {k: F.lit(v) for k, v in base.items()} | {"as_of": ntz(AS_OF)}
    spikes = null_spike(profile).select(
        "*", F.col("quality_check_type").alias("check_type"), F.col("null_rows").alias("rows_failed"),
        F.lit(10.0).alias("expected_value"), F.col("null_pct").alias("actual_value"), F.col("details_json").alias("details"),
    )
    levels = slo.completeness(profile, 0.99).withColumnRenamed("metric_type", "check_type")
    return union_all(
        [
            to_results(counts, AS_OF, "orders", CONTRACT, CONTRACT),
            conform(spikes.withColumns(fixed), RESULT),
            conform(levels.withColumns(fixed), RESULT),
        ]
    )


FLAGSHIP_SQL = f"""
WITH {ORDERS_SQL}, n AS ({_per_column(ORDER_COLUMNS, "orders_gaps")}),
f AS (
  SELECT count(*) FILTER (null_rows > 0)
       + (SELECT CAST(bool_or(o_orderstatus NOT IN ('F', 'O')) AS INTEGER) + CAST(bool_or(NOT o_totalprice > 1000) AS INTEGER)
               + CAST(bool_or(length(o_orderpriority) > 8) AS INTEGER) FROM orders_gaps) AS tests,
         sum((20000*CAST(rows_total - null_rows AS BIGINT) + rows_total) // (2*rows_total)) AS points FROM n),
r AS (SELECT concat_ws('; ', CASE WHEN tests > 0 THEN 'Tests failing: ' || CAST(tests AS VARCHAR) || ' failures' END,
                       CASE WHEN points < 6 * 9900 THEN 'SLOs failing: 1 failures' END) AS reason FROM f)
SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS subscriber_name,
       CASE WHEN n_nationkey % 5 = 0 THEN '[]' ELSE '["{CONTRACT}", "sales/other"]' END AS watching_contract_ids_json,
       n_nationkey % 5 <> 0 AND reason = '' AS ready_for_consumption,
       CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE '{CONTRACT}: ' || CASE WHEN reason = '' THEN 'Ready' ELSE reason END || '; sales/other: Ready' END
         AS ready_for_consumption_reason
FROM nation, r"""


@query("orders_readiness", FLAGSHIP_SQL)
def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Nations as consumers of the agreement: one row per nation with its flag."""
    rows = settled(result_rows(spark, d))
    levels = ("freshness", "completeness", "availability", "accuracy")
    checks = rows.filter(~F.col("check_type").isin("null_spike", *levels))
    tests = checks.select("contract_id", "status", F.col("as_of").alias("run_timestamp"))
    slos = rows.filter(F.col("check_type").isin(*levels)).select(
        "contract_id", "status", F.col("as_of").alias("measurement_ts")
    )
    issues = rows.filter(F.col("check_type") == "null_spike").select(
        "model_id", "severity", F.lit(False).alias("reviewed_flag"), F.col("as_of").alias("detected_at")
    )
    models = spark.createDataFrame([(CONTRACT, CONTRACT)], "id string, contract_id string")
    status = readiness.contract_status(tests, slos, issues, models, DAY)
    nations = table(spark, d, "nation").select(
        F.col("n_nationkey").cast("string").alias("id"),
        F.col("n_name").alias("subscriber_name"),
        F.when(F.col("n_nationkey") % 5 == 0, F.lit("[]")).otherwise(F.lit(f'["{CONTRACT}", "sales/other"]')).alias(
            "watching_contract_ids_json"
        ),
        F.lit(False).alias("ready_for_consumption"),
        F.lit(None).cast("string").alias("ready_for_consumption_reason"),
    )
    return readiness.readiness(status, nations, AS_OF)
