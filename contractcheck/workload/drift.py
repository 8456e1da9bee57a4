"""Drift of fields per table.

Each user plays a table: the fields seen before mid-January are the declared ones,
the fields seen after are the real ones. Fields of one event type are system fields.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractcheck.operators import drift
from contractcheck.workload.base import query, table

SPLIT = "2024-01-16 00:00:00"

FIELDS_SQL = f"""
fields AS (
  SELECT 't' || CAST(user_id AS VARCHAR) AS table_name, ts < TIMESTAMP '{SPLIT}' AS early,
         CASE WHEN event_type = 'view' THEN '_' ELSE '' END || event_type || '_' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 4 AS VARCHAR) AS column_name
  FROM events),
declared AS (SELECT DISTINCT table_name, column_name FROM fields WHERE early),
actual AS (SELECT DISTINCT table_name, column_name FROM fields WHERE NOT early),
diff AS (
  SELECT table_name, 'missing' AS diff_type, column_name FROM (SELECT * FROM declared EXCEPT SELECT * FROM actual)
  UNION ALL
  SELECT table_name, 'extra', column_name FROM (SELECT * FROM actual EXCEPT SELECT * FROM declared)
  WHERE table_name IN (SELECT table_name FROM declared))"""


def fields(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    k = F.get_json_object("props", "$.k").cast("bigint") % 4
    name = F.concat(
        F.when(F.col("event_type") == "view", F.lit("_")).otherwise(F.lit("")), "event_type", F.lit("_"), k.cast("string")
    )
    seen = table(spark, d, "events").select(
        F.concat(F.lit("t"), F.col("user_id").cast("string")).alias("table_name"), name.alias("column_name"), "ts"
    )
    split = F.lit(SPLIT).cast("timestamp_ntz")
    early, late = seen.filter(F.col("ts") < split), seen.filter(F.col("ts") >= split)
    return early.drop("ts"), late.drop("ts")


@query("schema_diff", f"WITH {FIELDS_SQL} SELECT table_name, diff_type, column_name FROM diff")
def schema_diff(spark, d):
    return drift.schema_diff(*fields(spark, d))


@query(
    "schema_missing",
    f"WITH {FIELDS_SQL} SELECT table_name, column_name AS missing_column FROM diff WHERE diff_type = 'missing'",
)
def schema_missing(spark, d):
    return drift.missing_columns(*fields(spark, d))


@query(
    "schema_drift",
    f"""
WITH {FIELDS_SQL}
SELECT table_name, column_name, 'schema_drift' AS quality_check_type,
       CASE diff_type WHEN 'missing' THEN 'high' ELSE 'medium' END AS severity,
       CASE diff_type WHEN 'missing' THEN 'fail' ELSE 'warning' END AS status,
       'Column ''' || column_name || CASE diff_type WHEN 'missing' THEN ''' in contract but missing from table'
            ELSE ''' in table but not in contract' END AS description,
       '{{"issue_type":"' || diff_type || '_column","column":"' || column_name || '"}}' AS details_json
FROM diff WHERE diff_type = 'missing' OR NOT starts_with(column_name, '_')""",
)
def schema_drift(spark, d):
    return drift.schema_drift(*fields(spark, d))
