"""Quantiles, outliers, ranges, sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from contractcheck.operators import values
from contractcheck.operators.ordered import with_prior
from contractcheck.workload.base import AS_OF, query, table


def _quartiles(group: str, value: str, source: str) -> str:
    """Oracle CTEs ``ranked`` and ``q``: quartiles by row number."""
    def at(p: int, offset: int) -> str:
        return f"max({value}) FILTER (rn = ((n - 1) * {p}) // 100 + {offset} + 1)"

    def point(p: int) -> str:
        low = at(p, 0)
        high = f"coalesce({at(p, 1)}, {low})"
        return f"{low} + ({high} - {low}) * ((((max(n) - 1) * {p}) % 100) / 100.0::DOUBLE)"

    return f"""
ranked AS (SELECT {group}, {value}, row_number() OVER (PARTITION BY {group} ORDER BY {value}) AS rn,
                  count(*) OVER (PARTITION BY {group}) AS n FROM {source}),
q AS (SELECT {group}, count(*) AS n_values, {point(25)} AS p25, {point(50)} AS p50, {point(75)} AS p75
      FROM ranked GROUP BY {group})"""


@query(
    "group_quantiles",
    f"WITH {_quartiles('l_returnflag', 'l_extendedprice', 'lineitem')} SELECT l_returnflag, n_values, p25, p50, p75 FROM q",
)
def group_quantiles(spark, d):
    return values.group_quantiles(table(spark, d, "lineitem"), ["l_returnflag"], "l_extendedprice", (25, 50, 75))


@query(
    "group_quantiles_decimal",
    f"""
WITH v AS (SELECT CASE WHEN l_linenumber < 5 THEN 'common' ELSE l_linestatus END AS kind,
                  CAST(l_extendedprice AS DECIMAL(12,2)) AS price FROM lineitem),
{_quartiles('kind', 'price', 'v')} SELECT kind, n_values, CAST(p25 AS DOUBLE) AS p25, CAST(p50 AS DOUBLE) AS p50, CAST(p75 AS DOUBLE) AS p75 FROM q""",
)
def group_quantiles_decimal(spark, d):
    """Decimal values; one group holds more than half of the rows and is cut into slices."""
    kind = F.when(F.col("l_linenumber") < 5, "common").otherwise(F.col("l_linestatus"))
    prices = table(spark, d, "lineitem").select(kind.alias("kind"), F.col("l_extendedprice").cast("decimal(12,2)").alias("price"))
    return values.group_quantiles(prices, ["kind"], "price", (25, 50, 75), slices=8)


@query(
    "sequence_text",
    """
WITH k AS (SELECT p_brand, concat('part#', lpad(CAST(p_partkey AS VARCHAR), 9, '0'), '/', p_type) AS code FROM part),
s AS (SELECT p_brand, code, lag(code) OVER (PARTITION BY p_brand ORDER BY code) AS before FROM k)
SELECT p_brand, count(*) AS rows_total, count(before) AS rows_after_another, min(code) AS first_code, max(before) AS last_but_one
FROM s GROUP BY 1""",
)
def sequence_text(spark, d):
    """Text keys with a long common prefix, cut into slices by the text itself."""
    code = F.concat(F.lit("part#"), F.lpad(F.col("p_partkey").cast("string"), 9, "0"), F.lit("/"), F.col("p_type"))
    parts = table(spark, d, "part").select("p_brand", code.alias("code"))
    seen = with_prior(parts, ["p_brand"], ["code"], maxima={"before": F.col("code")}, slices=8)
    return seen.groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("rows_total"), F.count("before").alias("rows_after_another"), F.min("code").alias("first_code"), F.max("before").alias("last_but_one")
    )


@query(
    "outlier_iqr",
    f"""
WITH {_quartiles('event_type', 'value', 'events')},
f AS (SELECT event_type, n_values, p25 - (p75 - p25) * 1.5::DOUBLE AS lower_fence, p75 + (p75 - p25) * 1.5::DOUBLE AS upper_fence FROM q)
SELECT event_type, any_value(n_values) AS n_values, any_value(lower_fence) AS lower_fence, any_value(upper_fence) AS upper_fence,
       count(*) FILTER (value < lower_fence OR value > upper_fence) AS outlier_rows
FROM events JOIN f USING (event_type) GROUP BY event_type""",
)
def outlier_iqr(spark, d):
    return values.outliers_iqr(table(spark, d, "events"), ["event_type"], "value")


@query(
    "outlier_z",
    """
WITH v AS (SELECT event_type, value AS v FROM events WHERE value IS NOT NULL),
s AS (SELECT event_type, count(*) AS n, avg(v) AS mean, stddev_samp(v) AS sd FROM v GROUP BY 1)
SELECT event_type, any_value(n) AS n_values, count(*) FILTER (abs(CAST(v AS DOUBLE) - mean) > sd * 3) AS outlier_rows
FROM v JOIN s USING (event_type) GROUP BY event_type""",
)
def outlier_z(spark, d):
    return values.outliers_z(table(spark, d, "events"), ["event_type"], "value", limit=3.0)


@query(
    "outlier_z_small_values",
    """
WITH v AS (SELECT l_returnflag, l_discount * l_tax / 1000 AS v FROM lineitem),
s AS (SELECT l_returnflag, count(*) AS n, avg(v) AS mean, stddev_samp(v) AS sd FROM v GROUP BY 1)
SELECT l_returnflag, any_value(n) AS n_values, count(*) FILTER (abs(v - mean) > sd * 2) AS outlier_rows
FROM v JOIN s USING (l_returnflag) GROUP BY l_returnflag""",
)
def outlier_z_small_values(spark, d):
    """Values far below a hundredth are judged like any others."""
    small = table(spark, d, "lineitem").select("l_returnflag", (F.col("l_discount") * F.col("l_tax") / 1000).alias("v"))
    return values.outliers_z(small, ["l_returnflag"], "v", limit=2.0)


@query(
    "mutually_exclusive_ranges",
    """
WITH r AS (SELECT o_custkey, o_orderdate AS lo, o_orderdate + to_days(CAST(o_orderkey % 120 AS INTEGER)) AS hi FROM orders),
s AS (SELECT o_custkey, lo, max(hi) OVER (PARTITION BY o_custkey ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM r)
SELECT o_custkey, count(*) AS rows_total, count(*) FILTER (reach > lo) AS rows_failed FROM s GROUP BY 1""",
)
def mutually_exclusive_ranges(spark, d):
    days = F.make_dt_interval((F.col("o_orderkey") % 120).cast("int"))
    ranges = table(spark, d, "orders").select(
        "o_custkey", F.col("o_orderdate").alias("lo"), (F.col("o_orderdate") + days).alias("hi")
    )
    return values.overlapping_ranges(ranges, "lo", "hi", ["o_custkey"])


@query(
    "sequential_values",
    """
WITH s AS (SELECT l_orderkey, l_linenumber, lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS before FROM lineitem)
SELECT l_orderkey, count(*) AS rows_total, count(*) FILTER (before IS NOT NULL AND l_linenumber <> before + 1) AS rows_failed
FROM s GROUP BY 1""",
)
def sequential_values(spark, d):
    return values.sequence_breaks(table(spark, d, "lineitem"), "l_linenumber", 1, ["l_orderkey"])


@query(
    "sequence_whole_table",
    """
WITH s AS (SELECT event_id, lag(event_id) OVER (ORDER BY event_id) AS before FROM events WHERE event_type <> 'error')
SELECT count(*) AS rows_total, count(*) FILTER (before IS NOT NULL AND event_id <> before + 1) AS rows_failed FROM s""",
)
def sequence_whole_table(spark, d):
    return values.sequence_breaks(table(spark, d, "events").filter("event_type <> 'error'"), "event_id")


@query(
    "recency",
    f"""
WITH m AS (SELECT max(ts) AS latest FROM events),
a AS (SELECT latest, CAST((200 * date_diff('microsecond', latest, TIMESTAMP '{AS_OF}') + 3600000000) // 7200000000 AS DOUBLE) / 100 AS age_hours FROM m)
SELECT latest, age_hours, CASE WHEN age_hours <= 24 THEN 'pass' ELSE 'fail' END AS status FROM a""",
)
def recency(spark, d):
    return values.recency(table(spark, d, "events"), "ts", 24, AS_OF)
