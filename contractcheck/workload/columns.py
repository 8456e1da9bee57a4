"""Row-level checks, all counters of a table in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractcheck.operators.counters import Check, column_counters, null_profile, null_spike, status_of, to_results
from contractcheck.operators.drift import column_types
from contractcheck.operators.slo import completeness
from contractcheck.operators.values import check_accepted, check_expression
from contractcheck.plans.shared_scan import Probe, measured, table_probes
from contractcheck.workload.base import AS_OF, query, sql_pct2, table

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]

# The test tables have no NULLs; these two columns get some from known values.
ORDERS_SQL = """
orders_gaps AS (
  SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus, o_totalprice, o_orderdate,
         nullif(o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority
  FROM orders)"""


def orders_with_gaps(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"),
        "o_totalprice",
        "o_orderdate",
        F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("o_orderpriority"),
    )


def _per_column(columns: list[str], source: str) -> str:
    """One SQL row of null counts per column."""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS rows_total, count(*) - count({c}) AS null_rows FROM {source}"
        for c in columns
    )


@query(
    "not_null_counts",
    f"""
WITH {ORDERS_SQL}, n AS ({_per_column(ORDER_COLUMNS, "orders_gaps")})
SELECT column_name, rows_total, null_rows AS rows_failed,
       CASE WHEN rows_total = 0 THEN 'unknown' WHEN null_rows = 0 THEN 'pass' ELSE 'fail' END AS status
FROM n""",
)
def not_null_counts(spark, d):
    counts = column_counters(orders_with_gaps(spark, d), [Check(c, "not_null") for c in ORDER_COLUMNS])
    status = status_of(F.col("rows_total"), F.col("rows_failed"))
    return counts.select("column_name", "rows_total", "rows_failed", status.alias("status"))


@query(
    "null_spike",
    f"""
WITH {ORDERS_SQL}, n AS ({_per_column(ORDER_COLUMNS, "orders_gaps")}),
p AS (SELECT *, {sql_pct2("null_rows", "rows_total")} AS null_pct FROM n)
SELECT column_name, 'null_spike' AS quality_check_type,
       CASE WHEN null_pct > 20 THEN 'high' ELSE 'medium' END AS severity, 'fail' AS status,
       'Column ''' || column_name || ''' has ' || CAST(null_pct AS VARCHAR) || '% nulls (threshold: 10%)' AS description,
       '{{"column":"' || column_name || '","null_percentage":' || CAST(null_pct AS VARCHAR) || ',"threshold":10.0}}' AS details_json,
       rows_total, null_rows, null_pct
FROM p WHERE null_pct > 10""",
)
def null_spike_orders(spark, d):
    return null_spike(null_profile(orders_with_gaps(spark, d), ORDER_COLUMNS), threshold=10)


LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
LINE_SQL = """
lines AS (
  SELECT * REPLACE (nullif(l_returnflag, 'N') AS l_returnflag, nullif(l_linenumber, 1) AS l_linenumber,
                    nullif(l_discount, 0.05) AS l_discount) FROM lineitem)"""


def lines_with_gaps(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").withColumns(
        {
            "l_returnflag": F.nullif("l_returnflag", F.lit("N")),
            "l_linenumber": F.nullif("l_linenumber", F.lit(1)),
            "l_discount": F.nullif("l_discount", F.lit(0.05)),
        }
    )


@query(
    "null_profile",
    f"""
WITH {LINE_SQL}, n AS ({_per_column(LINE_COLUMNS, "lines")})
SELECT column_name, rows_total, null_rows, {sql_pct2("null_rows", "rows_total")} AS null_pct,
       {sql_pct2("(rows_total - null_rows)", "rows_total")} AS non_null_pct
FROM n""",
)
def null_profile_lineitem(spark, d):
    return null_profile(lines_with_gaps(spark, d), LINE_COLUMNS).select(
        "column_name", "rows_total", "null_rows", "null_pct", "non_null_pct"
    )


@query(
    "completeness_slo",
    f"""
WITH {ORDERS_SQL}, n AS ({_per_column(ORDER_COLUMNS, "orders_gaps")}),
b AS (SELECT (20000*CAST(rows_total - null_rows AS BIGINT) + rows_total) // (2*rows_total) AS bp FROM n),
s AS (SELECT CAST((2*CAST(sum(bp) AS BIGINT) + count(*)) // (2*count(*)) AS DOUBLE) / 100 AS actual_value FROM b)
SELECT 'completeness' AS metric_type, CAST(99 AS DOUBLE) AS expected_value, actual_value,
       CASE WHEN actual_value >= 99 THEN 'pass' ELSE 'fail' END AS status,
       CASE WHEN actual_value >= 99 THEN 'info' ELSE 'high' END AS severity,
       'mean over 6 required columns' AS details
FROM s""",
)
def completeness_orders(spark, d):
    return completeness(null_profile(orders_with_gaps(spark, d), ORDER_COLUMNS), min_pct=0.99)


CUSTOMER_CHECKS = [
    Check("c_acctbal", "expression_is_true", {"expression": ">= 0"}),
    Check("c_name", "expression_is_true", {"expression": "RLIKE '^Customer#[0-9]{9}$'"}),
    Check("c_mktsegment", "accepted_values", {"values": ["BUILDING", "MACHINERY", "FURNITURE"]}),
    Check("c_mktsegment", "not_accepted_values", {"values": ["AUTOMOBILE"]}),
    Check("c_mktsegment", "length", {"value": 9}),
    Check("c_mktsegment", "max_length", {"value": 8}),
    Check("c_code", "castable", {"type": "bigint"}),
    Check("c_none", "at_least_one"),
    Check("c_name", "at_least_one"),
]


def customers_with_code(spark: SparkSession, d: str) -> DataFrame:
    """``c_code`` is the number in the name, with a letter for some rows."""
    number = F.split_part("c_name", F.lit("#"), F.lit(2))
    return table(spark, d, "customer").withColumns(
        {
            "c_code": F.when(F.col("c_custkey") % 13 == 0, F.concat(F.lit("x"), number)).otherwise(number),
            "c_none": F.nullif("c_custkey", F.col("c_custkey")),
        }
    )


@query(
    "row_checks",
    r"""
WITH t AS (SELECT *, CASE WHEN c_custkey % 13 = 0 THEN 'x' ELSE '' END || split_part(c_name, '#', 2) AS c_code FROM customer)
SELECT CAST(0 AS BIGINT) AS pos, 'c_acctbal' AS column_name, 'expression_is_true' AS check_type, count(*) AS rows_total,
       count(*) FILTER (NOT c_acctbal >= 0) AS rows_failed FROM t
UNION ALL SELECT 1, 'c_name', 'expression_is_true', count(*), count(*) FILTER (NOT regexp_matches(c_name, '^Customer#[0-9]{9}$')) FROM t
UNION ALL SELECT 2, 'c_mktsegment', 'accepted_values', count(*),
       count(*) FILTER (c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'FURNITURE')) FROM t
UNION ALL SELECT 3, 'c_mktsegment', 'not_accepted_values', count(*), count(*) FILTER (c_mktsegment IN ('AUTOMOBILE')) FROM t
UNION ALL SELECT 4, 'c_mktsegment', 'length', count(*), count(*) FILTER (length(c_mktsegment) <> 9) FROM t
UNION ALL SELECT 5, 'c_mktsegment', 'max_length', count(*), count(*) FILTER (length(c_mktsegment) > 8) FROM t
UNION ALL SELECT 6, 'c_code', 'castable', count(*), count(*) FILTER (TRY_CAST(c_code AS BIGINT) IS NULL) FROM t
UNION ALL SELECT 7, 'c_none', 'at_least_one', count(*), 1 FROM t
UNION ALL SELECT 8, 'c_name', 'at_least_one', count(*), 0 FROM t""",
)
def row_checks(spark, d):
    counts = column_counters(customers_with_code(spark, d), CUSTOMER_CHECKS)
    return counts.select(F.col("pos").cast("bigint").alias("pos"), "column_name", "check_type", "rows_total", "rows_failed")


@query(
    "accepted_values",
    "SELECT o_orderstatus AS value, count(*) AS rows_failed FROM orders WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY 1",
)
def accepted_values(spark, d):
    return check_accepted(table(spark, d, "orders"), "o_orderstatus", ["F", "O"])


@query(
    "not_accepted_values",
    """SELECT o_orderpriority AS value, count(*) AS rows_failed FROM orders
WHERE o_orderpriority IN ('1-URGENT', '5-LOW') GROUP BY 1""",
)
def not_accepted_values(spark, d):
    return check_accepted(table(spark, d, "orders"), "o_orderpriority", ["1-URGENT", "5-LOW"], negate=True)


@query("expression_is_true", "SELECT c_custkey, c_acctbal FROM customer WHERE NOT (c_acctbal >= 0)")
def expression_is_true(spark, d):
    return check_expression(table(spark, d, "customer"), "c_acctbal >= 0").select("c_custkey", "c_acctbal")


@query(
    "regex_check",
    """SELECT page_id, url FROM pages WHERE NOT regexp_matches(url, '^https://[a-z.]+/[a-z]{2}/[0-9]+$')""",
)
def regex_check(spark, d):
    return check_expression(table(spark, d, "pages"), "url RLIKE '^https://[a-z.]+/[a-z]{2}/[0-9]+$'").select("page_id", "url")


@query(
    "text_lengths",
    """
SELECT 'text' AS column_name, 'max_length' AS check_type, count(*) AS rows_total,
       count(*) FILTER (length(text) > 2000) AS rows_failed FROM documents
UNION ALL SELECT 'lang', 'length', count(*), count(*) FILTER (length(lang) <> 2) FROM documents
UNION ALL SELECT 'source', 'length', count(*), count(*) FILTER (length(source) <> 4) FROM documents""",
)
def text_lengths(spark, d):
    checks = [
        Check("text", "max_length", {"value": 2000}),
        Check("lang", "length", {"value": 2}),
        Check("source", "length", {"value": 4}),
    ]
    return column_counters(table(spark, d, "documents"), checks).select(
        "column_name", "check_type", "rows_total", "rows_failed"
    )


@query(
    "type_mismatch",
    """
WITH t AS (SELECT json_extract_string(props, '$.k') AS k, event_type, CAST(value AS VARCHAR) AS v FROM events)
SELECT 'k' AS column_name, count(*) AS rows_total,
       count(*) FILTER (k IS NOT NULL AND TRY_CAST(k AS BIGINT) IS NULL) AS rows_failed FROM t
UNION ALL SELECT 'event_type', count(*), count(*) FILTER (TRY_CAST(event_type AS DATE) IS NULL) FROM t
UNION ALL SELECT 'v', count(*), count(*) FILTER (TRY_CAST(v AS DOUBLE) IS NULL) FROM t""",
)
def type_mismatch(spark, d):
    rows = table(spark, d, "events").select(
        F.get_json_object("props", "$.k").alias("k"), "event_type", F.col("value").cast("string").alias("v")
    )
    checks = [
        Check("k", "castable", {"type": "bigint"}),
        Check("event_type", "castable", {"type": "date"}),
        Check("v", "castable", {"type": "double"}),
    ]
    return column_counters(rows, checks).select("column_name", "rows_total", "rows_failed")


DECLARED_TYPES = {
    "c_custkey": "bigint",
    "c_name": "varchar(25)",
    "c_nationkey": "integer",
    "c_acctbal": "decimal(18,2)",
    "c_mktsegment": "int",
    "c_phone": "string",
}


@query(
    "column_types",
    """
WITH declared(column_name, declared_type, family) AS (VALUES
  ('c_custkey', 'bigint', 'integer'), ('c_name', 'varchar(25)', 'string'), ('c_nationkey', 'integer', 'integer'),
  ('c_acctbal', 'decimal(18,2)', 'decimal'), ('c_mktsegment', 'int', 'integer'), ('c_phone', 'string', 'string')),
actual AS (
  SELECT column_name, CASE data_type WHEN 'BIGINT' THEN 'integer' WHEN 'INTEGER' THEN 'integer'
         WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'float' END AS family
  FROM information_schema.columns WHERE table_name = 'customer'),
bad AS (
  SELECT count(*) AS rows_total, count(*) FILTER (TRY_CAST(c_mktsegment AS INTEGER) IS NULL) AS seg,
         count(*) FILTER (TRY_CAST(c_acctbal AS DECIMAL(18,2)) IS NULL) AS bal FROM customer)
SELECT d.column_name, d.declared_type, coalesce(a.family = d.family, false) AS type_matches, b.rows_total,
       CASE d.column_name WHEN 'c_mktsegment' THEN b.seg WHEN 'c_acctbal' THEN b.bal WHEN 'c_phone' THEN NULL ELSE 0 END AS rows_failed
FROM declared d LEFT JOIN actual a USING (column_name) CROSS JOIN bad b""",
)
def declared_types(spark, d):
    """Declared against real types, and how many values would survive the cast."""
    customer = table(spark, d, "customer")
    counts = column_counters(customer, [Check(c, "castable", {"type": t}) for c, t in DECLARED_TYPES.items()])
    declared = F.create_map(*[F.lit(x) for kv in DECLARED_TYPES.items() for x in kv])
    good = [name for name, _, _, same in column_types(customer, DECLARED_TYPES) if same]
    return counts.select(
        "column_name",
        declared[F.col("column_name")].alias("declared_type"),
        F.col("column_name").isin(*good).alias("type_matches"),
        "rows_total",
        "rows_failed",
    )


ORDER_CHECKS = [Check(c, "not_null") for c in ORDER_COLUMNS] + [
    Check("o_orderstatus", "accepted_values", {"values": ["F", "O"]}),
    Check("o_totalprice", "expression_is_true", {"expression": "> 1000"}),
    Check("o_orderpriority", "max_length", {"value": 8}),
    Check("o_clerk", "not_null"),
]


@query(
    "orders_contract_results",
    f"""
WITH {ORDERS_SQL}, n AS (
{_per_column(ORDER_COLUMNS, "orders_gaps").replace("null_rows FROM", "rows_failed, 'not_null' AS check_type FROM")}
UNION ALL SELECT 'o_orderstatus', count(*), count(*) FILTER (o_orderstatus NOT IN ('F', 'O')), 'accepted_values' FROM orders_gaps
UNION ALL SELECT 'o_totalprice', count(*), count(*) FILTER (NOT o_totalprice > 1000), 'expression_is_true' FROM orders_gaps
UNION ALL SELECT 'o_orderpriority', count(*), count(*) FILTER (length(o_orderpriority) > 8), 'max_length' FROM orders_gaps
UNION ALL SELECT 'o_clerk', count(*), NULL, 'not_null' FROM orders_gaps)
SELECT 'sales/orders' AS contract_id, 'sales/orders' AS model_id, 'orders' AS table_name, column_name, check_type,
       CASE WHEN rows_failed IS NULL THEN 'error' WHEN rows_failed = 0 THEN 'pass' ELSE 'fail' END AS status,
       'error' AS severity, rows_total, rows_failed, CAST(0 AS DOUBLE) AS expected_value,
       CAST(rows_failed AS DOUBLE) AS actual_value,
       '{{"column_name":"' || column_name || '","check_type":"' || check_type || '"'
         || CASE WHEN rows_failed IS NULL THEN '' ELSE ',"rows_failed":' || CAST(rows_failed AS VARCHAR) END || '}}' AS details,
       TIMESTAMP '{AS_OF}' AS as_of
FROM n""",
)
def orders_contract_results(spark, d):
    """The common result rows of one table's agreement, from one scan."""
    counts = column_counters(orders_with_gaps(spark, d), ORDER_CHECKS)
    return to_results(counts, AS_OF, "orders", "sales/orders", "sales/orders")


INVALID_PROBES = {
    "parts": [
        Check("p_partkey", "not_null"),
        Check("size_text", "expression_is_true", {"expression": "> 0"}),
        Check("p_name", "not_null"),
        Check("size_text", "max_length", {"value": 2}),
        Check("p_retailprice", "expression_is_true", {"expression": "> 1000"}),
    ],
    "customers": [Check("c_acctbal", "expression_is_true", {"expression": "< 0"}), Check("c_name", "expression_is_true", {"expression": "= 1"})],
}


@query(
    "invalid_checks",
    """
WITH p AS (SELECT *, CASE WHEN p_size % 10 = 3 THEN 'oops' ELSE CAST(p_size AS VARCHAR) END AS size_text FROM part),
n AS (
  SELECT 'parts' AS table_name, 'p_partkey' AS column_name, 'not_null' AS check_type, count(*) AS rows_total, count(*) FILTER (p_partkey IS NULL) AS rows_failed, NULL AS reason FROM p
  UNION ALL SELECT 'parts', 'size_text', 'expression_is_true', NULL, NULL, 'CAST_INVALID_INPUT'
  UNION ALL SELECT 'parts', 'p_name', 'not_null', count(*), count(*) FILTER (p_name IS NULL), NULL FROM p
  UNION ALL SELECT 'parts', 'size_text', 'max_length', count(*), count(*) FILTER (length(size_text) > 2), NULL FROM p
  UNION ALL SELECT 'parts', 'p_retailprice', 'expression_is_true', count(*), count(*) FILTER (NOT p_retailprice > 1000), NULL FROM p
  UNION ALL SELECT 'parts', NULL, 'table', count(*), 0, NULL FROM p
  UNION ALL SELECT 'customers', 'c_acctbal', 'expression_is_true', count(*), count(*) FILTER (NOT c_acctbal < 0), NULL FROM customer
  UNION ALL SELECT 'customers', 'c_name', 'expression_is_true', NULL, NULL, 'CAST_INVALID_INPUT'
  UNION ALL SELECT 'customers', NULL, 'table', count(*), 0, NULL FROM customer)
SELECT table_name, column_name, check_type, rows_total, rows_failed, reason,
       CASE WHEN rows_failed IS NULL THEN 'error' WHEN rows_total = 0 THEN 'unknown' WHEN rows_failed = 0 THEN 'pass' ELSE 'fail' END AS status FROM n""",
)
def invalid_checks(spark, d):
    """Checks that fail while they run stand as errors with their reason; all others of both tables are counted."""
    size = F.when(F.col("p_size") % 10 == 3, "oops").otherwise(F.col("p_size").cast("string"))
    tables = {"parts": table(spark, d, "part").withColumn("size_text", size), "customers": table(spark, d, "customer")}
    probes = [Probe(name, f"{name}/{i}", k) for name, checks in INVALID_PROBES.items() for i, k in enumerate(checks)]
    probes += [p for name in tables for p in table_probes(name, with_moment=False)]
    rows = measured(spark, tables, probes)
    shown = F.regexp_extract("reason", r"\[([A-Z_]+)", 1)
    return rows.select("table_name", "column_name", "check_type", "rows_total", "rows_failed", shown.alias("reason"), status_of(F.col("rows_total"), F.col("rows_failed")).alias("status"))
