"""Uniqueness, references, coverage and cardinality."""

from __future__ import annotations

from pyspark.sql import functions as F

from contractcheck.operators import keys
from contractcheck.workload.base import query, sql_pct2, table

UNIQUE_SQL = """
WITH k AS (SELECT {keys}, count(*) AS n FROM {table} GROUP BY ALL)
SELECT CAST(sum(n) AS BIGINT) AS rows_total, count(*) AS keys_total, count(*) FILTER (n > 1) AS rows_failed,
       CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS duplicate_rows FROM k"""


@query("unique_key", UNIQUE_SQL.format(keys="text", table="documents"))
def unique_key(spark, d):
    return keys.check_unique(table(spark, d, "documents"), ["text"], digest=True)


@query("unique_composite", UNIQUE_SQL.format(keys="l_orderkey, l_linenumber", table="lineitem"))
def unique_composite(spark, d):
    return keys.check_unique(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


KEY_SETS = [["l_orderkey", "l_linenumber"], ["l_partkey"], ["l_suppkey", "l_partkey", "l_orderkey"], ["l_returnflag"], ["l_orderkey", "l_linenumber"]]
MANY_SQL = "\nUNION ALL\n".join(f"SELECT {i} AS pos, * FROM ({UNIQUE_SQL.format(keys=', '.join(k), table='lineitem')})" for i, k in enumerate(KEY_SETS))


@query("unique_many_keys", MANY_SQL)
def unique_many_keys(spark, d):
    """Five declared keys of one table, one scan and one shuffle."""
    return keys.check_unique_many(table(spark, d, "lineitem"), KEY_SETS)


@query(
    "duplicate_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS rows_per_key FROM lineitem
GROUP BY 1, 2 HAVING count(*) > 1""",
)
def duplicate_keys(spark, d):
    return keys.duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "relationships",
    """
SELECT count(*) AS rows_total, count(*) FILTER (l.doc_id IS NULL) AS rows_failed,
       count(DISTINCT CASE WHEN l.doc_id IS NULL THEN d.doc_id END) AS keys_failed
FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id)""",
)
def relationships(spark, d):
    return keys.check_relationship(table(spark, d, "documents"), ["doc_id"], table(spark, d, "labels"), ["doc_id"])


LINES_SQL = """
WITH parents AS (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
SELECT count(*) AS rows_total, count(*) FILTER (NOT EXISTS (SELECT 1 FROM parents WHERE o_orderkey = l_orderkey)) AS rows_failed,
       count(DISTINCT l_orderkey) FILTER (NOT EXISTS (SELECT 1 FROM parents WHERE o_orderkey = l_orderkey)) AS keys_failed
FROM lineitem"""


@query("relationships_lineitem", LINES_SQL)
def relationships_lineitem(spark, d):
    parents = table(spark, d, "orders").filter("o_orderstatus <> 'P'")
    return keys.check_relationship(table(spark, d, "lineitem"), ["l_orderkey"], parents, ["o_orderkey"])


@query("relationships_filtered", LINES_SQL)
def relationships_filtered(spark, d):
    """The same check with the orders' keys as broadcast bitmaps: lines with an order are not shuffled."""
    parents = table(spark, d, "orders").filter("o_orderstatus <> 'P'")
    return keys.check_relationship_by_bitmap(table(spark, d, "lineitem"), ["l_orderkey"], parents, ["o_orderkey"])


@query(
    "orphan_keys",
    """
SELECT l_partkey, count(*) AS rows_per_key FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size > 10) GROUP BY 1""",
)
def orphan_keys(spark, d):
    parents = table(spark, d, "part").filter("p_size > 10")
    return keys.orphan_keys(table(spark, d, "lineitem"), ["l_partkey"], parents, ["p_partkey"])


@query(
    "coverage_slo",
    f"""
WITH c AS (SELECT count(*) AS rows_total, count(*) FILTER (EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)) AS covered
           FROM (SELECT DISTINCT doc_id FROM documents) d),
p AS (SELECT *, {sql_pct2("covered", "rows_total")} AS actual_value FROM c)
SELECT rows_total, covered, CAST(99 AS DOUBLE) AS expected_value, actual_value,
       CASE WHEN actual_value >= 99 THEN 'pass' ELSE 'fail' END AS status FROM p""",
)
def coverage_slo(spark, d):
    return keys.coverage(table(spark, d, "documents"), ["doc_id"], table(spark, d, "labels"), ["doc_id"], 99)


@query(
    "join_report",
    """
WITH a AS (SELECT c_custkey AS k, count(*) AS l FROM customer WHERE c_acctbal > 0 GROUP BY 1),
b AS (SELECT o_custkey AS k, count(*) AS r FROM orders GROUP BY 1),
j AS (SELECT a.l, b.r FROM a FULL JOIN b USING (k))
SELECT CAST(coalesce(sum(l) FILTER (r IS NOT NULL), 0) AS BIGINT) AS left_matched,
       CAST(coalesce(sum(l) FILTER (r IS NULL), 0) AS BIGINT) AS left_unmatched,
       CAST(coalesce(sum(r) FILTER (l IS NOT NULL), 0) AS BIGINT) AS right_matched,
       CAST(coalesce(sum(r) FILTER (l IS NULL), 0) AS BIGINT) AS right_unmatched,
       (SELECT count(*) FROM customer JOIN orders ON c_custkey = o_custkey WHERE c_acctbal > 0) AS joined_rows,
       max(r) FILTER (l IS NOT NULL) AS max_fan_out
FROM j""",
)
def join_report(spark, d):
    active = table(spark, d, "customer").filter("c_acctbal > 0")
    return keys.join_report(active, ["c_custkey"], table(spark, d, "orders"), ["o_custkey"])


@query(
    "equal_rowcount",
    """SELECT (SELECT count(*) FROM orders) AS left_rows, (SELECT count(*) FROM lineitem) AS right_rows,
CASE WHEN (SELECT count(*) FROM orders) = (SELECT count(*) FROM lineitem) THEN 'pass' ELSE 'fail' END AS status""",
)
def equal_rowcount(spark, d):
    return keys.equal_rowcount(table(spark, d, "orders"), table(spark, d, "lineitem"))


@query(
    "cardinality_equality",
    """
WITH a AS (SELECT o_orderkey % 1000 AS k, count(*) AS left_rows FROM orders GROUP BY 1),
b AS (SELECT l_orderkey % 1000 AS k, count(DISTINCT l_orderkey) AS right_rows FROM lineitem GROUP BY 1)
SELECT k, coalesce(left_rows, 0) AS left_rows, coalesce(right_rows, 0) AS right_rows
FROM a FULL JOIN b USING (k) WHERE coalesce(left_rows, 0) <> coalesce(right_rows, 0)""",
)
def cardinality_equality(spark, d):
    orders = table(spark, d, "orders").select((F.col("o_orderkey") % 1000).alias("k"))
    lines = table(spark, d, "lineitem").select("l_orderkey").distinct().select((F.col("l_orderkey") % 1000).alias("k"))
    return keys.cardinality_equality(orders, ["k"], lines, ["k"])
