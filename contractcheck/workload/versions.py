"""The version log, with ``documents`` as published contents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractcheck.operators import versions
from contractcheck.workload.base import AS_OF, query, table

LOG_SQL = """
log AS (
  SELECT source AS contract_id, 'doc ' || source AS contract_name, CAST(doc_id % 3 AS VARCHAR) || '.' || CAST(doc_id AS VARCHAR) AS version,
         lang AS domain, text AS contract_content, TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(doc_id // 2 AS INTEGER)) AS published_at,
         lang || '-team' AS publisher, doc_id
  FROM documents)"""


def version_log(spark: SparkSession, d: str) -> DataFrame:
    """Two documents share a moment, so the tie-break matters."""
    minutes = F.call_function("div", F.col("doc_id"), F.lit(2)).cast("int")
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return table(spark, d, "documents").select(
        F.col("source").alias("contract_id"),
        F.concat(F.lit("doc "), "source").alias("contract_name"),
        F.concat((F.col("doc_id") % 3).cast("string"), F.lit("."), F.col("doc_id").cast("string")).alias("version"),
        F.col("lang").alias("domain"),
        F.col("text").alias("contract_content"),
        (start + F.make_dt_interval(mins=minutes)).alias("published_at"),
        F.concat("lang", F.lit("-team")).alias("publisher"),
        "doc_id",
    )


@query(
    "content_hash",
    f"WITH {LOG_SQL} SELECT contract_id, version, sha256(contract_content) AS contract_hash, published_at FROM log",
)
def content_hash(spark, d):
    return versions.content_hashes(version_log(spark, d))


@query(
    "content_changes",
    f"""WITH {LOG_SQL}, h AS (SELECT *, sha256(contract_content) AS contract_hash FROM log),
p AS (SELECT *, lag(contract_hash) OVER (PARTITION BY contract_id ORDER BY published_at, doc_id) AS previous_hash FROM h)
SELECT contract_id, version, published_at, contract_hash, previous_hash, coalesce(previous_hash <> contract_hash, false) AS changed FROM p""",
)
def content_changes(spark, d):
    return versions.content_changes(version_log(spark, d), tie_break="doc_id")


@query(
    "latest_version",
    f"""WITH {LOG_SQL} SELECT contract_id, max(published_at) AS last_published_at, max(version) AS latest_version,
arg_max(version, [CAST(split_part(version, '.', 1) AS BIGINT), CAST(split_part(version, '.', 2) AS BIGINT)]) AS highest_version
FROM log GROUP BY 1""",
)
def latest_version(spark, d):
    return versions.latest_versions(version_log(spark, d))


@query(
    "publisher_activity",
    f"""WITH {LOG_SQL} SELECT publisher, count(*) AS contracts_published, min(published_at) AS first_published,
max(published_at) AS last_published FROM log GROUP BY 1 ORDER BY 2 DESC, 1""",
)
def publisher_activity(spark, d):
    return versions.publisher_activity(version_log(spark, d))


@query(
    "recent_published",
    f"""WITH {LOG_SQL} SELECT contract_id, contract_name, version, domain, publisher, published_at FROM log
ORDER BY published_at DESC, contract_id, version LIMIT 100""",
)
def recent_published(spark, d):
    return versions.recent_publications(version_log(spark, d), 100)


@query(
    "publish_new",
    f"""
SELECT lower(c_mktsegment || '_' || c_name) AS contract_id, c_name AS contract_name, CAST(c_nationkey AS VARCHAR) AS version,
       c_mktsegment AS domain, '{{"n":' || CAST(c_nationkey AS VARCHAR) || '}}' AS contract_content,
       TIMESTAMP '{AS_OF}' AS published_at, 'team' AS publisher, TIMESTAMP '{AS_OF}' AS created_at
FROM customer WHERE c_custkey % 3 <> 0""",
)
def publish_new(spark, d):
    """A third of the agreements was published before and is skipped."""
    contracts = table(spark, d, "customer").select(
        "c_custkey",
        F.col("c_name").alias("name"),
        F.col("c_nationkey").cast("string").alias("version"),
        F.col("c_mktsegment").alias("domain"),
        F.concat(F.lit('{"n":'), F.col("c_nationkey").cast("string"), F.lit("}")).alias("contract_json"),
    )
    before = versions.publish(contracts.filter("c_custkey % 3 = 0"), "team", "2024-01-01 00:00:00")
    return versions.publish(contracts, "team", AS_OF, already=before)


# (column, type and allowed values before, type and allowed values after); NULL = absent.
# Parts differ by size in what changes, so every kind of change occurs.
@query(
    "breaking_changes",
    """
WITH v AS (
  SELECT 'part/' || CAST(p_partkey AS VARCHAR) AS contract_id, p_size, p_type, p_brand FROM part),
old AS (SELECT contract_id, unnest([{'c': 'id', 't': 'bigint', 'e': NULL}, {'c': 'price', 't': 'decimal(15,2)', 'e': NULL},
                                    {'c': 'kind', 't': 'string', 'e': '["' || p_type || '"]'}, {'c': 'legacy', 't': 'string', 'e': NULL}]) AS x FROM v),
new AS (SELECT contract_id, unnest([{'c': 'id', 't': CASE WHEN p_size % 5 = 0 THEN 'string' ELSE 'bigint' END, 'e': NULL},
                                    {'c': 'price', 't': CASE WHEN p_size % 2 = 0 THEN 'decimal(18,2)' WHEN p_size % 3 = 0 THEN 'decimal(18,6)' ELSE 'decimal(15,2)' END, 'e': NULL},
                                    {'c': 'kind', 't': 'string', 'e': CASE WHEN p_size % 4 = 0 THEN '["' || p_brand || '"]' ELSE '["' || p_type || '"]' END},
                                    {'c': CASE WHEN p_size % 7 = 0 THEN 'modern' ELSE 'legacy' END, 't': 'string', 'e': NULL}]) AS x FROM v),
j AS (SELECT coalesce(o.contract_id, n.contract_id) AS contract_id, coalesce(o.x.c, n.x.c) AS column_name, o.x AS o, n.x AS n
      FROM old o FULL JOIN new n ON o.contract_id = n.contract_id AND o.x.c = n.x.c),
k AS (SELECT contract_id, column_name,
        CASE WHEN n IS NULL THEN 'removed' WHEN o IS NULL THEN 'added'
             WHEN o.t = 'decimal(15,2)' AND n.t = 'decimal(18,2)' THEN 'widened'
             WHEN o.t <> n.t THEN 'type_changed' WHEN o.e IS DISTINCT FROM n.e THEN 'enum_changed' END AS change_type FROM j)
SELECT contract_id, column_name, change_type, change_type IN ('removed', 'type_changed', 'enum_changed') AS breaking,
       CASE change_type WHEN 'removed' THEN 90 WHEN 'type_changed' THEN 60 WHEN 'enum_changed' THEN 30 ELSE 0 END AS notice_days
FROM k WHERE change_type IS NOT NULL""",
)
def breaking_changes(spark, d):
    size = F.col("p_size")
    none = F.lit(None).cast("string")

    def listed(name):
        return F.concat(F.lit('["'), F.col(name), F.lit('"]'))

    def columns(*defs):
        rows = [
            F.struct(F.lit(c).alias("column_name") if isinstance(c, str) else c.alias("column_name"), t.alias("data_type"), e.alias("enum_values_json"))
            for c, t, e in defs
        ]
        return table(spark, d, "part").select(F.concat(F.lit("part/"), F.col("p_partkey").cast("string")).alias("contract_id"), F.inline(F.array(*rows)))

    old = columns(
        ("id", F.lit("bigint"), none), ("price", F.lit("decimal(15,2)"), none),
        ("kind", F.lit("string"), listed("p_type")), ("legacy", F.lit("string"), none),
    )
    new = columns(
        ("id", F.when(size % 5 == 0, "string").otherwise("bigint"), none),
        ("price", F.when(size % 2 == 0, "decimal(18,2)").when(size % 3 == 0, "decimal(18,6)").otherwise("decimal(15,2)"), none),
        ("kind", F.lit("string"), F.when(size % 4 == 0, listed("p_brand")).otherwise(listed("p_type"))),
        (F.when(size % 7 == 0, "modern").otherwise("legacy"), F.lit("string"), none),
    )
    return versions.diff_versions(old, new)


# (path, condition on the part, change, type before, type after), told once as rows for
# the SQL and once as type texts below.
NESTED = (
    ("payload.id", "p_size % 5 = 0", "type_changed", "bigint", "string"),
    ("payload.amount", "p_size % 2 = 0", "widened", "decimal(15,2)", "decimal(18,2)"),
    ("payload.amount", "p_size % 2 <> 0 AND p_size % 3 = 0", "type_changed", "decimal(15,2)", "decimal(18,6)"),
    ("payload.tags[]", "p_size % 7 = 0", "type_changed", "string", "struct<v:string>"),
    ("payload.attrs", "p_size % 9 = 0", "removed", "map<string,int>", None),
    ("payload.attrs{value}", "p_size % 9 <> 0 AND p_size % 4 = 0", "type_changed", "int", "bigint"),
    ("payload.note", "p_size % 6 = 0", "added", None, "string"),
    ("lines[].price", "p_size % 3 = 0", "widened", "decimal(10,2)", "decimal(12,2)"),
    ("legacy", "p_size % 8 = 0", "removed", "array<string>", None),
    ("modern", "p_size % 8 = 0", "added", None, "array<string>"),
)


def _sql_value(text: str | None) -> str:
    return "CAST(NULL AS VARCHAR)" if text is None else f"'{text}'"


NESTED_SQL = " UNION ALL ".join(
    f"""
SELECT 'part/' || CAST(p_partkey AS VARCHAR) AS contract_id, regexp_extract('{path}', '^[a-z]+') AS column_name, '{path}' AS path, '{change}' AS change_type,
       {_sql_value(old)} AS old_type, {_sql_value(new)} AS new_type, {change in ('removed', 'type_changed')} AS breaking,
       CAST({versions.NOTICE_DAYS.get(change, 0)} AS INTEGER) AS notice_days FROM part WHERE {where}"""
    for path, where, change, old, new in NESTED
)


@query("nested_type_changes", NESTED_SQL)
def nested_type_changes(spark, d):
    """Two versions of nested columns; the new one lists its fields in another order."""
    part = table(spark, d, "part").withColumn("contract_id", F.concat(F.lit("part/"), F.col("p_partkey").cast("string")))

    def when(condition, then, other):
        return F.when(F.expr(condition), F.lit(then)).otherwise(other if not isinstance(other, str) else F.lit(other))

    def columns(**types):
        rows = [F.struct(F.lit(n).alias("column_name"), F.lit(t).alias("data_type")) for n, t in types.items()]
        return part.select("contract_id", "p_size", F.inline(F.array(*rows)))

    old = columns(
        payload="struct<id:bigint,amount:decimal(15,2),tags:array<string>,attrs:map<string,int>>",
        lines="array<struct<sku:string,price:decimal(10,2)>>",
        legacy="array<string>",
    )
    attrs = when("p_size % 9 = 0", "", F.concat(F.lit(", attrs: map<string, "), when("p_size % 4 = 0", "bigint", "int"), F.lit(">")))
    amount = when("p_size % 2 = 0", "decimal(18, 2)", when("p_size % 3 = 0", "decimal(18, 6)", "decimal(15, 2)"))
    payload = F.concat(
        F.lit("STRUCT<amount: "), amount, F.lit(", tags: array<"), when("p_size % 7 = 0", "struct<v: string>", "string"), F.lit(">"),
        attrs, F.lit(", id: "), when("p_size % 5 = 0", "string", "bigint"), when("p_size % 6 = 0", ", note: string", ""), F.lit(">"),
    )
    price = when("p_size % 3 = 0", "12", "10")
    new = columns(
        payload=payload,
        lines=F.concat(F.lit("array<struct<sku:string,price:decimal("), price, F.lit(",2)>>")),
        legacy="array<string>",
    ).withColumn("column_name", F.expr("IF(column_name = 'legacy' AND p_size % 8 = 0, 'modern', column_name)"))
    return versions.nested_type_changes(old, new)
