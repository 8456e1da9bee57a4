"""Agreement documents, registry rows and test-run results.

Every part becomes one YAML agreement and every supplier one model file, written
by Spark, so the whole path from text to registry grows with the tables. The size
of a part decides whether its document is sound or has one of several faults.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contractcheck.functions.lineage import settled
from contractcheck.operators import contracts as reg
from contractcheck.operators import drift, slo, storage, test_ids, transforms, versions
from contractcheck.sources.documents import explode_models, parse_documents, split_contracts
from contractcheck.sources.tables import only_tests
from contractcheck.workload.base import AS_OF, query, table

# Faults by p_size % 10: 3 no domain, 5 column is text, 6 column without type,
# 7 schema is a list, 8 schema without properties, 9 not YAML. Others are sound.
HEAD = """version: 1.<v>
name: part_<key>
<domain>description: "<pname>"
owner: {name: "<ptype> team", email: "<ptype>@example.com"}
critical: <critical>
slos:
  freshness: {max_age_hours: <size>.5}
  completeness: {min_coverage: 0.9999<digit>}
  accuracy: {tolerance: "± <digit>e-05 %"}
  availability: {target_uptime: 0.99<digit>}
tags:
  - core
  - pii: "label<digit>"
deprecation_policy:
  example: {deprecated_column: "old_<key>", removal_date: "2024-0<month>-15", replacement: "use id"}
"""
BODY = """schema:
  type: object
  properties:
    id:
      type: bigint
      required: true
      description: "key of <key>"
      tests:
        - unique
        - not_null
    label:
      type: string
      required: <needed>
      max_length: <size>
      enum: ["<ptype>", "<pname>"]
      tests:
        - not_null
        - in: ["<ptype>", "<pname>"]
        - relationships: {to: "dim_label", field: "label"}
    price: <price>
"""


def fill(template: str, values: dict[str, Column]) -> Column:
    """A template with columns in its ``<gaps>``."""
    pieces = re.split(r"<(\w+)>", template)
    return F.concat(*[values[p].cast("string") if i % 2 else F.lit(p) for i, p in enumerate(pieces)])


def agreement_files(spark: SparkSession, d: str) -> DataFrame:
    size, key = F.col("p_size"), F.col("p_partkey")
    fault = size % 10
    domain = F.lower(F.regexp_replace("p_brand", "#", "_"))
    values = {
        "v": size % 4,
        "key": key,
        "domain": F.when(fault == 3, "").otherwise(F.concat(F.lit("domain: "), domain, F.lit("\n"))),
        "pname": F.col("p_name"),
        "ptype": F.col("p_type"),
        "critical": F.when(size % 2 == 0, "true").otherwise("false"),
        "size": size,
        "digit": fault,
        "month": size % 9 + 1,
        "needed": F.when(size % 3 == 0, "true").otherwise("false"),
        "price": F.when(fault == 5, "just text").when(fault == 6, "{required: false}").otherwise('{type: "decimal(18,2)"}'),
    }
    body = F.when(fault == 7, "schema: [a, b]\n").when(fault == 8, "schema: {type: object}\n").otherwise(fill(BODY, values))
    text = F.when(fault == 9, "version: [1\n").otherwise(F.concat(fill(HEAD, values), body))
    path = F.concat(F.lit("/agreements/"), domain, F.lit("/part_"), key.cast("string"), F.lit("/v1.yaml"))
    return table(spark, d, "part").select(path.alias("source_path"), text.alias("text"))


def usable(spark: SparkSession, d: str) -> DataFrame:
    return split_contracts(parse_documents(agreement_files(spark, d)))[0]


PARTS_SQL = """
parts AS (
  SELECT *, p_size % 10 AS fault, lower(replace(p_brand, '#', '_')) AS domain, 'part_' || CAST(p_partkey AS VARCHAR) AS name,
         lower(replace(p_brand, '#', '_')) || '/part_' || CAST(p_partkey AS VARCHAR) AS id,
         '/agreements/' || lower(replace(p_brand, '#', '_')) || '/part_' || CAST(p_partkey AS VARCHAR) || '/v1.yaml' AS source_path
  FROM part),
good AS (SELECT * FROM parts WHERE fault NOT IN (3, 9)),
cols AS (
  SELECT id AS model_id, 'id' AS column_name, CAST(0 AS BIGINT) AS pos, 'bigint' AS data_type, true AS required_flag,
         'key of ' || CAST(p_partkey AS VARCHAR) AS description, NULL AS enum_values_json, NULL::BIGINT AS max_length FROM good WHERE fault NOT IN (7, 8)
  UNION ALL
  SELECT id, 'label', 1, 'string', p_size % 3 = 0, NULL, '["' || p_type || '", "' || p_name || '"]', p_size FROM good WHERE fault NOT IN (7, 8)
  UNION ALL
  SELECT id, 'price', 2, CASE WHEN fault = 6 THEN NULL ELSE 'decimal(18,2)' END, false, NULL, NULL, NULL FROM good WHERE fault NOT IN (5, 7, 8))"""


@query(
    "extract_contracts",
    f"""
WITH {PARTS_SQL}
SELECT id, name, '1.' || CAST(p_size % 4 AS VARCHAR) AS version, domain, p_type || ' team' AS owner_name, p_type || '@example.com' AS owner_email,
       CAST(NULL AS VARCHAR) AS owner_slack, source_path, p_name AS description, CAST(p_size + 0.5 AS DOUBLE) AS slo_freshness_hours,
       CAST('0.9999' || CAST(fault AS VARCHAR) AS DOUBLE) AS slo_completeness, CAST(CAST(fault AS VARCHAR) || 'e-05' AS DOUBLE) AS slo_accuracy,
       CAST('0.99' || CAST(fault AS VARCHAR) AS DOUBLE) AS slo_availability
FROM good""",
)
def extract_contracts(spark, d):
    return reg.extract_contracts(usable(spark, d)).drop("contract_json")


@query(
    "rejected_contracts",
    f"""WITH {PARTS_SQL} SELECT source_path, CASE fault WHEN 3 THEN 'missing: domain' ELSE 'not readable: ParserError' END AS reject_reason
FROM parts WHERE fault IN (3, 9)""",
)
def rejected_contracts(spark, d):
    return split_contracts(parse_documents(agreement_files(spark, d)))[1]


@query(
    "contract_lint",
    f"""
WITH {PARTS_SQL}
SELECT source_path, 'not readable: ParserError' AS error FROM parts WHERE fault = 9
UNION ALL SELECT source_path, 'Missing required top-level key: ''domain''' FROM parts WHERE fault = 3
UNION ALL SELECT source_path, '''schema'' must be a mapping/object' FROM parts WHERE fault = 7
UNION ALL SELECT source_path, '''schema.properties'' must be a mapping/object' FROM parts WHERE fault = 8
UNION ALL SELECT source_path, 'Column ''price'' definition must be an object' FROM parts WHERE fault = 5
UNION ALL SELECT source_path, 'Column ''price'' missing required ''type''' FROM parts WHERE fault = 6""",
)
def contract_lint(spark, d):
    return reg.lint(parse_documents(agreement_files(spark, d))).drop("pos")


@query(
    "contract_models",
    f"""
WITH {PARTS_SQL}
SELECT id, name AS model_name, 'analytics' AS schema_name, id AS contract_id, 'table' AS materialized_as, CAST(p_size + 0.5 AS DOUBLE) AS freshness_slo_hours,
       CAST('0.9999' || CAST(fault AS VARCHAR) AS DOUBLE) AS completeness_slo, p_size % 2 = 0 AS critical, false AS pii_flag, p_type || ' team' AS owner_name
FROM good""",
)
def contract_models(spark, d):
    return reg.contract_models(usable(spark, d))


@query(
    "contract_columns",
    f"""WITH {PARTS_SQL} SELECT model_id || '/' || column_name AS id, model_id, column_name, pos, data_type, required_flag, description,
enum_values_json, max_length FROM cols""",
)
def contract_columns(spark, d):
    rows = reg.contract_columns(usable(spark, d)).drop("length")
    return rows.withColumns({"pos": F.col("pos").cast("bigint"), "max_length": F.col("max_length").cast("bigint")})


@query(
    "contract_column_order",
    f"""WITH {PARTS_SQL} SELECT c.pos, c.column_name FROM cols c WHERE model_id = (SELECT min(id) FROM good WHERE fault = 0) ORDER BY pos""",
)
def contract_column_order(spark, d):
    """Declared columns of the first sound agreement, in order.

    The columns are settled, so that looking for the agreement, sampling for the order
    and reading the result parse the documents once in all.
    """
    columns = settled(reg.contract_columns(usable(spark, d)).select("model_id", "pos", "column_name", "max_length"))
    first = columns.filter((F.col("max_length") % 10 == 0)).agg(F.min("model_id")).first()[0]
    return drift.contract_column_list(columns, first).withColumn("pos", F.col("pos").cast("bigint"))


TESTS_SQL = f"""
{PARTS_SQL},
tests AS (
  SELECT id AS model_id, t.column_name, CAST(t.pos AS BIGINT) AS pos, t.test_name,
         CASE t.test_name WHEN 'in' THEN '["' || p_type || '", "' || p_name || '"]'
                          WHEN 'relationships' THEN '{{"field": "label", "to": "dim_label"}}' END AS params,
         CASE t.test_name WHEN 'in' THEN '{{"in": ["' || p_type || '", "' || p_name || '"]}}'
                          WHEN 'relationships' THEN '{{"relationships": {{"to": "dim_label", "field": "label"}}}}' END AS test_params_json
  FROM good, (VALUES ('id', 0, 'unique'), ('id', 1, 'not_null'), ('label', 0, 'not_null'), ('label', 1, 'in'), ('label', 2, 'relationships'))
       t(column_name, pos, test_name) WHERE fault NOT IN (7, 8))"""


@query(
    "contract_tests",
    f"""WITH {TESTS_SQL}
SELECT concat_ws('/', model_id, column_name, test_name, params) AS id, test_name, test_name AS test_type, model_id || '/' || column_name AS column_id,
       model_id, column_name, pos, 'error' AS severity, test_params_json, 'Test ' || test_name || ' on ' || column_name AS description
FROM tests""",
)
def contract_tests(spark, d):
    return reg.contract_tests(usable(spark, d)).withColumn("pos", F.col("pos").cast("bigint"))


MODEL_FILE = """version: 2
models:
  - name: m_<key>
    description: "model <key>"
    meta:
      contract: "<contract>"
      owner: "owner <nation>"
      slo_freshness_hours: <nation>.25
      slo_completeness: 0.<nation>
      critical: <critical>
    config: {materialized: table, tags: [a, b]}
    columns:
      - name: id
        description: "key"
        tests:
          - unique
          - dbt_utils.expression_is_true:
              expression: "RLIKE '^S_[0-9]{<nation>}$'"
      - name: label
        tests:
          - accepted_values:
              values: ["A", "B<nation>"]
  - name: v_<key>
"""


def model_files(spark: SparkSession, d: str) -> DataFrame:
    """Models name their agreement by id, by file path, or not at all."""
    key, nation = F.col("s_suppkey"), F.col("s_nationkey")
    named = F.when(key % 3 == 0, F.concat(F.lit("a/part_"), key.cast("string"), F.lit("/v1"))).when(
        key % 3 == 1, F.concat(F.lit("agreed/"), key.cast("string"))
    ).otherwise("nowhere")
    values = {"key": key, "nation": nation, "contract": named, "critical": F.when(key % 2 == 0, "true").otherwise("false")}
    text = fill(MODEL_FILE, values)
    path = F.concat(F.lit("/models/"), key.cast("string"), F.lit(".yml"))
    return table(spark, d, "supplier").select(path.alias("source_path"), text.alias("text"))


def model_docs(spark: SparkSession, d: str) -> DataFrame:
    return explode_models(parse_documents(model_files(spark, d)))


MODELS_SQL = """
sup AS (SELECT *, CAST(s_suppkey AS VARCHAR) AS k, CAST(s_nationkey AS VARCHAR) AS n,
               CASE s_suppkey % 3 WHEN 0 THEN 'a/part_' || CAST(s_suppkey AS VARCHAR) || '/v1' WHEN 1 THEN 'agreed/' || CAST(s_suppkey AS VARCHAR)
                    ELSE 'nowhere' END AS contract FROM supplier),
models AS (
  SELECT 'dbt/m_' || k AS id, 'm_' || k AS model_name, 'analytics' AS schema_name, contract AS contract_id, 'table' AS materialized_as,
         CAST(s_nationkey + 0.25 AS DOUBLE) AS freshness_slo_hours, CAST('0.' || n AS DOUBLE) AS completeness_slo, s_suppkey % 2 = 0 AS critical, false AS pii_flag,
         'owner ' || n AS owner_name FROM sup
  UNION ALL
  SELECT 'dbt/v_' || k, 'v_' || k, 'analytics', NULL, 'view', NULL, NULL, false, false, NULL FROM sup)"""


@query("model_definitions", f"WITH {MODELS_SQL} SELECT * FROM models")
def model_definitions(spark, d):
    rows = reg.extract_models(model_docs(spark, d)).drop("meta_json")
    return rows


@query(
    "model_columns",
    f"""WITH {MODELS_SQL} SELECT 'dbt/m_' || k || '/id' AS id, 'dbt/m_' || k AS model_id, 'id' AS column_name, CAST(0 AS BIGINT) AS pos,
'key' AS description, false AS required_flag FROM sup
UNION ALL SELECT 'dbt/m_' || k || '/label', 'dbt/m_' || k, 'label', 1, NULL, false FROM sup""",
)
def model_columns(spark, d):
    rows = reg.model_columns(model_docs(spark, d)).select("id", "model_id", "column_name", "pos", "description", "required_flag")
    return rows.withColumn("pos", F.col("pos").cast("bigint"))


@query(
    "model_tests",
    f"""WITH {MODELS_SQL},
t AS (
  SELECT 'dbt/m_' || k AS model_id, 'id' AS column_name, CAST(0 AS BIGINT) AS pos, 'unique' AS test_name, NULL AS params FROM sup
  UNION ALL SELECT 'dbt/m_' || k, 'id', 1, 'dbt_utils.expression_is_true', '{{"expression": "RLIKE ''^S_[0-9]{{' || n || '}}$''"}}' FROM sup
  UNION ALL SELECT 'dbt/m_' || k, 'label', 0, 'accepted_values', '{{"values": ["A", "B' || n || '"]}}' FROM sup)
SELECT concat_ws('/', model_id, column_name, test_name, params) AS id, test_name, model_id, column_name, pos, 'error' AS severity,
       '{{"' || test_name || '": ' || params || '}}' AS test_params_json, 'dbt test: ' || test_name || ' on ' || column_name AS description
FROM t""",
)
def model_tests(spark, d):
    rows = reg.model_tests(model_docs(spark, d)).drop("test_type", "column_id")
    return rows.withColumn("pos", F.col("pos").cast("bigint"))


def supplier_contracts(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey").cast("string")
    return table(spark, d, "supplier").select(
        F.concat(F.lit("agreed/"), k).alias("id"),
        F.col("s_name").alias("name"),
        F.concat(F.lit("s3a://agreements/a/part_"), k, F.lit("/v1.yaml")).alias("source_path"),
    )


RESOLVED_SQL = f"""
{MODELS_SQL},
resolved AS (SELECT m.* REPLACE (CASE WHEN starts_with(contract_id, 'a/part_') THEN 'agreed/' || split_part(split_part(contract_id, '_', 2), '/', 1)
                                      ELSE contract_id END AS contract_id) FROM models m)"""


@query("resolve_contract", f"WITH {RESOLVED_SQL} SELECT id, model_name, contract_id FROM resolved")
def resolve_contract(spark, d):
    models = reg.extract_models(model_docs(spark, d))
    return reg.resolve_contract(models, supplier_contracts(spark, d)).select("id", "model_name", "contract_id")


@query(
    "slo_targets",
    f"""WITH {RESOLVED_SQL} SELECT DISTINCT contract_id, s_name AS contract_name, model_name, freshness_slo_hours, completeness_slo
FROM resolved JOIN sup ON contract_id = 'agreed/' || k""",
)
def slo_targets(spark, d):
    contracts = supplier_contracts(spark, d)
    models = reg.resolve_contract(reg.extract_models(model_docs(spark, d)), contracts)
    return slo.slo_targets(contracts, models, schemas=models)


@query(
    "required_columns",
    f"WITH {PARTS_SQL} SELECT DISTINCT name AS model_name, column_name FROM cols JOIN good ON id = model_id WHERE required_flag",
)
def required_columns(spark, d):
    good = usable(spark, d)
    return slo.required_columns(reg.contract_columns(good), reg.contract_models(good))


@query(
    "tags",
    f"""WITH {PARTS_SQL} SELECT id AS contract_id, 'core' AS tag, NULL AS value FROM good
UNION ALL SELECT id, 'pii', 'label' || CAST(fault AS VARCHAR) FROM good""",
)
def tags(spark, d):
    return transforms.tagged(reg.extract_contracts(usable(spark, d)))


@query("pii_columns", f"WITH {PARTS_SQL} SELECT id AS contract_id, 'label' || CAST(fault AS VARCHAR) AS column_name FROM good")
def pii_columns(spark, d):
    return transforms.pii_columns(reg.extract_contracts(usable(spark, d)))


@query(
    "deprecation_calendar",
    f"""WITH {PARTS_SQL},
x AS (SELECT id AS contract_id, 'old_' || CAST(p_partkey AS VARCHAR) AS column_name, make_date(2024, p_size % 9 + 1, 15) AS removal_date FROM good),
y AS (SELECT *, CAST(removal_date - DATE '2024-02-01' AS INTEGER) AS days_left FROM x)
SELECT contract_id, column_name, removal_date, 'use id' AS replacement, days_left,
       CASE WHEN days_left < 0 THEN 'due' WHEN days_left < 90 THEN 'notice period' ELSE 'announced' END AS state FROM y""",
)
def deprecation_calendar(spark, d):
    return versions.deprecation_calendar(reg.extract_contracts(usable(spark, d)), AS_OF)


UPSERT_SQL = """
target AS (SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance, 'old' AS note, TIMESTAMP '2024-01-01 00:00:00' AS _created_ts,
                  TIMESTAMP '2024-01-01 00:00:00' AS _updated_ts FROM supplier WHERE s_suppkey % 4 <> 0),
source AS (SELECT s_suppkey AS id, upper(s_name) AS name, s_acctbal + 1 AS balance FROM supplier WHERE s_suppkey % 3 = 0)"""


def _upsert_sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    sup = table(spark, d, "supplier")
    old, now = (F.lit(t).cast("timestamp_ntz") for t in ("2024-01-01 00:00:00", AS_OF))
    target = sup.filter("s_suppkey % 4 <> 0").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"),
        F.lit("old").alias("note"), old.alias("_created_ts"), old.alias("_updated_ts"),
    )
    source = sup.filter("s_suppkey % 3 = 0").select(
        F.col("s_suppkey").alias("id"), F.upper("s_name").alias("name"), (F.col("s_acctbal") + 1).alias("balance"),
        now.alias("_created_ts"), now.alias("_updated_ts"),
    )
    return target, source


@query(
    "upsert_contracts",
    f"""WITH {UPSERT_SQL}
SELECT id, coalesce(s.name, t.name) AS name, coalesce(s.balance, t.balance) AS balance, t.note,
       CASE WHEN t.id IS NULL THEN TIMESTAMP '{AS_OF}' ELSE t._created_ts END AS _created_ts,
       CASE WHEN s.id IS NOT NULL THEN TIMESTAMP '{AS_OF}' ELSE t._updated_ts END AS _updated_ts
FROM target t FULL JOIN source s USING (id)""",
)
def upsert_contracts(spark, d):
    target, source = _upsert_sides(spark, d)
    return storage.upsert(target, source, ["id"], ["name", "balance", "_updated_ts"], ["_created_ts"])


@query(
    "keyed_update",
    f"""WITH {UPSERT_SQL} SELECT id, coalesce(s.name, t.name) AS name, t.balance, t.note, t._created_ts,
CASE WHEN s.id IS NOT NULL THEN TIMESTAMP '{AS_OF}' ELSE t._updated_ts END AS _updated_ts FROM target t LEFT JOIN source s USING (id)""",
)
def keyed_update(spark, d):
    target, source = _upsert_sides(spark, d)
    return storage.keyed_update(target, source, ["id"], ["name", "_updated_ts"])


def run_results(spark: SparkSession, d: str) -> DataFrame:
    """Every event as a result of a test run, with generated test names."""
    user, k = F.col("user_id"), F.get_json_object("props", "$.k").cast("bigint")
    u20 = (user % 20).cast("string")
    model = (
        F.when(user % 4 == 0, F.concat(F.lit("m"), u20))
        .when(user % 4 == 1, F.concat(F.lit("m"), u20, F.lit("_ext")))
        .when(user % 4 == 2, F.concat(F.lit("dim_u"), user.cast("string")))
        .otherwise(F.concat(F.lit("z"), user.cast("string")))
    )
    kind = F.element_at(
        F.create_map(
            *[
                F.lit(x)
                for pair in (
                    ("view", "not_null"), ("click", "unique"), ("error", "accepted_values"),
                    ("signup", "expression_is_true"), ("purchase", "equal_rowcount"),
                )
                for x in pair
            ]
        ),
        F.col("event_type"),
    )
    name = F.concat(F.lit("test.proj."), kind, F.lit("_"), model, F.lit("_col_"), (k % 3).cast("string"))
    return table(spark, d, "events").select(
        F.when(F.col("event_id") % 10 == 0, "model").when(F.col("event_id") % 10 == 1, F.lit(None)).otherwise("test").alias("resource_type"),
        F.when(F.col("event_id") % 10 == 0, F.concat(F.lit("model.proj.m"), u20)).otherwise(
            F.concat(name, F.when(F.col("event_type") == "error", "__A__B").otherwise(""))
        ).alias("unique_id"),
        F.when(F.col("value") > 30, "fail").otherwise("pass").alias("status"),
        F.when(F.col("value") > 30, F.lit("too many")).otherwise("").alias("message"),
        (F.col("value") / 7).alias("execution_time"),
        F.concat(F.lit("select "), F.repeat(F.lit("x"), (F.col("event_id") % 2000).cast("int"))).alias("compiled_code"),
        F.floor("value").cast("bigint").alias("failures"),
        "event_id",
    )


def run_models(spark: SparkSession, d: str) -> DataFrame:
    k = (F.col("c_custkey") % 20).cast("string")
    both = F.explode(F.array(F.concat(F.lit("m"), k), F.concat(F.lit("m"), k, F.lit("_ext"))))
    named = table(spark, d, "customer").select(both.alias("model_name")).distinct()
    return named.select(
        F.concat(F.lit("dbt/"), "model_name").alias("id"), "model_name", F.concat(F.lit("dom/"), "model_name").alias("contract_id")
    )


RUN_SQL = """
runs AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) % 3 AS col,
         CASE user_id % 4 WHEN 0 THEN 'm' || CAST(user_id % 20 AS VARCHAR) WHEN 1 THEN 'm' || CAST(user_id % 20 AS VARCHAR) || '_ext'
              WHEN 2 THEN 'dim_u' || CAST(user_id AS VARCHAR) ELSE 'z' || CAST(user_id AS VARCHAR) END AS model_name,
         CASE event_type WHEN 'view' THEN 'not_null' WHEN 'click' THEN 'unique' WHEN 'error' THEN 'accepted_values'
              WHEN 'signup' THEN 'expression_is_true' ELSE 'equal_rowcount' END AS test_type
  FROM events WHERE event_id % 10 <> 0),
named AS (
  SELECT *, 'col_' || CAST(col AS VARCHAR) AS column_name, test_type || '_' || model_name || '_col_' || CAST(col AS VARCHAR) AS test_name,
         'test.proj.' || test_type || '_' || model_name || '_col_' || CAST(col AS VARCHAR) || CASE WHEN event_type = 'error' THEN '__A__B' ELSE '' END AS unique_id
  FROM runs)"""


@query("parse_test_id", f"WITH {RUN_SQL} SELECT DISTINCT unique_id, test_name, test_type, model_name, column_name FROM named")
def parse_test_id(spark, d):
    return test_ids.parse_test_ids(only_tests(run_results(spark, d)), run_models(spark, d))


@query(
    "classify_test",
    f"WITH {RUN_SQL} SELECT test_type, count(*) AS n FROM named GROUP BY 1",
)
def classify_test(spark, d):
    from contractcheck.functions.text import classify_test as classify
    from contractcheck.functions.text import test_base_name

    kind = classify(test_base_name(F.col("unique_id")))
    return only_tests(run_results(spark, d)).groupBy(kind.alias("test_type")).agg(F.count(F.lit(1)).alias("n"))


RESULT_SQL = f"""
{RUN_SQL},
logged AS (
  SELECT sha256('run_1|' || unique_id || '|{AS_OF}') AS id, 'run_1' AS run_id, unique_id AS test_id, CAST(NULL AS VARCHAR) AS contract_id, model_name, column_name,
         test_name, test_type, CASE WHEN value > 30 THEN 'fail' ELSE 'pass' END AS status, CASE WHEN value > 30 THEN 'too many' END AS failure_message,
         CASE WHEN value > 30 AND floor(value) > 0 THEN CAST(floor(value) AS BIGINT) END AS rows_affected, CAST(floor(value / 7 * 1000) AS BIGINT) AS execution_time_ms,
         'select ' || repeat('x', CAST(event_id % 2000 AS INTEGER)) AS compiled_sql, TIMESTAMP '{AS_OF}' AS run_timestamp, 'test_run' AS configured_by,
         TIMESTAMP '{AS_OF}' AS _inserted_ts
  FROM named)"""


@query("log_test_results", f"WITH {RESULT_SQL} SELECT * FROM logged")
def log_test_results(spark, d):
    return test_ids.denormalise_results(only_tests(run_results(spark, d)), "run_1", AS_OF, run_models(spark, d))


@query(
    "enrich_contract",
    f"""WITH {RESULT_SQL} SELECT test_id, model_name, CASE WHEN starts_with(model_name, 'm') THEN 'dom/' || model_name END AS contract_id, count(*) AS n
FROM logged GROUP BY ALL""",
)
def enrich_contract(spark, d):
    models = run_models(spark, d)
    log = test_ids.denormalise_results(only_tests(run_results(spark, d)), "run_1", AS_OF, models)
    return test_ids.enrich_contract(log, models).groupBy("test_id", "model_name", "contract_id").agg(F.count(F.lit(1)).alias("n"))
