"""Registry rows out of agreement and model documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractcheck.functions.text import json_text, map_content_text
from contractcheck.operators.lookups import lookup_join

# Top-level keys every agreement must have.
REQUIRED_KEYS = ("version", "name", "domain", "schema")

DEFAULT_SCHEMA = "analytics"
MODEL_NAMESPACE = "dbt"

HEADER = """
    version string, name string, domain string, description string, critical boolean, pii_flag boolean,
    owner struct<name:string, email:string, slack:string>,
    slo struct<freshness_hours:string, completeness:string, accuracy:string, availability:string>,
    slos struct<freshness:struct<max_age_hours:string>, completeness:struct<min_coverage:string>,
                accuracy:struct<tolerance:string>, availability:struct<target_uptime:string>>,
    schema string
"""
COLUMN_DEF = """
    type string, description string, required boolean, enum string, max_length int, length int,
    tests array<string>
"""
MODEL_DEF = """
    name string, description string,
    meta struct<contract:string, owner:string, slo_freshness_hours:string, slo_completeness:string,
                critical:boolean, pii_flag:boolean>,
    config struct<materialized:string, tags:array<string>>,
    columns array<string>
"""
MODEL_COLUMN = "name string, description string, data_type string, required boolean, tests array<string>"


def _number(text: Column) -> Column:
    """First number in a text such as ``0.99``, ``1e-05`` or ``± 0.01%``."""
    return F.nullif(F.regexp_extract(text, r"([0-9]+(?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?)", 1), F.lit(""))


def _is_object(text: Column) -> Column:
    return F.coalesce(text.startswith("{"), F.lit(False))


def unrolled(exploded: DataFrame) -> DataFrame:
    """Drop the empty row an outer explode leaves for an empty list.

    A plain explode makes the optimizer test the list for emptiness before it is
    unrolled, down at the scan, so every parse would run twice per row.
    """
    return exploded.filter(F.col("pos").isNotNull())


def _parsed(contracts: DataFrame) -> DataFrame:
    header = contracts.select("source_path", "content", F.from_json("content", HEADER).alias("d"))
    return header.withColumn("contract_id", F.concat_ws("/", "d.domain", "d.name"))


def extract_contracts(contracts: DataFrame) -> DataFrame:
    """One row per document. Nested ``slos`` win over the flat ``slo`` spelling."""
    d = _parsed(contracts)
    return d.select(
        F.col("contract_id").alias("id"),
        "d.name",
        F.coalesce("d.version", F.lit("1.0")).alias("version"),
        "d.domain",
        F.col("d.owner.name").alias("owner_name"),
        F.col("d.owner.email").alias("owner_email"),
        F.col("d.owner.slack").alias("owner_slack"),
        "source_path",
        F.coalesce("d.description", F.lit("")).alias("description"),
        _hours().alias("slo_freshness_hours"),
        _share("completeness", "min_coverage").alias("slo_completeness"),
        _share("accuracy", "tolerance").alias("slo_accuracy"),
        _share("availability", "target_uptime").alias("slo_availability"),
        F.col("content").alias("contract_json"),
    )


def _hours() -> Column:
    text = F.coalesce("d.slos.freshness.max_age_hours", "d.slo.freshness_hours")
    return _number(text).cast("double")


def _share(name: str, inner: str) -> Column:
    return _number(F.coalesce(f"d.slos.{name}.{inner}", f"d.slo.{name}")).cast("double")


def contract_models(contracts: DataFrame) -> DataFrame:
    """The table each agreement describes, as a registry model."""
    d = _parsed(contracts)
    return d.select(
        F.col("contract_id").alias("id"),
        F.col("d.name").alias("model_name"),
        F.lit(DEFAULT_SCHEMA).alias("schema_name"),
        "contract_id",
        F.lit("table").alias("materialized_as"),
        _hours().alias("freshness_slo_hours"),
        _share("completeness", "min_coverage").alias("completeness_slo"),
        F.coalesce("d.critical", F.lit(False)).alias("critical"),
        F.coalesce("d.pii_flag", F.lit(False)).alias("pii_flag"),
        F.col("d.owner.name").alias("owner_name"),
    )


def _properties(contracts: DataFrame) -> DataFrame:
    d = _parsed(contracts)
    props = F.from_json(F.get_json_object("d.schema", "$.properties"), "map<string,string>")
    return unrolled(d.select("contract_id", F.posexplode_outer(props).alias("pos", "column_name", "definition")))


def contract_columns(contracts: DataFrame) -> DataFrame:
    """One row per declared column, in declared order."""
    p = _properties(contracts).filter(_is_object(F.col("definition")))
    c = p.withColumn("c", F.from_json("definition", COLUMN_DEF))
    has_enum = F.coalesce(F.size(F.from_json("c.enum", "array<string>")) > 0, F.lit(False))
    return c.select(
        F.concat_ws("/", "contract_id", "column_name").alias("id"),
        F.col("contract_id").alias("model_id"),
        "column_name",
        "pos",
        F.col("c.type").alias("data_type"),
        F.coalesce("c.required", F.lit(False)).alias("required_flag"),
        F.col("c.description").alias("description"),
        F.when(has_enum, F.col("c.enum")).alias("_enum"),
        F.col("c.max_length").alias("max_length"),
        F.col("c.length").alias("length"),
    ).withColumn("enum_values_json", json_text("_enum")).drop("_enum")


def _named_tests(columns: DataFrame, label: str) -> DataFrame:
    """``columns`` carries ``model_id, column_name, tests``. A test is a bare name
    or a one-key map; the map's content becomes part of the identifier."""
    one = unrolled(columns.select("model_id", "column_name", F.posexplode_outer("tests").alias("pos", "test")))
    mapped = _is_object(F.col("test"))
    named = one.select(
        "model_id",
        "column_name",
        "pos",
        F.when(mapped, F.json_object_keys("test")[0]).otherwise(F.col("test")).alias("test_name"),
        F.when(mapped, F.col("test")).alias("definition"),
    )
    full = named.withColumn("params", map_content_text("definition")).withColumn(
        "test_params_json", json_text("definition")
    )
    column_id = F.concat_ws("/", "model_id", "column_name")
    return full.select(
        F.concat_ws("/", column_id, "test_name", "params").alias("id"),
        "test_name",
        F.col("test_name").alias("test_type"),
        column_id.alias("column_id"),
        "model_id",
        "column_name",
        "pos",
        F.lit("error").alias("severity"),
        "test_params_json",
        F.concat(F.lit(f"{label} "), F.col("test_name"), F.lit(" on "), F.col("column_name")).alias("description"),
    )


def contract_tests(contracts: DataFrame) -> DataFrame:
    """One row per declared test of a column."""
    p = _properties(contracts).filter(_is_object(F.col("definition")))
    tests = F.from_json("definition", COLUMN_DEF).getField("tests")
    return _named_tests(
        p.select(F.col("contract_id").alias("model_id"), "column_name", tests.alias("tests")), "Test"
    )


def extract(contracts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Contracts, models, columns and tests of usable documents."""
    return (
        extract_contracts(contracts),
        contract_models(contracts),
        contract_columns(contracts),
        contract_tests(contracts),
    )


def _model_docs(models: DataFrame) -> DataFrame:
    d = models.withColumn("d", F.from_json("content", MODEL_DEF)).filter(F.col("d.name").isNotNull())
    return d.withColumn("model_id", F.concat(F.lit(f"{MODEL_NAMESPACE}/"), F.col("d.name")))


def extract_models(models: DataFrame) -> DataFrame:
    d = _model_docs(models)
    return d.select(
        F.col("model_id").alias("id"),
        F.col("d.name").alias("model_name"),
        F.lit(DEFAULT_SCHEMA).alias("schema_name"),
        F.col("d.meta.contract").alias("contract_id"),
        F.coalesce("d.config.materialized", F.lit("view")).alias("materialized_as"),
        _number(F.col("d.meta.slo_freshness_hours")).cast("double").alias("freshness_slo_hours"),
        _number(F.col("d.meta.slo_completeness")).cast("double").alias("completeness_slo"),
        F.coalesce("d.meta.critical", F.lit(False)).alias("critical"),
        F.coalesce("d.meta.pii_flag", F.lit(False)).alias("pii_flag"),
        F.col("d.meta.owner").alias("owner_name"),
        F.get_json_object("content", "$.meta").alias("meta_json"),
    )


def _model_column_docs(models: DataFrame) -> DataFrame:
    d = unrolled(_model_docs(models).select("model_id", F.posexplode_outer("d.columns").alias("pos", "definition")))
    return d.withColumn("c", F.from_json("definition", MODEL_COLUMN))


def model_columns(models: DataFrame) -> DataFrame:
    return _model_column_docs(models).select(
        F.concat_ws("/", "model_id", "c.name").alias("id"),
        "model_id",
        F.col("c.name").alias("column_name"),
        "pos",
        F.col("c.data_type").alias("data_type"),
        F.coalesce("c.required", F.lit(False)).alias("required_flag"),
        F.col("c.description").alias("description"),
        F.lit(None).cast("string").alias("enum_values_json"),
    )


def model_tests(models: DataFrame) -> DataFrame:
    c = _model_column_docs(models)
    return _named_tests(
        c.select("model_id", F.col("c.name").alias("column_name"), F.col("c.tests").alias("tests")),
        f"{MODEL_NAMESPACE} test:",
    )


def resolve_contract(models: DataFrame, contracts: DataFrame) -> DataFrame:
    """Point models at agreement ids. A model may name the id itself or the path
    of the file below the agreements folder, without its ending."""
    by_id = contracts.select(F.col("id").alias("contract_id"), F.col("id").alias("_resolved"))
    path = F.regexp_extract("source_path", r"([^/]+/[^/]+/[^/]+)\.ya?ml$", 1)
    by_path = contracts.select(path.alias("contract_id"), F.col("id").alias("_resolved")).filter("contract_id != ''")
    names = by_id.unionByName(by_path).groupBy("contract_id").agg(F.min("_resolved").alias("_resolved"))
    joined = lookup_join(models, names, ["contract_id"], "left", spread_by=["id"])
    cols = [F.coalesce("_resolved", "contract_id").alias(c) if c == "contract_id" else F.col(c) for c in models.columns]
    return joined.select(*cols)


def lint(documents: DataFrame) -> DataFrame:
    """``source_path, pos, error``: one row per fault, none for a clean document.

    Works on every document, also unreadable ones and those without the mandatory keys.
    """
    d = documents.select(
        "source_path",
        "parse_error",
        F.json_object_keys("content").alias("keys"),
        F.get_json_object("content", "$.schema").alias("schema_text"),
        F.get_json_object("content", "$.schema.properties").alias("props_text"),
    )
    missing = [
        F.when(~F.array_contains("keys", k), F.lit(f"Missing required top-level key: '{k}'")) for k in REQUIRED_KEYS
    ]
    has_schema, has_props = _is_object(F.col("schema_text")), _is_object(F.col("props_text"))
    shape = F.when(~has_schema, F.lit("'schema' must be a mapping/object")).when(
        ~has_props, F.lit("'schema.properties' must be a mapping/object")
    )
    entries = F.map_entries(F.from_json("props_text", "map<string,string>"))

    def column_fault(entry: Column) -> Column:
        name = F.concat(F.lit("Column '"), entry["key"], F.lit("'"))
        keys = F.json_object_keys(entry["value"])
        return F.when(~_is_object(entry["value"]), F.concat(name, F.lit(" definition must be an object"))).when(
            ~F.array_contains(keys, "type"), F.concat(name, F.lit(" missing required 'type'"))
        )

    per_column = F.when(has_schema & has_props, F.transform(entries, column_fault))
    found = F.concat(F.array(*missing, shape), F.coalesce(per_column, F.array().cast("array<string>")))
    errors = F.when(F.col("parse_error").isNotNull(), F.array("parse_error")).otherwise(
        F.filter(found, lambda e: e.isNotNull())
    )
    return unrolled(d.select("source_path", F.posexplode_outer(errors).alias("pos", "error")))
