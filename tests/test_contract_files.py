"""YAML agreements and model files from a folder to registry rows."""

import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from contractcheck.operators import contracts as reg
from contractcheck.operators import drift, test_ids, transforms, versions
from contractcheck.sources import tables as src
from contractcheck.sources.documents import parse_documents, read_contracts, read_model_definitions, split_contracts

AGREEMENT = """
version: 1.0
name: dim_thing
domain: shop
description: "All things"
owner: {name: "Shop team", email: "shop@example.com", slack: "#shop"}
slos:
  freshness: {max_age_hours: 12}
  completeness: {min_coverage: 0.98}
  accuracy: {method: "ledger", tolerance: "± 0.05%"}
  availability: {target_uptime: 0.999}
schema:
  type: object
  properties:
    thing_id:
      type: string
      required: true
      tests: [unique, not_null]
    kind:
      type: string
      enum: ["A", "B, C", 'it''s']
      max_length: 20
      tests:
        - not_null
        - in: ["A", "B, C"]
        - relationships: {to: "dim_kind", field: "kind"}
        - starts: "2024-01-01"
    made_on: {type: date}
tags: [critical, pii: "thing_id"]
deprecation_policy:
  example: {deprecated_column: "old_id", removal_date: "2024-06-01", replacement: "thing_id"}
"""
FLAT = """{"version": "2", "name": "orders", "domain": "shop", "slo": {"freshness_hours": 6, "completeness": 0.5},
"critical": true, "schema": {"properties": {"id": {"type": "int"}}}}"""
BAD = {
    "no_domain.yaml": "version: 1\nname: x\nschema: {properties: {}}\n",
    "schema_list.yaml": "version: 1\nname: x\ndomain: d\nschema: [a]\n",
    "no_properties.yml": "version: 1\nname: x\ndomain: d\nschema: {type: object}\n",
    "text_column.yaml": "version: 1\nname: x\ndomain: d\nschema: {properties: {c: hello}}\n",
    "no_type.yaml": "version: 1\nname: x\ndomain: d\nschema: {properties: {c: {required: true}}}\n",
    "broken.yaml": "version: [1\n",
    "list.yaml": "- 1\n",
    "blank.yaml": "\n",
}
MODELS = """
version: 2
models:
  - name: dim_thing
    meta: {contract: "shop/thing/v1", owner: "Shop team", slo_freshness_hours: 24, slo_completeness: 0.99, critical: true, pii_flag: true}
    config: {materialized: table}
    columns:
      - name: thing_id
        tests:
          - unique
          - dbt_utils.expression_is_true:
              expression: "RLIKE '^T_[0-9]{3}$'"
      - name: made_on
  - name: stg_thing
"""


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "contracts/shop/thing").mkdir(parents=True)
    (tmp_path / "contracts/shop/thing/v1.yaml").write_text(AGREEMENT)
    (tmp_path / "contracts/shop/orders.yml").write_text(FLAT)
    (tmp_path / "contracts/readme.txt").write_text("not an agreement")
    (tmp_path / "bad").mkdir()
    for name, text in BAD.items():
        (tmp_path / "bad" / name).write_text(text)
    (tmp_path / "models/marts").mkdir(parents=True)
    (tmp_path / "models/marts/thing.yml").write_text(MODELS)
    (tmp_path / "models/broken.yml").write_text("models: [")
    return tmp_path


@pytest.fixture
def good(spark, folder):
    return split_contracts(read_contracts(spark, str(folder / "contracts")))[0]


def test_contract_rows(good, rows):
    by_id = {r["id"]: r for r in rows(reg.extract_contracts(good))}
    assert sorted(by_id) == ["shop/dim_thing", "shop/orders"]
    thing, orders = by_id["shop/dim_thing"], by_id["shop/orders"]
    assert (thing["version"], orders["version"]) == ("1.0", "2")
    assert (thing["slo_freshness_hours"], orders["slo_freshness_hours"]) == (12, 6)
    assert [str(thing[f"slo_{k}"]) for k in ("completeness", "accuracy", "availability")] == ["0.98", "0.05", "0.999"]
    assert orders["slo_availability"] is None and orders["description"] == ""
    assert thing["owner_slack"] == "#shop"
    assert json.loads(thing["contract_json"])["owner"]["email"] == "shop@example.com"


def test_model_of_a_contract(good, rows):
    by_id = {r["id"]: r for r in rows(reg.contract_models(good))}
    assert by_id["shop/orders"]["critical"] is True and by_id["shop/dim_thing"]["critical"] is False
    assert by_id["shop/dim_thing"]["schema_name"] == "analytics"


def test_columns_keep_their_order(good, rows):
    cols = reg.contract_columns(good)
    got = [r["column_name"] for r in drift.contract_column_list(cols, "shop/dim_thing").collect()]
    assert got == ["thing_id", "kind", "made_on"]
    kind = next(r for r in rows(cols) if r["column_name"] == "kind")
    assert kind["enum_values_json"] == json.dumps(["A", "B, C", "it's"])
    assert (kind["max_length"], kind["required_flag"], kind["id"]) == (20, False, "shop/dim_thing/kind")


def test_tests_with_and_without_parameters(good, rows):
    got = {r["id"]: r for r in rows(reg.contract_tests(good))}
    base = "shop/dim_thing/kind/"
    assert f"{base}not_null" in got
    assert f'{base}in/["A", "B, C"]' in got
    link = got[base + 'relationships/{"field": "kind", "to": "dim_kind"}']
    assert link["test_params_json"] == '{"relationships": {"to": "dim_kind", "field": "kind"}}'
    assert link["description"] == "Test relationships on kind"
    assert f'{base}starts/"2024-01-01"' in got
    assert len(got) == 6


def test_model_files(spark, folder, good, rows):
    models = read_model_definitions(spark, str(folder / "models"))
    by_id = {r["id"]: r for r in rows(reg.extract_models(models))}
    assert sorted(by_id) == ["dbt/dim_thing", "dbt/stg_thing"]
    assert by_id["dbt/stg_thing"]["materialized_as"] == "view"
    resolved = reg.resolve_contract(reg.extract_models(models), reg.extract_contracts(good))
    assert {r["id"]: r["contract_id"] for r in rows(resolved)} == {"dbt/dim_thing": "shop/dim_thing", "dbt/stg_thing": None}
    assert {r["id"] for r in rows(reg.model_tests(models))} == {
        "dbt/dim_thing/thing_id/unique",
        'dbt/dim_thing/thing_id/dbt_utils.expression_is_true/{"expression": "RLIKE \'^T_[0-9]{3}$\'"}',
    }
    assert [r["column_name"] for r in rows(reg.model_columns(models))] == ["made_on", "thing_id"]


def test_faults(spark, folder, rows):
    documents = read_contracts(spark, str(folder / "bad"))
    found = {(r["source_path"].rsplit("/", 1)[1], r["error"]) for r in rows(reg.lint(documents))}
    assert found == {
        ("no_domain.yaml", "Missing required top-level key: 'domain'"),
        ("schema_list.yaml", "'schema' must be a mapping/object"),
        ("no_properties.yml", "'schema.properties' must be a mapping/object"),
        ("text_column.yaml", "Column 'c' definition must be an object"),
        ("no_type.yaml", "Column 'c' missing required 'type'"),
        ("broken.yaml", "not readable: ParserError"),
        ("list.yaml", "not a mapping"),
        ("blank.yaml", "not a mapping"),
    }
    rejected = {r["source_path"].rsplit("/", 1)[1] for r in rows(split_contracts(documents)[1])}
    assert rejected == {"no_domain.yaml", "broken.yaml", "list.yaml", "blank.yaml"}


def test_a_sound_document_has_no_faults(spark, folder):
    assert reg.lint(read_contracts(spark, str(folder / "contracts"))).collect() == []


def test_tags(good, rows):
    contracts = reg.extract_contracts(good)
    assert rows(transforms.pii_columns(contracts)) == [{"contract_id": "shop/dim_thing", "column_name": "thing_id"}]
    assert rows(transforms.by_tag(contracts, "critical"), "id") == [{"id": "shop/dim_thing"}]
    assert transforms.by_tag(contracts, "none").collect() == []


@pytest.mark.parametrize(("as_of", "state"), [("2024-01-01", "announced"), ("2024-05-01", "notice period"), ("2024-07-01", "due")])
def test_deprecation_calendar(good, as_of, state):
    r = versions.deprecation_calendar(reg.extract_contracts(good), f"{as_of} 00:00:00").first()
    assert (r.column_name, r.state) == ("old_id", state)


def test_publishing_twice_adds_nothing(good, rows):
    contracts = reg.extract_contracts(good)
    first = versions.publish(contracts, "me", "2024-01-01 00:00:00")
    assert {r["contract_id"] for r in rows(first)} == {"shop_dim_thing", "shop_orders"}
    assert versions.publish(contracts, "me", "2024-01-02 00:00:00", first).collect() == []


def test_numeric_version_order(spark):
    log = spark.createDataFrame([("c", "1.9"), ("c", "1.10")], "contract_id string, version string").withColumn(
        "published_at", F.lit("2024-01-01").cast("timestamp_ntz")
    )
    r = versions.latest_versions(log).first()
    assert (r.latest_version, r.highest_version) == ("1.9", "1.10")


def test_run_artifact(spark, tmp_path, rows):
    results = [
        {"resource_type": "test", "unique_id": "test.p.not_null_dim_thing_thing_id", "status": "pass", "execution_time": 0.0129},
        {"unique_id": "test.p.accepted_values_dim_thing_kind__A__B", "status": "fail", "failures": 3, "message": "Got 3",
         "compiled_code": "x" * 1500},
        {"resource_type": "model", "unique_id": "model.p.dim_thing", "status": "success"},
        {"unique_id": "test.p.unique_dim_thing_extra_id", "status": "fail", "failures": 0},
        {"resource_type": "test", "unique_id": "odd", "status": None},
        {"resource_type": "test", "unique_id": "test.p.rlike_orders_code", "status": "pass"},
    ]
    (tmp_path / "run_results.json").write_text(json.dumps({"results": results}, indent=1))
    read = src.only_tests(src.read_artifact(spark, str(tmp_path / "run_results.json")))
    models = spark.createDataFrame(
        [("dbt/dim_thing", "dim_thing", "shop/x"), ("dbt/dim_thing_extra", "dim_thing_extra", "shop/x"), ("shop/x", "dim_thing", "shop/x")],
        "id string, model_name string, contract_id string",
    )
    log = test_ids.denormalise_results(read, "run_1", "2024-01-01 00:00:00", models)
    got = {r["test_id"]: r for r in rows(log)}
    assert len(got) == 5
    first = got["test.p.not_null_dim_thing_thing_id"]
    assert (first["model_name"], first["column_name"], first["execution_time_ms"], first["test_type"]) == ("dim_thing", "thing_id", 12, "not_null")
    bad = got["test.p.accepted_values_dim_thing_kind__A__B"]
    assert (bad["column_name"], bad["rows_affected"], len(bad["compiled_sql"])) == ("kind", 3, 1500)
    longer = got["test.p.unique_dim_thing_extra_id"]
    assert (longer["model_name"], longer["column_name"], longer["rows_affected"]) == ("dim_thing_extra", "id", None)
    odd = got["odd"]
    assert (odd["model_name"], odd["column_name"], odd["test_name"], odd["status"]) == ("unknown", None, "unknown", "unknown")
    assert got["test.p.rlike_orders_code"]["test_type"] == "expression_is_true"
    plain = {r["test_id"]: r for r in rows(test_ids.denormalise_results(read, "run_1", "2024-01-01 00:00:00"))}
    assert (plain["test.p.unique_dim_thing_extra_id"]["model_name"], plain["test.p.unique_dim_thing_extra_id"]["column_name"]) == (
        "dim_thing", "extra_id",
    )
    linked = {r["test_id"]: r["contract_id"] for r in rows(test_ids.enrich_contract(log, models))}
    assert linked["test.p.unique_dim_thing_extra_id"] == "shop/x" and linked["odd"] is None


def test_broken_artifact_gives_no_rows(spark, tmp_path):
    (tmp_path / "bad.json").write_text("{not json")
    assert src.read_artifact(spark, str(tmp_path / "bad.json")).collect() == []


def test_seeds(spark, tmp_path, rows):
    (tmp_path / "accounts.csv").write_text(
        "account_id,account_name,account_type,account_status,customer_id,balance_usd,currency_code,last_transaction_date,opened_date,closed_date\n"
        "A_1,One,SAVINGS,ACTIVE,C_1,10.50,USD,2024-01-02,2020-01-01,\n"
        "A_2,Two,CREDIT,CLOSED,C_2,0.00,EUR,2024-01-02,2020-01-01,2024-01-03\n"
    )
    staged = transforms.staging(src.read_seed(spark, str(tmp_path / "accounts.csv"), "accounts"), ["last_transaction_date", "opened_date", "closed_date"])
    dim = transforms.dimension(staged, staged.columns)
    assert {r["account_id"]: r["closed_date"] is None for r in rows(dim)} == {"A_1": True, "A_2": False}
    assert dict(dim.dtypes)["closed_date"] == "date" and dict(dim.dtypes)["balance_usd"] == "decimal(18,2)"

    (tmp_path / "publishers.csv").write_text("publisher_id,publisher_name,publisher_type,publisher_contact\np1,Team,team,t@example.com\n")
    pub = rows(src.publishers_from_seed(src.read_seed(spark, str(tmp_path / "publishers.csv"), "publishers")))
    assert pub == [{"id": "p1", "publisher_type": "team", "name": "Team", "config_json": '{"contact":"t@example.com"}'}]

    (tmp_path / "subscribers.csv").write_text("subscriber_id,subscriber_name,subscriber_type,subscriber_contact\ns1,board,app,b@example.com\ns2,other,app,o@example.com\n")
    sub = rows(src.subscribers_from_seed(src.read_seed(spark, str(tmp_path / "subscribers.csv"), "subscribers"), {"s1": '["a/b"]'}))
    assert [(r["id"], r["email"], r["watching_contract_ids_json"]) for r in sub] == [("s1", "b@example.com", '["a/b"]'), ("s2", "o@example.com", None)]

    (tmp_path / "slo.csv").write_text("slo_id,contract_id,metric_name,metric_value,metric_timestamp\nm1,a/b,freshness,23.5,2024-01-01T10:00:00Z\n")
    m = rows(src.slo_metrics_from_seed(src.read_seed(spark, str(tmp_path / "slo.csv"), "slo_metrics")))[0]
    assert (m["metric_type"], m["actual_value"], str(m["measurement_ts"])) == ("freshness", 23.5, "2024-01-01 10:00:00")


def test_malformed_date_fails_when_strict(spark):
    df = spark.createDataFrame([("soon",)], "d string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        transforms.staging(df, ["d"]).collect()
    assert transforms.staging(df, ["d"], strict=False).first().d is None
    assert transforms.malformed_dates(df, ["d"]).first().rows_failed == 1


def test_metric_queries_from_a_folder(spark, tmp_path, rows):
    spark.range(10).createOrReplaceTempView("numbers_for_metrics")
    (tmp_path / "b.sql").write_text("SELECT avg(id) AS actual_value FROM numbers_for_metrics;\n")
    (tmp_path / "a.sql").write_text("SELECT count(*) AS actual_value FROM numbers_for_metrics")
    (tmp_path / "notes.txt").write_text("no")
    assert rows(src.metric_queries(spark, str(tmp_path))) == [
        {"metric_type": "a", "actual_value": 10.0}, {"metric_type": "b", "actual_value": 4.5}
    ]


def test_helpers_travel_without_the_package(tmp_path):
    """The YAML helper is sent to the workers by value: a process that cannot import
    the package can run it."""
    from pyspark import cloudpickle

    from contractcheck.functions.text import _parse_one

    (tmp_path / "f.bin").write_bytes(cloudpickle.dumps(_parse_one))
    code = "import pickle, sys; from pyspark import cloudpickle; print(pickle.load(open('f.bin', 'rb'))('x: 1'))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=60)
    assert done.stdout.strip() == """('{"x": 1}', None)""", done.stderr


def test_text_without_content(spark):
    files = spark.createDataFrame([("a", "x: 1"), ("b", None), ("c", "")], "source_path string, text string")
    got = {r.source_path: (r.content, r.parse_error) for r in parse_documents(files).collect()}
    assert got == {"a": ('{"x": 1}', None), "b": (None, "not a mapping"), "c": (None, "not a mapping")}


def test_an_empty_file_is_a_reject(spark, tmp_path):
    (tmp_path / "sub dir").mkdir()
    (tmp_path / "sub dir" / "nothing é.yaml").write_text("")
    (tmp_path / "good.yaml").write_text('{"version": "1", "name": "n", "domain": "d", "schema": {}}')
    good, rejects = split_contracts(read_contracts(spark, str(tmp_path)))
    assert good.count() == 1
    assert [(r.source_path.rsplit("/", 1)[-1], bool(r.reject_reason)) for r in rejects.collect()] == [("nothing%20é.yaml", True)]


DOC = '{{"version": "1", "name": "{name}", "domain": "d", "schema": {{"properties": {{}}}}}}'


def test_only_new_and_changed_files_are_parsed(spark, tmp_path, monkeypatch):
    """Three arrivals, a crash between, a file of zero bytes, one that goes."""
    from contractcheck.operators import storage
    from contractcheck.plans import daily

    folder, root = tmp_path / "agreements", str(tmp_path / "registry")
    folder.mkdir()
    run = daily.Run(spark, root, "2024-03-02 06:00:00", {})

    def names():
        return {r["id"] for r in run.read("contracts").collect()}

    def mark():
        """Kept documents get a sign that only a fresh parse would not have."""
        marked = run.read("contract_documents").withColumn("content", F.regexp_replace("content", '"domain": "d"', '"domain": "kept"'))
        storage.write_snapshot(marked, root, "contract_documents")

    (folder / "a.yaml").write_text(DOC.format(name="a"))
    (folder / "none.yaml").write_text("")
    rejects = daily.refresh_registry(run, str(folder)).collect()
    assert names() == {"d/a"} and [r["source_path"].rsplit("/", 1)[-1] for r in rejects] == ["none.yaml"]

    mark()
    (folder / "b.yaml").write_text(DOC.format(name="b"))
    with monkeypatch.context() as m:
        m.setattr(daily, "_merge", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            daily.refresh_registry(run, str(folder))
    assert names() == {"d/a"}
    daily.refresh_registry(run, str(folder))
    assert names() == {"d/a", "kept/a", "d/b"}  # a came from its kept document, b was parsed

    mark()
    (folder / "a.yaml").write_text(DOC.format(name="a") + "\n")
    (folder / "none.yaml").write_text(DOC.format(name="late"))
    (folder / "b.yaml").unlink()
    rejects = daily.refresh_registry(run, str(folder)).collect()
    assert rejects == [] and names() == {"d/a", "kept/a", "d/b", "d/late"}
    kept = {r["source_path"].rsplit("/", 1)[-1]: r["content"] for r in run.read("contract_documents").collect()}
    assert set(kept) == {"a.yaml", "none.yaml"} and not any("kept" in c for c in kept.values())


def test_column_order_parses_every_document_once(spark, tmp_path, monkeypatch):
    import pandas as pd

    from contractcheck.functions.text import PARSED, _parse_one
    from contractcheck.sources import documents
    from contractcheck.workload.contracts import contract_column_order

    seen = tmp_path / "seen"
    seen.mkdir()
    log = str(seen)

    @F.pandas_udf(PARSED)
    def logged(texts: pd.Series) -> pd.DataFrame:
        import uuid

        with open(f"{log}/{uuid.uuid4().hex}", "w") as f:
            f.write("x" * len(texts))
        return pd.DataFrame([_parse_one(t) for t in texts], columns=["content", "parse_error"])

    # Fault 5, two sound agreements of one name (their columns come twice), a later sound one, one that is not YAML.
    parts = [(3, "a", "Brand#1", "T", 15), (4, "b", "Brand#2", "T", 20), (4, "b", "Brand#2", "T", 20), (7, "c", "Brand#3", "T", 10), (8, "d", "Brand#1", "T", 9)]
    spark.createDataFrame(parts, "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    monkeypatch.setattr(documents, "yaml_to_json", logged.asNondeterministic())
    got = [(r.pos, r.column_name) for r in contract_column_order(spark, str(tmp_path)).collect()]
    assert got == [(0, "id"), (0, "id"), (1, "label"), (1, "label"), (2, "price"), (2, "price")]
    assert sum(f.stat().st_size for f in seen.iterdir()) == len(parts)
