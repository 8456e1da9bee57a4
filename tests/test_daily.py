"""Storage, retention and a whole run over two days."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from contractcheck.functions.lineage import settled
from contractcheck.operators import readiness, reports, storage
from contractcheck.plans.daily import Run, run_daily
from contractcheck.schemas import COLUMN_DEFAULTS, SUBSCRIBERS, TEST_RESULTS, conform, empty, missing_required

AGREEMENT = """
version: "{version}"
name: things
domain: shop
slos:
  freshness: {{max_age_hours: 24}}
  completeness: {{min_coverage: 0.9}}
schema:
  properties:
    id: {{type: bigint, required: true, tests: [unique, not_null]}}
    kind: {{type: string, required: true, max_length: 3, enum: ["A", "B"], tests: [not_null, in: ["A", "B"]]}}
    owner: {{type: int, tests: [relationships: {{to: owners, field: owner_id}}, positive]}}
    amount: {{type: "decimal(18,2)", tests: [dbt_expectations.expect_column_values_to_be_of_type: ["decimal"]]}}
    gone: {{type: string, tests: [not_null]}}
"""
MODEL = """
models:
  - name: things
    meta: {contract: "shop/things", critical: true, slo_freshness_hours: 24, slo_completeness: 0.5}
    columns:
      - name: id
        tests:
          - not_null
          - dbt_utils.expression_is_true: {expression: "< 100"}
"""


def things(spark, n, nulls, created):
    return spark.range(n).select(
        "id",
        F.when(F.col("id") >= nulls, F.when(F.col("id") % 2 == 0, "A").otherwise("B")).alias("kind"),
        (F.col("id") % 3).cast("int").alias("owner"),
        F.lit(1).cast("decimal(18,2)").alias("amount"),
        F.lit(created).cast("timestamp_ntz").alias("updated_at"),
        F.lit(1).alias("_batch"),
        F.lit(1).alias("surplus"),
    )


@pytest.fixture
def world(spark, tmp_path):
    (tmp_path / "contracts").mkdir()
    (tmp_path / "contracts/v1.yaml").write_text(AGREEMENT.format(version="1.9"))
    (tmp_path / "contracts/v2.yaml").write_text(AGREEMENT.format(version="1.10"))
    (tmp_path / "contracts/bad.yaml").write_text("name: x\n")
    (tmp_path / "models").mkdir()
    (tmp_path / "models/m.yml").write_text(MODEL)
    root = str(tmp_path / "registry")
    storage.ensure_tables(spark, root)
    subs = spark.createDataFrame(
        [("s1", "board", '["shop/things"]'), ("s2", "free", '["shop/none"]'), ("s3", "idle", None)],
        "id string, subscriber_name string, watching_contract_ids_json string",
    )
    storage.write_snapshot(subs, root, "subscribers")
    return tmp_path, root


def start(spark, world, as_of, n, nulls, created, **more):
    base, root = world
    things(spark, n, nulls, created).write.mode("overwrite").parquet(str(base / "things"))
    spark.createDataFrame([(0,), (1,)], "owner_id int").write.mode("overwrite").parquet(str(base / "owners"))
    run = Run(
        spark, root, as_of, {"things": str(base / "things"), "owners": str(base / "owners")},
        custom_tests={"positive": lambda df, check: df.filter(F.col(check.column) < 0)}, **more,
    )
    return run, run_daily(run, str(base / "contracts"), str(base / "models"))


def test_two_days(spark, world, rows):
    run, summary = start(spark, world, "2024-03-02 06:00:00", 10, 3, "2024-03-01 00:00:00")

    versions = {r["version"] for r in rows(run.read("contracts"))}
    assert versions == {"1.9", "1.10"}
    models = {r["id"]: r for r in rows(run.read("models"))}
    assert models["dbt/things"]["contract_id"] == "shop/things" and models["dbt/things"]["meta_json"]
    assert len(rows(run.log("contract_registry"))) == 2

    results = {(r["test_id"].removeprefix("shop/things/").removeprefix("dbt/things/"), r["contract_id"]): r for r in rows(run.log("test_results"))}
    status = {k[0]: r["status"] for k, r in results.items()}
    assert {k[1] for k in results} == {"shop/things"}
    assert status["id/unique"] == "pass" and status["kind/not_null"] == "fail"
    assert status['kind/in/["A", "B"]'] == "pass" and status["kind/enum"] == "pass" and status["kind/max_length"] == "pass"
    link = next(k for k in status if k.startswith("owner/relationships"))
    assert status[link] == "fail" and status["owner/positive"] == "pass"
    assert next(s for k, s in status.items() if "of_type" in k) == "pass"
    assert status["gone/not_null"] == "error"
    assert next(s for k, s in status.items() if "expression_is_true" in k) == "pass"
    link_row = next(r for k, r in results.items() if k[0] == link)
    assert link_row["rows_affected"] == 3

    # Two registrations of the table ask for different completeness levels.
    slos = {(r["metric_type"], r["expected_value"]): (r["status"], r["actual_value"]) for r in rows(run.log("slo_metrics"))}
    assert slos == {
        ("freshness", 24.0): ("fail", 30.0),
        ("completeness", 90.0): ("fail", 85.0),
        ("completeness", 50.0): ("pass", 85.0),
        ("availability", 99.9): ("pass", 100.0),
    }

    issues = {(r["model_id"], r["quality_check_type"], r["description"].split("'")[1], r["severity"]) for r in rows(run.log("data_quality_log"))}
    assert ("shop/things", "schema_drift", "gone", "high") in issues
    assert ("shop/things", "schema_drift", "surplus", "medium") in issues
    assert ("shop/things", "null_spike", "kind", "high") in issues
    assert ("dbt/things", "schema_drift", "kind", "medium") in issues
    assert not any(i[2] == "_batch" for i in issues)

    subs = {r["id"]: r for r in rows(run.read("subscribers"))}
    assert subs["s1"]["ready_for_consumption"] is False
    assert subs["s1"]["ready_for_consumption_reason"] == "shop/things: Tests failing: 2 failures; SLOs failing: 2 failures"
    assert (subs["s2"]["ready_for_consumption"], subs["s2"]["ready_for_consumption_reason"]) == (True, "shop/none: Ready")
    assert subs["s3"]["ready_for_consumption"] is False and subs["s3"]["daily_slo_check_ts"] is None
    assert {r["subscriber_id"] for r in rows(run.log("outbox"))} == {"s2"}

    out = rows(summary)[0]
    assert (out["failed"], out["level"]) == (3, 2)

    # The same run again adds nothing to the logs.
    sizes = {t: run.log(t).count() for t in ("test_results", "slo_metrics", "data_quality_log", "outbox", "contract_registry")}
    start(spark, world, "2024-03-02 06:00:00", 10, 3, "2024-03-01 00:00:00")
    assert {t: run.log(t).count() for t in sizes} == sizes

    # The next day is clean but for the declared column that does not exist.
    base, root = world
    run2, summary2 = start(spark, world, "2024-03-10 06:00:00", 2, 0, "2024-03-10 00:00:00")
    assert len(rows(run2.log("contract_registry"))) == 2
    subs = {r["id"]: r for r in rows(run2.read("subscribers"))}
    assert subs["s1"]["ready_for_consumption"] is True
    assert {(r["subscriber_id"], r["created_at"].day) for r in rows(run2.log("outbox"))} == {("s2", 2), ("s1", 10)}
    # Seven days of retention: the first run is gone from two logs, not from the third.
    assert {r["run_timestamp"].day for r in rows(run2.log("test_results"))} == {10}
    assert {r["measurement_ts"].day for r in rows(run2.log("slo_metrics"))} == {10}
    assert {r["detected_at"].day for r in rows(run2.log("data_quality_log"))} == {2, 10}
    kept = {r["id"]: r for r in rows(run2.read("models"))}["shop/things"]
    assert (kept["_created_ts"].day, kept["_updated_ts"].day) == (2, 10)


def test_critical_models_can_block(spark, world, rows):
    run, _ = start(spark, world, "2024-03-02 06:00:00", 10, 3, "2024-03-02 00:00:00", critical_models_block=True, slos=False)
    assert {r["severity"] for r in rows(run.log("data_quality_log")) if r["model_id"] == "dbt/things"} == {"medium"}
    assert {r["severity"] for r in rows(run.log("data_quality_log")) if r["model_id"] == "shop/things"} == {"high", "medium"}
    assert run.log("slo_metrics").count() == 0


def log_rows(spark, moments):
    df = spark.createDataFrame([(str(i), m) for i, m in enumerate(moments)], "id string, m string")
    return df.select(
        "id", F.lit("r").alias("run_id"), F.col("id").alias("test_id"), F.col("m").cast("timestamp_ntz").alias("run_timestamp")
    )


def test_retention_deletes_by_day(spark, tmp_path, rows):
    root, archive = str(tmp_path / "r"), str(tmp_path / "a")
    storage.append_log(log_rows(spark, ["2024-01-01 10:00:00", "2024-01-03 05:00:00", "2024-01-03 07:00:00", "2024-01-04 00:00:00", None]), root, "test_results")
    kept_file = [f for f in os.listdir(f"{root}/test_results/run_date=2024-01-04") if f.endswith(".parquet")]
    assert storage.expire_log(spark, root, "test_results", 7, "2024-01-10 06:00:00", archive, enabled=False) == 0
    assert storage.expire_log(spark, root, "test_results", 7, "2024-01-10 06:00:00", archive) == 2
    assert sorted(r["id"] for r in rows(storage.read_log(spark, root, "test_results"))) == ["2", "3", "4"]
    assert kept_file == [f for f in os.listdir(f"{root}/test_results/run_date=2024-01-04") if f.endswith(".parquet")]
    assert sorted(r.id for r in spark.read.parquet(f"{archive}/test_results").collect()) == ["0", "1"]
    assert storage.expire_log(spark, root, "test_results", 7, "2024-01-10 06:00:00") == 0
    assert storage.expire_log(spark, root, "test_results", 6, "2024-01-10 08:00:00") == 2
    assert not os.path.exists(f"{root}/test_results/run_date=2024-01-03")


def test_retention_can_be_repeated_after_a_crash(spark, tmp_path, rows, monkeypatch):
    """The rewrite of the edge day is cut short after its old files were deleted."""
    root, archive = str(tmp_path / "r"), str(tmp_path / "a")
    storage.append_log(log_rows(spark, ["2024-01-01 10:00:00", "2024-01-03 05:00:00", "2024-01-03 07:00:00"]), root, "test_results")

    def crash(session, staging, target):
        storage._delete(session, target)
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(storage, "_put_in_place", crash)
        with pytest.raises(RuntimeError):
            storage.expire_log(spark, root, "test_results", 7, "2024-01-10 06:00:00", archive)
    assert storage.expire_log(spark, root, "test_results", 7, "2024-01-10 06:00:00", archive) == 1
    assert [r["id"] for r in rows(storage.read_log(spark, root, "test_results"))] == ["2"]
    assert sorted(r.id for r in spark.read.parquet(f"{archive}/test_results").collect()) == ["0", "1"]


def test_one_day_reads_one_folder(spark, tmp_path):
    root = str(tmp_path)
    storage.append_log(log_rows(spark, ["2024-01-01 10:00:00", "2024-01-02 10:00:00"]), root, "test_results")
    day = storage.read_log(spark, root, "test_results", "2024-01-02")
    assert [r.id for r in day.collect()] == ["1"]
    assert "PartitionFilters: [isnotnull(run_date" in day._jdf.queryExecution().toString()
    assert reports.find_results(storage.read_log(spark, root, "test_results"), day="2024-01-01").count() == 1


def test_unfinished_snapshots_are_ignored(spark, tmp_path, rows):
    root = str(tmp_path)
    assert storage.write_snapshot(spark.range(1), root, "t") == 1
    assert storage.write_snapshot(spark.range(2), root, "t") == 2
    os.remove(f"{root}/t/v=000000002/_SUCCESS")
    assert storage.read_current(spark, root, "t").count() == 1
    assert storage.write_snapshot(spark.range(3), root, "t") == 2
    assert storage.read_current(spark, root, "t").count() == 3
    with pytest.raises(FileNotFoundError):
        storage.read_current(spark, root, "unknown")


def test_keys_must_be_unique(spark):
    df = spark.createDataFrame([(1,), (1,)], "id int")
    with pytest.raises(ValueError, match="not unique"):
        storage.assert_unique(df, ["id"], "models")


def test_defaults_and_required_columns(spark, rows):
    df = spark.createDataFrame([("s1", "name"), ("s2", None)], "id string, subscriber_name string")
    out = conform(df, SUBSCRIBERS, COLUMN_DEFAULTS["subscribers"])
    assert {r["ready_for_consumption"] for r in rows(out)} == {False}
    assert [r.id for r in missing_required(out, SUBSCRIBERS).collect()] == ["s2"]


def test_materialise_with_a_hot_value(spark, tmp_path):
    df = spark.range(1000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k")
    storage.materialise(df, str(tmp_path / "m"), "k")
    assert spark.read.parquet(str(tmp_path / "m")).count() == 1000


def status_frame(spark, log, moment="2024-01-05 10:00:00"):
    logs = {
        "tests": ("contract_id string, status string", "run_timestamp"),
        "slos": ("contract_id string, status string", "measurement_ts"),
        "issues": ("model_id string, severity string, reviewed_flag boolean", "detected_at"),
    }
    frames = [
        spark.createDataFrame(log.get(k, []), schema).withColumn(ts, F.lit(moment).cast("timestamp_ntz")) for k, (schema, ts) in logs.items()
    ]
    models = spark.createDataFrame([("m1", "a"), ("m2", "a"), ("m3", "b")], "id string, contract_id string")
    return readiness.contract_status(*frames, models, "2024-01-05")


def test_decisions(spark, rows):
    log = {
        "tests": [("a", "pass"), ("b", "fail"), ("b", "fail"), ("c", "error"), (None, "fail")],
        "slos": [("a", "unknown"), ("b", "fail")],
        "issues": [("m1", "high", False), ("m2", "critical", True), ("m3", "critical", False), ("lost", "critical", False)],
    }
    got = {r["contract_id"]: (r["ready"], r["reason"], r["dq_status"]) for r in rows(status_frame(spark, log))}
    assert got == {
        "a": (True, "All checks passed", "warning"),
        "b": (False, "Tests failing: 2 failures; SLOs failing: 1 failures; Data quality issues: 1 critical", "fail"),
        "c": (True, "All checks passed", "pass"),
    }
    assert rows(status_frame(spark, log, "2024-01-06 00:00:00")) == []


def test_watch_lists(spark, rows):
    status = status_frame(spark, {"tests": [("it's", "fail")]})
    when = F.lit(None).cast("timestamp_ntz")
    subs = spark.createDataFrame(
        [("1", '["z", "it\'s", "z"]'), ("2", "[]"), ("3", "{oops"), ("4", None), ("5", '["z"]')], "id string, watching_contract_ids_json string"
    ).select(
        "*", F.lit(None).cast("boolean").alias("ready_for_consumption"), F.lit("before").alias("ready_for_consumption_reason"),
        when.alias("daily_slo_check_ts"), when.alias("_updated_ts"),
    )
    got = {r["id"]: r for r in rows(readiness.readiness(status, subs, "2024-01-05 11:00:00"))}
    assert got["1"]["ready_for_consumption_reason"] == "z: Ready; it's: Tests failing: 1 failures; z: Ready"
    assert got["1"]["ready_for_consumption"] is False and got["5"]["ready_for_consumption"] is True
    assert got["1"]["_updated_ts"] == dt.datetime(2024, 1, 5, 11)
    assert all(got[i]["ready_for_consumption_reason"] == "before" and got[i]["_updated_ts"] is None for i in "234")
    changes = {r["id"] for r in rows(readiness.flag_changes(subs, readiness.readiness(status, subs, "2024-01-05 11:00:00")))}
    assert changes == {"1", "5"}


def test_breach_switches(spark, rows):
    moment = F.lit("2024-01-05 10:00:00").cast("timestamp_ntz")
    slos = spark.createDataFrame([("1", "a", "freshness", "fail")], "id string, contract_id string, metric_type string, status string").withColumn("measurement_ts", moment)
    tests = spark.createDataFrame([("2", "a", "t", "fail")], "id string, contract_id string, test_id string, status string").withColumn("run_timestamp", moment)
    assert [r["event_type"] for r in rows(readiness.breaches(slos, tests, "2024-01-05"))] == ["slo_breach"]
    assert readiness.breaches(slos, tests, "2024-01-05", False, False).collect() == []


def test_latest_breaks_ties_by_id(spark, rows):
    df = spark.createDataFrame([("t", 1, "a"), ("t", 1, "b"), ("u", 2, "c")], "test_id string, run_timestamp int, id string")
    want = [{"test_id": "t", "run_timestamp": 1, "id": "b"}, {"test_id": "u", "run_timestamp": 2, "id": "c"}]
    assert rows(reports.latest(df, ["test_id"], ["run_timestamp", "id"])) == want
    assert rows(reports.latest_by_max(df, ["test_id"], ["run_timestamp", "id"])) == want


def test_health_uses_the_latest_result_only(spark, rows):
    contracts = spark.createDataFrame([("a", "A", "d"), ("b", "B", "d")], "id string, name string, domain string")
    models = spark.createDataFrame([("m", "a")], "id string, contract_id string")
    tests = spark.createDataFrame([("t1", "m"), ("t2", "m"), ("t3", "m")], "id string, model_id string")
    results = spark.createDataFrame(
        [("t1", "pass", 1, "1"), ("t1", "pass", 2, "2"), ("t2", "pass", 1, "3"), ("t2", "fail", 2, "4")],
        "test_id string, status string, run_timestamp int, id string",
    )
    got = {r["name"]: r for r in rows(reports.contract_health(contracts, models, tests, results))}
    assert (got["A"]["total_tests"], got["A"]["passing_tests"], got["A"]["failing_tests"], got["A"]["pass_rate"]) == (3, 1, 1, 33.33)
    assert (got["B"]["total_tests"], got["B"]["pass_rate"]) == (0, None)


def test_settled_uses_the_folder_of_the_session(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path / "shared"))
    assert settled(spark.range(3)).count() == 3
    assert os.listdir(tmp_path / "shared")


def test_empty_logs(spark, tmp_path):
    assert storage.read_log(spark, str(tmp_path), "test_results").count() == 0
    assert empty(spark, TEST_RESULTS).columns[0] == "id"


def test_nobody_is_ready_about_a_table_nobody_read(spark, tmp_path):
    agreement = """
domain: {domain}
name: {name}
version: "1.0"
owner: {{name: a, email: a@b.c}}
schema:
  properties:
    id: {{type: bigint, required: true, tests: [not_null, not_null, accepted_values: {{values: [1, null]}}, expression_is_true: {{expression: ">> ?? 1"}}]}}
slos:
  freshness: {{max_age_hours: 24}}
  completeness: {{min_coverage: 0.9}}
"""
    folder = tmp_path / "agreements"
    folder.mkdir()
    (folder / "ghost.yaml").write_text(agreement.format(domain="shop", name="ghost"))
    (folder / "orders.yaml").write_text(agreement.format(domain="shop", name="orders"))
    (folder / "orders_copy.yaml").write_text(agreement.format(domain="shop", name="orders"))
    (folder / "broken.yaml").write_text("{")
    spark.createDataFrame([(1,), (2,)], "id bigint").write.parquet(str(tmp_path / "orders"))
    run = Run(spark, str(tmp_path / "registry"), "2024-02-01 06:00:00", {"orders": str(tmp_path / "orders")})
    summary = run_daily(run, str(folder)).collect()[0]
    assert summary["rejected"] == 2 and summary["level"] == 2
    gone = run.log("slo_metrics", run.day).filter("contract_id = 'shop/ghost' AND metric_type = 'availability'").collect()
    assert [r["status"] for r in gone] == ["fail"]
    results = run.log("test_results", run.day).collect()
    ghost = {r["status"] for r in results if r["model_name"] == "ghost"}
    orders = {(r["test_name"], r["status"]) for r in results if r["model_name"] == "orders"}
    assert ghost == {"error"}
    assert orders == {("not_null", "pass"), ("accepted_values", "fail"), ("expression_is_true", "error")}
    assert sum(r["model_name"] == "orders" and r["test_name"] == "not_null" for r in results) == 1


DECLARED = """
domain: shop
name: items
version: "1.0"
owner: {name: a, email: a@b.c}
schema:
  properties:
    id:
      type: bigint
      tests:
        - unique: {columns: [id, g]}
        - equal_rowcount: {compare_model: twin}
        - dbt_utils.equal_rowcount: {compare_model: nowhere}
        - cardinality_equality: {to: "ref('twin')", field: id}
        - sequential_values: {interval: 1, group_by_columns: [g]}
    low:
      type: int
      tests:
        - mutually_exclusive_ranges: {lower_bound_column: low, upper_bound_column: high, partition_by: g}
        - dbt_utils.unique_combination_of_columns: {combination_of_columns: [g, absent]}
    at: {type: timestamp, tests: [recency: {datepart: day, field: at, interval: 1}]}
"""


def test_declared_tests_run(spark, tmp_path):
    (tmp_path / "agreements").mkdir()
    (tmp_path / "agreements/items.yaml").write_text(DECLARED)
    items = [(1, 0, 0, 5), (2, 0, 5, 9), (4, 0, 8, 9), (1, 1, 0, 1)]
    table = spark.createDataFrame(items, "id bigint, g int, low int, high int")
    table.withColumn("at", F.lit("2024-01-31 12:00:00").cast("timestamp_ntz")).write.parquet(str(tmp_path / "items"))
    spark.createDataFrame([(1,), (2,), (4,)], "id bigint").write.parquet(str(tmp_path / "twin"))
    tables = {"items": str(tmp_path / "items"), "twin": str(tmp_path / "twin")}
    run = Run(spark, str(tmp_path / "registry"), "2024-02-01 06:00:00", tables)
    run_daily(run, str(tmp_path / "agreements"))
    got = {(r["test_name"], r["status"], r["rows_affected"]) for r in run.log("test_results").collect()}
    assert got == {
        ("unique", "pass", None),
        ("equal_rowcount", "fail", 1),
        ("equal_rowcount", "error", None),
        ("cardinality_equality", "fail", 1),
        ("sequential_values", "fail", 1),
        ("mutually_exclusive_ranges", "fail", 1),
        ("unique_combination_of_columns", "error", None),
        ("recency", "pass", None),
    }
