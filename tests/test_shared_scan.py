"""One scan per table, probes that fail alone, levels out of the run's counts."""

import pytest
from pyspark.sql import functions as F

from contractcheck.operators import slo, transforms
from contractcheck.operators.counters import Check, profile_from_counts
from contractcheck.plans import shared_scan
from contractcheck.plans.daily import Run, run_daily
from contractcheck.plans.shared_scan import Probe, bisected, measured, one_pass, table_probes


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def tables(spark, tmp_path):
    spark.range(100).selectExpr("id", "IF(id = 77, 'oops', CAST(id AS STRING)) AS code", "id % 5 AS k", "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS created_at").write.parquet(str(tmp_path / "a"))
    spark.range(50).selectExpr("id", "id / 0.5D AS v").write.parquet(str(tmp_path / "b"))
    return {n: spark.read.parquet(str(tmp_path / n)) for n in "ab"}


def expression(table, column, text):
    return Probe(table, f"{table}/{column}{text}", Check(column, "expression_is_true", {"expression": text}))


def test_one_scan_per_table(tables):
    probes = [Probe("a", f"n{i}", Check(c, "not_null")) for i, c in enumerate(("id", "code", "k"))]
    probes += [expression("a", "id", "> 5"), expression("a", "k", "< 3"), *table_probes("a"), *table_probes("b"), expression("b", "v", ">= 0")]
    assert plan(one_pass(tables, probes, ("created_at",))).count("FileScan parquet") == 2


def test_culprits_stand_alone(tables, monkeypatch):
    probes = [expression("a", "id", f"> {i}") for i in range(20)] + [expression("a", "code", "> 0"), *table_probes("a")]
    probes += [expression("b", "v", "> 10"), *table_probes("b"), expression("b", "id", "% 0 = 1")]
    passes = []
    monkeypatch.setattr(shared_scan, "one_pass", lambda *a: passes.append(len(a[1])) or one_pass(*a))
    rows = bisected(tables, probes, ("created_at",))
    got = {r[1]: r for r in rows}
    assert len(rows) == len(probes) == len(got)
    bad = {k: r[8] for k, r in got.items() if r[6] is None}
    assert set(bad) == {"a/code> 0", "b/id% 0 = 1"}
    assert "CAST_INVALID_INPUT" in bad["a/code> 0"] and "BY_ZERO" in bad["b/id% 0 = 1"]
    assert [got[f"a/id> {i}"][6] for i in range(20)] == [i + 1 for i in range(20)]
    assert got["b/v> 10"][5:7] == (50, 6) and got["a/newest"][7].year == 2024 and got["b/newest"][7] is None
    assert len(passes) <= 4 * 5 + 2


def test_a_broken_file_is_one_table(spark, tables, tmp_path):
    (tmp_path / "c").mkdir()
    spark.range(5).write.mode("overwrite").parquet(str(tmp_path / "c"))
    broken = spark.read.parquet(str(tmp_path / "c"))
    for f in (tmp_path / "c").glob("*.parquet"):
        f.write_bytes(b"PAR1" + b"x" * 20)
    probes = [expression("a", "id", "> 5"), expression("c", "id", "> 5"), *table_probes("a"), *table_probes("c", with_moment=False)]
    got = {r.test_id: (r.rows_total, r.rows_failed, bool(r.reason)) for r in measured(spark, {**tables, "c": broken}, probes).collect()}
    assert got == {"a/id> 5": (100, 6, False), "c/id> 5": (None, None, True), "a/table": (100, 0, False), "a/newest": (100, 0, False), "c/table": (None, None, True)}


def test_many_counters_take_more_passes(tables, monkeypatch):
    monkeypatch.setattr(shared_scan, "MAX_COUNTERS_PER_PASS", 4)
    probes = [expression("a", "id", f"> {i}") for i in range(10)]
    frame = one_pass(tables, probes, ())
    assert plan(frame).count("FileScan parquet") == 3
    assert sorted(r.rows_failed for r in frame.collect()) == list(range(1, 11))


AGREEMENT = """
domain: shop
name: {name}
version: "1.0"
owner: {{name: a, email: a@b.c}}
slos:
{levels}
schema:
  properties:
    id: {{type: bigint, required: true, tests: [not_null, expression_is_true: {{expression: ">= 0"}}]}}
    code: {{type: string, required: true, tests: [not_null, expression_is_true: {{expression: "> 0"}}]}}
"""


@pytest.mark.parametrize("defaults", [False, True])
def test_a_run_with_a_failing_cast(spark, tables, tmp_path, defaults):
    """The cast fails in one of two tables; everything else of both is logged, and fractions of levels hold."""
    folder = tmp_path / "agreements"
    folder.mkdir()
    (folder / "a.yaml").write_text(AGREEMENT.format(name="a", levels="  freshness: {max_age_hours: 0.5}\n  completeness: {min_coverage: 0.99999}"))
    (folder / "b.yaml").write_text(AGREEMENT.format(name="b", levels="  availability: {target_uptime: 0.9}"))
    paths = {n: str(tmp_path / n) for n in "ab"}
    run = Run(spark, str(tmp_path / "registry"), "2024-01-01 00:31:00", paths, default_levels=defaults)
    summary = run_daily(run, str(folder)).collect()[0]
    results = {r["test_id"]: r for r in run.log("test_results", run.day).collect()}
    status = {k.removeprefix("shop/").split("{")[0]: r["status"] for k, r in results.items()}
    assert status["a/code/expression_is_true/"] == "error" and status["b/code/not_null"] == "error"
    assert status["a/id/not_null"] == status["a/id/expression_is_true/"] == status["b/id/not_null"] == "pass"
    reason = next(r["failure_message"] for k, r in results.items() if k.startswith("shop/a/code/expression"))
    assert "CAST_INVALID_INPUT" in reason and "oops" in reason
    slos = {(r["contract_id"], r["metric_type"], r["expected_value"]): r["status"] for r in run.log("slo_metrics", run.day).collect()}
    wanted = {("shop/a", "freshness", 0.5): "fail", ("shop/a", "completeness", 99.999): "pass", ("shop/a", "availability", 99.9): "pass", ("shop/b", "availability", 99.9): "pass"}
    if defaults:
        wanted |= {("shop/b", "freshness", 24.0): "unknown", ("shop/b", "completeness", 99.0): slos[("shop/b", "completeness", 99.0)]}
    assert slos == wanted
    assert summary["level"] == 2 and summary["quality_failed"] > 0


def test_levels_measure_a_level_once(spark, tables):
    counts = measured(spark, tables, [*table_probes("a"), Probe("a", "required/code", Check("code", "not_null", severity="required"))], ("created_at",))
    targets = spark.createDataFrame([("c", "a", 0.0, 0.5), ("c", "a", 0.0, 0.5), ("c", "gone", 1.0, 1.0)], "contract_id string, model_name string, freshness_slo_hours double, completeness_slo double")
    profile = profile_from_counts(counts.filter("severity = 'required'"), ("table_name",))
    got = slo.levels(targets, counts, profile, "2024-01-01 00:00:00")
    found = {(r.model_name, r.metric_type): (r.expected_value, r.actual_value, r.status) for r in got.collect()}
    assert got.count() == 4
    assert found == {
        ("a", "freshness"): (0.0, 0.0, "pass"), ("a", "completeness"): (50.0, 100.0, "pass"),
        ("a", "availability"): (99.9, 100.0, "pass"), ("gone", "availability"): (99.9, 0.0, "fail"),
    }


@pytest.mark.parametrize("slices", [1, 5])
def test_as_of_rates(spark, rows, slices):
    import datetime as dt

    day = lambda n: dt.date(2024, 1, n)
    rates = spark.createDataFrame([("A", day(3), 2.0), ("A", day(10), 3.0), ("B", day(5), 1.0), ("B", day(5), 1.5), ("B", day(6), 4.0), (None, day(1), 9.0), ("A", None, 8.0)], "currency string, day date, rate double")
    given = [(i, "A", day(1 + i), 10.0) for i in range(20)] + [(20, "B", day(5), 1.0), (21, "B", day(9), 1.0), (22, None, day(9), 1.0), (23, "C", day(9), 1.0), (24, "A", None, 1.0), (25, "A", day(9), None)]
    df = spark.createDataFrame(given, "k int, cur string, at date, amount double")
    got = {r["k"]: (r["rate_day"], r["usd"], r["usd_status"]) for r in rows(transforms.convert_as_of(df, "amount", "cur", "at", rates, "k", into="usd", slices=slices))}
    for i in range(20):
        rate, since = (3, day(10)) if i >= 9 else (2, day(3))
        assert got[i] == ((since, 10 * rate, "ok") if i >= 2 else (None, None, "no rate"))
    assert got[20] == (day(5), None, "several rates") and got[21] == (day(6), 4, "ok")
    assert got[22] == got[23] == got[24] == (None, None, "no rate") and got[25] == (day(3), None, "ok")


def test_many_keys_equal_the_single_checks(spark, tables):
    """Same counts with nulls, a hot key and names that need quotes; one scan and one shuffle of rows."""
    from contractcheck.operators.keys import check_unique, check_unique_many

    df = tables["a"].selectExpr("IF(id % 7 = 0, NULL, id) AS id", "IF(id < 60, 'hot', code) AS `a.b`", "k", "IF(k = 1, NULL, k) AS n")
    sets = [["id"], ["a.b"], ["id", "k"], ["k", "n"], ["n"], ["id"], ["a.b", "k", "id"]]
    many = check_unique_many(df, sets)
    assert plan(many).count("FileScan parquet") == 1 and plan(many).count("Exchange hashpartitioning(k0") == 1
    got = {r.pos: tuple(r)[1:] for r in many.collect()}
    plain = df.withColumnRenamed("a.b", "ab")
    for i, keys in enumerate(sets):
        assert got[i] == tuple(check_unique(plain, [k.replace(".", "") for k in keys]).first()), keys
    empty = {tuple(r)[1:] for r in check_unique_many(df.limit(0), sets).collect()}
    assert empty == {(0, 0, 0, 0)}


def test_unique_keys_of_a_run_share_one_shuffle(tables):
    probes = [Probe("a", "u1", Check("id", "unique"), key=("id",)), Probe("a", "u2", Check("k", "unique"), key=("k",)), expression("a", "id", "> 5")]
    frame = one_pass(tables, probes, ())
    assert plan(frame).count("FileScan parquet") == 2
    assert {r.test_id: (r.rows_total, r.rows_failed) for r in frame.collect()} == {"u1": (100, 0), "u2": (100, 5), "a/id> 5": (100, 6)}
