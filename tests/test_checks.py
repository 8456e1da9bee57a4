"""Row-level and cross-row checks on small frames with the awkward cases."""

import pytest
from pyspark.sql import functions as F

from contractcheck.functions.numbers import ntz
from contractcheck.operators import drift, keys, slo, values
from contractcheck.operators.counters import (
    MAX_COUNTERS_PER_PASS,
    Check,
    check_from_row,
    column_counters,
    null_profile,
    null_spike,
    to_results,
)

AS_OF = "2024-03-01 00:00:00"


@pytest.fixture
def people(spark):
    data = [(1, "ab", "x"), (2, None, "y"), (3, "abc", None), (3, "", "x"), (None, "abcd", "z")]
    return spark.createDataFrame(data, "id int, name string, kind string")


def counted(df, *checks):
    return {(r.column_name, r.check_type): (r.rows_total, r.rows_failed) for r in column_counters(df, checks).collect()}


def test_counters(people):
    got = counted(
        people,
        Check("id", "not_null"),
        Check("name", "max_length", {"value": 3}),
        Check("name", "length", {"value": 2}),
        Check("kind", "accepted_values", {"values": ["x", "y"]}),
        Check("kind", "not_accepted_values", {"values": ["z"]}),
        Check("id", "expression_is_true", {"expression": "> 1"}),
        Check(None, "expression_is_true", {"expression": "id > 2 OR name IS NOT NULL"}),
        Check("gone", "not_null"),
    )
    assert got == {
        ("id", "not_null"): (5, 1),
        ("name", "max_length"): (5, 1),
        ("name", "length"): (5, 3),
        ("kind", "accepted_values"): (5, 1),
        ("kind", "not_accepted_values"): (5, 1),
        ("id", "expression_is_true"): (5, 1),
        (None, "expression_is_true"): (5, 1),
        ("gone", "not_null"): (5, None),
    }


def test_status_rows(people, rows):
    checks = [Check("id", "not_null"), Check("kind", "at_least_one"), Check("gone", "not_null")]
    got = {r["column_name"]: r["status"] for r in rows(to_results(column_counters(people, checks), AS_OF, "people"))}
    assert got == {"id": "fail", "kind": "pass", "gone": "error"}
    nothing = to_results(column_counters(people.limit(0), checks[:1]), AS_OF, "people")
    assert [r["status"] for r in rows(nothing)] == ["unknown"]


def test_more_counters_than_fit_one_pass(people):
    many = [Check("id", "expression_is_true", {"expression": f"> {i}"}) for i in range(MAX_COUNTERS_PER_PASS + 5)]
    got = {r.pos: r.rows_failed for r in column_counters(people, many).collect()}
    assert len(got) == len(many) and got[0] == 0 and got[2] == 2 and got[MAX_COUNTERS_PER_PASS + 4] == 4


def test_no_checks(people):
    assert column_counters(people, []).collect() == []


def test_column_name_with_a_dot(spark):
    df = spark.createDataFrame([(1,), (None,)], "`a.b` int")
    assert counted(df, Check("a.b", "not_null")) == {("a.b", "not_null"): (2, 1)}


def test_check_rows_of_both_spellings():
    assert check_from_row("c", "in", '{"in": ["A"]}').kind == "accepted_values"
    check = check_from_row("c", "dbt_utils.expression_is_true", '{"dbt_utils.expression_is_true": {"expression": "> 1"}}')
    assert (check.kind, check.params["expression"]) == ("expression_is_true", "> 1")
    assert check_from_row("c", "max_length", '{"max_length": 5}').params["value"] == 5
    assert check_from_row("c", "not_null", None).kind == "not_null"


@pytest.mark.parametrize(("nulls", "severity"), [(10, None), (11, "medium"), (20, "medium"), (21, "high"), (100, "high")])
def test_null_spike_limits(spark, nulls, severity):
    df = spark.range(100).selectExpr(f"CASE WHEN id >= {nulls} THEN id END AS c")
    found = [r.severity for r in null_spike(null_profile(df, ["c"]), 10).collect()]
    assert found == ([severity] if severity else [])


def test_null_spike_of_an_empty_table(spark):
    assert null_spike(null_profile(spark.range(0), ["id"])).collect() == []


def test_unique_ignores_null_keys(people, rows):
    assert rows(keys.check_unique(people, ["id"])) == [{"rows_total": 5, "keys_total": 3, "rows_failed": 1, "duplicate_rows": 2}]
    assert rows(keys.check_unique(people, ["id", "name"]))[0]["rows_failed"] == 0
    assert rows(keys.check_unique(people.limit(0), ["id"]))[0]["rows_total"] == 0
    assert rows(keys.check_unique(people, ["kind"], digest=True)) == [
        {"rows_total": 5, "keys_total": 3, "rows_failed": 1, "duplicate_rows": 2}
    ]


def test_relationship_ignores_null_children(spark, rows):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (1,), (None,)], "p int")
    assert rows(keys.check_relationship(child, ["k"], parent, ["p"])) == [{"rows_total": 3, "rows_failed": 1, "keys_failed": 1}]
    assert rows(keys.orphan_keys(child, ["k"], parent, ["p"])) == [{"k": 2, "rows_per_key": 1}]


def test_join_report_counts_fan_out(spark, rows):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1,), (1,), (1,), (3,)], "r int")
    assert rows(keys.join_report(left, ["k"], right, ["r"])) == [
        {"left_matched": 2, "left_unmatched": 1, "right_matched": 3, "right_unmatched": 1, "joined_rows": 6, "max_fan_out": 3}
    ]


def test_schema_drift(spark, rows):
    declared = spark.createDataFrame([("t", "a"), ("t", "B")], "table_name string, column_name string")
    actual = spark.createDataFrame(
        [("t", "a"), ("t", "b"), ("t", "_loaded"), ("other", "x")], "table_name string, column_name string"
    )
    got = {(r["column_name"], r["severity"], r["status"]) for r in rows(drift.schema_drift(declared, actual))}
    assert got == {("B", "high", "fail"), ("b", "medium", "warning")}
    diff = {(r["diff_type"], r["column_name"]) for r in rows(drift.schema_diff(declared, actual))}
    assert diff == {("missing", "B"), ("extra", "b"), ("extra", "_loaded")}


def test_declared_types(spark):
    df = spark.createDataFrame([], "a decimal(20,2), b string, c int")
    got = drift.column_types(df, {"a": "decimal(18,2)", "b": "varchar(3)", "c": "decimal(9,0)", "d": "int"})
    assert [g[3] for g in got] == [True, True, False, False]
    assert not values.type_matches("decimal(18,4)", df.schema["a"].dataType)


def test_freshness_limits(spark, rows):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-02-29 00:00:00' AS created_at, CAST(NULL AS TIMESTAMP_NTZ) AS updated_at")

    def got(hours, columns=slo.DEFAULT_TIMESTAMP_COLUMNS):
        r = rows(slo.freshness(df, columns, hours, AS_OF))[0]
        return r["status"], r["actual_value"]

    assert got(24) == ("pass", 24.0)
    assert got(23.99) == ("fail", 24.0)
    assert got(24, ["loaded"]) == ("unknown", None)
    assert got(24, ["updated_at"]) == ("unknown", None)


def test_completeness(spark, rows):
    df = spark.range(4).selectExpr("id AS a", "nullif(id, 1) AS b")
    assert rows(slo.completeness(null_profile(df, ["a", "b"]), 0.875))[0]["status"] == "pass"
    assert rows(slo.completeness(null_profile(df, ["a", "b"]), 88))[0]["status"] == "fail"
    none = rows(slo.completeness(null_profile(df, []), 99))[0]
    assert (none["status"], none["actual_value"]) == ("unknown", 100.0)
    assert rows(slo.completeness(null_profile(df.limit(0), ["a"]), 99))[0]["status"] == "unknown"


def test_availability_of_a_missing_table(spark, rows, tmp_path):
    r = rows(slo.availability(spark, str(tmp_path / "none")))[0]
    assert (r["status"], r["severity"], r["actual_value"]) == ("fail", "critical", 0.0)


def test_reconcile(spark, rows):
    a = spark.createDataFrame([(100.0,), (0.01,)], "v double")
    b = spark.createDataFrame([(100.0,)], "v double")
    assert rows(slo.reconcile(a, "v", b, "v", 0.01))[0]["status"] == "pass"
    assert rows(slo.reconcile(a, "v", b, "v", 0.001))[0]["status"] == "fail"
    assert rows(slo.reconcile(a.limit(0), "v", b, "v"))[0]["status"] == "unknown"


def test_reconcile_values_of_any_size(spark, rows):
    def status(x, y, kind="double", tolerance=0.01):
        one, two = (spark.createDataFrame([(v,)], "v string").select(F.col("v").cast(kind).alias("v")) for v in (x, y))
        r = rows(slo.reconcile(one, "v", two, "v", tolerance))[0]
        return r["status"], r["details"]

    assert status("4e-12", "1e-12") == ("fail", "difference 0.000000000003000000")
    assert status("4e-30", "1e-30")[0] == "fail" and status("1e-30", "1e-30")[0] == "pass"
    assert status("1e300", "1e300")[0] == "pass" and status("2e300", "1e300")[0] == "fail"
    assert status("1" * 30, "1" * 30, "decimal(38,0)") == ("pass", "difference 0.00")
    assert status("0.0000000000003", "0.0000000000001", "decimal(38,13)")[0] == "fail"
    assert status("7", "7", "bigint") == ("pass", "difference 0.00")


def test_default_targets(spark, rows):
    df = spark.createDataFrame([(None, None), (3, 0.5)], "freshness_slo_hours int, completeness_slo double")
    assert rows(slo.with_default_targets(df)) == [
        {"freshness_slo_hours": 24, "completeness_slo": 99.0},
        {"freshness_slo_hours": 3, "completeness_slo": 50.0},
    ]


def test_approximate_outliers_find_the_far_row(spark, rows):
    df = spark.range(1000).selectExpr("1 AS g", "CAST(id % 10 AS DOUBLE) AS v").unionAll(spark.sql("SELECT 1, 1000D"))
    assert rows(values.outliers_iqr(df, ["g"], "v", approx=True), "outlier_rows") == [{"outlier_rows": 1}]
    assert rows(values.outliers_z(df, ["g"], "v"), "outlier_rows") == [{"outlier_rows": 1}]


def test_moments_are_zone_free(spark):
    assert spark.range(1).select(ntz(AS_OF).cast("string").alias("t")).first().t == AS_OF
