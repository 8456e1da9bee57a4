"""Every named query against its SQL on the same tables."""

import os

import compare
import pytest

from contractcheck.operators import ordered
from contractcheck.workload import ORACLES, QUERIES
from contractcheck.workload.flagship import flagship

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    if name not in ORACLES:
        assert df.columns
        return
    columns, got = compare.spark_rows(df)
    wanted_columns, wanted = compare.oracle_rows(duck, ORACLES[name])
    assert columns == wanted_columns
    assert got == wanted
    assert compare.type_differences(df, duck, ORACLES[name]) == {}


@pytest.mark.parametrize(
    "name",
    ["fx_convert", "enrich_contract", "subscriber_readiness", "outlier_iqr", "outlier_z", "schema_drift", "resolve_contract",
     "mutually_exclusive_ranges", "content_changes", "group_quantiles", "sequence_whole_table"],
)
def test_same_rows_without_broadcast(spark, duck, name, monkeypatch):
    """The salted joins and many slices give the same rows as the small-table plan."""
    monkeypatch.setattr(ordered, "TASK_ROWS", 10)
    saved = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        _, got = compare.spark_rows(QUERIES[name](spark, SF_DIR))
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    _, wanted = compare.oracle_rows(duck, ORACLES[name])
    assert got == wanted


def test_flagship(spark, rows):
    out = rows(flagship(spark, SF_DIR))
    assert len(out) == 25
    watching = [r for r in out if r["watching_contract_ids_json"] != "[]"]
    assert all(r["ready_for_consumption"] is False for r in watching)
    assert {r["ready_for_consumption_reason"] for r in watching} == {
        "sales/orders: Tests failing: 2 failures; SLOs failing: 1 failures; sales/other: Ready"
    }
    untouched = [r for r in out if r["watching_contract_ids_json"] == "[]"]
    assert len(untouched) == 5 and all(r["ready_for_consumption_reason"] is None for r in untouched)
