"""Properties over generated inputs."""

from fractions import Fraction

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from contractcheck.functions.numbers import pct2
from contractcheck.operators.drift import schema_diff
from contractcheck.operators.storage import upsert

RELAXED = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@RELAXED
@given(st.lists(st.tuples(st.integers(0, 10**9), st.integers(0, 10**9)), min_size=1, max_size=200))
def test_pct2_is_exact_half_up(spark, pairs):
    pairs = [(min(k, n), n) for k, n in pairs]
    df = spark.createDataFrame(pairs, "k bigint, n bigint")
    got = [r.p for r in df.select(pct2(F.col("k"), F.col("n")).alias("p")).collect()]
    for (k, n), p in zip(pairs, got, strict=True):
        if n == 0:
            assert p is None
        else:
            hundredths = (Fraction(10000 * k, n) + Fraction(1, 2)).__floor__()
            assert p == hundredths / 100


TABLE = st.dictionaries(st.integers(0, 12), st.text("abc", max_size=3), max_size=10)


@RELAXED
@given(TABLE, TABLE)
def test_upsert(spark, old, new):
    schema = "id int, v string, note string"
    target = spark.createDataFrame([(k, v, "kept") for k, v in old.items()], schema)
    source = spark.createDataFrame([(k, v, "new") for k, v in new.items()], schema)
    once = upsert(target, source, ["id"], ["v"], ["note"])
    want = {k: (v, "kept") for k, v in old.items()}
    for k, v in new.items():
        want[k] = (v, want[k][1] if k in want else "new")
    assert {r.id: (r.v, r.note) for r in once.collect()} == want
    twice = upsert(once, source, ["id"], ["v"], ["note"])
    assert {r.id: (r.v, r.note) for r in twice.collect()} == want


NAMES = st.sets(st.sampled_from(["a", "A", "b", "_c", "d e"]), min_size=1)


@RELAXED
@given(NAMES, NAMES)
def test_drift_is_symmetric(spark, left, right):
    def frame(names):
        return spark.createDataFrame([("t", n) for n in names], "table_name string, column_name string")

    def diff(a, b):
        return {(r.diff_type, r.column_name) for r in schema_diff(frame(a), frame(b)).collect()}

    there, back = diff(left, right), diff(right, left)
    assert there == {("missing", n) for n in left - right} | {("extra", n) for n in right - left}
    assert back == {("extra" if d == "missing" else "missing", n) for d, n in there}
