"""Hot keys: same rows as brute force, and no plan that puts a group in one task."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from contractcheck.operators import ordered, values
from contractcheck.operators.lookups import lookup_join
from contractcheck.operators.ordered import with_prior
from contractcheck.operators.reports import latest
from contractcheck.operators.values import group_quantiles, overlapping_ranges, sequence_breaks
from contractcheck.operators.versions import content_changes


@pytest.fixture
def hot(spark):
    """A third of all rows belongs to one group and a third of those to one moment."""
    rnd = random.Random(5)
    data = []
    for i in range(900):
        g = 0 if i % 3 == 0 else rnd.randrange(1, 40)
        t = 50 if i % 9 == 0 else rnd.randrange(100)
        data.append((g, t, i, rnd.randrange(1000)))
    data.append((None, 3, 900, 1))
    data.append((None, 4, 901, 2))
    return spark.createDataFrame(data, "g int, t int, id int, v int")


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.mark.parametrize("slices", [1, 7, 500, None])
@pytest.mark.parametrize("groups", [["g"], []])
def test_prior_equals_a_plain_window(hot, rows, slices, groups, monkeypatch):
    """Without a given number of slices the hot group is sliced and the others are not."""
    monkeypatch.setattr(ordered, "TASK_ROWS", 50)
    order = ["t", "id"]
    got = with_prior(
        hot, groups, order, maxima={"m": F.col("v")}, sums={"s": F.col("v")}, totals=["s"], slices=slices
    )
    w = Window.partitionBy(*groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*groups)
    want = hot.select("*", F.max("v").over(w).alias("m"), F.sum("v").over(w).alias("s"), F.sum("v").over(whole).alias("total_s"))
    assert rows(got) == rows(want)


def test_only_the_hot_group_is_sliced(hot, monkeypatch):
    assert ordered.hot_buckets(hot, ["g"]) == {}
    monkeypatch.setattr(ordered, "TASK_ROWS", 50)
    assert len(ordered.hot_buckets(hot, ["g"])) == 1


def test_slices_split_the_hot_group_and_its_hot_moment(hot):
    sliced = hot.select("*", ordered.slice_of(hot, ["t", "id"], 50).alias("s"))
    biggest = sliced.groupBy("s").count().agg(F.max("count")).first()[0]
    assert biggest < 3 * 902 / 50
    moment = sliced.filter("t = 50").select("s").distinct().count()
    assert moment > 5


KEYS = {
    "decimal(18,2)": "CAST(1000 * sin(id) AS DECIMAL(18,2))",
    "decimal(38,10)": "CAST('-9999999999999999999999999' AS DECIMAL(38,10)) + CAST(id AS DECIMAL(38,10)) / 7",
    "text with one prefix": "concat('https://a.very.long.prefix.example.org/', hex(id * 7919 % 10007))",
    "other letters": "concat(CASE id % 3 WHEN 0 THEN 'é' WHEN 1 THEN 'z' ELSE '😀' END, id)",
    "one value": "'same'",
    "double": "CASE id % 5 WHEN 0 THEN double('NaN') WHEN 1 THEN -double('Infinity') ELSE id / 3 END",
    "binary": "unhex(hex(id))",
    "nulls": "CASE WHEN id % 2 = 0 THEN CAST(id AS DECIMAL(10,1)) END",
}


@pytest.mark.parametrize("name", sorted(KEYS))
def test_every_sortable_type_is_cut(spark, rows, name):
    """Slices rise with the order and none holds three times its share."""
    df = spark.range(6000).selectExpr("id", f"{KEYS[name]} AS o")
    sliced = df.select("*", ordered.slice_of(df, ["o", "id"], 40).alias("s"))
    assert sliced.groupBy("s").count().agg(F.max("count")).first()[0] < 3 * 6000 / 40
    order = Window.orderBy("o", "id")
    assert sliced.withColumn("before", F.lag("s").over(order)).filter("before > s").count() == 0
    want = df.select("*", F.sum("id").over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("t"))
    assert rows(with_prior(df, [], ["o", "id"], sums={"t": F.col("id")}, slices=40), "id", "t") == rows(want, "id", "t")


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "date", "double", "string"])
def test_prior_for_other_order_types(spark, rows, kind):
    base = spark.range(60).selectExpr("id % 3 AS g", "id", "timestampadd(DAY, CAST(id AS INT), TIMESTAMP_NTZ '2024-01-01 00:00:00') AS ts")
    value = F.col("ts") if kind.startswith(("timestamp", "date")) else F.col("id")
    df = base.select("g", "id", value.cast(kind).alias("o"))
    w = Window.partitionBy("g").orderBy("o").rowsBetween(Window.unboundedPreceding, -1)
    want = df.select("*", F.max("id").over(w).alias("m"))
    assert rows(with_prior(df, ["g"], ["o"], maxima={"m": F.col("id")}, slices=9)) == rows(want)


def test_quantiles_equal_the_builtin(hot, rows):
    df = hot.filter("g IS NOT NULL").withColumn("v", F.col("v").cast("double"))
    got = group_quantiles(df, ["g"], "v", (10, 25, 50, 75), slices=20)
    want = df.groupBy("g").agg(F.count("v").alias("n_values"), *[F.percentile("v", p / 100).alias(f"p{p}") for p in (10, 25, 50, 75)])
    for a, b in zip(rows(got), rows(want), strict=True):
        assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-9 for k in a)


def test_overlaps_against_brute_force(spark):
    rnd = random.Random(11)
    data = [(0 if i % 3 else rnd.randrange(1, 5), rnd.randrange(60), i) for i in range(200)]
    data = [(g, lo, lo + rnd.choice([-1, 0, 1, 2, 9])) for g, lo, _ in data]
    want = {}
    for g in {d[0] for d in data}:
        ranges = sorted(d[1:] for d in data if d[0] == g)
        bad, reach = 0, None
        for lo, hi in ranges:
            bad += reach is not None and reach > lo
            reach = hi if reach is None else max(reach, hi)
        want[g] = (len(ranges), bad)
    df = spark.createDataFrame(data, "g int, lo int, hi int")
    got = {r.g: (r.rows_total, r.rows_failed) for r in overlapping_ranges(df, "lo", "hi", ["g"], slices=10).collect()}
    assert got == want


@pytest.mark.parametrize("step", [1, 5])
def test_sequence_against_brute_force(spark, step):
    numbers = [1, 2, 3, 3, 5, 10, 15, 15, 20, 21]
    df = spark.createDataFrame([(n,) for n in numbers], "n int")
    bad = sum(b != a + step for a, b in zip(numbers, numbers[1:]))
    got = sequence_breaks(df, "n", step, slices=4).first()
    assert (got.rows_total, got.rows_failed) == (len(numbers), bad)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
@pytest.mark.parametrize("limit", ["-1", "10485760"])
def test_salted_join_equals_a_plain_join(spark, hot, rows, how, limit):
    dim = spark.createDataFrame([(0, "zero"), (1, "one"), (77, "none")], "g int, name string")
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        got = rows(lookup_join(hot, dim, ["g"], how, salts=5))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)
    assert got == rows(hot.join(dim, ["g"], how))


def test_salted_join_spreads_one_key(spark, hot):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup_join(hot, hot.select("g").distinct(), ["g"], "left", salts=8)
        text = plan(joined)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
    assert "hashpartitioning(g" in text and "_salt" in text


def test_latest_keeps_one_row_per_key_before_the_shuffle(hot):
    text = plan(latest(hot, ["g"], ["t", "id"]))
    assert text.count("WindowGroupLimit") >= 2


def test_content_changes_against_brute_force(spark):
    rnd = random.Random(3)
    data = [("c" if i % 3 else f"c{i % 7}", f"{i}", rnd.choice("ab"), i // 4, i) for i in range(120)]
    df = spark.createDataFrame(data, "contract_id string, version string, contract_content string, minute int, seq int").select(
        "*", F.expr("timestampadd(MINUTE, minute, TIMESTAMP_NTZ '2024-01-01 00:00:00')").alias("published_at")
    )
    got = {(r.contract_id, r.version): r.changed for r in content_changes(df, "seq", slices=16).collect()}
    want, last = {}, {}
    for c, v, text, _, _ in sorted(data, key=lambda d: (d[3], d[4])):
        want[c, v] = c in last and last[c] != text
        last[c] = text
    assert got == want


def test_text_is_dropped_before_the_shuffle(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        F.col("source").alias("contract_id"), F.col("doc_id").cast("string").alias("version"), F.col("text").alias("contract_content"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("published_at"), "doc_id",
    )
    text = plan(content_changes(df, "doc_id"))
    for line in text.splitlines():
        if line.startswith("Input") or "Exchange" not in line:
            continue
        assert "text#" not in line


def test_outliers_plan_has_no_exact_percentile_aggregate(hot):
    text = plan(values.outliers_iqr(hot.withColumn("v", F.col("v").cast("double")), ["g"], "v"))
    assert "percentile(" not in text
