"""Groups of copies that hold most rows, and the identity of rows."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from contractcheck.functions import lineage
from contractcheck.llm import ngram_join


def test_rows_of_heavy_keys_are_not_shuffled(spark):
    rows = spark.range(40_000, numPartitions=8).select("id", F.when(F.col("id") % 10 < 8, 0).otherwise(F.col("id")).alias("k"))
    per_key = rows.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    saved = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = ngram_join.joined_by_weight(rows, per_key, "k", "n")
        assert sorted(got.select("k", "id", "first").collect()) == sorted(rows.join(per_key, "k").select("k", "id", "first").collect())
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan
        # Every task holds rows of the heavy key, as it did before the join.
        kept = got.where("k = 0").groupBy(F.spark_partition_id()).count().collect()
        assert len(kept) >= 8 and max(r["count"] for r in kept) <= 32_000 / 8
    finally:
        for c, value in saved.items():
            spark.conf.set(c, value)


def test_heavy_keys_of_an_empty_table(spark):
    rows = spark.createDataFrame([], "k binary, id bigint")
    assert ngram_join.joined_by_weight(rows, rows.groupBy("k").agg(F.count("*").alias("n")), "k", "n").collect() == []


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_row_identity(spark, kind):
    """Null, empty, and where an id ends and a text begins make different rows; equal rows are one."""
    ids = [None, "1", "11"] if kind == "string" else [None, 1, 11]
    texts = [None, "", "1", "11", "n", "t"]
    rows = [(i, t) for i in ids for t in texts] + ([("", t) for t in texts] if kind == "string" else [])
    df = spark.createDataFrame(rows + rows, f"doc_id {kind}, text string").select(ngram_join.row_hash("doc_id", "text").alias("h"))
    found = [bytes(r.h) for r in df.collect()]
    assert len(set(found)) == len(rows) and {len(h) for h in found} == {16}


def test_many_copies_and_near_copies(spark):
    """One text in 30,000 rows and 300 near copies of it: one class, all links, one row stays."""
    words = [f"word{i}" for i in range(400)]
    copies = spark.range(30_000, numPartitions=8).select(F.col("id").alias("doc_id"), F.lit(" ".join(words)).alias("text"))
    near = [(30_000 + i, " ".join(words + [f"extra{i}"])) for i in range(300)]
    docs = copies.union(spark.createDataFrame(near, "doc_id bigint, text string")).union(spark.createDataFrame([(50_000, "some other text"), (50_001, None)], "doc_id bigint, text string"))
    counted = ngram_join.jaccard_join(docs).groupBy("class_id", "n_links").count().collect()
    assert sorted((r["class_id"], r["n_links"], r["count"]) for r in counted) == [(0, 30_299, 30_300), (50_000, 0, 1), (50_001, 0, 1)]
    assert sorted(r.doc_id for r in ngram_join.one_per_group(docs).select("doc_id").collect()) == [0, 50_000, 50_001]


@pytest.fixture
def many_partitions(spark):
    """64 shuffle partitions that stay 64, however few rows they hold."""
    saved = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    yield 64
    for c, value in saved.items():
        spark.conf.set(c, value)


def test_settled_files_follow_the_bound(spark, many_partitions, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(2000).groupBy((F.col("id") % 1000).alias("k")).count()
    monkeypatch.setattr(lineage, "ROWS_PER_FILE", 50)
    for bound, parts in ((None, many_partitions), (1000, max(cores, 20)), (0, cores), (10**9, many_partitions)):
        kept = lineage.settled(rows, bound)
        assert kept.rdd.getNumPartitions() == parts and kept.count() == 1000


def test_few_rows_settle_in_few_files(spark, many_partitions):
    words = [f"word{i}" for i in range(60)]
    docs = spark.createDataFrame([(i, " ".join(words + [f"extra{i % 5}"])) for i in range(40)], "doc_id bigint, text string").repartition(4)
    lineage.settled(spark.range(1))  # sets the folder if there is none yet
    folder = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    before = {f for f in folder.rglob("part-*")}
    assert [r.doc_id for r in ngram_join.one_per_group(docs).collect()] == [0]
    # Only the verified links keep a file for every shuffle partition.
    assert len({f for f in folder.rglob("part-*")} - before) <= many_partitions + 12 * spark.sparkContext.defaultParallelism
