"""References checked against bitmaps of the parent's keys."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from contractcheck.operators import keys

LONGS = st.one_of(st.none(), st.integers(-70_000, 70_000), st.sampled_from([-(2**63), 2**63 - 1, 0, 1, -1, 32768, 32769, -32768]))


def both(child, parent, **more):
    args = (child, ["c"], parent, ["p"])
    return keys.check_relationship_by_bitmap(*args, **more).collect(), keys.check_relationship(*args).collect()


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(LONGS, max_size=30), st.lists(LONGS, max_size=30))
def test_bitmaps_give_the_same_counts(spark, child, parent):
    got, want = both(spark.createDataFrame([(x,) for x in child + parent[:5]], "c bigint"), spark.createDataFrame([(x,) for x in parent], "p bigint"))
    assert got == want


def test_every_place_of_a_bitmap(spark):
    """All keys around three bucket borders and below zero, every third of them a parent."""
    child = spark.range(-40_000, 70_000).select(F.col("id").alias("c"))
    got, want = both(child, child.where("c % 3 = 0").select(F.col("c").cast("int").alias("p")))
    assert got == want and got[0]["keys_failed"] == 73_333


def test_other_keys_take_the_join(spark):
    text = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    got, want = both(text, text.where("c = 'a'").select(F.col("c").alias("p")))
    assert got == want and got[0]["rows_failed"] == 1
    wide = spark.range(100).select((F.col("id") * 10**9).alias("c"))
    got, want = both(wide, wide.where("c > 0").select(F.col("c").alias("p")), most_bytes=50 * keys.BITMAP_BYTES)
    assert got == want and got[0]["rows_failed"] == 1


def shuffled(df):
    """Rows that the exchanges of a query have written."""
    df.collect()
    plan, total = df._jdf.queryExecution().executedPlan().toString(), 0
    todo = [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStage"):
            todo.append(node.plan())
            continue
        if name == "Exchange":
            total += node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total, plan


def test_rows_with_a_parent_are_not_shuffled(spark):
    child = spark.range(400_000, numPartitions=8).select((F.col("id") % 100_000).alias("c"))
    parent = spark.range(10, 100_000, numPartitions=4).select(F.col("id").alias("p"))
    few, plan = shuffled(keys.check_relationship_by_bitmap(child, ["c"], parent, ["p"]))
    many, _ = shuffled(keys.check_relationship(child, ["c"], parent, ["p"]))
    assert "BroadcastHashJoin" in plan and many > 400_000 and few < 200
