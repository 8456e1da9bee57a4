"""Nested types as trees, and many measurements of one table in one scan."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from contractcheck.functions.type_trees import changes, tree, written
from contractcheck.operators.versions import nested_type_changes
from contractcheck.sources import tables as src

ATOMS = st.sampled_from(["int", "bigint", "string", "decimal(10,2)", "decimal(12,2)", "timestamp_ntz"])
TYPES = st.recursive(
    ATOMS,
    lambda inner: st.one_of(
        inner.map(lambda t: f"array<{t}>"),
        st.tuples(ATOMS, inner).map(lambda kv: f"map<{kv[0]},{kv[1]}>"),
        st.dictionaries(st.sampled_from("abcd"), inner, min_size=1).map(lambda f: "struct<" + ",".join(f"{n}:{t}" for n, t in f.items()) + ">"),
    ),
    max_leaves=8,
)


@settings(max_examples=200, deadline=None)
@given(TYPES, TYPES)
def test_trees_and_changes(left, right):
    """Text comes back, equal types have no change, both directions tell the same paths."""
    a, b = tree(left), tree(right)
    assert (written(a), written(b)) == (left, right)
    assert changes(a, a, "c") == []
    there, back = changes(a, b, "c"), changes(b, a, "c")
    assert {(p, o, n) for p, _, o, n in there} == {(p, n, o) for p, _, o, n in back}
    assert bool(there) == (a != b)


def test_text_that_is_no_type_is_a_leaf():
    for text in ("", "struct<", "struct<a:int", "array<int,int>", "map<int>", "struct<a:int,a:int>", "struct<a int>", "some thing", ">"):
        assert tree(text) == (text,)
    assert tree("struct<`a b`:int>") == ("struct", {"a b": ("int",)})
    assert tree("struct<>") == ("struct", {})
    assert changes(tree("array<int>"), tree("broken<"), "c") == [("c", "type_changed", "array<int>", "broken<")]


def test_schema_texts_of_spark_are_read(spark):
    kind = T.StructType([
        T.StructField("a", T.ArrayType(T.MapType(T.StringType(), T.DecimalType(9, 3)))),
        T.StructField("b", T.StructType([T.StructField("c", T.TimestampNTZType())])),
    ])
    assert written(tree(kind.simpleString())) == kind.simpleString()


def test_nulls_empty_frames_and_real_schemas(spark, rows):
    schema = "contract_id string, column_name string, data_type string"
    old = spark.createDataFrame([("x", "a", None), ("x", "b", "int"), ("x", "c", None), ("x", "d", "array< INT >")], schema)
    new = spark.createDataFrame([("x", "a", "int"), ("x", "b", None), ("x", "c", None), ("x", "d", "array<int>")], schema)
    assert [(r["path"], r["change_type"]) for r in rows(nested_type_changes(old, new))] == [("a", "type_changed"), ("b", "type_changed")]
    assert rows(nested_type_changes(old.limit(0), new.limit(0))) == []
    declared = spark.createDataFrame([("t", "s", "struct<x:array<decimal(9,2)>>")], "table_name string, column_name string, data_type string")
    real = src.table_columns(spark, {"t": spark.sql("SELECT named_struct('x', array(1.5BD)) AS s")})
    got = rows(nested_type_changes(declared, real, ["table_name"]))
    assert [(r["path"], r["change_type"], r["new_type"], r["notice_days"]) for r in got] == [("s.x[]", "type_changed", "decimal(2,1)", 60)]


def scans(df):
    """Scans that the finished plan runs, reused subqueries aside."""
    df.collect()
    todo, seen = [df._jdf.queryExecution().executedPlan()], set()
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStage") or name == "Subquery":
            todo.append(node.plan() if name != "Subquery" else node.child())
            continue
        if name.startswith("Scan parquet"):
            seen.add(node.id())
        for parts in (node.children(), node.subqueries()):
            todo += [parts.apply(i) for i in range(parts.size()) if parts.apply(i).nodeName() != "ReusedSubquery"]
    return len(seen)


def test_fused_metrics_scan_a_table_once(spark, rows, tmp_path):
    spark.range(1000).selectExpr("id", "id % 7 AS k").write.parquet(f"{tmp_path}/t")
    spark.read.parquet(f"{tmp_path}/t").createOrReplaceTempView("numbers_to_fuse")
    texts = {
        "it's": "SELECT count(*) AS actual_value FROM numbers_to_fuse;\n",
        "kinds": "SELECT count(DISTINCT k) AS actual_value FROM numbers_to_fuse -- all",
        "mean": "SELECT avg(id) AS actual_value FROM numbers_to_fuse",
        "odd": "SELECT count_if(id % 2 = 1) AS actual_value FROM numbers_to_fuse",
    }
    fused = src.fused_metrics(spark, texts)
    assert rows(fused) == rows(src.run_metrics(spark, texts | {"kinds": texts["kinds"][:-7]}))
    assert scans(fused) == 1 and scans(src.run_metrics(spark, texts)) == 4
    none = src.fused_metrics(spark, {"n": "SELECT id AS actual_value FROM numbers_to_fuse WHERE id < 0"})
    assert rows(none) == [{"metric_type": "n", "actual_value": None}]
    assert rows(src.fused_metrics(spark, {})) == []
    (tmp_path / "q").mkdir()
    (tmp_path / "q" / "a.sql").write_text(texts["mean"])
    assert rows(src.metric_queries(spark, f"{tmp_path}/q", fused=True)) == [{"metric_type": "a", "actual_value": 499.5}]
