"""Distinct counts over day ranges: exact, and from kept sketches."""

from pyspark.sql import functions as F

from contractcheck.operators import distincts, storage

BY, TS = ["model_name"], "run_timestamp"


def results(spark, n=60_000):
    """A log of six days; model m0 holds a third of the rows, tests come back on later days."""
    i = F.col("id")
    return spark.range(n).select(
        i.cast("string").alias("id"),
        F.concat(F.lit("t"), F.when(i % 50 == 49, None).otherwise(F.pmod(F.xxhash64("id"), F.lit(20_000))).cast("string")).alias("test_id"),
        F.when(F.floor(i / 6) % 3 == 0, "m0").otherwise(F.concat(F.lit("m"), (i % 7).cast("string"))).alias("model_name"),
        F.lit("pass").alias("status"),
        F.expr("timestamp_ntz'2024-03-01 00:00:00' + make_interval(0, 0, 0, cast(id % 6 as int), 5, 0, 0)").alias(TS),
    )


def exact(log, first, last):
    kept = {}
    for r in log.collect():
        if first <= str(r[TS])[:10] <= last:
            own = kept.setdefault(r["model_name"], [0, set()])
            own[0] += 1
            own[1] |= {r["test_id"]} - {None}
    return {m: (n, len(tests)) for m, (n, tests) in kept.items()}


def test_exact_and_sketched_range(spark, tmp_path):
    log, root, table = results(spark), str(tmp_path), "test_results"
    storage.append_log(log, root, table)
    assert distincts.sketched_days(spark, root, table, "test_id") is None
    for day in (1, 2, 3, 4, 5, 6, 2, 4):  # two days are run again
        distincts.keep_day_sketches(spark, root, table, f"2024-03-{day:02d}", BY, "test_id")
    kept = distincts.sketched_days(spark, root, table, "test_id")
    assert kept.count() == 6 * kept.select("model_name").distinct().count()
    for first, last in (("2024-03-01", "2024-03-06"), ("2024-03-02", "2024-03-04"), ("2024-03-06", "2024-03-06")):
        want = exact(log, first, last)
        got = distincts.distinct_in_range(storage.read_log(spark, root, table), TS, first, last, BY, "test_id").collect()
        assert {r["model_name"]: (r["rows"], r["distinct_values"]) for r in got} == want
        near = distincts.sketched_in_range(kept, first, last, BY).collect()
        assert {r["model_name"]: r["rows"] for r in near} == {m: n for m, (n, _) in want.items()}
        bound = 4 * 1.04 / 2 ** (distincts.REGISTERS / 2)
        assert all(abs(r["distinct_estimate"] - want[r["model_name"]][1]) <= bound * want[r["model_name"]][1] for r in near)


def test_a_range_reads_its_day_folders(spark, tmp_path):
    log, root, table = results(spark, 600), str(tmp_path), "test_results"
    storage.append_log(log, root, table)
    one = distincts.distinct_in_range(storage.read_log(spark, root, table), TS, "2024-03-02", "2024-03-03", BY, "test_id")
    plan = one._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: ")[1].split("]")[0]
    assert "run_date" in filters and "PushedFilters: []" not in plan
    none = distincts.distinct_in_range(storage.read_log(spark, root, table), TS, "2025-01-01", "2025-01-02", BY, "test_id")
    assert none.count() == 0
