"""From logs to a per-consumer flag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractcheck.functions.numbers import day_bounds, ntz
from contractcheck.functions.text import json_list
from contractcheck.operators.lookups import lookup_join, union_all

COUNTS = [
    "total_tests", "passing_tests", "failing_tests",
    "total_slos", "passing_slos", "failing_slos",
    "total_issues", "critical_issues", "high_issues",
]


def _marks(df: DataFrame, **marks: Column) -> DataFrame:
    """``contract_id`` and all counts as columns, 0 where nothing is given."""
    zero = F.lit(0).cast("bigint")
    return df.select("contract_id", *[marks.get(c, zero).cast("bigint").alias(c) for c in COUNTS])


def _summed(marks: DataFrame) -> DataFrame:
    return marks.groupBy("contract_id").agg(*[F.sum(c).alias(c) for c in COUNTS])


def _test_marks(results: DataFrame, day: str) -> DataFrame:
    return _marks(
        results.filter(day_bounds(F.col("run_timestamp"), day)),
        total_tests=F.lit(1),
        passing_tests=F.col("status") == "pass",
        failing_tests=F.col("status") == "fail",
    )


def _slo_marks(slos: DataFrame, day: str) -> DataFrame:
    return _marks(
        slos.filter(day_bounds(F.col("measurement_ts"), day)),
        total_slos=F.lit(1),
        passing_slos=F.col("status") == "pass",
        failing_slos=F.col("status") == "fail",
    )


def _issue_marks(issues: DataFrame, models: DataFrame, day: str) -> DataFrame:
    """Issues are counted per model before they meet the registry, so a noisy model
    stays one row."""
    today = issues.filter(day_bounds(F.col("detected_at"), day) & (F.col("reviewed_flag") == F.lit(False)))
    per_model = today.groupBy("model_id").agg(
        F.count(F.lit(1)).alias("t"),
        F.count_if(F.col("severity") == "critical").alias("c"),
        F.count_if(F.col("severity") == "high").alias("h"),
    )
    owner = models.select(F.col("id").alias("model_id"), "contract_id")
    joined = per_model.join(owner, ["model_id"])
    return _marks(joined, total_issues=F.col("t"), critical_issues=F.col("c"), high_issues=F.col("h"))


def test_counts(results: DataFrame, day: str) -> DataFrame:
    """Test results of one day per agreement."""
    return _summed(_test_marks(results, day))


def slo_counts(slos: DataFrame, day: str) -> DataFrame:
    """Measurements of one day per agreement."""
    return _summed(_slo_marks(slos, day))


def issue_counts(issues: DataFrame, models: DataFrame, day: str) -> DataFrame:
    """Unreviewed issues of one day per agreement."""
    return _summed(_issue_marks(issues, models, day))


def verdict(failing: Column) -> Column:
    return F.when(F.coalesce(failing, F.lit(0)) == 0, "pass").otherwise("fail")


def issue_verdict(critical: Column, high: Column) -> Column:
    return (
        F.when(F.coalesce(critical, F.lit(0)) > 0, "fail")
        .when(F.coalesce(high, F.lit(0)) > 0, "warning")
        .otherwise("pass")
    )


def with_decision(counts: DataFrame) -> DataFrame:
    """Add the three verdicts, the flag and its reason to a frame of counts."""
    n = {c: F.coalesce(c, F.lit(0)) for c in COUNTS}
    judged = counts.select(
        "contract_id",
        *[n[c].cast("bigint").alias(c) for c in COUNTS],
        verdict(n["failing_tests"]).alias("test_status"),
        verdict(n["failing_slos"]).alias("slo_status"),
        issue_verdict(n["critical_issues"], n["high_issues"]).alias("dq_status"),
    )
    bad_tests, bad_slos, bad_dq = (F.col(c) == "fail" for c in ("test_status", "slo_status", "dq_status"))

    def text(before: str, count: str, after: str) -> Column:
        return F.concat(F.lit(before), F.col(count).cast("string"), F.lit(after))

    reasons = F.concat_ws(
        "; ",
        F.when(bad_tests, text("Tests failing: ", "failing_tests", " failures")),
        F.when(bad_slos, text("SLOs failing: ", "failing_slos", " failures")),
        F.when(bad_dq, text("Data quality issues: ", "critical_issues", " critical")),
    )
    return judged.withColumn("ready", ~(bad_tests | bad_slos | bad_dq)).withColumn(
        "reason", F.when(F.col("ready"), F.lit("All checks passed")).otherwise(reasons)
    )


def contract_status(
    results: DataFrame, slos: DataFrame, issues: DataFrame, models: DataFrame, day: str
) -> DataFrame:
    """One row per agreement that has any entry on ``day``.

    The entries of the three logs are added up together: one partial sum per task
    and agreement, then one shuffle.
    """
    marks = union_all([_test_marks(results, day), _slo_marks(slos, day), _issue_marks(issues, models, day)])
    return with_decision(_summed(marks.filter(F.col("contract_id").isNotNull())))


def watch_items(subscribers: DataFrame) -> DataFrame:
    """``id, pos, contract_id`` per watched agreement; broken lists give no rows."""
    lists = json_list(F.col("watching_contract_ids_json"))
    return subscribers.select("id", F.posexplode_outer(lists).alias("pos", "contract_id")).filter(F.col("pos").isNotNull())


def subscriber_verdicts(status: DataFrame, subscribers: DataFrame) -> DataFrame:
    """``id, ready, reason, watched`` for subscribers that watch something.

    An agreement without entries today counts as ready. The text joins the items
    of the subscriber's own list, which is one cell of the input, so no group can
    grow beyond its row.
    """
    state = status.select("contract_id", "ready", "reason")
    items = lookup_join(watch_items(subscribers), state, ["contract_id"], "left", spread_by=["id", "pos"])
    ok = F.coalesce("ready", F.lit(True))
    line = F.concat("contract_id", F.lit(": "), F.when(ok, F.lit("Ready")).otherwise(F.col("reason")))
    rows = items.select("id", "pos", ok.alias("ok"), line.alias("line"))
    ordered = F.sort_array(F.collect_list(F.struct("pos", "line")))
    return rows.groupBy("id").agg(
        F.bool_and("ok").alias("ready"),
        F.array_join(F.transform(ordered, lambda i: i["line"]), "; ").alias("reason"),
        F.count(F.lit(1)).alias("watched"),
    )


def readiness(status: DataFrame, subscribers: DataFrame, as_of: str) -> DataFrame:
    """The subscribers table with new flags; rows without a watch list stay as they are."""
    new = subscriber_verdicts(status, subscribers).select(
        "id", F.col("ready").alias("_ready"), F.col("reason").alias("_reason")
    )
    joined = subscribers.join(new, ["id"], "left")
    touched = F.col("_ready").isNotNull()
    fresh = {
        "ready_for_consumption": F.col("_ready"),
        "ready_for_consumption_reason": F.col("_reason"),
        "daily_slo_check_ts": ntz(as_of),
        "_updated_ts": ntz(as_of),
    }
    cols = [
        F.when(touched, fresh[c]).otherwise(F.col(c)).alias(c) if c in fresh else F.col(c) for c in subscribers.columns
    ]
    return joined.select(*cols)


def notifications(subscribers: DataFrame, as_of: str) -> DataFrame:
    """Outbox rows with the message body a delivery service would send."""
    moment = ntz(as_of)
    return subscribers.select(
        F.col("id").alias("subscriber_id"),
        F.lit("readiness").alias("event_type"),
        F.to_json(
            F.struct(
                F.col("id").alias("subscriber_id"),
                "subscriber_name",
                "ready_for_consumption",
                F.col("ready_for_consumption_reason").alias("reason"),
                F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
                F.col("watching_contract_ids_json").alias("watched_contracts"),
            )
        ).alias("payload"),
        moment.alias("created_at"),
    )


def flag_changes(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Subscribers whose flag differs between two states, new ones included."""
    old = previous.select("id", F.col("ready_for_consumption").alias("previous_flag"))
    both = current.select("id", F.col("ready_for_consumption").alias("current_flag")).join(old, ["id"], "left")
    return both.filter(~F.col("previous_flag").eqNullSafe(F.col("current_flag"))).select(
        "id", "previous_flag", "current_flag"
    )


def breaches(slos: DataFrame, results: DataFrame, day: str, slo_breach: bool = True, test_failure: bool = False) -> DataFrame:
    """Failing measurements and, on request, failing tests of one day."""
    frames = []
    if slo_breach:
        hit = slos.filter(day_bounds(F.col("measurement_ts"), day) & (F.col("status") == "fail"))
        frames.append(hit.select("id", "contract_id", F.lit("slo_breach").alias("event_type"), F.col("metric_type").alias("subject")))
    if test_failure:
        hit = results.filter(day_bounds(F.col("run_timestamp"), day) & (F.col("status") == "fail"))
        frames.append(hit.select("id", "contract_id", F.lit("test_failure").alias("event_type"), F.col("test_id").alias("subject")))
    if not frames:
        return slos.limit(0).select("id", "contract_id", F.lit("").alias("event_type"), F.col("metric_type").alias("subject"))
    return union_all(frames)
