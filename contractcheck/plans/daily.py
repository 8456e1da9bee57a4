"""The daily run: registry, tests, service levels, data quality, readiness.

Every step reads tables and writes tables. What one step writes is the input of the
next, so a lost executor never repeats more than the step it was in.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractcheck.functions.numbers import ntz
from contractcheck.functions.text import quote_name, stable_id
from contractcheck.operators import contracts as registry
from contractcheck.operators import drift, readiness, reports, slo, storage, versions
from contractcheck.operators.counters import (
    Check,
    check_from_row,
    is_row_check,
    null_spike,
    problem,
    profile_from_counts,
    status_of,
)
from contractcheck.operators.drift import column_types
from contractcheck.operators.lookups import union_all
from contractcheck.plans.declared import counted, declared_counts, unique_key
from contractcheck.plans.shared_scan import Probe, measured, reason_of, table_probes
from contractcheck.sources.documents import explode_models, parse_changed, read_text_files, split_contracts
from contractcheck.sources.tables import table_columns

TABLES_PER_JOB = 20

# Which columns an upsert refreshes; the others are set on insert only.
UPDATED = {
    "contracts": [
        "name", "domain", "owner_name", "owner_email", "owner_slack", "source_path", "description",
        "slo_freshness_hours", "slo_completeness", "slo_accuracy", "slo_availability", "contract_json", "_updated_ts",
    ],
    "models": [
        "model_name", "schema_name", "contract_id", "materialized_as", "freshness_slo_hours", "completeness_slo",
        "critical", "pii_flag", "owner_name", "_updated_ts",
    ],
    "columns": [
        "model_id", "column_name", "pos", "data_type", "required_flag", "description", "enum_values_json",
        "max_length", "length",
    ],
    "tests": [
        "test_name", "test_type", "column_id", "model_id", "column_name", "pos", "severity", "test_params_json",
        "description",
    ],
}

CustomTest = Callable[[DataFrame, Check], DataFrame]


@dataclass(frozen=True)
class Run:
    """Where a run works and what it does. ``tables`` maps model names to Parquet
    paths; ``custom_tests`` maps test names to functions giving failing rows. With
    ``default_levels`` an agreement that names no level is held to the common ones."""

    spark: SparkSession
    root: str
    as_of: str
    tables: Mapping[str, str]
    user: str = "contractcheck"
    drift: bool = True
    null_spikes: bool = True
    null_spike_threshold: float = 10
    slos: bool = True
    default_levels: bool = False
    critical_models_block: bool = False
    timestamp_columns: tuple[str, ...] = slo.DEFAULT_TIMESTAMP_COLUMNS
    custom_tests: Mapping[str, CustomTest] = field(default_factory=dict)
    retention_days: int = 7
    retention_enabled: bool = True
    retention_tables: tuple[str, ...] = ("test_results", "slo_metrics")
    archive: str | None = None

    @property
    def day(self) -> str:
        return self.as_of[:10]

    @property
    def run_id(self) -> str:
        return "run_" + "".join(c for c in self.as_of if c.isdigit())

    def read(self, table: str) -> DataFrame:
        return storage.read_current(self.spark, self.root, table)

    def log(self, table: str, day: str | None = None) -> DataFrame:
        return storage.read_log(self.spark, self.root, table, day)

    def kept(self, df: DataFrame, name: str) -> DataFrame:
        """Write an intermediate result and read it back."""
        path = f"{self.root}/_runs/{self.run_id}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def table(self, model_name: str) -> DataFrame | None:
        path = self.tables.get(model_name)
        try:
            return self.spark.read.parquet(path) if path else None
        except Exception:  # reported by the availability level
            return None


def _merge(run: Run, table: str, rows: DataFrame, insert_only: list[str]) -> None:
    key = ["id", "version"] if table == "contracts" else ["id"]
    moment = ntz(run.as_of)
    stamped = rows.withColumns({"_created_ts": moment, "_updated_ts": moment, "published_at": moment, "published_by": F.lit(run.user)})
    source = storage.assert_unique(stamped, key, table)
    storage.write_snapshot(storage.upsert(run.read(table), source, key, UPDATED[table], insert_only), run.root, table)


def highest_versions(good: DataFrame) -> DataFrame:
    """One document per agreement: the highest version describes the table."""
    d = registry.extract_contracts(good)
    ranked = d.select("source_path", "id", versions.version_number(F.col("version")).alias("v"))
    best = ranked.groupBy("id").agg(F.max_by("source_path", F.struct("v", "source_path")).alias("source_path"))
    return good.join(best.select("source_path"), ["source_path"], "left_semi")


def first_of_each(good: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents without later copies of one agreement version, and those copies as rejects."""
    d = registry.extract_contracts(good).select("source_path", "id", "version")
    first = d.groupBy("id", "version").agg(F.min("source_path").alias("kept"))
    copies = d.join(first, ["id", "version"]).filter(F.col("source_path") != F.col("kept"))
    copies = copies.select("source_path", F.concat(F.lit("same agreement and version as "), "kept").alias("reject_reason"))
    return good.join(copies.select("source_path"), ["source_path"], "left_anti"), copies


def _listed_once(tests: DataFrame) -> DataFrame:
    """A test that a column lists twice counts once, at its first place."""
    same = [c for c in tests.columns if c != "pos"]
    return tests.groupBy(*same).agg(F.min("pos").alias("pos")).select(*tests.columns)


def _documents(run: Run, path: str, table: str) -> DataFrame:
    """The parsed files below ``path``. They are kept as a snapshot, so the next run, or this
    one repeated after a crash, parses only files that are new or have changed."""
    parsed = parse_changed(read_text_files(run.spark, path), run.read(table))
    storage.write_snapshot(parsed, run.root, table)
    return run.read(table)


def refresh_registry(run: Run, contracts_path: str, models_path: str | None = None) -> DataFrame:
    """Load documents into the registry and return the rejected ones."""
    storage.ensure_tables(run.spark, run.root)
    documents = _documents(run, contracts_path, "contract_documents")
    good, rejects = split_contracts(documents)
    good, copies = first_of_each(good)
    rejects = run.kept(rejects.select("source_path", "reject_reason").unionAll(copies), "rejects")
    _merge(run, "contracts", registry.extract_contracts(good), ["published_at", "published_by", "_created_ts"])
    current = highest_versions(good)
    _merge(run, "models", registry.contract_models(current), ["_created_ts"])
    _merge(run, "columns", registry.contract_columns(current), ["_created_ts"])
    _merge(run, "tests", _listed_once(registry.contract_tests(current)), ["_created_ts"])
    if models_path:
        models = run.kept(explode_models(_documents(run, models_path, "model_documents")), "models")
        resolved = registry.resolve_contract(registry.extract_models(models), run.read("contracts"))
        _merge(run, "models", resolved, ["meta_json", "_created_ts"])
        _merge(run, "columns", registry.model_columns(models), ["_created_ts"])
        _merge(run, "tests", _listed_once(registry.model_tests(models)), ["_created_ts"])
    return rejects


def publish_versions(run: Run) -> None:
    """Append agreement versions that were never published."""
    new = versions.publish(run.read("contracts"), run.user, run.as_of, run.log("contract_registry"))
    storage.append_once(new, run.root, "contract_registry", run.day)


def planned_checks(run: Run) -> dict[str, list[tuple[str, Check]]]:
    """Checks per table name with their test ids: the declared tests, and the
    lengths and value lists columns declare outside their tests. Only this list,
    bounded by the registered columns, comes to the driver."""
    models = run.read("models").select(F.col("id").alias("model_id"), "model_name")
    tests = run.read("tests").join(models, ["model_id"]).select(
        "model_name", "id", "column_name", "test_name", "test_params_json", "severity"
    )
    columns = run.read("columns").join(models, ["model_id"])
    implied = [
        columns.filter(F.col(c).isNotNull()).select(
            "model_name",
            F.concat_ws("/", "id", F.lit(c)).alias("id"),
            "column_name",
            F.lit(c).alias("test_name"),
            F.concat(F.lit(f'{{"{c}": '), F.col(c).cast("string"), F.lit("}")).alias("test_params_json"),
            F.lit("error").alias("severity"),
        )
        for c in ("max_length", "length")
    ]
    implied.append(
        columns.filter(F.col("enum_values_json").isNotNull()).select(
            "model_name",
            F.concat_ws("/", "id", F.lit("enum")).alias("id"),
            "column_name",
            F.lit("enum").alias("test_name"),
            F.concat(F.lit('{"enum": '), "enum_values_json", F.lit("}")).alias("test_params_json"),
            F.lit("error").alias("severity"),
        )
    )
    plan: dict[str, list[tuple[str, Check]]] = {}
    for r in union_all([tests, *implied]).orderBy("model_name", "id").collect():
        check = check_from_row(r.column_name, r.test_name, r.test_params_json, r.severity)
        plan.setdefault(r.model_name, []).append((r.id, check))
    return plan


def _cross_row_counts(run: Run, df: DataFrame, check: Check) -> DataFrame | None:
    """Counts of a check that needs a shuffle, a second table or the schema."""
    if check.column not in df.columns:
        return None
    if check.test_name in run.custom_tests:
        return counted(df, run.custom_tests[check.test_name](df, check))
    if check.kind == "column_type":
        wanted = check.params.get("values") or [check.params.get("value")]
        fits = any(column_types(df, {check.column: w})[0][3] for w in wanted)
        return run.spark.createDataFrame([(1, 0 if fits else 1)], "rows_total bigint, rows_failed bigint")

    def other(name: str) -> DataFrame:
        found = run.table(name.strip().removeprefix("ref(").removesuffix(")").strip(" '\""))
        if found is None:
            raise LookupError(f"table {name} is not mapped or readable")
        return found

    counts = declared_counts(df, check, other, run.as_of)
    if counts is not None:
        counts.schema  # noqa: B018  (columns that are absent show here, not in the common job)
    return counts


def _probe(run: Run, table: str, df: DataFrame, test_id: str, check: Check) -> Probe:
    """The check as a probe, with a reason if it can't be built."""
    if is_row_check(check):
        return Probe(table, test_id, check, reason=problem(df, check))
    try:
        key = None if check.test_name in run.custom_tests else unique_key(check)
        if key:
            df.select(*[quote_name(c) for c in key]).schema  # noqa: B018  (absent columns show here)
            return Probe(table, test_id, check, key=tuple(key))
        counts, reason = _cross_row_counts(run, df, check), None
    except Exception as exc:  # such as a missing parameter; an error of this check alone
        counts, reason = None, reason_of(exc)
    if counts is None and reason is None:
        reason = f"no test {check.test_name} for column {check.column}"
    return Probe(table, test_id, check, counts, reason)


def table_probes_of(run: Run, table: str, df: DataFrame, checks: list[tuple[str, Check]], required: list[str]) -> list[Probe]:
    """Declared checks, null counts of the required columns and the table's own facts."""
    probes = [_probe(run, table, df, i, k) for i, k in checks]
    probes += [Probe(table, f"required/{c}", Check(c, "not_null", severity="required")) for c in required]
    return probes + table_probes(table)


def required_by_model(run: Run) -> dict[str, list[str]]:
    rows = slo.required_columns(run.read("columns"), run.read("models")).orderBy("model_name", "column_name").collect()
    out: dict[str, list[str]] = {}
    for r in rows:
        out.setdefault(r.model_name, []).append(r.column_name)
    return out


def count_all(run: Run) -> DataFrame:
    """Counts of all planned checks and the facts of all registered tables, written once
    and used by every later step: one scan per table.

    Checks of a table that is not mapped or can't be read have no counts and are
    logged as errors; nobody is told "ready" about a table that nobody read.
    """
    plan, required = planned_checks(run), required_by_model(run)
    registered = [r.model_name for r in run.read("models").select("model_name").distinct().collect()]
    tables, probes = {}, []
    for name in sorted({*plan, *required, *registered}):
        df = run.table(name)
        if df is not None:
            tables[name] = df
            probes += table_probes_of(run, name, df, plan.get(name, []), required.get(name, []))
        else:
            gone = [Probe(name, i, k) for i, k in plan.get(name, [])] + table_probes(name, with_moment=False)
            probes += [replace(p, reason="table is not mapped or readable") for p in gone]
    return run.kept(measured(run.spark, tables, probes, run.timestamp_columns, TABLES_PER_JOB), "counts")


def log_tests(run: Run, counts: DataFrame) -> None:
    """Append one result per test; failures are always logged."""
    moment = ntz(run.as_of)
    owner = run.read("models").select(F.col("model_name").alias("table_name"), F.col("id").alias("model_id"), "contract_id")
    by_contract = owner.groupBy("table_name").agg(
        F.min_by("contract_id", F.struct((F.col("model_id") != F.col("contract_id")).cast("int"), "model_id")).alias("contract_id")
    )
    tests = counts.filter(~F.col("severity").isin("required", "table")).join(by_contract, ["table_name"], "left")
    status = status_of(F.col("rows_total"), F.col("rows_failed"))
    rows = tests.select(
        stable_id(F.lit(run.run_id), F.col("test_id")).alias("id"),
        F.lit(run.run_id).alias("run_id"),
        "test_id",
        "contract_id",
        F.col("table_name").alias("model_name"),
        "column_name",
        F.col("check_type").alias("test_name"),
        F.col("check_type").alias("test_type"),
        status.alias("status"),
        F.when(status == "fail", F.concat(F.col("rows_failed").cast("string"), F.lit(" failing"))).when(status == "error", F.col("reason")).alias("failure_message"),
        F.when(status == "fail", F.col("rows_failed")).alias("rows_affected"),
        moment.alias("run_timestamp"),
        F.lit(run.user).alias("configured_by"),
        moment.alias("_inserted_ts"),
    )
    storage.append_once(rows, run.root, "test_results", run.day)


def log_slos(run: Run, counts: DataFrame) -> None:
    """Append freshness, completeness and availability of every agreement's model, all out of the run's counts."""
    targets = slo.slo_targets(run.read("contracts"), run.read("models"))
    if run.default_levels:
        targets = slo.filled_targets(targets)
    profile = profile_from_counts(counts.filter(F.col("severity") == "required"), ("table_name",))
    found = slo.levels(targets, counts, profile, run.as_of)
    rows = run.kept(slo.measured(found, F.col("contract_id"), run.as_of, F.col("model_name")), "slos")
    storage.append_once(rows, run.root, "slo_metrics", run.day)


def log_quality(run: Run, counts: DataFrame) -> None:
    """Append schema drift and null spikes. A table registered twice is measured
    once and reported per registration."""
    models = run.read("models").select(F.col("id").alias("model_id"), F.col("model_name").alias("table_name"), "critical")
    frames = []
    if run.drift:
        real = {n: df for n in run.tables if (df := run.table(n)) is not None}
        declared = run.read("columns").join(models, ["model_id"]).select("model_id", "table_name", "column_name")
        actual = table_columns(run.spark, real).join(models, ["table_name"]).select("model_id", "table_name", "column_name")
        present = declared.join(actual.select("model_id").distinct(), ["model_id"], "left_semi")
        frames.append(drift.schema_drift(present, actual, ("model_id",)).drop("column_name"))
    if run.null_spikes:
        nulls = profile_from_counts(counts.filter(F.col("severity") == "required"), ("table_name",))
        needed = run.read("columns").filter("required_flag").select("model_id", "column_name")
        wanted = nulls.join(models, ["table_name"]).join(needed, ["model_id", "column_name"], "left_semi")
        spikes = null_spike(wanted, run.null_spike_threshold, ("model_id",))
        frames.append(spikes.drop("column_name", "rows_total", "null_rows", "null_pct"))
    if not frames:
        return
    moment = ntz(run.as_of)
    issues = union_all(frames).join(models.select("model_id", "critical"), ["model_id"])
    severity = F.col("severity")
    if run.critical_models_block:
        severity = F.when(F.col("critical") & (severity == "high"), "critical").otherwise(severity)
    rows = issues.select(
        stable_id(F.col("model_id"), F.col("description"), moment).alias("id"),
        "model_id",
        "quality_check_type",
        severity.alias("severity"),
        "status",
        "description",
        "details_json",
        F.lit(False).alias("reviewed_flag"),
        moment.alias("detected_at"),
        moment.alias("_inserted_ts"),
    )
    storage.append_once(rows, run.root, "data_quality_log", run.day)


def update_readiness(run: Run) -> None:
    """Set every subscriber's flag and put changed ones into the outbox."""
    results, slos = run.log("test_results", run.day), run.log("slo_metrics", run.day)
    status = readiness.contract_status(results, slos, run.log("data_quality_log", run.day), run.read("models"), run.day)
    before = run.read("subscribers")
    after = run.kept(readiness.readiness(status, before, run.as_of), "subscribers")
    changed = readiness.flag_changes(before, after).select("id")
    # Messages first: a run that stops in between still sees the change when repeated.
    messages = readiness.notifications(after.join(changed, ["id"], "left_semi"), run.as_of)
    storage.append_once(messages, run.root, "outbox", run.day)
    storage.write_snapshot(after, run.root, "subscribers")


def run_daily(run: Run, contracts_path: str, models_path: str | None = None) -> DataFrame:
    """One whole run; returns its summary row."""
    rejects = refresh_registry(run, contracts_path, models_path)
    publish_versions(run)
    counts = count_all(run)
    log_tests(run, counts)
    if run.slos:
        log_slos(run, counts)
    log_quality(run, counts)
    update_readiness(run)
    for table in run.retention_tables:
        storage.expire_log(
            run.spark, run.root, table, run.retention_days, run.as_of, run.archive, run.retention_enabled
        )
    summary = reports.run_summary(run.log("test_results", run.day).filter(F.col("run_id") == run.run_id))
    return reports.with_levels_and_rejects(
        summary, run.log("slo_metrics", run.day), rejects, run.run_id, run.as_of, run.log("data_quality_log", run.day)
    )
