"""Column layout of the registry tables, the logs and the check results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S, _L, _I, _B = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType()
_TS, _D = T.TimestampNTZType(), T.DoubleType()


def _table(required: dict[str, T.DataType], optional: dict[str, T.DataType]) -> T.StructType:
    fields = [T.StructField(n, t, False) for n, t in required.items()]
    return T.StructType(fields + [T.StructField(n, t, True) for n, t in optional.items()])


CONTRACTS = _table(
    {"id": _S, "name": _S, "version": _S, "domain": _S},
    {
        "owner_name": _S, "owner_email": _S, "owner_slack": _S, "source_path": _S, "description": _S,
        "slo_freshness_hours": _D, "slo_completeness": _D, "slo_accuracy": _D, "slo_availability": _D,
        "published_at": _TS, "published_by": _S, "contract_json": _S, "_created_ts": _TS, "_updated_ts": _TS,
    },
)
MODELS = _table(
    {"id": _S, "model_name": _S, "schema_name": _S},
    {
        "contract_id": _S, "materialized_as": _S, "freshness_slo_hours": _D, "completeness_slo": _D,
        "critical": _B, "pii_flag": _B, "owner_name": _S, "meta_json": _S, "_created_ts": _TS, "_updated_ts": _TS,
    },
)
COLUMNS = _table(
    {"id": _S, "model_id": _S, "column_name": _S},
    {
        "pos": _I, "data_type": _S, "required_flag": _B, "description": _S, "enum_values_json": _S,
        "max_length": _I, "length": _I, "_created_ts": _TS,
    },
)
TESTS = _table(
    {"id": _S, "test_name": _S, "test_type": _S},
    {
        "column_id": _S, "model_id": _S, "column_name": _S, "pos": _I, "severity": _S,
        "test_params_json": _S, "description": _S, "_created_ts": _TS,
    },
)
TEST_RESULTS = _table(
    {"id": _S, "run_id": _S, "test_id": _S},
    {
        "contract_id": _S, "model_name": _S, "column_name": _S, "test_name": _S, "test_type": _S, "status": _S,
        "failure_message": _S, "rows_affected": _L, "execution_time_ms": _L, "compiled_sql": _S,
        "run_timestamp": _TS, "configured_by": _S, "_inserted_ts": _TS,
    },
)
PUBLISHERS = _table(
    {"id": _S, "publisher_type": _S, "name": _S},
    {"description": _S, "config_json": _S, "last_publish_at": _TS, "last_status": _S, "_created_ts": _TS, "_updated_ts": _TS},
)
SUBSCRIBERS = _table(
    {"id": _S, "subscriber_name": _S},
    {
        "email": _S, "slack_channel": _S, "webhook_url": _S, "watching_contract_ids_json": _S,
        "ready_for_consumption": _B, "ready_for_consumption_reason": _S, "daily_slo_check_ts": _TS,
        "_created_ts": _TS, "_updated_ts": _TS,
    },
)
SLO_METRICS = _table(
    {"id": _S, "contract_id": _S, "metric_type": _S},
    {
        "expected_value": _D, "actual_value": _D, "status": _S, "severity": _S,
        "measurement_details_json": _S, "measurement_ts": _TS, "_inserted_ts": _TS,
    },
)
DATA_QUALITY_LOG = _table(
    {"id": _S, "model_id": _S, "quality_check_type": _S, "severity": _S, "status": _S},
    {
        "description": _S, "details_json": _S, "reviewed_flag": _B, "reviewer_name": _S,
        "detected_at": _TS, "_inserted_ts": _TS,
    },
)
CONTRACT_REGISTRY = _table(
    {"contract_id": _S, "contract_name": _S, "version": _S},
    {"domain": _S, "contract_content": _S, "published_at": _TS, "publisher": _S, "created_at": _TS},
)
OUTBOX = _table(
    {"subscriber_id": _S, "event_type": _S},
    {"payload": _S, "created_at": _TS},
)
RESULT = _table(
    {},
    {
        "contract_id": _S, "model_id": _S, "table_name": _S, "column_name": _S, "check_type": _S, "status": _S,
        "severity": _S, "rows_total": _L, "rows_failed": _L, "expected_value": _D, "actual_value": _D,
        "details": _S, "as_of": _TS,
    },
)

DOCUMENTS = _table({"source_path": _S, "digest": _S}, {"content": _S, "parse_error": _S})

REGISTRY_TABLES = {
    "contract_documents": DOCUMENTS,
    "model_documents": DOCUMENTS,
    "contracts": CONTRACTS,
    "models": MODELS,
    "columns": COLUMNS,
    "tests": TESTS,
    "publishers": PUBLISHERS,
    "subscribers": SUBSCRIBERS,
}
LOG_TABLES = {
    "test_results": (TEST_RESULTS, "run_timestamp"),
    "slo_metrics": (SLO_METRICS, "measurement_ts"),
    "data_quality_log": (DATA_QUALITY_LOG, "detected_at"),
    "contract_registry": (CONTRACT_REGISTRY, "published_at"),
    "outbox": (OUTBOX, "created_at"),
}

LOG_KEYS = {
    "test_results": ["id"],
    "slo_metrics": ["id"],
    "data_quality_log": ["id"],
    "contract_registry": ["contract_id", "version"],
    "outbox": ["subscriber_id", "event_type", "created_at"],
}

# What a column holds when the writer gives nothing.
COLUMN_DEFAULTS = {
    "models": {"critical": False, "pii_flag": False},
    "tests": {"severity": "error"},
    "subscribers": {"ready_for_consumption": False},
    "data_quality_log": {"reviewed_flag": False},
}


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def conform(df: DataFrame, schema: T.StructType, defaults: dict[str, object] | None = None) -> DataFrame:
    """Same columns, order and types as ``schema``; absent columns are NULL or
    their default."""
    defaults = defaults or {}
    have = set(df.columns)
    picked = []
    for field in schema.fields:
        value = F.col(field.name) if field.name in have else F.lit(None)
        if field.name in defaults:
            value = F.coalesce(value.cast(field.dataType), F.lit(defaults[field.name]))
        picked.append(value.cast(field.dataType).alias(field.name))
    return df.select(*picked)


def missing_required(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows in which a not-null column of ``schema`` is NULL."""
    bad = F.lit(False)
    for field in schema.fields:
        if not field.nullable:
            bad = bad | F.col(field.name).isNull()
    return df.filter(bad)
