"""Identifiers, JSON text and test-name handling.

Only YAML parsing and canonical JSON text need Python. Both are Arrow-batched
scalar helpers over agreement documents, which are small next to the data.
"""

from __future__ import annotations

import json
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

try:
    import yaml

    YAML_LOADER = getattr(yaml, "CSafeLoader", yaml.SafeLoader)
except ImportError:  # JSON documents still load without the YAML package
    yaml = None
    YAML_LOADER = None

# Workers get the helpers below by value, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PARSED = T.StructType(
    [T.StructField("content", T.StringType()), T.StructField("parse_error", T.StringType())]
)


def _load(text: str | None):
    if yaml is None:
        return json.loads(text or "null")
    return yaml.load(text or "", Loader=YAML_LOADER)


def _parse_one(text: str | None) -> tuple[str | None, str | None]:
    try:
        doc = _load(text)
    except Exception as exc:
        return None, f"not readable: {type(exc).__name__}"
    if not isinstance(doc, dict):
        return None, "not a mapping"
    return json.dumps(doc, default=str), None


@F.pandas_udf(PARSED)
def yaml_to_json(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_parse_one(t) for t in texts], columns=["content", "parse_error"])


# Keeps the optimizer from copying the call into filters on its result, which would
# parse every document once more, before the documents are spread over the cores.
yaml_to_json = yaml_to_json.asNondeterministic()


@F.pandas_udf(T.StringType())
def json_text(values: pd.Series) -> pd.Series:
    """JSON re-written with ``", "`` and ``": "`` separators, order kept."""
    return values.map(lambda v: None if v is None else json.dumps(json.loads(v)))


def _content(text: str | None) -> str | None:
    if text is None:
        return None
    return json.dumps(next(iter(json.loads(text).values()), None), sort_keys=True)


@F.pandas_udf(T.StringType())
def map_content_text(values: pd.Series) -> pd.Series:
    """The value inside a one-key JSON map, keys sorted, for use in identifiers."""
    return values.map(_content)


def stable_id(*parts: Column) -> Column:
    """Repeatable identifier: the same natural key always gives the same id."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)


def quote_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def json_list(col: Column) -> Column:
    """A JSON array of strings; NULL, blank or broken text gives an empty one."""
    empty = F.array().cast("array<string>")
    return F.coalesce(F.from_json(col, "array<string>"), empty)


# Leading words of a generated test name, tried in this order.
TEST_PREFIXES = (
    "not_null_",
    "unique_",
    "accepted_values_",
    "expression_is_true_",
    "relationships_",
    "dbt_utils_",
    "equal_rowcount_",
    "cardinality_equality_",
    "mutually_exclusive_ranges_",
    "not_accepted_values_",
    "sequential_values_",
    "at_least_one_",
    "recency_",
    "custom_",
)

# A name that contains the text belongs to the type; first match wins.
TEST_TYPES = (
    ("not_null", "not_null"),
    ("unique", "unique"),
    ("accepted_values", "accepted_values"),
    ("relationships", "relationships"),
    ("expression_is_true", "expression_is_true"),
    ("equal_rowcount", "equal_rowcount"),
    ("contract", "contract_validation"),
)

# Layer prefixes of model names.
MODEL_LAYERS = ("dim", "stg")


def test_full_name(unique_id: Column) -> Column:
    """Last dotted part; empty when there is no dot."""
    return F.when(unique_id.contains("."), F.element_at(F.split(unique_id, r"\."), -1)).otherwise("")


def test_base_name(unique_id: Column) -> Column:
    """Full name up to the first double underscore, ``unknown`` when blank."""
    full = test_full_name(unique_id)
    return F.when(full == "", F.lit("unknown")).otherwise(F.element_at(F.split(full, "__"), 1))


def classify_test(name: Column) -> Column:
    kind = F.lit("generic")
    for needle, label in reversed(TEST_TYPES):
        hit = name.contains(needle)
        if needle == "expression_is_true":
            hit = hit | F.lower(name).contains("rlike")
        kind = F.when(hit, F.lit(label)).otherwise(kind)
    return kind


def strip_test_prefix(base: Column) -> Column:
    """What is left of a test name behind its test type: model and column."""
    known = F.regexp_extract(base, "^(" + "|".join(TEST_PREFIXES) + ")", 1)
    unknown = F.when(base.contains("_"), F.regexp_replace(base, "^[^_]*_", "")).otherwise(base)
    behind = F.substring(base, F.length(known) + 1, F.length(base))
    return F.when(known != "", behind).otherwise(unknown)


def guess_model(rest: Column) -> Column:
    """Model part when the registry does not know the name: two words for the
    layered names, else the first word."""
    words = F.split(rest, "_")
    layered = words[0].isin(*MODEL_LAYERS) & (F.size(words) >= 3)
    return F.when(layered, F.concat_ws("_", words[0], words[1])).otherwise(words[0])


def column_after(rest: Column, model: Column) -> Column:
    """Column part behind ``model_``; NULL when nothing follows."""
    tail = F.substring(rest, F.length(model) + 2, F.length(rest))
    return F.when(F.length(rest) > F.length(model) + 1, tail)
