"""Checks tables against declared agreements, on Spark."""

from contractcheck.operators.contracts import extract, lint
from contractcheck.operators.counters import column_counters, null_profile, null_spike
from contractcheck.operators.drift import schema_diff, schema_drift
from contractcheck.operators.keys import check_relationship, check_unique
from contractcheck.operators.readiness import contract_status, flag_changes, readiness
from contractcheck.operators.reports import latest
from contractcheck.operators.slo import completeness, freshness, reconcile
from contractcheck.operators.storage import retain, upsert
from contractcheck.operators.values import check_accepted, check_expression
from contractcheck.operators.versions import diff_versions
from contractcheck.sources.documents import read_contracts

__all__ = [
    "check_accepted", "check_expression", "check_relationship", "check_unique", "column_counters", "completeness",
    "contract_status", "diff_versions", "extract", "flag_changes", "freshness", "latest", "lint", "null_profile",
    "null_spike", "read_contracts", "readiness", "reconcile", "retain", "schema_diff", "schema_drift", "upsert",
]
