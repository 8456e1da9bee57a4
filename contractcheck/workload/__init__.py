"""Named queries over the test tables, each with its plain-SQL counterpart."""

from contractcheck.workload import columns, contracts, drift, flagship, keys, logs, slo, transforms, values, versions  # noqa: F401
from contractcheck.workload.base import ORACLES, QUERIES  # noqa: F401
