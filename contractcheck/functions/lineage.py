"""Cutting the plan of a result that several later steps read."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


#: Rows from which on a task of a frame with a known bound writes a file of its own.
ROWS_PER_FILE = 100_000


def settled(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Compute once and keep the rows in the session's checkpoint folder.

    ``rows``, if given, is a bound of the row count: the last step then has a task per
    core, or more by :data:`ROWS_PER_FILE`, instead of a nearly empty file for every
    shuffle partition. A local file system starts processes for each file. The bound
    suits steps whose work grows with their rows; it never adds tasks.

    The folder named in ``spark.checkpoint.dir`` is shared by the cluster and
    outlives a lost executor. Only where none is set, as in local tests, a
    temporary one is used.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="contractcheck-"))
    if rows is not None:
        df = df.coalesce(max(context.defaultParallelism, -(-rows // ROWS_PER_FILE)))
    return df.checkpoint(eager=True)
