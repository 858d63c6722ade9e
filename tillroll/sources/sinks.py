"""Writers: CSV, JSON and parquet, to any Hadoop-compatible URI."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tillroll.session import delete_path, scratch_path


# Rows that may go into one file, and so through one task.
MAX_SINGLE_FILE_ROWS = 1_000_000


def _write_one(df: DataFrame, path: str, sort_by: list[str] | None, mode: str, write: Callable) -> None:
    """Write ``df`` as one file, which is only sensible for small results.

    One run: the rows are counted as they are written, and no more than one
    beyond the limit gets that far.  Too many are an error, after which ``path``
    is empty.  A sorted file is sorted inside its single partition.
    """
    few = df.limit(MAX_SINGLE_FILE_ROWS + 1)
    one = few.repartition(1).sortWithinPartitions(*sort_by) if sort_by else few.coalesce(1)
    seen = Observation()
    write(one.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode))
    if seen.get["rows"] > MAX_SINGLE_FILE_ROWS:
        delete_path(df.sparkSession, path)
        raise ValueError(f"more than {MAX_SINGLE_FILE_ROWS} rows for one file; write many files")


def write_csv(
    df: DataFrame,
    path: str,
    single_file: bool = False,
    sort_by: list[str] | None = None,
    mode: str = "overwrite",
) -> str:
    """Write ``df`` as CSV with a header; returns ``path``.

    ``single_file`` reproduces the reference's one-file result folder and is
    meant for small aggregates; leave it off for large frames so every task
    writes its own part file in parallel.
    """
    write = lambda w: w.option("header", True).csv(path)
    if single_file:
        _write_one(df, path, sort_by, mode, write)
    else:
        write(df.write.mode(mode))
    return path


def write_json(
    df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite"
) -> str:
    """Write ``df`` as JSON lines (nested columns kept)."""
    write = lambda w: w.json(path)
    if single_file:
        _write_one(df, path, None, mode, write)
    else:
        write(df.write.mode(mode))
    return path


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    mode: str = "overwrite",
) -> str:
    """Write ``df`` as parquet, optionally partitioned by low-cardinality keys."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    For an aggregate that one result needs several times: the input is read
    once, and a lost executor costs a re-read.  It is deleted when the session
    ends.
    """
    path = write_parquet(df, scratch_path(df.sparkSession, name))
    return df.sparkSession.read.schema(df.schema).parquet(path)
