"""The tuned report: the same steps over a materialized fact table.

``tuned_report`` is a context manager.  On entry it materializes the fact
table once and persists the small category aggregate; every step then starts
from the materialized data; on exit (also on error) everything is released.
It must return the same rows as the plain functions, and tests check that.

How the fact table is held (``storage``):

* ``"cache"``   - ``persist(MEMORY_AND_DISK)``; partitions that do not fit in
  memory spill to local disk, and a lost executor's blocks are recomputed
  from lineage.  Right for data that is a small share of cluster memory.
* ``"table"``   - written as parquet under the shared checkpoint folder and
  read back.  Cuts the lineage (a lost executor costs a re-read, not a
  rerun of the joins) and scales to any size: the choice at 100 TB.
* ``"checkpoint"`` - ``DataFrame.checkpoint()`` into the same shared folder.
* ``None``      - nothing materialized (useful to isolate the other changes).

A large fact table belongs in a ``table``; ``cache`` is for one that is a small
share of the cluster's memory.  No blind ``repartition`` before caching (it
shuffles every column; available through ``partitions`` when measured to help).
"""

from __future__ import annotations

import weakref
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from tillroll.operators import report
from tillroll.operators.joins import broadcast_if_small
from tillroll.plans.onepass import grouped_aggregate, split_results
from tillroll.session import checkpoint_root, delete_path, scratch_path
from tillroll.sources.sinks import write_csv


@dataclass
class TunedReport:
    fact: DataFrame
    category_stats: DataFrame
    grouped: dict[str, DataFrame] | None = None

    def _group(self, name: str, fn) -> DataFrame:
        return self.grouped[name] if self.grouped else fn(self.fact)

    def load_shape(self) -> DataFrame:
        return report.load_shape(self.fact)

    def basic_stats(self) -> DataFrame:
        return report.column_profile(self.fact)

    def sales_by_category(self) -> DataFrame:
        return self.category_stats

    def sales_by_region(self) -> DataFrame:
        return self._group("sales_by_region", report.sales_by_region)

    def top_products(self) -> DataFrame:
        """Top products with the category discount, joined to the persisted
        category table, which is broadcast if its stored size is small."""
        return report.top_products_with_lookup(
            self.fact, broadcast_if_small(self.category_stats))

    def monthly_trends(self) -> DataFrame:
        return self._group("monthly_trends", report.monthly_trends)

    def age_group_analysis(self) -> DataFrame:
        return self._group("age_group_analysis", report.age_group_analysis)

    def payment_analysis(self) -> DataFrame:
        return self._group("payment_analysis", report.payment_analysis)

    def window_ranking(self) -> DataFrame:
        return report.window_ranking(self.fact)

    def save(self, path: str) -> str:
        return write_csv(self.category_stats, path, single_file=True)


def materialize(
    df: DataFrame, storage: str | None, partitions: int | None = None
) -> tuple[DataFrame, str | None]:
    """Hold ``df`` as described in the module notes.

    Returns the frame to use and the folder it lies in, if any.
    """
    spark = df.sparkSession
    if partitions:
        df = df.repartition(partitions)
    if storage is None:
        return df, None
    if storage == "cache":
        return df.persist(StorageLevel.MEMORY_AND_DISK), None
    if storage == "table":
        path = scratch_path(spark, "fact")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path), path
    if storage == "checkpoint":
        checkpoint_root(spark)  # registers a folder when none is set
        held = df.checkpoint(eager=True)
        files = held._jdf.queryExecution().logical().rdd().getCheckpointFile()
        return held, files.get() if files.isDefined() else None
    raise ValueError(f"unknown storage {storage!r}")


def held_while(result: DataFrame, *frames: DataFrame) -> DataFrame:
    """``result``, with the persisted ``frames`` it reads from kept as long as it is.

    When the caller lets go of ``result`` the frames are unpersisted.  A plan
    made from it that runs later still gives the same rows; it computes them anew.
    """
    weakref.finalize(result, _unpersist, frames)
    return result


def _unpersist(frames: tuple[DataFrame, ...]) -> None:
    for frame in frames:
        if frame.sparkSession.getActiveSession() is not None:  # not when all has ended
            frame.unpersist()


@contextmanager
def tuned_report(
    df: DataFrame,
    storage: str | None = "cache",
    partitions: int | None = None,
    one_pass_groups: bool = False,
) -> Iterator[TunedReport]:
    """Materialize ``df`` and the category table; release both on exit.

    With ``one_pass_groups`` the five group-by steps (and the category table
    the lookup join uses) come from one shared aggregate
    (``tillroll.plans.onepass``), persisted, instead of one scan each.
    """
    fact, path = materialize(df, storage, partitions)
    held = [fact] if storage == "cache" else []
    try:
        grouped = None
        if one_pass_groups:
            agg = grouped_aggregate(fact).persist(StorageLevel.MEMORY_AND_DISK)
            held.append(agg)
            grouped = split_results(agg)
            cat_stats = grouped["sales_by_category"]
        else:
            cat_stats = report.sales_by_category(fact).persist(StorageLevel.MEMORY_ONLY)
            held.append(cat_stats)
        yield TunedReport(fact, cat_stats, grouped)
    finally:
        for frame in held:
            frame.unpersist()
        if path:
            delete_path(df.sparkSession, path)
