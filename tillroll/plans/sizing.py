"""Size shuffles from the data, not from a constant.

Spark's default of 200 shuffle partitions is right for a few GB.  At 100 TB
it would put hundreds of GB into each reduce task, and AQE only coalesces
partitions, it does not split them (except skewed join partitions).  So the
starting width is derived from the measured input size, and AQE then
coalesces whatever turns out small.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tillroll.session import default_parallelism
from tillroll.sources.files import file_sizes

# Target bytes per shuffle partition: large enough to keep task overhead
# small, small enough to sort and aggregate in an executor's memory share.
TARGET_PARTITION_BYTES = 256 << 20


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of the data files under ``paths``, from their listing."""
    total = file_sizes(spark, paths).agg(F.sum("size_bytes")).first()[0]
    return int(total or 0)


def size_shuffles(
    spark: SparkSession,
    paths: list[str],
    target_bytes: int = TARGET_PARTITION_BYTES,
    min_partitions: int | None = None,
) -> int:
    """Set the shuffle width for jobs over ``paths``; returns it.

    ``ceil(input bytes / target)``, at least the cluster's default
    parallelism (or ``min_partitions``), so every core has work.  AQE's
    advisory size is set to the same target, so coalescing aims at it.
    """
    floor = min_partitions or default_parallelism(spark)
    n = max(floor, -(-input_bytes(spark, paths) // target_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_bytes))
    return n
