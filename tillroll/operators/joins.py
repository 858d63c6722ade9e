"""Join helpers: broadcast only behind a size check, with a fallback."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bytes up to which a side is hinted; beyond, the planner (and adaptive
# execution, from measured shuffle sizes) chooses the join on its own.
MAX_BROADCAST_BYTES = 32 << 20


def planned_bytes(df: DataFrame) -> int:
    """The planner's size of ``df``: measured for a cached or stored table, an
    upper estimate for anything else.  Runs no job."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_if_small(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Hint ``df`` for broadcast only when its size is known to be small."""
    return F.broadcast(df) if planned_bytes(df) <= max_bytes else df
