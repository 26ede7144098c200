"""Generated ids of the fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import fits_broadcast, settled
from .running import totals_before

# monotonically_increasing_id puts the partition above bit 33, the row below.
_ROW_BITS = 33
# The offsets of some millions of tasks.
_OFFSET_BYTES = 64 << 20


def next_id(existing: DataFrame, name: str) -> int:
    """The first free id of a table that is appended to, by one writer at a time."""
    return existing.agg(F.coalesce(F.max(name) + 1, F.lit(0))).first()[0]


def with_id(df: DataFrame, name: str, start: int = 0) -> DataFrame:
    """Unique ids from ``start`` on, with gaps and without a shuffle.

    The ids belong to one run of the plan: use it directly before a write.
    """
    return df.select((F.monotonically_increasing_id() + start).alias(name), "*")


def with_dense_id(df: DataFrame, name: str, start: int = 0) -> DataFrame:
    """Ids ``start``, ``start + 1``, … without gaps.

    Counting rows and numbering them must see the same places: rows that were shuffled are written out
    first, others are read twice. Each task's rows are moved up by the rows before it; what was before
    is summed up in blocks of tasks, and copied to the executors if it is measured to be small.
    """
    placed = settled(df).withColumn("_place", F.monotonically_increasing_id())
    placed = placed.withColumn("_part", F.shiftright("_place", _ROW_BITS))
    totals = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    offsets = totals_before(totals, [], "_part", "_rows", "_before").select("_part", "_before")
    offsets = F.broadcast(offsets) if fits_broadcast(offsets, _OFFSET_BYTES) else offsets
    row = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return placed.join(offsets, "_part").select((row + F.col("_before") + start).alias(name), *df.columns)
