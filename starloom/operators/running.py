"""Running sums over ordered parts, without one task for all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Parts whose totals are summed up by one task.
PARTS_PER_BLOCK = 4096


def totals_before(totals: DataFrame, within: Sequence[str], part: str, value: str, name: str) -> DataFrame:
    """``totals`` (a row per part) with the sum of ``value`` over all earlier parts of the same ``within``.

    Parts are whole numbers. Their totals are summed up block by block, and the sums of blocks once
    more, so a task holds the parts of one block only.
    """
    blocks = totals.withColumn("_block", F.floor(F.col(part) / PARTS_PER_BLOCK))
    earlier = (Window.unboundedPreceding, -1)
    inside = F.sum(value).over(Window.partitionBy(*within, "_block").orderBy(part).rowsBetween(*earlier))
    sums = blocks.groupBy(*within, "_block").agg(F.sum(value).alias("_sum"))
    # One row for thousands of parts. With nothing in ``within`` a single task sums up these.
    upto = F.sum("_sum").over(Window.partitionBy(*within).orderBy("_block").rowsBetween(*earlier))
    offsets = sums.select(*within, "_block", F.coalesce(upto, F.lit(0)).alias("_offset"))
    found = blocks.withColumn("_inside", F.coalesce(inside, F.lit(0))).join(offsets, [*within, "_block"])
    return found.withColumn(name, F.col("_offset") + F.col("_inside")).drop("_block", "_inside", "_offset")


def running_total(
    rows: DataFrame, within: Sequence[str], part: str, order: Sequence[str], value: Column, name: str
) -> DataFrame:
    """``rows`` with the sum of ``value`` over the earlier rows of the same ``within``, by (part, order).

    ``within`` and ``part`` say which rows one task has; ``part`` is a whole number.
    """
    valued = rows.withColumn("_value", value)
    totals = valued.groupBy(*within, part).agg(F.sum("_value").alias("_total"))
    before = totals_before(totals, within, part, "_total", "_before").select(*within, part, "_before")
    inside = Window.partitionBy(*within, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = valued.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    joined = summed.join(before, [*within, part])
    return joined.withColumn(name, F.col("_before") + F.col("_inside")).drop("_value", "_inside", "_before")
