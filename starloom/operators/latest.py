"""Latest rows per key.

A key may hold a large share of all rows, also with all of them tied at the latest
time, so no group is ever brought together whole. The maxima per key come from an
aggregation that collapses a key within each split. If they can be broadcast, the rows
are compared with them where they are. If not, they are joined with the maxima, and AQE
can split that join on a hot key. Where keys come several times per split, each split
first keeps only its own latest rows: Spark runs that rank below the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import fits_broadcast, through_table


def max_per_key(df: DataFrame, key: str, order: str, name: str | None = None) -> DataFrame:
    """One row per key, the NULL key included, with the largest ``order``."""
    return df.groupBy(key).agg(F.max(order).alias(name or f"max_{order}"))


def latest_rows_by_join(df: DataFrame, key: str, order: str, columns: Sequence[str]) -> DataFrame:
    """All rows at the maximum of their key, ties and copies kept: the plain self-join."""
    return _at_peak(df, max_per_key(df, key, order, "_peak"), key, order, columns)


def latest_rows(
    df: DataFrame,
    key: str,
    order: str,
    columns: Sequence[str],
    max_broadcast_bytes: int | None = None,
) -> DataFrame:
    """The rows of ``latest_rows_by_join``, planned by the size of the maxima.

    The maxima are written out first, to be computed once and measured.
    ``max_broadcast_bytes`` defaults to Spark's own threshold.
    """
    known = df.where(F.col(key).isNotNull() & F.col(order).isNotNull())
    peak = through_table(max_per_key(known, key, order, "_peak"))
    if fits_broadcast(peak, max_broadcast_bytes):
        return _at_peak(known, F.broadcast(peak), key, order, columns)
    rows = _latest_of_split(known, key, order, columns) if _recur_in_splits(known, key) else known
    return _at_peak(rows, peak.hint("merge"), key, order, columns)


def _recur_in_splits(df: DataFrame, key: str, times: int = 4) -> bool:
    """Whether the splits hold their keys over ``times`` times on average."""
    pair = F.xxhash64(key, F.spark_partition_id())
    found = df.select(pair.alias("pair")).agg(
        F.approx_count_distinct("pair").alias("pairs"), F.count("pair").alias("rows")
    )
    pairs, rows = found.first()
    return rows > times * pairs


def _latest_of_split(df: DataFrame, key: str, order: str, columns: Sequence[str]) -> DataFrame:
    """Each input split's own latest rows per key, ties kept."""
    within = Window.partitionBy(key, "_split").orderBy(F.col(order).desc())
    return (
        df.select(*dict.fromkeys([key, order, *columns]))
        .withColumn("_split", F.spark_partition_id())
        .withColumn("_rank", F.rank().over(within))
        .where(F.col("_rank") == 1)
    )


def _at_peak(rows: DataFrame, peak: DataFrame, key: str, order: str, columns: Sequence[str]) -> DataFrame:
    peak = peak.withColumnRenamed(key, "_key")
    at_peak = (F.col(key) == F.col("_key")) & (F.col(order) == F.col("_peak"))
    return rows.join(peak, at_peak, "inner").select(key, *columns)


def latest_one(
    df: DataFrame, key: str, order: str, columns: Sequence[str], tie_breakers: Sequence[str] = ()
) -> DataFrame:
    """Exactly one row per key: the latest, then by ``tie_breakers`` and ``columns``, descending.

    Each split ships at most one row per key.
    """
    known = df.where(F.col(key).isNotNull() & F.col(order).isNotNull())
    total_order = dict.fromkeys([order, *tie_breakers, *columns])
    window = Window.partitionBy(key).orderBy(*[F.col(c).desc_nulls_last() for c in total_order])
    return (
        known.select(*dict.fromkeys([key, *total_order]))
        .withColumn("_position", F.row_number().over(window))
        .where(F.col("_position") == 1)
        .select(key, *columns)
    )
