"""Physical layout: bucketed by key, replicated, clustered by key range."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import fits_broadcast, settled


def to_buckets(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """Gather rows by bucket before a bucketed write, for few and large files.

    Adaptive execution cuts a bucket above its advisory partition size over several tasks,
    so a hot key is not written by one. Spark's bucket number is the hash of the keys
    modulo the number of buckets.
    """
    numbered = df.withColumn("_bucket", F.pmod(F.hash(*keys), F.lit(buckets)))
    return numbered.hint("rebalance", buckets, F.col("_bucket")).drop("_bucket")


def write_distributed(
    df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str
) -> DataFrame:
    """Save ``df`` as a table bucketed by ``keys``; equally bucketed tables join in place."""
    (
        to_buckets(df, keys, buckets)
        .write.bucketBy(buckets, *keys)
        .option("path", path)
        .format("parquet")
        .saveAsTable(table)
    )
    return df.sparkSession.table(table)


def replicated(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Mark a small table for a copy on every executor; left alone above the size limit."""
    return F.broadcast(df) if fits_broadcast(df, max_bytes) else df


def sorted_within(df: DataFrame, key: str) -> DataFrame:
    """Sort each partition, so that Parquet row groups get narrow key ranges. No shuffle."""
    return df.sortWithinPartitions(key)


def range_clustered(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Give each output file its own key range, sorted.

    A row number as second sort column lets a hot key value span several files.
    """
    numbered = settled(df).withColumn("_row", F.monotonically_increasing_id())
    by = [F.col(key), F.col("_row")]
    ranged = numbered.repartitionByRange(partitions, *by) if partitions else numbered.repartitionByRange(*by)
    return ranged.sortWithinPartitions(key).drop("_row")
