"""Checks for the declared constraints, which a Parquet table does not enforce."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import Table
from ..session import broadcast_limit, fits_broadcast, through_table


#: Keys that a bitmap (of 4 kB, for 32768 keys in a row) must hold on average to be smaller than they are.
_DENSE = 1 << 9
_BITMAP_BYTES = 1 << 12
_WHOLE = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their ``copies``.

    Generated ids lie close together. Where they are found to, each range of them is first
    marked in a bitmap, and only ids of ranges that hold more rows than marks are shuffled.
    """
    whole = len(keys) == 1 and df.schema[keys[0]].dataType in (T.IntegerType(), T.LongType())
    suspects = _dense_ranges_with_copies(df, keys[0]) if whole else None
    if suspects is not None:
        suspects = F.broadcast(suspects) if fits_broadcast(suspects) else suspects
        # NULL is in no range, but may occur more than once as well.
        found = df.select(*keys, F.bitmap_bucket_number(F.col(keys[0])).alias("_range"))
        nulls = found.where(F.col(keys[0]).isNull()).select(*keys)
        df = found.join(suspects, "_range", "left_semi").select(*keys).unionAll(nulls)
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)
    )


def _dense_ranges_with_copies(df: DataFrame, key: str) -> DataFrame | None:
    """(_range) of keys among which some occur more than once; None if keys lie too far apart for bitmaps."""
    ranges = df.select(key, F.bitmap_bucket_number(F.col(key)).alias("_range")).where(F.col(key).isNotNull())
    seen = ranges.agg(F.count(F.lit(1)).alias("rows"), F.approx_count_distinct("_range").alias("ranges")).first()
    if seen["rows"] < _DENSE * seen["ranges"]:
        return None
    marks = F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(key))))
    counted = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("rows"), marks.alias("marks"))
    return counted.where("rows > marks").select("_range")


def orphans(fact: DataFrame, foreign_key: str, dimension: DataFrame, primary_key: str) -> DataFrame:
    """Foreign key values without a dimension row, with the number of fact ``rows``.

    Known values are dropped where the fact is read, by a copy of the dimension's values or, of too
    many whole numbers, of their bitmaps; only orphans are shuffled then. If both are measured to be too large,
    both sides come down to one row per value before the join, so no value is hot in it. (A Bloom
    filter is no help there: it can only prove that a value is unknown, and few are.) NULL refers
    to nothing and is no orphan.
    """
    used = fact.select(foreign_key).where(F.col(foreign_key).isNotNull())
    known = dimension.select(F.col(primary_key).alias("_known")).where("_known IS NOT NULL").distinct()
    is_known = F.col(foreign_key) == F.col("_known")
    counted = F.count(F.lit(1)).alias("rows")
    if fits_broadcast(known):
        return used.join(F.broadcast(known), is_known, "left_anti").groupBy(foreign_key).agg(counted)
    marks = None
    if used.schema[foreign_key].dataType in _WHOLE and known.schema["_known"].dataType in _WHOLE:
        marks = _marks(known, "_known")
    if marks is not None:
        return _unmarked(used, foreign_key, marks).groupBy(foreign_key).agg(counted)
    return used.groupBy(foreign_key).agg(counted).join(known, is_known, "left_anti")


def _marks(keys: DataFrame, key: str) -> DataFrame | None:
    """(_range, _marks): a bit for every key; None if that is too large to be copied."""
    ranges = keys.select(F.col(key).cast("long").alias("_key"))
    ranges = ranges.withColumn("_range", F.bitmap_bucket_number("_key"))
    many = ranges.agg(F.approx_count_distinct("_range")).first()[0]
    if many * _BITMAP_BYTES > broadcast_limit(keys.sparkSession):
        return None
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("_key")).alias("_marks")
    marks = through_table(ranges.groupBy("_range").agg(bits))
    return marks if fits_broadcast(marks) else None


def _unmarked(rows: DataFrame, key: str, marks: DataFrame) -> DataFrame:
    """Rows whose key has no bit in ``marks``, which is copied."""
    value = F.col(key).cast("long")
    place = F.bitmap_bit_position(value)
    byte = F.conv(F.hex(F.substring("_marks", (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = F.getbit(byte, (place % 8).cast("int")) == 1
    met = rows.join(F.broadcast(marks), F.bitmap_bucket_number(value) == F.col("_range"), "left")
    return met.where(F.col("_range").isNull() | ~marked).select(key)


def missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a NULL in any of the columns."""
    return df.where(reduce(or_, [F.col(c).isNull() for c in columns]))


def too_long(df: DataFrame, max_bytes: Mapping[str, int]) -> DataFrame:
    """Rows with a text over its limit in bytes (not characters)."""
    return df.where(reduce(or_, [F.octet_length(c) > n for c, n in max_bytes.items()]))


def loss_counts(rules: Mapping[str, Column]) -> list[Column]:
    """For each raw column the count of values that are not empty and have no typed value."""
    counts = []
    for name, typed in rules.items():
        given = F.col(f"`{name}`").cast("string")
        lost = given.isNotNull() & (F.trim(given) != "") & typed.isNull()
        counts.append(F.count_if(lost).alias(name))
    return counts


def coercion_losses(raw: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Per typed column, how many non-empty raw values came out as NULL.

    ``rules`` maps the raw column to its conversion. One pass, no shuffle of rows.
    """
    counts = raw.agg(*loss_counts(rules))
    return counts.unpivot([], list(rules), "field", "lost")


def enforced(df: DataFrame, table: Table) -> DataFrame:
    """Stop the job at the first NULL in a required column or text over its limit."""

    def checked(column) -> Column:
        value = F.col(column.name)
        if column.required:
            message = F.lit(f"{table.name}.{column.name} must not be null")
            return F.when(value.isNull(), F.raise_error(message)).otherwise(value)
        if column.max_bytes:
            message = F.lit(f"{table.name}.{column.name} is over {column.max_bytes} bytes")
            too_big = F.octet_length(value) > column.max_bytes
            return F.when(too_big, F.raise_error(message)).otherwise(value)
        return value

    present = {c.name: c for c in table.columns}
    return df.select(*[checked(present[name]).alias(name) for name in df.columns])


def violations(tables: Mapping[str, DataFrame], specs: Sequence[Table]) -> DataFrame:
    """(table, rule, column, violations) over every declared constraint of ``specs``.

    ``tables`` maps the names in ``specs`` to their data. Duplicate keys and orphans
    are counted by key value, NULLs and long texts by row.
    """

    def counted(bad: DataFrame, table: str, rule: str, column: str) -> DataFrame:
        return bad.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(table).alias("table"),
            F.lit(rule).alias("rule"),
            F.lit(column).alias("column"),
            "violations",
        )

    reports = []
    for spec in specs:
        data = tables[spec.name]
        if spec.primary_key:
            repeated = duplicate_keys(data, [spec.primary_key])
            reports.append(counted(repeated, spec.name, "primary key", spec.primary_key))
        for column, (other, key) in spec.foreign_keys.items():
            unknown = orphans(data, column, tables[other], key)
            reports.append(counted(unknown, spec.name, "foreign key", column))
        # The row checks of a table share one scan.
        rules = [(c.name, "not null", F.col(c.name).isNull()) for c in spec.columns if c.required]
        rules += [
            (c.name, "length", F.octet_length(c.name) > c.max_bytes) for c in spec.columns if c.max_bytes
        ]
        if rules:
            totals = data.agg(*[F.count_if(bad).alias(f"{i}") for i, (_, _, bad) in enumerate(rules)])
            entries = [
                F.struct(
                    F.lit(spec.name).alias("table"),
                    F.lit(rule).alias("rule"),
                    F.lit(column).alias("column"),
                    F.col(f"`{i}`").alias("violations"),
                )
                for i, (column, rule, _) in enumerate(rules)
            ]
            reports.append(totals.select(F.inline(F.array(*entries))))
    return reduce(DataFrame.unionAll, reports)
