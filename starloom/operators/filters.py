"""Row filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_where_not_equal(df: DataFrame, column: str, value: str) -> DataFrame:
    """What is left after deleting the rows where ``column != value``.

    A NULL is not unequal to anything, so rows with a NULL stay.
    """
    return df.where(F.col(column).isNull() | (F.col(column) == value))
