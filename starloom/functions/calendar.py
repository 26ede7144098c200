"""Calendar fields of a timestamp."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_fields(ts: Column) -> list[Column]:
    """hour, day, week (ISO), month, year and weekday (Sunday = 0), all smallint."""
    fields = {
        "hour": F.hour(ts),
        "day": F.day(ts),
        "week": F.weekofyear(ts),
        "month": F.month(ts),
        "year": F.year(ts),
        # Spark counts Sunday as 1.
        "weekday": F.dayofweek(ts) - 1,
    }
    return [field.cast("smallint").alias(name) for name, field in fields.items()]
