"""The four dimensions, from the staging tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar_fields
from ..operators import latest_one, latest_rows

USER_FIELDS = ["first_name", "last_name", "gender", "level"]


def users(events: DataFrame, max_broadcast_bytes: int | None = None) -> DataFrame:
    """Attributes of each user at the user's last event; tied events all count."""
    return latest_rows(events, "user_id", "ts", USER_FIELDS, max_broadcast_bytes)


def users_distinct(events: DataFrame) -> DataFrame:
    """``users`` with one row per user: the last event within session and item order."""
    return latest_one(events, "user_id", "ts", USER_FIELDS, ["session_id", "item_in_session"])


def songs(catalogue: DataFrame) -> DataFrame:
    """Distinct song rows. One song_id has several if its other fields differ."""
    return catalogue.select("song_id", "title", "artist_id", "year", "duration").distinct()


def artists(catalogue: DataFrame) -> DataFrame:
    """Distinct artist rows. One artist_id has several if its other fields differ."""
    return catalogue.select(
        "artist_id",
        F.col("artist_name").alias("name"),
        F.col("artist_location").alias("location"),
        F.col("artist_latitude").alias("latitude"),
        F.col("artist_longitude").alias("longitude"),
    ).distinct()


def time(events: DataFrame) -> DataFrame:
    """Calendar fields of every event, repeated times included."""
    return events.select(F.col("ts").alias("start_time"), *calendar_fields(F.col("ts")))


def time_distinct(events: DataFrame) -> DataFrame:
    """``time`` with one row per start time; only the time itself is shuffled."""
    return time(events.select("ts").distinct())
