"""The fact table, from the staging tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import left_match

# A play names its song by text only.
MATCH_ON = [("artist", "artist_name"), ("song", "title")]


def songplays(events: DataFrame, catalogue: DataFrame, **join_options) -> DataFrame:
    """Each event with the ids of every catalogue row of that artist and title.

    Without the generated id, which belongs to the write. ``join_options`` go to ``left_match``.
    """
    plays = events.select(
        F.col("ts").alias("start_time"),
        "user_id",
        "level",
        "session_id",
        "location",
        "user_agent",
        "artist",
        "song",
    )
    matched = left_match(plays, catalogue, MATCH_ON, ["song_id", "artist_id"], **join_options)
    return matched.select(
        "start_time",
        "user_id",
        "level",
        "song_id",
        "artist_id",
        "session_id",
        "location",
        "user_agent",
    )
