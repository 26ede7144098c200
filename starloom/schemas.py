"""The seven tables: columns, types and declared constraints."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Column:
    name: str
    type: T.DataType
    max_bytes: int | None = None
    required: bool = False


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Column, ...]
    primary_key: str | None = None
    # column -> (table, column)
    foreign_keys: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    distribute_by: str | None = None
    sort_by: str | None = None
    replicated: bool = False

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]


def _text(name: str, max_bytes: int = 255) -> Column:
    return Column(name, T.StringType(), max_bytes)


def _int(name: str, required: bool = False) -> Column:
    return Column(name, T.IntegerType(), required=required)


def _small(name: str) -> Column:
    return Column(name, T.ShortType())


# Longest text a VARCHAR(MAX) column takes, in bytes.
MAX_TEXT = 65535

STAGING_EVENTS = Table(
    "staging_events",
    (
        _text("artist"),
        _text("auth"),
        _text("first_name"),
        _text("gender", 1),
        _int("item_in_session"),
        _text("last_name"),
        Column("length", T.DecimalType(18, 5)),
        _text("level", 10),
        _text("location"),
        _text("method", 10),
        _text("page", 50),
        Column("registration", T.LongType()),
        _int("session_id"),
        _text("song"),
        _int("status"),
        # Declared as a bigint of milliseconds; converted once, on load.
        Column("ts", T.TimestampNTZType()),
        _text("user_agent"),
        _int("user_id"),
    ),
)

SONGPLAYS = Table(
    "songplays",
    (
        # 64 bits: Spark's generated ids carry the partition in the high bits.
        Column("songplay_id", T.LongType()),
        Column("start_time", T.TimestampNTZType(), required=True),
        _int("user_id", required=True),
        _text("level"),
        _text("song_id"),
        _text("artist_id"),
        _int("session_id"),
        _text("location"),
        _text("user_agent"),
    ),
    primary_key="songplay_id",
    foreign_keys={
        "start_time": ("time", "start_time"),
        "user_id": ("users", "user_id"),
        "song_id": ("songs", "song_id"),
        "artist_id": ("artists", "artist_id"),
    },
    distribute_by="song_id",
)

USERS = Table(
    "users",
    (
        _int("user_id"),
        _text("first_name"),
        _text("last_name"),
        _text("gender"),
        _text("level"),
    ),
    primary_key="user_id",
    replicated=True,
)

TIME = Table(
    "time",
    (
        Column("start_time", T.TimestampNTZType()),
        _small("hour"),
        _small("day"),
        _small("week"),
        _small("month"),
        _small("year"),
        _small("weekday"),
    ),
    primary_key="start_time",
    sort_by="start_time",
    replicated=True,
)


def staging_songs(numeric_scale: int = 0) -> Table:
    """``numeric_scale`` 0 is the declared NUMERIC without a precision: no fraction."""
    numeric = T.DecimalType(18, numeric_scale)
    return Table(
        "staging_songs",
        (
            _int("num_songs"),
            _text("artist_id"),
            Column("artist_latitude", numeric),
            Column("artist_longitude", numeric),
            _text("artist_location"),
            _text("artist_name", MAX_TEXT),
            _text("song_id"),
            _text("title", MAX_TEXT),
            Column("duration", numeric),
            _int("year"),
        ),
    )


def songs(numeric_scale: int = 0) -> Table:
    return Table(
        "songs",
        (
            _text("song_id"),
            _text("title"),
            _text("artist_id"),
            _int("year"),
            Column("duration", T.DecimalType(18, numeric_scale)),
        ),
        primary_key="song_id",
        distribute_by="artist_id",
    )


def artists(numeric_scale: int = 0) -> Table:
    numeric = T.DecimalType(18, numeric_scale)
    return Table(
        "artists",
        (
            _text("artist_id"),
            _text("name"),
            _text("location"),
            Column("latitude", numeric),
            Column("longitude", numeric),
        ),
        primary_key="artist_id",
        replicated=True,
    )


def staging_tables(numeric_scale: int = 0) -> list[Table]:
    return [STAGING_EVENTS, staging_songs(numeric_scale)]


def star_tables(numeric_scale: int = 0) -> list[Table]:
    """Dimensions before the fact that refers to them."""
    return [USERS, songs(numeric_scale), artists(numeric_scale), TIME, SONGPLAYS]
