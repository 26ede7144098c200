"""The load, end to end: JSON -> staging tables -> star."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from ..operators import audit, drop_where_not_equal, next_id, with_dense_id
from ..schemas import Table
from ..sources import LOG_KEYS, SONG_KEYS, conversions, read_log, read_songs, typed_log, typed_songs
from . import dimensions
from .facts import songplays
from .warehouse import Warehouse

KEPT_PAGE = "NextSong"


def staged_events(
    raw: DataFrame, keys: Mapping[str, str] = LOG_KEYS, strict: bool = False
) -> DataFrame:
    """Typed log records without those of other pages.

    ``read_log`` with ``page`` leaves them out earlier, before their other fields are parsed.
    """
    return drop_where_not_equal(typed_log(raw, keys, strict), "page", KEPT_PAGE)


def _losses(raw: DataFrame, keys: Mapping[str, str], table: Table, enforce: bool) -> dict[str, int]:
    """How many values of each key do not convert: none where that stops the load, else counted."""
    if enforce:
        return dict.fromkeys(keys, 0)
    return raw.agg(*audit.loss_counts(conversions(keys, table))).first().asDict()


def load_events(
    warehouse: Warehouse,
    paths: str | Sequence[str],
    enforce: bool = True,
    file_glob: str | None = None,
    keys: Mapping[str, str] = LOG_KEYS,
) -> dict[str, int]:
    """Append log files to staging; how many values of each key did not convert and became NULL.

    Records of other pages are left out before the write, so no reader ever sees them.
    ``enforce`` stops at the first value of a kept record that does not convert; without it the
    sources are read once more to count.
    """
    kept = read_log(warehouse.spark, paths, file_glob, keys, page=KEPT_PAGE)
    warehouse.append("staging_events", typed_log(kept, keys, enforce), enforce)
    raw = read_log(warehouse.spark, paths, file_glob, keys)
    return _losses(raw, keys, warehouse.spec("staging_events"), enforce)


def load_songs(
    warehouse: Warehouse,
    paths: str | Sequence[str],
    enforce: bool = True,
    one_per_line: bool = False,
    file_glob: str | None = None,
    keys: Mapping[str, str] = SONG_KEYS,
) -> dict[str, int]:
    """Append catalogue files to staging, as ``load_events`` does with logs.

    Many tiny files come in, some of a good size go out.
    """
    raw = read_songs(warehouse.spark, paths, file_glob, one_per_line, keys)
    catalogue = typed_songs(raw, warehouse.numeric_scale, keys, enforce)
    warehouse.append("staging_songs", catalogue.hint("rebalance"), enforce)
    return _losses(raw, keys, warehouse.spec("staging_songs"), enforce)


def load_staging(
    warehouse: Warehouse,
    log_paths: str | Sequence[str],
    song_paths: str | Sequence[str],
    enforce: bool = True,
    *,
    log_glob: str | None = None,
    song_glob: str | None = None,
    one_per_line: bool = False,
    log_keys: Mapping[str, str] = LOG_KEYS,
    song_keys: Mapping[str, str] = SONG_KEYS,
) -> dict[str, dict[str, int]]:
    """Append both sources to their staging tables; the losses of each table."""
    return {
        "staging_events": load_events(warehouse, log_paths, enforce, log_glob, log_keys),
        "staging_songs": load_songs(warehouse, song_paths, enforce, one_per_line, song_glob, song_keys),
    }


def insert_star(
    warehouse: Warehouse, enforce: bool = True, distinct_keys: bool = False, dense_ids: bool = False
) -> None:
    """Append dimensions and fact from all of staging; a repeated run repeats its rows.

    ``distinct_keys`` keeps one row per user and per start time.
    """
    events, catalogue = warehouse.read("staging_events"), warehouse.read("staging_songs")
    users = dimensions.users_distinct if distinct_keys else dimensions.users
    time = dimensions.time_distinct if distinct_keys else dimensions.time
    # The few latest rows are still spread over as many tasks as the events.
    warehouse.append("users", users(events).hint("rebalance"), enforce)
    warehouse.append("songs", dimensions.songs(catalogue), enforce)
    warehouse.append("artists", dimensions.artists(catalogue), enforce)
    warehouse.append("time", time(events), enforce)
    plays = songplays(events, catalogue)
    start = next_id(warehouse.read("songplays"), "songplay_id")
    if dense_ids:
        warehouse.append("songplays", with_dense_id(plays, "songplay_id", start), enforce)
    else:
        warehouse.append("songplays", plays, enforce, number=("songplay_id", start))


def run(
    warehouse: Warehouse,
    log_paths: str | Sequence[str],
    song_paths: str | Sequence[str],
    mode: str = "append",
    enforce: bool = True,
    distinct_keys: bool = False,
    dense_ids: bool = False,
    **source_options,
) -> dict[str, dict[str, int]]:
    """Load and transform. ``mode`` "overwrite" empties the warehouse first.

    ``source_options`` go to ``load_staging``, whose losses are returned.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode must be append or overwrite, not {mode!r}")
    if mode == "overwrite":
        warehouse.reset()
    else:
        warehouse.create()
    losses = load_staging(warehouse, log_paths, song_paths, enforce, **source_options)
    insert_star(warehouse, enforce, distinct_keys, dense_ids)
    return losses
