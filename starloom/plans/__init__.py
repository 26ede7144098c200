from .dimensions import artists, songs, time, time_distinct, users, users_distinct
from .facts import songplays
from .load import insert_star, load_events, load_songs, load_staging, run
from .warehouse import Warehouse

__all__ = [
    "Warehouse",
    "artists",
    "insert_star",
    "load_events",
    "load_songs",
    "load_staging",
    "run",
    "songplays",
    "songs",
    "time",
    "time_distinct",
    "users",
    "users_distinct",
]
