from .json_files import LOG_KEYS, SONG_KEYS, conversions, read_log, read_songs, typed_log, typed_songs

__all__ = ["LOG_KEYS", "SONG_KEYS", "conversions", "read_log", "read_songs", "typed_log", "typed_songs"]
