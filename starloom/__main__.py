"""python -m starloom reset|stage|insert|run --location DIR [--log DIR] [--songs DIR]"""

from __future__ import annotations

import argparse
import json
import sys

from .plans import Warehouse, insert_star, load_events, load_songs
from .session import build_session
from .sources import LOG_KEYS, SONG_KEYS


def mapping(path: str) -> dict[str, str]:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


def report(table: str, losses: dict[str, int]) -> None:
    for key, count in losses.items():
        if count:
            print(f"{table}: {count} values of {key} did not convert", file=sys.stderr)


def main() -> None:
    parser = argparse.ArgumentParser(prog="starloom", description=__doc__)
    parser.add_argument("step", choices=["reset", "stage", "insert", "run"])
    parser.add_argument("--location", required=True, help="folder of the tables")
    parser.add_argument("--log", nargs="+", help="prefixes of the activity log")
    parser.add_argument("--songs", nargs="+", help="prefixes of the song catalogue")
    parser.add_argument("--mode", choices=["append", "overwrite"], default="append")
    parser.add_argument("--distinct-keys", action="store_true")
    parser.add_argument("--dense-ids", action="store_true")
    parser.add_argument("--log-glob", help="names of log files")
    parser.add_argument("--song-glob", help="names of catalogue files")
    parser.add_argument("--one-per-line", action="store_true", help="no catalogue object goes over a line's end")
    parser.add_argument("--log-keys", type=mapping, default=LOG_KEYS, help="JSON file: key or path -> log column")
    parser.add_argument("--song-keys", type=mapping, default=SONG_KEYS, help="the same for the catalogue")
    parser.add_argument("--no-enforce", dest="enforce", action="store_false", help="load what breaks a rule, report lost values")
    parser.add_argument("--numeric-scale", type=int, default=0, help="digits kept of NUMERIC columns")
    parser.add_argument("--buckets", type=int, default=0, help="buckets of distributed tables")
    args = parser.parse_args()
    if args.step == "run" and not (args.log and args.songs):
        parser.error("run needs --log and --songs")
    if args.step == "stage" and not (args.log or args.songs):
        parser.error("stage needs --log or --songs")

    warehouse = Warehouse(
        build_session(), location=args.location, buckets=args.buckets, numeric_scale=args.numeric_scale
    )
    log = {"file_glob": args.log_glob, "keys": args.log_keys}
    songs = {"file_glob": args.song_glob, "keys": args.song_keys, "one_per_line": args.one_per_line}
    if args.step == "reset":
        warehouse.reset()
        return
    if args.step == "run" and args.mode == "overwrite":
        warehouse.reset()
    warehouse.create()
    if args.step != "insert":
        if args.log:
            report("staging_events", load_events(warehouse, args.log, args.enforce, **log))
        if args.songs:
            report("staging_songs", load_songs(warehouse, args.songs, args.enforce, **songs))
    if args.step != "stage":
        insert_star(warehouse, args.enforce, args.distinct_keys, args.dense_ids)


if __name__ == "__main__":
    main()
