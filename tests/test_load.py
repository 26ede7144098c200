"""The whole load on the micro fixture, with its edge cases worked out by hand."""

import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom.operators import audit
from starloom.plans import Warehouse, insert_star, load_staging, run
from starloom.sources import read_log, read_songs, typed_log, typed_songs


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def loaded(spark, log_dir, song_dir, tmp_path_factory):
    target = Warehouse(
        spark, "staging_mod", "star_mod", location=str(tmp_path_factory.mktemp("tables"))
    )
    run(target, log_dir, song_dir, mode="overwrite")
    return target


def test_staging_events(loaded):
    staged = loaded.read("staging_events")
    assert rows(staged.select("item_in_session")) == [(i,) for i in (0, 1, 2, 3, 4, 7, 8)]
    constant = staged.select("registration", "length", "session_id", "status", "first_name").distinct()
    assert rows(constant) == [(1600000123456, Decimal("301.20467"), 512, 200, "Ida")]
    times = {r.item_in_session: r.ts for r in staged.collect()}
    assert times[0] == datetime(2018, 11, 3, 23, 59, 59, 999000)
    assert times[8] == datetime(2018, 12, 31)


def test_staging_songs(loaded):
    staged = loaded.read("staging_songs")
    assert rows(staged.select("song_id", "duration", "artist_latitude", "artist_longitude")) == sorted(
        [
            ("S1", Decimal(187), Decimal(51), Decimal(-3)),
            ("S2", Decimal(100), Decimal(51), Decimal(-3)),
            ("S3", Decimal(60), None, None),
            ("S3", Decimal(60), None, None),
            ("S4", Decimal(61), None, None),
        ],
        key=repr,
    )


def test_users_keep_ties(loaded):
    assert rows(loaded.read("users").select("user_id", "level")) == [
        (39, "paid"),
        (40, "free"),
        (40, "paid"),
        (41, "free"),
    ]


def test_songs_and_artists(loaded):
    assert rows(loaded.read("songs").select("song_id")) == [("S1",), ("S2",), ("S3",), ("S4",)]
    assert rows(loaded.read("artists").select("artist_id", "location")) == [
        ("A1", "QX"),
        ("A1", "QX, ZZ"),
        ("A2", ""),
    ]


def test_time(loaded):
    time = loaded.read("time")
    assert [f.dataType.simpleString() for f in time.schema] == ["timestamp_ntz"] + ["smallint"] * 6
    assert rows(time.drop("start_time")) == sorted(
        [(23, 3, 44, 11, 2018, 6)] + [(0, 4, 44, 11, 2018, 0)] * 5 + [(0, 31, 1, 12, 2018, 1)],
        key=repr,
    )
    assert time.select("start_time").distinct().count() == 5


def test_songplays(loaded):
    plays = loaded.read("songplays")
    got = plays.groupBy("start_time", "user_id", "song_id", "artist_id").count()
    assert rows(got.drop("start_time")) == sorted(
        [
            (39, "S1", "A1", 1),
            (39, "S3", "A2", 2),
            (39, "S4", "A2", 1),
            (39, "S2", "A1", 1),
            (40, None, None, 1),
            (40, None, None, 2),
            (41, None, None, 1),
        ],
        key=repr,
    )
    assert plays.select("songplay_id").distinct().count() == 9


def test_distinct_variants(warehouse, log_dir, song_dir):
    run(warehouse, log_dir, song_dir, distinct_keys=True, dense_ids=True)
    # User 40's tied events are settled by item: 4 comes after 3.
    assert rows(warehouse.read("users").select("user_id", "level")) == [
        (39, "paid"),
        (40, "free"),
        (41, "free"),
    ]
    assert warehouse.read("time").count() == 5
    ids = rows(warehouse.read("songplays").select("songplay_id"))
    assert ids == [(i,) for i in range(9)]


def test_append_repeats_and_overwrite_resets(warehouse, log_dir, song_dir):
    run(warehouse, log_dir, song_dir)
    insert_star(warehouse)
    assert warehouse.read("songplays").count() == 18
    assert warehouse.read("songplays").select("songplay_id").distinct().count() == 18
    assert warehouse.read("time").count() == 14
    load_staging(warehouse, log_dir, song_dir)
    assert warehouse.read("staging_events").count() == 14
    run(warehouse, log_dir, song_dir, mode="overwrite")
    assert warehouse.read("songplays").count() == 9
    assert warehouse.read("staging_songs").count() == 5


def test_dense_ids_go_on_from_the_last(warehouse, log_dir, song_dir):
    run(warehouse, log_dir, song_dir, dense_ids=True)
    insert_star(warehouse, dense_ids=True)
    ids = rows(warehouse.read("songplays").select("songplay_id"))
    assert sorted(i for (i,) in ids) == list(range(18))


def test_tables_are_found_again(spark, warehouse, log_dir, song_dir):
    run(warehouse, log_dir, song_dir)
    # What a new session with an empty catalog sees: the files, but no tables.
    for tables in warehouse.schemas.values():
        for table in tables:
            spark.sql(f"DROP TABLE {warehouse.qualified(table.name)}")
    warehouse.create()
    assert warehouse.read("songplays").count() == 9
    warehouse.create()
    assert warehouse.read("songplays").count() == 9


def test_reset_of_managed_tables(spark, log_dir, song_dir):
    managed = Warehouse(spark, "staging_managed", "star_managed")
    run(managed, log_dir, song_dir, mode="overwrite")
    run(managed, log_dir, song_dir, mode="overwrite")
    assert managed.read("songplays").count() == 9
    managed.reset()
    assert managed.read("songplays").count() == 0


def test_bucketed_warehouse(spark, log_dir, song_dir, tmp_path):
    bucketed = Warehouse(spark, "staging_b", "star_b", location=str(tmp_path), buckets=4)
    run(bucketed, log_dir, song_dir, mode="overwrite")
    assert bucketed.read("songplays").count() == 9
    described = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED star_b.songplays").collect()}
    assert described["Num Buckets"] == "4"
    assert described["Bucket Columns"] == "[`song_id`]"


def test_numeric_scale(spark, log_dir, song_dir, tmp_path):
    fine = Warehouse(spark, "staging_f", "star_f", location=str(tmp_path), numeric_scale=5)
    run(fine, log_dir, song_dir, mode="overwrite")
    assert rows(fine.read("songs").where("song_id = 'S1'").select("duration")) == [
        (Decimal("187.40586"),)
    ]
    assert rows(fine.read("artists").where("location = 'QX'").select("longitude")) == [
        (Decimal("-3.94000"),)
    ]


def test_violations(loaded):
    found = {(r["table"], r["rule"], r["column"]): r["violations"] for r in loaded.violations().collect()}
    assert found["users", "primary key", "user_id"] == 1
    assert found["artists", "primary key", "artist_id"] == 1
    assert found["time", "primary key", "start_time"] == 2
    assert found["songs", "primary key", "song_id"] == 0
    assert found["songplays", "primary key", "songplay_id"] == 0
    assert found["songplays", "foreign key", "song_id"] == 0
    assert found["songplays", "not null", "user_id"] == 0
    assert found["songs", "length", "title"] == 0


def test_null_user_stops_the_insert(spark, warehouse, song_dir, tmp_path):
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "a.json").write_text('{"page": "NextSong", "ts": 1541289600000, "userId": ""}\n')
    load_args = (warehouse, str(tmp_path / "log"), song_dir)
    with pytest.raises(Exception, match="songplays.user_id must not be null"):
        run(*load_args)
    assert warehouse.read("songplays").count() == 0
    run(*load_args, mode="overwrite", enforce=False)
    assert warehouse.read("songplays").count() == 1
    found = {(r["rule"], r["column"]): r["violations"] for r in warehouse.violations().collect()}
    assert found["not null", "user_id"] == 1


def test_long_title_stops_the_insert(spark, warehouse, log_dir, tmp_path):
    (tmp_path / "songs").mkdir()
    # 128 two-byte letters fit 255 characters, not 255 bytes.
    (tmp_path / "songs" / "a.json").write_text('{"song_id": "S", "title": "%s"}' % ("é" * 128))
    with pytest.raises(Exception, match="songs.title is over 255 bytes"):
        run(warehouse, log_dir, str(tmp_path / "songs"))
    assert warehouse.read("staging_songs").count() == 1
    assert warehouse.read("songs").count() == 0


def test_broken_json_stops_the_load(spark, warehouse, song_dir, tmp_path):
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "a.json").write_text('{"page": "NextSong", "ts"\n')
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILFAST|malformed"):
        run(warehouse, str(tmp_path / "log"), song_dir)


def test_broken_catalogue_stops_the_load(spark, warehouse, log_dir, tmp_path):
    (tmp_path / "songs").mkdir()
    (tmp_path / "songs" / "a.json").write_text('{"song_id": "S1", "title"')
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILFAST|malformed"):
        run(warehouse, log_dir, str(tmp_path / "songs"))
    assert warehouse.read("staging_songs").count() == 0


def test_reading_takes_globs_lists_and_arrays(spark, log_dir, tmp_path):
    assert read_log(spark, f"{log_dir}/2018/12").count() == 1
    assert read_log(spark, [f"{log_dir}/2018/11", f"{log_dir}/2018/12"]).count() == 9
    assert read_log(spark, log_dir, file_glob="2018-12-*").count() == 1
    (tmp_path / "a.json").write_text('[\n{"song_id": "S1"},\n{"song_id": "S2",\n "year": "7"}\n]')
    two = sorted([("S1", None), ("S2", 7)], key=repr)
    assert rows(typed_songs(read_songs(spark, str(tmp_path))).select("song_id", "year")) == two
    (tmp_path / "b.jsonl").write_text('{"song_id": "S1"}\n\n{"song_id": "S2", "year": 7}\n')
    lines = read_songs(spark, str(tmp_path), file_glob="*.jsonl", one_per_line=True)
    assert rows(typed_songs(lines).select("song_id", "year")) == two


def test_coercions(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '{"userId": "", "registration": "9223372036854775807", "length": "-1.9999999", "ts": -1}\n'
        '{"userId": "x7", "registration": 1.5e3, "length": 1.9999999, "ts": 253402300799999}\n'
        '{"userId": 39, "registration": null, "length": "", "ts": "1530203040506"}\n'
        '{"userId": "2147483648", "registration": "1e30", "length": 1e14, "ts": null}\n'
    )
    raw = read_log(spark, str(tmp_path))
    typed = typed_log(raw)
    assert [r.user_id for r in typed.collect()] == [None, None, 39, None]
    assert [r.registration for r in typed.collect()] == [9223372036854775807, 1500, None, None]
    assert [r.length for r in typed.collect()] == [Decimal("-1.99999"), Decimal("1.99999"), None, None]
    assert [r.ts for r in typed.collect()] == [
        datetime(1969, 12, 31, 23, 59, 59, 999000),
        datetime(9999, 12, 31, 23, 59, 59, 999000),
        datetime(2018, 6, 28, 16, 24, 0, 506000),
        None,
    ]
    from starloom.functions import bigint, integer, truncated_decimal

    losses = audit.coercion_losses(
        raw,
        {
            "userId": integer(F.col("userId")),
            "registration": bigint(F.col("registration")),
            "length": truncated_decimal(F.col("length"), 18, 5),
        },
    )
    assert rows(losses) == [("length", 1), ("registration", 1), ("userId", 2)]


def test_time_zone_of_the_session_does_not_matter(spark, log_dir):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        first = typed_log(read_log(spark, log_dir)).where("item_in_session = 0").first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert first.ts == datetime(2018, 11, 3, 23, 59, 59, 999000)


def test_every_object_is_loaded(spark, tmp_path):
    (tmp_path / "songs").mkdir()
    (tmp_path / "songs" / "a.json").write_text('{"song_id": "S1",\n "title": "a } \\" { b"}\n\n{"song_id": "S2"}\n[{"song_id": "S3"},\n{"song_id": "S4"}]\n')
    (tmp_path / "songs" / "b.json").write_text('{"song_id": "S5", "more": {"x": {"y": [1, {"z": "}"}]}}},{"song_id": "S6"}')
    (tmp_path / "songs" / "c.json").write_text(" \n")
    got = rows(typed_songs(read_songs(spark, str(tmp_path / "songs"))).select("song_id", "title"))
    assert got == sorted([(f"S{n}", 'a } " { b' if n == 1 else None) for n in range(1, 7)], key=repr)
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "a.json").write_text('{"ts": 1} {"ts": 2}\n[{"ts": 3},{"ts": 4}]\n\n{"ts": 5}\n')
    assert sorted(r.ts for r in read_log(spark, str(tmp_path / "log")).collect()) == ["1", "2", "3", "4", "5"]


@pytest.mark.parametrize("rest", ['{"page": "Home", "ts": ', "]", "x", "null", '"a"', '{"a": 1', "[[]]"])
def test_anything_beside_the_objects_stops_the_load(spark, tmp_path, rest):
    (tmp_path / "a.json").write_text(f'{{"page": "Home", "song_id": "S"}} {rest}\n')
    for raw in (read_log(spark, str(tmp_path)), read_songs(spark, str(tmp_path)), read_songs(spark, str(tmp_path), one_per_line=True)):
        with pytest.raises(Exception, match="MALFORMED_RECORD|FAILFAST|malformed"):
            raw.collect()


def test_keys_may_be_paths(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"user": {"id": "7", "name": {"first": "Io"}}, "t": 0, "kind": "NextSong"}\n')
    keys = {"user.id": "user_id", "user.name.first": "first_name", "t": "ts", "kind": "page"}
    typed = typed_log(read_log(spark, str(tmp_path), keys=keys), keys, strict=True)
    assert rows(typed) == [(7, "Io", datetime(1970, 1, 1), "NextSong")]


@pytest.mark.parametrize("field", ['"sessionId": "x7"', '"itemInSession": "9999999999"', '"length": 1e20', '"ts": "9223372036854775807"', '"status": 200.5'])
def test_a_value_that_does_not_convert_stops_the_load(spark, warehouse, song_dir, tmp_path, field):
    (tmp_path / "log").mkdir()
    fields = {"page": '"NextSong"', "ts": "5", "userId": '"1"'}
    key, value = field.split(": ", 1)
    fields[key.strip('"')] = value
    text = ", ".join(f'"{k}": {v}' for k, v in fields.items())
    (tmp_path / "log" / "a.json").write_text(f"{{{text}}}\n")
    warehouse.create()
    with pytest.raises(Exception, match="cannot hold"):
        load_staging(warehouse, str(tmp_path / "log"), song_dir)
    assert warehouse.read("staging_events").count() == 0
    losses = load_staging(warehouse, str(tmp_path / "log"), song_dir, enforce=False)
    assert {k for k, n in losses["staging_events"].items() if n} == {key.strip('"')}
    assert not any(losses["staging_songs"].values())


def test_tables_of_another_shape_are_refused(spark, warehouse, log_dir, song_dir):
    from dataclasses import replace

    run(warehouse, log_dir, song_dir)
    others = replace(warehouse, numeric_scale=5), replace(warehouse, buckets=4)
    for other in others:
        with pytest.raises(ValueError, match="not"):
            other.create()
    for tables in warehouse.schemas.values():
        for table in tables:
            spark.sql(f"DROP TABLE {warehouse.qualified(table.name)}")
    for other in others:
        with pytest.raises(ValueError, match="files of"):
            other.create()
    warehouse.create()
    assert warehouse.read("songplays").count() == 9


def test_an_apostrophe_in_the_location(spark, warehouse, log_dir, song_dir, tmp_path):
    from dataclasses import replace

    other = replace(warehouse, location=str(tmp_path / "it's here"))
    run(other, log_dir, song_dir)
    assert other.read("songplays").count() == 9


def nested(depth):
    return '{"a":' * depth + '"}{\\" {"' + "}" * depth


def test_records_of_any_depth(spark, tmp_path):
    deep = [f'{{"song_id": "S{d}", "title": {nested(d)}, "year": {d}}}' for d in (1, 2, 5, 7, 40, 300)]
    (tmp_path / "a.json").write_text("[" + ",\n".join(deep) + "]")
    (tmp_path / "b.json").write_text("".join(deep[:4]))
    got = rows(typed_songs(read_songs(spark, str(tmp_path)), strict=True).select("song_id", "year"))
    want = [(f"S{d}", d) for d in (1, 2, 5, 7, 40, 300)]
    assert got == sorted(want + want[:4])
    log = tmp_path / "log"
    log.mkdir()
    (log / "one.json").write_text("\n".join(f'{{"page": "NextSong", "ts": {d}, "x": {nested(d)}}} {{"ts": "0"}}' for d in (1, 9, 40)))
    assert sorted(r.ts for r in read_log(spark, str(log)).collect()) == ["0", "0", "0", "1", "40", "9"]
    (log / "two.json").write_text('{"ts": ' + nested(9)[:-1] + "}")
    with pytest.raises(Exception, match="MALFORMED"):
        read_log(spark, str(log)).collect()


def test_large_files_over_many_lines_are_read_by_several_tasks(spark, tmp_path):
    catalogue = tmp_path / "songs"
    catalogue.mkdir()
    record = lambda k: {"song_id": f"S{k}", "title": '}{ "q" \\ [' + "x" * (k % 90), "year": k, "more": {"a": [{"b": {}}, k]}}
    several = [json.dumps(record(k), indent=k % 4) for k in range(3000)]
    (catalogue / "array.json").write_text("[\n" + ",\n".join(several) + "\n]\n")
    (catalogue / "stream.json").write_text("\n".join(several[:500]) + " ".join(several[500:1000]))
    (catalogue / "small.json").write_text(several[7])
    (catalogue / "empty.json").write_text("[\n\n]" + " " * 30_000)
    split, usual = "16k", spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        raw = read_songs(spark, str(catalogue))
        got = rows(typed_songs(raw, strict=True).select("song_id", "title", "year"))
        assert got == sorted([(f"S{k}", record(k)["title"], k) for k in [*range(3000), *range(1000), 7]])
        assert read_songs(spark, f"{catalogue}/array.json").count() == 3000
        for n, wrong in enumerate(["[\n" + ",\n".join(several), ",\n".join(several) + "\n}", "x\n" + "\n".join(several), "]" + "\n".join(several) + "["]):
            folder = tmp_path / f"wrong{n}"
            folder.mkdir()
            (folder / "a.json").write_text(wrong)
            with pytest.raises(Exception, match="MALFORMED"):
                read_songs(spark, str(folder)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", usual)


def test_records_of_other_pages_are_left_out_before_they_are_parsed(spark, log_dir, tmp_path):
    kept = read_log(spark, log_dir, page="NextSong")
    want = read_log(spark, log_dir).where("page IS NULL OR page = 'NextSong'")
    assert rows(kept) == rows(want) and kept.count() < read_log(spark, log_dir).count()
    (tmp_path / "a.json").write_text('{"page": "Home", "ts": 1, "page": "NextSong"}\n{"p": {"q": "Home"}, "ts": 2}\n{"ts": 3}')
    assert sorted(r.ts for r in read_log(spark, str(tmp_path), page="NextSong").collect()) == ["1", "2", "3"]
    keys = {"p.q": "page", "ts": "ts"}
    assert sorted(r.ts for r in read_log(spark, str(tmp_path), keys=keys, page="NextSong").collect()) == ["1", "3"]
    (tmp_path / "b.json").write_text('{"page": "Home", "ts": }')
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILFAST|malformed"):
        read_log(spark, str(tmp_path), page="NextSong").collect()


def test_only_texts_with_deep_objects_are_counted_through(spark, tmp_path):
    flat, deep = '{"song_id": "S%d", "title": "}{ \\" ["}', '{"song_id": "S%d", "title": {"a": {"b": "{"}}}'
    (tmp_path / "flat.json").write_text("[" + ",\n".join(flat % k for k in range(20_000)) + "]")
    (tmp_path / "mixed.json").write_text("\n".join((flat, deep)[k % 2] % k for k in range(100)))
    found = read_songs(spark, str(tmp_path)).select("song_id")
    assert sorted(r.song_id for r in found.collect()) == sorted(f"S{k}" for k in [*range(20_000), *range(100)])
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE(regexp_replace(" in text and text.count("aggregate(regexp_extract_all(") == 1
    for wrong in ('{"song_id": "S1"}}', '{"song_id": {"a": 1}', '{"song_id": "S1}', '{"song_id": "S1"} "{}'):
        folder = tmp_path / f"wrong{len(wrong)}"
        folder.mkdir()
        (folder / "a.json").write_text(wrong)
        with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
            read_songs(spark, str(folder)).collect()
