"""The tables under plain Spark SQL, and the command line."""

import sys

import pytest

from starloom import __main__ as command_line
from starloom.plans import Warehouse, insert_star, load_staging


def counted(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def twice(spark, log_dir, song_dir, tmp_path):
    """The same staging under two warehouses, the first one filled by the library."""
    ours = Warehouse(spark, "staging_ours", "star_ours", location=str(tmp_path / "ours"))
    theirs = Warehouse(spark, "staging_sql", "star_sql", location=str(tmp_path / "sql"))
    for target in (ours, theirs):
        target.reset()
        load_staging(target, log_dir, song_dir)
    insert_star(ours)
    return ours, theirs


def test_sql_fills_the_same_star(spark, twice):
    ours, theirs = twice
    spark.sql("USE star_sql")
    try:
        spark.sql("""
            INSERT INTO users
            SELECT user_id, first_name, last_name, gender, level
            FROM staging_sql.staging_events
            WHERE (user_id, ts) IN
              (SELECT user_id, max(ts) FROM staging_sql.staging_events GROUP BY user_id)""")
        spark.sql("""
            INSERT INTO songs SELECT DISTINCT song_id, title, artist_id, year, duration
            FROM staging_sql.staging_songs""")
        spark.sql("""
            INSERT INTO artists
            SELECT DISTINCT artist_id, artist_name, artist_location, artist_latitude, artist_longitude
            FROM staging_sql.staging_songs""")
        spark.sql("""
            INSERT INTO time
            SELECT ts, date_part('hour', ts), date_part('day', ts), date_part('week', ts),
              date_part('month', ts), date_part('year', ts), date_part('dow', ts) - 1
            FROM staging_sql.staging_events""")
        spark.sql("""
            INSERT INTO songplays
              (start_time, user_id, level, song_id, artist_id, session_id, location, user_agent)
            SELECT ts, user_id, level, song_id, artist_id, session_id, location, user_agent
            FROM staging_sql.staging_events LEFT JOIN staging_sql.staging_songs
              ON artist = artist_name AND song = title""")
    finally:
        spark.sql("USE default")
    for name in ("users", "songs", "artists", "time", "songplays"):
        left, right = ours.read(name).drop("songplay_id"), theirs.read(name).drop("songplay_id")
        assert counted(left) == counted(right), name


def test_typical_report(spark, twice):
    ours, _ = twice
    report = spark.sql("""
        SELECT a.name, t.weekday, count(DISTINCT p.songplay_id) AS plays
        FROM star_ours.songplays p
        JOIN star_ours.artists a ON a.artist_id = p.artist_id
        JOIN star_ours.time t ON t.start_time = p.start_time
        GROUP BY ALL""")
    assert counted(report) == [("Ann", 1, 1), ("Ann", 6, 1), ("Bob", 0, 3)]


def test_replicated_dimensions_need_no_shuffle(twice):
    ours, _ = twice
    plays, artists, songs = ours.read("songplays"), ours.lookup("artists"), ours.lookup("songs")
    joined = plays.join(artists, "artist_id")._jdf.queryExecution()
    assert "BroadcastHashJoin" in joined.executedPlan().toString()
    assert "broadcast" not in songs._jdf.queryExecution().logical().toString()


def test_command_line(spark, log_dir, song_dir, tmp_path, monkeypatch):
    location = str(tmp_path / "cli")

    def call(*args):
        monkeypatch.setattr(sys, "argv", ["starloom", *args, "--location", location])
        command_line.main()

    sources = ["--log", log_dir, "--songs", song_dir]
    call("reset")
    # Prefix by prefix.
    call("stage", "--songs", song_dir)
    call("stage", "--log", f"{log_dir}/2018/11")
    call("stage", "--log", f"{log_dir}/2018/12")
    call("insert", "--dense-ids")
    assert spark.read.parquet(f"{location}/star/songplays").count() == 9
    call("run", *sources, "--mode", "overwrite", "--distinct-keys")
    assert spark.read.parquet(f"{location}/star/users").count() == 3
    for step in ("run", "stage"):
        with pytest.raises(SystemExit):
            call(step)
