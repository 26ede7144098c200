"""Registered queries and their SQL counterparts.

Every query runs over whole tables. ``standins`` makes the activity log and the
catalogue from the test tables; the library does the rest.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.errors import PySparkException as SparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from standins import (  # noqa: E402
    BY_DAY_SQL,
    LOG_SQL,
    SONGS_SQL,
    STAGED_SQL,
    by_day,
    log,
    raw_log,
    raw_songs,
    songs,
    table,
    truncated_sql,
    write_log_files,
    write_song_files,
)
from starloom import schemas  # noqa: E402
from starloom.functions import bigint, calendar_fields, epoch_millis, integer, truncated_decimal  # noqa: E402
from starloom.operators import (  # noqa: E402
    audit,
    drop_where_not_equal,
    latest_rows_by_join,
    max_per_key,
    range_clustered,
    replicated,
    salt_pair,
    with_dense_id,
    with_id,
    write_distributed,
)
from starloom.operators.joins import PARTS  # noqa: E402
from starloom.operators.layout import sorted_within  # noqa: E402
from starloom.plans import Warehouse, dimensions, load_events, load_songs, run, songplays  # noqa: E402
from starloom.session import scratch_dir  # noqa: E402
from starloom.sources import LOG_KEYS, read_log, read_songs, typed_log, typed_songs  # noqa: E402

try:  # the training-data operators may be left out, or lack a library that only they need
    import corpus_pipeline
    from starloom.llm import queries as llm_queries
except ImportError:
    llm_queries = corpus_pipeline = None

SMOKE_DIR = "/root/testdata/sf0.001"


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_where_not_equal(log(spark, sf_dir), "page", "NextSong")


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as bigint or double, which both engines hand out alike."""
    plain = {"decimal(18,0)": "bigint", "decimal(18,5)": "double"}
    return df.select(*[F.col(c).cast(plain.get(t, t)).alias(c) for c, t in df.dtypes])


# Sources and coercions


def load_events_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = write_log_files(spark, sf_dir, f"{scratch_dir(spark)}/log_data")
    return comparable(typed_log(read_log(spark, files)))


def load_songs_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = write_song_files(spark, sf_dir, f"{scratch_dir(spark)}/song_data")
    return comparable(typed_songs(read_songs(spark, files)))


def load_songs_many_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of many objects each: a line apiece, over several lines, and in arrays."""
    raw = raw_songs(spark, sf_dir)
    record = F.to_json(F.struct("*"))
    pretty = F.to_json(F.struct("*"), {"pretty": "true"})
    chunks = raw.select(F.pmod(F.xxhash64("song_id"), F.lit(23)).alias("chunk"), record.alias("line"), pretty.alias("lines"))
    files = chunks.groupBy("chunk").agg(F.array_sort(F.collect_list("line")).alias("line"), F.array_sort(F.collect_list("lines")).alias("lines"))
    arrays = F.concat(F.lit("["), F.array_join("line", ","), F.lit("]"))
    value = F.when(F.col("chunk") % 3 == 0, F.array_join("line", "\n")).when(F.col("chunk") % 3 == 1, F.array_join("lines", "\n"))
    target = f"{scratch_dir(spark)}/many"
    files.select(value.otherwise(arrays)).write.option("maxRecordsPerFile", 1).text(target)
    return comparable(typed_songs(read_songs(spark, target), strict=True))


def load_events_two_per_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_log(spark, sf_dir)
    both = raw.select(F.to_json(F.struct("*")).alias("record"), "sessionId", F.floor(F.col("itemInSession") / 2).alias("pair"))
    lines = both.groupBy("sessionId", "pair").agg(F.array_join(F.collect_list("record"), " ").alias("value"))
    target = f"{scratch_dir(spark)}/pairs"
    lines.select("value").write.text(target)
    return comparable(typed_log(read_log(spark, target), strict=True))


def load_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load without enforcement reports of values that do not convert, by key."""
    broken = raw_log(spark, sf_dir).withColumns(
        {
            "sessionId": F.expr("CASE WHEN status = 404 THEN 'none' ELSE CAST(sessionId AS STRING) END"),
            "itemInSession": F.expr("CASE WHEN itemInSession % 10 = 3 THEN 9999999999 ELSE itemInSession END"),
            "length": F.expr("CASE WHEN level = 'paid' THEN 1e20 ELSE length END"),
            "status": F.col("status").cast("double"),
        }
    )
    target = f"{scratch_dir(spark)}/broken"
    broken.write.option("ignoreNullFields", False).json(target)
    warehouse = new_warehouse(spark)
    warehouse.create()
    losses = load_events(warehouse, target, enforce=False)
    return spark.createDataFrame(sorted(losses.items()), "field string, lost long")


def coerce_epoch_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    millis = F.expr("timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    events = table(spark, sf_dir, "events")
    return events.select("event_id", epoch_millis(millis.cast("string")).alias("start_time"))


def coerce_text_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.expr(
        "CASE event_type WHEN 'click' THEN '' WHEN 'error' THEN concat('u', user_id) "
        "ELSE CAST(user_id AS STRING) END"
    )
    return table(spark, sf_dir, "events").select("event_id", integer(text).alias("user_id"))


def coerce_float_bigint(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.expr("CAST(CAST(1600000123456 + event_id AS DOUBLE) AS STRING)")
    return table(spark, sf_dir, "events").select("event_id", bigint(text).alias("registration"))


def coerce_decimal_trunc(spark: SparkSession, sf_dir: str) -> DataFrame:
    seventh = (F.col("value") / 7).cast("string")
    minus = (-F.col("value") / 7).cast("string")
    return table(spark, sf_dir, "events").select(
        "event_id",
        truncated_decimal(seventh, 18, 5).cast("double").alias("fine"),
        truncated_decimal(minus, 18, 5).cast("double").alias("fine_negative"),
        truncated_decimal(seventh, 18, 0).cast("bigint").alias("whole"),
        truncated_decimal(minus, 18, 0).cast("bigint").alias("whole_negative"),
    )


def coercion_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_log(spark, sf_dir)
    rules = {
        "userId": integer(F.col("userId")),
        "sessionId": integer(F.col("sessionId")),
        "userAgent": integer(F.col("userAgent")),
        "page": bigint(F.col("page")),
    }
    return audit.coercion_losses(raw, rules)


# Staging


def stage_keep_nullsafe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(spark, sf_dir).select("session_id", "item_in_session", "page", "ts")


# Dimensions


def users_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.users(by_day(log(spark, sf_dir)))


def users_latest_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way taken when there are too many users to broadcast their last times."""
    return dimensions.users(by_day(log(spark, sf_dir)), max_broadcast_bytes=0)


def users_latest_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = by_day(log(spark, sf_dir))
    return latest_rows_by_join(events, "user_id", "ts", dimensions.USER_FIELDS)


def users_latest_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.users_distinct(by_day(log(spark, sf_dir)))


def user_max_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return max_per_key(log(spark, sf_dir), "user_id", "ts")


def songs_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(dimensions.songs(songs(spark, sf_dir)))


def artists_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(dimensions.artists(songs(spark, sf_dir)))


def time_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.time(log(spark, sf_dir))


def time_dim_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten years of dates, with the weeks that span two of them."""
    date = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select("o_orderkey", *calendar_fields(date))


def time_dim_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return dimensions.time_distinct(orders.select(F.col("o_orderdate").alias("ts")))


# Fact


def songplays_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return songplays(staged(spark, sf_dir), songs(spark, sf_dir))


def songplays_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All log records, also those without artist or song, in the shuffled join."""
    return songplays(log(spark, sf_dir), songs(spark, sf_dir), max_broadcast_bytes=0)


def songplays_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shuffled join with low thresholds for hot keys: the hit is dealt over many cells."""
    return songplays(
        log(spark, sf_dir), songs(spark, sf_dir), max_broadcast_bytes=0, max_groups=64, min_rows=2
    )


def surrogate_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = with_id(table(spark, sf_dir, "lineitem"), "songplay_id")
    return numbered.agg(
        F.count("songplay_id").alias("n_rows"),
        F.countDistinct("songplay_id").alias("n_ids"),
    )


def surrogate_id_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = with_dense_id(table(spark, sf_dir, "lineitem"), "songplay_id", start=100)
    return numbered.agg(
        F.count("songplay_id").alias("n_rows"),
        F.countDistinct("songplay_id").alias("n_ids"),
        F.min("songplay_id").alias("lowest"),
        F.max("songplay_id").alias("highest"),
    )


# Tables and layout


def new_warehouse(spark: SparkSession) -> Warehouse:
    """An empty warehouse under names of its own, below the shared scratch folder."""
    tag = uuid.uuid4().hex[:12]
    warehouse = Warehouse(spark, f"staging_{tag}", f"star_{tag}", location=scratch_dir(spark))
    warehouse.create()
    return warehouse


def append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = new_warehouse(spark)
    for _ in range(2):
        warehouse.append("staging_songs", songs(spark, sf_dir))
    return comparable(warehouse.read("staging_songs"))


def insert_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = new_warehouse(spark)
    fields = ["artist_id", "artist_name", "artist_location", "artist_latitude", "artist_longitude"]
    warehouse.append_by_position("artists", songs(spark, sf_dir).select(*fields).distinct())
    return comparable(warehouse.read("artists"))


def bucketed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tables bucketed alike, hot keys over several buckets; the join moves no row."""
    on = ("l_partkey", "p_partkey")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    lines, parts = salt_pair(lines, parts, [on])
    base, tag = scratch_dir(spark), uuid.uuid4().hex[:12]
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = write_distributed(lines, f"lines_{tag}", [on[0], *PARTS], buckets, f"{base}/lines")
    parts = write_distributed(parts, f"parts_{tag}", [on[1], *PARTS], buckets, f"{base}/parts")
    same_cell = (lines[on[0]] == parts[on[1]]) & (lines[PARTS[0]] == parts[PARTS[0]])
    same_cell &= lines[PARTS[1]] == parts[PARTS[1]]
    return lines.join(parts.hint("merge"), same_cell).select("l_orderkey", "l_linenumber", "p_brand", "p_size")


def replicated_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    joined = customer.join(replicated(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select("c_custkey", "n_name")


def _orders_of_1997(spark: SparkSession, orders: DataFrame) -> DataFrame:
    target = f"{scratch_dir(spark)}/orders"
    orders.write.parquet(target)
    year = F.col("o_orderdate").between(
        F.expr("TIMESTAMP_NTZ'1997-01-01 00:00:00'"), F.expr("TIMESTAMP_NTZ'1997-12-31 00:00:00'")
    )
    return spark.read.parquet(target).where(year).select("o_orderkey", "o_orderdate")


def sorted_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_of_1997(spark, sorted_within(table(spark, sf_dir, "orders"), "o_orderdate"))


def clustered_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_of_1997(spark, range_clustered(table(spark, sf_dir, "orders"), "o_orderdate"))


# Audits


def audit_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.duplicate_keys(dimensions.songs(songs(spark, sf_dir)), ["song_id"])


def audit_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.orphans(log(spark, sf_dir), "artist", songs(spark, sf_dir), "artist_name")


def audit_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = audit.missing(log(spark, sf_dir), ["ts", "user_id"])
    return found.select("session_id", "item_in_session", "ts", "user_id")


def audit_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = audit.too_long(table(spark, sf_dir, "documents"), {"text": 255, "source": 10})
    return found.select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), "source")


# The whole load


def _loaded(spark: SparkSession, sf_dir: str) -> Warehouse:
    warehouse, files = new_warehouse(spark), scratch_dir(spark)
    log_files = write_log_files(spark, sf_dir, f"{files}/log_data")
    song_files = write_song_files(spark, sf_dir, f"{files}/song_data")
    run(warehouse, log_files, song_files)
    return warehouse


def _as_text(df: DataFrame, name: str) -> DataFrame:
    """(table_name, content): all columns but the generated id, joined to one text."""
    columns = []
    for column, kind in df.drop("songplay_id").dtypes:
        value = F.col(column)
        if kind == "timestamp_ntz":
            epoch = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
            value = F.timestamp_diff("MILLISECOND", epoch, value)
        columns.append(F.coalesce(value.cast("string"), F.lit("~")))
    return df.select(F.lit(name).alias("table_name"), F.concat_ws("|", *columns).alias("content"))


def star_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON files to star; the content of all five tables."""
    warehouse = _loaded(spark, sf_dir)
    users, *others = [_as_text(warehouse.read(t.name), t.name) for t in schemas.star_tables()]
    for other in others:
        users = users.unionAll(other)
    return users


def reset_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaded, reset and loaded again: the rows of each table once."""
    warehouse = _loaded(spark, sf_dir)
    warehouse.reset()
    empty = sum(warehouse.read(t.name).count() for tables in warehouse.schemas.values() for t in tables)
    base = scratch_dir(spark)
    run(warehouse, write_log_files(spark, sf_dir, f"{base}/log"), write_song_files(spark, sf_dir, f"{base}/songs"))
    counts = [
        warehouse.read(t.name).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t.name).alias("table_name"), F.col("n_rows") + empty)
        for t in schemas.star_tables()
    ]
    return reduce(DataFrame.unionAll, counts).toDF("table_name", "n_rows")


def staged_atomic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A title over its limit stops the insert into songs: nothing of it is there, staging is whole."""
    long = raw_songs(spark, sf_dir).withColumn("title", F.expr("CASE WHEN num_songs = 1 AND year = 1970 THEN repeat('é', 128) ELSE title END"))
    target = f"{scratch_dir(spark)}/long"
    long.write.option("ignoreNullFields", False).json(target)
    warehouse = new_warehouse(spark)
    warehouse.create()
    load_songs(warehouse, target, one_per_line=True)
    stopped = 0
    try:
        warehouse.append("songs", dimensions.songs(warehouse.read("staging_songs")))
    except SparkException as error:
        stopped = int("songs.title is over 255 bytes" in str(error))
    counted = [
        warehouse.read(name).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name in ("staging_songs", "songs")
    ]
    return reduce(DataFrame.unionAll, counted).withColumn("stopped", F.lit(stopped))


def star_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON files to star; violations of the declared constraints."""
    return _loaded(spark, sf_dir).violations()


def entry(spark: SparkSession) -> DataFrame:
    """The fact table at the smoke scale."""
    return songplays_fact(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    registered = [
        load_events_json,
        load_songs_json,
        load_songs_many_per_file,
        load_events_two_per_line,
        load_losses,
        coerce_epoch_ms,
        coerce_text_int,
        coerce_float_bigint,
        coerce_decimal_trunc,
        coercion_losses,
        stage_keep_nullsafe,
        users_latest,
        users_latest_shuffled,
        users_latest_join,
        users_latest_one,
        user_max_ts,
        songs_distinct,
        artists_distinct,
        time_dim,
        time_dim_orders,
        time_dim_distinct,
        songplays_fact,
        songplays_null_keys,
        songplays_salted,
        surrogate_id,
        surrogate_id_dense,
        append_twice,
        insert_by_position,
        bucketed_join,
        replicated_dim,
        sorted_layout,
        clustered_layout,
        audit_duplicate_keys,
        audit_orphans,
        audit_not_null,
        audit_length,
        star_run,
        reset_reload,
        staged_atomic,
        star_violations,
    ]
    named = {query.__name__: query for query in registered}
    if llm_queries:
        named |= {**llm_queries.queries(), "pipeline": corpus_pipeline.run}
    return named


def _calendar_sql(ts: str) -> str:
    parts = {"hour": "hour", "day": "day", "week": "week", "month": "month", "year": "year", "weekday": "dow"}
    return ", ".join(f"CAST(date_part('{part}', {ts}) AS SMALLINT) AS {name}" for name, part in parts.items())


def _users_sql(events: str) -> str:
    return f"""
SELECT user_id, first_name, last_name, gender, level
FROM (SELECT *, max(ts) OVER (PARTITION BY user_id) AS last_ts FROM ({events}))
WHERE user_id IS NOT NULL AND ts = last_ts
"""


def _songplays_sql(events: str) -> str:
    return f"""
SELECT e.ts AS start_time, e.user_id, e.level, s.song_id, s.artist_id,
  e.session_id, e.location, e.user_agent
FROM ({events}) e LEFT JOIN ({SONGS_SQL}) s ON e.artist = s.artist_name AND e.song = s.title
"""


_SONG_DIM_SQL = f"SELECT DISTINCT song_id, title, artist_id, year, duration FROM ({SONGS_SQL})"
_ARTIST_DIM_SQL = f"""
SELECT DISTINCT artist_id, artist_name AS name, artist_location AS location,
  artist_latitude AS latitude, artist_longitude AS longitude
FROM ({SONGS_SQL})
"""
_TIME_DIM_SQL = f"SELECT ts AS start_time, {_calendar_sql('ts')} FROM ({{events}})"

# The star's tables as the load leaves them.
_STAR_SQL = {
    "users": _users_sql(STAGED_SQL),
    "songs": _SONG_DIM_SQL,
    "artists": _ARTIST_DIM_SQL,
    "time": _TIME_DIM_SQL.format(events=STAGED_SQL),
    "songplays": _songplays_sql(STAGED_SQL),
}


def _star_run_sql() -> str:
    selects = []
    for spec in schemas.star_tables():
        texts = []
        for column in spec.column_names:
            if column == "songplay_id":
                continue
            value = f"epoch_ms({column})" if column == "start_time" else column
            texts.append(f"coalesce(CAST({value} AS VARCHAR), '~')")
        content = f"concat_ws('|', {', '.join(texts)})"
        selects.append(
            f"SELECT '{spec.name}' AS table_name, {content} AS content FROM ({_STAR_SQL[spec.name]})"
        )
    return "\nUNION ALL\n".join(selects)


def _star_violations_sql() -> str:
    selects = []

    def count(name: str, rule: str, column: str, source: str) -> None:
        selects.append(
            f"SELECT '{name}' AS \"table\", '{rule}' AS \"rule\", '{column}' AS \"column\", "
            f"count(*) AS violations FROM ({source})"
        )

    for spec in schemas.star_tables():
        name, data = spec.name, _STAR_SQL[spec.name]
        if name == "songplays":
            data = f"SELECT row_number() OVER () AS songplay_id, * FROM ({data})"
        if key := spec.primary_key:
            count(name, "primary key", key, f"SELECT {key} FROM ({data}) GROUP BY {key} HAVING count(*) > 1")
        for column, (other, key) in spec.foreign_keys.items():
            known = f"SELECT 1 FROM ({_STAR_SQL[other]}) d WHERE d.{key} = f.{column}"
            count(
                name,
                "foreign key",
                column,
                f"SELECT DISTINCT {column} FROM ({data}) f "
                f"WHERE {column} IS NOT NULL AND NOT EXISTS ({known})",
            )
        for column in spec.columns:
            if column.required:
                source = f"SELECT 1 FROM ({data}) WHERE {column.name} IS NULL"
                count(name, "not null", column.name, source)
        for column in spec.columns:
            if column.max_bytes:
                too_long = f"octet_length(encode({column.name})) > {column.max_bytes}"
                count(name, "length", column.name, f"SELECT 1 FROM ({data}) WHERE {too_long}")
    return "\nUNION ALL\n".join(selects)


def _losses_sql() -> str:
    lost = {
        "sessionId": "event_type = 'error'",
        "itemInSession": "event_id % 50 % 10 = 3",
        "length": "value >= 20",
    }
    selects = [
        f"SELECT '{key}' AS field, count(*) FILTER (WHERE {lost.get(key, 'false')}) AS lost FROM events" for key in LOG_KEYS
    ]
    return "\nUNION ALL\n".join(selects)


def oracle_sql() -> dict[str, str]:
    fields = ", ".join(dimensions.USER_FIELDS)
    all_log = f"SELECT * REPLACE (CAST(length AS DOUBLE) AS length) FROM ({LOG_SQL})"
    seventh, minus = "value / 7", "-value / 7"
    orders_1997 = """
SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-12-31'
"""
    llm = {}
    if llm_queries:
        llm = llm_queries.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            llm["pipeline"] = corpus_pipeline.ORACLE_SQL
    return llm | {
        "load_events_json": all_log,
        "load_songs_json": SONGS_SQL,
        "load_songs_many_per_file": SONGS_SQL,
        "load_events_two_per_line": all_log,
        "load_losses": _losses_sql(),
        "coerce_epoch_ms": "SELECT event_id, date_trunc('millisecond', ts) AS start_time FROM events",
        "coerce_text_int": """
SELECT event_id, CASE WHEN event_type IN ('click', 'error') THEN NULL ELSE CAST(user_id AS INTEGER) END
  AS user_id
FROM events
""",
        "coerce_float_bigint": """
SELECT event_id, CAST(CAST(1600000123456 + event_id AS DOUBLE) AS BIGINT) AS registration FROM events
""",
        "coerce_decimal_trunc": f"""
SELECT event_id,
  CAST({truncated_sql(seventh, 5)} AS DOUBLE) AS fine,
  CAST({truncated_sql(minus, 5)} AS DOUBLE) AS fine_negative,
  CAST({truncated_sql(seventh, 0)} AS BIGINT) AS whole,
  CAST({truncated_sql(minus, 0)} AS BIGINT) AS whole_negative
FROM events
""",
        "coercion_losses": f"""
SELECT 'userId' AS field, CAST(0 AS BIGINT) AS lost
UNION ALL SELECT 'sessionId', CAST(0 AS BIGINT)
UNION ALL SELECT 'userAgent', count(user_agent) FROM ({LOG_SQL})
UNION ALL SELECT 'page', count(page) FROM ({LOG_SQL})
""",
        "stage_keep_nullsafe": f"SELECT session_id, item_in_session, page, ts FROM ({STAGED_SQL})",
        "users_latest": _users_sql(BY_DAY_SQL),
        "users_latest_shuffled": _users_sql(BY_DAY_SQL),
        "users_latest_join": _users_sql(BY_DAY_SQL),
        "users_latest_one": f"""
SELECT user_id, {fields} FROM (
  SELECT *, row_number() OVER (
    PARTITION BY user_id
    ORDER BY ts DESC, session_id DESC, item_in_session DESC, first_name DESC, last_name DESC,
      gender DESC, level DESC
  ) AS position
  FROM ({BY_DAY_SQL}) WHERE user_id IS NOT NULL AND ts IS NOT NULL
) WHERE position = 1
""",
        "user_max_ts": f"SELECT user_id, max(ts) AS max_ts FROM ({LOG_SQL}) GROUP BY user_id",
        "songs_distinct": _SONG_DIM_SQL,
        "artists_distinct": _ARTIST_DIM_SQL,
        "time_dim": _TIME_DIM_SQL.format(events=LOG_SQL),
        "time_dim_orders": f"SELECT o_orderkey, {_calendar_sql('o_orderdate')} FROM orders",
        "time_dim_distinct": f"""
SELECT DISTINCT o_orderdate AS start_time, {_calendar_sql('o_orderdate')} FROM orders
""",
        "songplays_fact": _songplays_sql(STAGED_SQL),
        "songplays_null_keys": _songplays_sql(LOG_SQL),
        "songplays_salted": _songplays_sql(LOG_SQL),
        "surrogate_id": "SELECT count(*) AS n_rows, count(*) AS n_ids FROM lineitem",
        "surrogate_id_dense": """
SELECT count(*) AS n_rows, count(*) AS n_ids, CAST(100 AS BIGINT) AS lowest, count(*) + 99 AS highest
FROM lineitem
""",
        "append_twice": f"SELECT * FROM ({SONGS_SQL}) UNION ALL SELECT * FROM ({SONGS_SQL})",
        "insert_by_position": _ARTIST_DIM_SQL,
        "bucketed_join": """
SELECT l_orderkey, l_linenumber, p_brand, p_size FROM lineitem JOIN part ON l_partkey = p_partkey
""",
        "replicated_dim": """
SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
""",
        "sorted_layout": orders_1997,
        "clustered_layout": orders_1997,
        "audit_duplicate_keys": f"""
SELECT song_id, count(*) AS copies FROM ({_SONG_DIM_SQL}) GROUP BY song_id HAVING count(*) > 1
""",
        "audit_orphans": f"""
SELECT artist, count(*) AS "rows" FROM ({LOG_SQL}) e
WHERE artist IS NOT NULL AND NOT EXISTS (SELECT 1 FROM ({SONGS_SQL}) s WHERE s.artist_name = e.artist)
GROUP BY artist
""",
        "audit_not_null": f"""
SELECT session_id, item_in_session, ts, user_id FROM ({LOG_SQL}) WHERE ts IS NULL OR user_id IS NULL
""",
        "audit_length": """
SELECT doc_id, octet_length(encode(text)) AS n_bytes, source FROM documents
WHERE octet_length(encode(text)) > 255 OR octet_length(encode(source)) > 10
""",
        "star_run": _star_run_sql(),
        "reset_reload": "\nUNION ALL\n".join(
            f"SELECT '{t.name}' AS table_name, count(*) AS n_rows FROM ({_STAR_SQL[t.name]})" for t in schemas.star_tables()
        ),
        "staged_atomic": """
SELECT 'staging_songs' AS table_name, count(*) AS n_rows, CAST(1 AS INTEGER) AS stopped FROM part
UNION ALL SELECT 'songs', CAST(0 AS BIGINT), CAST(1 AS INTEGER)
""",
        "star_violations": _star_violations_sql(),
    }
