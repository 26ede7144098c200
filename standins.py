"""Activity log and catalogue made from the test tables, once in Spark, once in SQL.

``events`` stands in for the activity log and ``part`` for the catalogue:

* A third of the events play the same hit; the others move through the catalogue by
  event id and run past its end, so some find no partner.
* A title has four catalogue rows and a song id two, some of them equal in every field,
  at any scale factor: repeated rows exist, the fan-out of the join stays the same.
* Artists, songs, user ids and pages are missing or empty in places.

The SQL is for DuckDB and gives the typed staging columns directly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.sources import typed_log, typed_songs


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log records as a JSON writer would get them, keys and types of the source."""
    events = table(spark, sf_dir, "events").select(
        "*",
        F.floor("value").cast("int").alias("k"),
    ).select(
        "*",
        F.expr("CASE WHEN k % 3 = 0 THEN 0 ELSE event_id DIV 4 END").alias("song_no"),
    )
    return events.selectExpr(
        "CASE WHEN k % 11 = 7 THEN NULL ELSE concat('Artist ', song_no DIV 32) END AS artist",
        "CASE WHEN event_type = 'signup' THEN 'LoggedOut' ELSE 'LoggedIn' END AS auth",
        "concat('First', user_id % 97) AS firstName",
        "CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender",
        "event_id % 50 AS itemInSession",
        "concat('Last', user_id % 89) AS lastName",
        "CASE WHEN event_type <> 'click' THEN value / 7 END AS length",
        "CASE WHEN value >= 20 THEN 'paid' ELSE 'free' END AS level",
        "concat('City ', user_id % 41, ', ST') AS location",
        "CASE WHEN event_type = 'view' THEN 'PUT' ELSE 'GET' END AS method",
        "CASE event_type WHEN 'view' THEN 'NextSong' WHEN 'click' THEN 'Home' "
        "WHEN 'error' THEN NULL ELSE event_type END AS page",
        "CAST(1600000123456 + user_id * 1000 AS DOUBLE) AS registration",
        "(event_id DIV 50) % 1000000 AS sessionId",
        "CASE WHEN k % 13 = 5 THEN NULL ELSE concat('Track ', song_no DIV 4) END AS song",
        "CASE WHEN event_type = 'error' THEN 404 ELSE 200 END AS status",
        "timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) AS ts",
        "concat('\"Agent/', user_id % 5, '.0 (X; Y) like \\\\ Z\"') AS userAgent",
        "CASE WHEN event_type = 'click' THEN '' ELSE CAST(user_id AS STRING) END AS userId",
    )


def raw_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue records as a JSON writer would get them."""
    return table(spark, sf_dir, "part").selectExpr(
        "1 AS num_songs",
        "concat('AR', p_partkey DIV 32) AS artist_id",
        "CASE WHEN p_type <> 'ECONOMY' THEN (p_retailprice - 950) / 7 END AS artist_latitude",
        "-p_retailprice / 9 AS artist_longitude",
        "p_type AS artist_location",
        "concat('Artist ', p_partkey DIV 32) AS artist_name",
        "concat('SO', p_partkey DIV 2) AS song_id",
        "concat('Track ', p_partkey DIV 4) AS title",
        "p_retailprice / 3 AS duration",
        "1970 + p_size % 3 AS year",
    )


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All log records, typed."""
    return typed_log(raw_log(spark, sf_dir))


def songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All catalogue records, typed."""
    return typed_songs(raw_songs(spark, sf_dir))


def by_day(events: DataFrame) -> DataFrame:
    """Times cut to the day, which makes many ties."""
    return events.withColumn("ts", F.to_date("ts").cast("timestamp_ntz"))


def write_log_files(spark: SparkSession, sf_dir: str, target: str) -> str:
    """The log as line-delimited JSON in folders by year and month."""
    raw = raw_log(spark, sf_dir)
    when = F.timestamp_millis("ts")
    (
        raw.withColumn("_year", F.year(when))
        .withColumn("_month", F.month(when))
        .write.partitionBy("_year", "_month")
        .option("ignoreNullFields", False)
        .json(target)
    )
    return target


def write_song_files(spark: SparkSession, sf_dir: str, target: str) -> str:
    """The catalogue as pretty-printed JSON over many lines, in two levels of folders.

    A file is an array of at most 4096 neighbouring rows of one input split.
    """
    pretty = {"pretty": "true", "ignoreNullFields": "false"}
    (
        raw_songs(spark, sf_dir)
        .select(
            F.to_json(F.struct("*"), pretty).alias("record"),
            F.shiftright(F.monotonically_increasing_id(), 12).alias("chunk"),
        )
        .groupBy("chunk")
        .agg(F.concat(F.lit("[\n"), F.array_join(F.collect_list("record"), ",\n"), F.lit("\n]")).alias("value"))
        .select(
            "value",
            F.concat(F.lit("A"), F.col("chunk") % 4).alias("_a"),
            F.concat(F.lit("B"), F.col("chunk") % 3).alias("_b"),
        )
        .write.partitionBy("_a", "_b")
        .option("maxRecordsPerFile", 1)
        .text(target)
    )
    return target


_EVENT_NUMBERS = """
SELECT *, CASE WHEN k % 3 = 0 THEN 0 ELSE event_id // 4 END AS song_no
FROM (SELECT *, CAST(floor(value) AS INTEGER) AS k FROM events)
"""


def truncated_sql(value: str, scale: int) -> str:
    return f"trunc(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 18)), {scale})"


LOG_SQL = f"""
SELECT
  CASE WHEN k % 11 = 7 THEN NULL ELSE 'Artist ' || (song_no // 32) END AS artist,
  CASE WHEN event_type = 'signup' THEN 'LoggedOut' ELSE 'LoggedIn' END AS auth,
  'First' || (user_id % 97) AS first_name,
  CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
  CAST(event_id % 50 AS INTEGER) AS item_in_session,
  'Last' || (user_id % 89) AS last_name,
  CASE WHEN event_type <> 'click' THEN {truncated_sql("value / 7", 5)} END AS length,
  CASE WHEN value >= 20 THEN 'paid' ELSE 'free' END AS level,
  'City ' || (user_id % 41) || ', ST' AS location,
  CASE WHEN event_type = 'view' THEN 'PUT' ELSE 'GET' END AS method,
  CASE event_type WHEN 'view' THEN 'NextSong' WHEN 'click' THEN 'Home'
    WHEN 'error' THEN NULL ELSE event_type END AS page,
  1600000123456 + user_id * 1000 AS registration,
  CAST((event_id // 50) % 1000000 AS INTEGER) AS session_id,
  CASE WHEN k % 13 = 5 THEN NULL ELSE 'Track ' || (song_no // 4) END AS song,
  CAST(CASE WHEN event_type = 'error' THEN 404 ELSE 200 END AS INTEGER) AS status,
  date_trunc('millisecond', ts) AS ts,
  '"Agent/' || (user_id % 5) || '.0 (X; Y) like \\ Z"' AS user_agent,
  CASE WHEN event_type = 'click' THEN NULL ELSE CAST(user_id AS INTEGER) END AS user_id
FROM ({_EVENT_NUMBERS})
"""

SONGS_SQL = f"""
SELECT
  CAST(1 AS INTEGER) AS num_songs,
  'AR' || (p_partkey // 32) AS artist_id,
  CASE WHEN p_type <> 'ECONOMY' THEN CAST({truncated_sql("(p_retailprice - 950) / 7", 0)} AS BIGINT) END
    AS artist_latitude,
  CAST({truncated_sql("-p_retailprice / 9", 0)} AS BIGINT) AS artist_longitude,
  p_type AS artist_location,
  'Artist ' || (p_partkey // 32) AS artist_name,
  'SO' || (p_partkey // 2) AS song_id,
  'Track ' || (p_partkey // 4) AS title,
  CAST({truncated_sql("p_retailprice / 3", 0)} AS BIGINT) AS duration,
  CAST(1970 + p_size % 3 AS INTEGER) AS year
FROM part
"""

# What staging holds after the rows of other pages are deleted.
STAGED_SQL = f"SELECT * FROM ({LOG_SQL}) WHERE (page <> 'NextSong') IS NOT TRUE"

BY_DAY_SQL = f"SELECT * REPLACE (CAST(date_trunc('day', ts) AS TIMESTAMP) AS ts) FROM ({LOG_SQL})"
