"""JSON sources: the activity log and the song catalogue.

Both are read below one or more prefixes, at any depth, with a fixed all-text
schema (no inference pass) and typed afterwards by ``functions.coerce``. A line or
file may hold any number of objects, one after the other or in an array: all are
loaded. Anything else between them, and a record that is not JSON, stops the load,
as it does in a bulk load without error allowance.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import coerce_to
from ..operators.running import running_total

# JSON key -> staging column. Fixed by the log format, in record order.
LOG_KEYS = {
    "artist": "artist",
    "auth": "auth",
    "firstName": "first_name",
    "gender": "gender",
    "itemInSession": "item_in_session",
    "lastName": "last_name",
    "length": "length",
    "level": "level",
    "location": "location",
    "method": "method",
    "page": "page",
    "registration": "registration",
    "sessionId": "session_id",
    "song": "song",
    "status": "status",
    "ts": "ts",
    "userAgent": "user_agent",
    "userId": "user_id",
}

# The catalogue's keys are the staging column names.
SONG_KEYS = {name: name for name in schemas.staging_songs().column_names}

# A string, closed or not, and what may stand between records: blanks, commas, and one array's brackets.
_STRING = r'"(?:[^"\\]++|\\.)*+"'
_BETWEEN = r"[\s,\uFEFF]+"
# One object and nothing else, without braces in it: most lines of a log.
_PLAIN = r"(?s)^\s*\{[^{}]*+\}\s*$"
# All but the braces outside of strings, and what is left of objects with at most one level of others in them.
_UNBRACED = rf'(?s)[^{{}}"]++|{_STRING}'
_SHALLOW = r"^(?:\{(?:\{\})*+\})*+$"


def _depth(text: Column) -> Column:
    """How deep the objects of a text are nested, braces in strings left out."""
    marks = F.regexp_extract_all(text, F.lit(rf"(?s){_STRING}|[{{}}]"), F.lit(0))
    start = F.struct(F.lit(0).alias("open"), F.lit(0).alias("most"))

    def step(so_far: Column, mark: Column) -> Column:
        now = so_far["open"] + F.when(mark == "{", 1).when(mark == "}", -1).otherwise(0)
        return F.struct(now.alias("open"), F.greatest(so_far["most"], now).alias("most"))

    return F.aggregate(marks, start, step, lambda end: end["most"])


def _object_pattern(depth: Column) -> Column:
    """A pattern of one object with others in it, as deep as asked for.

    Nothing is matched twice, so that a long record does not go deep. ``depth`` is 2 or more.
    """
    inside = rf'[^{{}}"]++|{_STRING}'
    flat = F.lit(rf"\{{(?:{inside})*+\}}")
    whole = F.aggregate(F.sequence(F.lit(2), depth), flat, lambda so_far, _: F.concat(F.lit(rf"\{{(?:{inside}|"), so_far, F.lit(r")*+\}")))
    return F.concat(F.lit("(?s)"), whole)


def _objects(texts: DataFrame) -> DataFrame:
    """(object): every object in the texts ``value``, each with all that is nested in it."""

    def searched(text: Column) -> Column:
        # Depths in steps, so that few patterns are made; only texts with deep objects are counted through.
        steps = F.pow(F.lit(2), F.ceil(F.log2(F.greatest(_depth(text), F.lit(2))))).cast("int")
        shallow = F.regexp_replace(text, _UNBRACED, "").rlike(_SHALLOW)
        pattern = F.when(shallow, _object_pattern(F.lit(2))).otherwise(_object_pattern(steps))
        return F.transform(F.array(pattern), cut)[0]

    def cut(pattern: Column) -> Column:
        rest = F.regexp_replace(F.regexp_replace("value", pattern, F.lit("")), _BETWEEN, "")
        stop = _malformed(F.input_file_name(), rest)
        return F.when(rest.isin("", "[]"), F.regexp_extract_all("value", pattern, F.lit(0))).otherwise(stop)

    value = F.col("value")
    return texts.select(F.explode(F.when(value.rlike(_PLAIN), F.array(value)).otherwise(searched(value))).alias("object"))


def _malformed(file: Column, what: Column) -> Column:
    return F.raise_error(F.concat(F.lit("MALFORMED_RECORD in "), file, F.lit(": "), F.left(what, F.lit(100))))


def _objects_over_lines(lines: DataFrame) -> DataFrame:
    """(object): every object in files that are read by lines, in several tasks per file.

    ``lines`` has file, part (where its task began in the file), line (its place there) and value. No
    string goes over a line's end, so each line is cut at its braces by itself. The depth before a
    piece is a running sum over the parts of its file; an object is what stands between a brace at
    depth 0 and its partner, in whatever parts these are.
    """
    cuts = F.regexp_extract_all("value", F.lit(rf'[{{}}]|(?:[^{{}}"]++|{_STRING}|")++'), F.lit(0))
    pieces = lines.select("file", "part", "line", F.posexplode(cuts).alias("pos", "piece"))
    opens, closes = F.col("piece") == "{", F.col("piece") == "}"
    order = ["line", "pos"]
    deep = running_total(pieces, ["file"], "part", order, F.when(opens, 1).when(closes, -1).otherwise(0), "_depth")
    outside = F.col("_depth") == 0
    # The objects begun before a piece number them; the brace that begins one counts for itself.
    numbered = running_total(deep, ["file"], "part", order, F.when(outside & opens, 1).otherwise(0), "_begun")
    place = F.struct("part", *order)
    inside = numbered.where(~outside | opens).withColumn("_record", F.col("_begun") + F.when(outside, 1).otherwise(0))
    parts = F.array_sort(F.collect_list(F.struct(place.alias("place"), "piece")))
    records = inside.groupBy("file", "_record").agg(
        F.array_join(F.transform(parts, lambda p: p["piece"]), "").alias("object"),
        F.sum(F.when(opens, 1).when(closes, -1).otherwise(0)).alias("left_open"),
    )
    whole = F.when(F.col("left_open") == 0, F.col("object")).otherwise(_malformed(F.col("file"), F.col("object")))
    # Outside there may be one array's brackets, in this order.
    rest = numbered.where(outside & ~opens).select("file", place.alias("place"), F.regexp_replace("piece", _BETWEEN, "").alias("rest"))
    strange = rest.where("rest <> ''").groupBy("file").agg(
        F.count(F.lit(1)).alias("n"), F.min_by("rest", "place").alias("first"), F.max_by("rest", "place").alias("last")
    )
    both = F.when(F.col("n") == 1, F.col("first")).otherwise(F.concat("first", "last"))
    refused = strange.where((F.col("n") > 2) | (both != "[]")).select(_malformed(F.col("file"), both).cast("string").alias("object"))
    return records.select(whole.alias("object")).unionAll(refused)


def _records(objects: DataFrame, keys: Mapping[str, str], keep: tuple[str, str] | None = None) -> DataFrame:
    """The objects' keys, one column of text each; ``a.b`` is key b of object a.

    With ``keep`` (key, value) only that key is read first, and objects with another value in it are
    left out before anything else of them is.
    """

    def values(wanted: Iterable[str]) -> Column:
        tops = list(dict.fromkeys(key.split(".")[0] for key in wanted))
        schema = T.StructType([T.StructField(top, T.StringType()) for top in tops])
        return F.from_json("object", schema, {"mode": "FAILFAST"})

    def value(record: Column, key: str) -> Column:
        top, _, below = key.partition(".")
        text = record.getField(top)
        return F.get_json_object(text, f"$.{below}") if below else text

    if keep:
        decides = value(values([keep[0]]), keep[0])
        objects = objects.where(F.coalesce(decides, F.lit(keep[1])) == keep[1])  # named once, so parsed once
    parsed = objects.select(values(keys).alias("record"))
    return parsed.select(*[value(F.col("record"), key).alias(key) for key in keys])


def _below(spark: SparkSession, file_glob: str | None) -> DataFrameReader:
    reader = spark.read.option("recursiveFileLookup", True)
    return reader.option("pathGlobFilter", file_glob) if file_glob else reader


def _listed(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def conversions(keys: Mapping[str, str], table: schemas.Table) -> dict[str, Column]:
    """The typed value of each key, from a column of text of that name."""
    types = {c.name: c.type for c in table.columns}
    return {key: coerce_to(F.col(f"`{key}`"), types[name]) for key, name in keys.items()}


def _typed(raw: DataFrame, keys: Mapping[str, str], table: schemas.Table, strict: bool) -> DataFrame:
    columns = []
    for key, typed in conversions(keys, table).items():
        if strict:
            given = F.col(f"`{key}`").cast("string")
            message = F.concat(F.lit(f"{table.name}.{keys[key]} cannot hold "), given)
            stop = F.raise_error(message).cast(table_type(table, keys[key]))
            typed = F.coalesce(typed, F.when(given != "", stop))  # named once, so converted once
        columns.append(typed.alias(keys[key]))
    return raw.select(*columns)


def table_type(table: schemas.Table, name: str) -> T.DataType:
    return next(c.type for c in table.columns if c.name == name)


def typed_log(raw: DataFrame, keys: Mapping[str, str] = LOG_KEYS, strict: bool = False) -> DataFrame:
    """Raw log records -> typed staging columns; ``keys`` maps keys to columns.

    ``strict`` stops at the first value that does not convert, else it becomes NULL.
    """
    return _typed(raw, keys, schemas.STAGING_EVENTS, strict)


def typed_songs(
    raw: DataFrame, numeric_scale: int = 0, keys: Mapping[str, str] = SONG_KEYS, strict: bool = False
) -> DataFrame:
    """Raw catalogue records -> typed staging columns, as ``typed_log`` does it."""
    return _typed(raw, keys, schemas.staging_songs(numeric_scale), strict)


def read_log(
    spark: SparkSession,
    paths: str | Sequence[str],
    file_glob: str | None = None,
    keys: Mapping[str, str] = LOG_KEYS,
    page: str | None = None,
) -> DataFrame:
    """Log files below ``paths``, as text fields: splittable, any number of objects on a line.

    With ``page`` only records of this page, and those without one.
    """
    texts = _below(spark, file_glob).text(_listed(paths))
    key = next((key for key, name in keys.items() if name == "page"), None)
    return _records(_objects(texts), keys, (key, page) if page is not None and key else None)


def read_songs(
    spark: SparkSession,
    paths: str | Sequence[str],
    file_glob: str | None = None,
    one_per_line: bool = False,
    keys: Mapping[str, str] = SONG_KEYS,
    whole_bytes: int | None = None,
) -> DataFrame:
    """Catalogue files below ``paths``, as text fields.

    A file holds any number of objects, over any lines, or arrays of them. Files of up to
    ``whole_bytes`` (``spark.sql.files.maxPartitionBytes`` unless given) are read whole, larger ones by several tasks
    each. With ``one_per_line`` no object goes over a line's end, and files of any size are split.
    """
    reader, listed = _below(spark, file_glob), _listed(paths)
    if one_per_line:
        return _records(_objects(reader.text(listed)), keys)
    limit = _partition_bytes(spark) if whole_bytes is None else whole_bytes
    size = F.col("_metadata.file_size")
    objects = _objects(reader.text(listed, wholetext=True).where(size <= limit))
    large = reader.text(listed).where(size > limit)
    if not large.select("value").isEmpty():
        lines = large.select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("part"),
            F.monotonically_increasing_id().alias("line"),
            "value",
        )
        objects = objects.unionAll(_objects_over_lines(lines))
    return _records(objects, keys)


def _partition_bytes(spark: SparkSession) -> int:
    """``spark.sql.files.maxPartitionBytes`` in bytes."""
    return int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
