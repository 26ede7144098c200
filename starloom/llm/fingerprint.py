"""Threshold-scaled fingerprints: every shingle hash below a fixed bound.

A shingle is five words in a row, its hash 128 bits in hexadecimal. Hashes below the bound, a
sixteenth of all, are kept, however many there are, so fingerprints of texts of very different
lengths can be compared: the share of one text's hashes that another holds estimates how much
of it the other contains. A text with few hashes below the bound keeps its 16 smallest, whatever they
are; a fingerprint thus knows every hash up to a reach of its own, and two are compared up to the
smaller of their reaches. The fingerprint of texts put together follows from theirs alone.

Only DataFrame functions are used.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import settled

#: Words in a shingle.
WORDS = 5
#: Hashes below it are kept: a sixteenth.
BOUND = "1"
#: So many of the smallest are kept at least.
FLOOR = 16
#: What no hash exceeds.
_END = "g"
_BLANKS = r"[\x20\x09-\x0D]+"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also inside of lambdas."""
    return F.transform(F.array(value), body).getItem(0)


def _lowest(hashes: Column, bound: str) -> Column:
    """Of an array of hashes what a fingerprint keeps, in order."""
    below = F.array_sort(F.array_distinct(F.filter(hashes, lambda h: h < bound)))
    some = F.slice(F.array_sort(F.array_distinct(hashes)), 1, FLOOR)
    return _let(below, lambda kept: F.when(F.size(kept) >= FLOOR, kept).otherwise(some))


def sketch(text: Column, words: int = WORDS, bound: str = BOUND) -> Column:
    """The kept hashes of a text, in order: an array of strings.

    Null counts as empty. A text of fewer words is one shingle, one without words has none and an empty
    fingerprint. Words are what stands between blanks, compared as they are.
    """

    def hashed(found: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(found) - (words - 1), F.lit(1)))
        shingles = F.transform(starts, lambda k: F.md5(F.array_join(F.slice(found, k, words), " ")))
        return F.when(F.size(found) > 0, shingles).otherwise(F.array().cast("array<string>"))

    split = F.array_remove(F.split(F.coalesce(text, F.lit("")), _BLANKS), "")
    return _let(_let(split, hashed), lambda hashes: _lowest(hashes, bound))


def merged(one: Column, other: Column, bound: str = BOUND) -> Column:
    """The fingerprint of all shingles of two texts, from their fingerprints."""
    end = _reach_of_both(one, other, bound)
    return _lowest(F.filter(F.array_union(one, other), lambda h: h <= end), bound)


def _reach(kept: Column, bound: str) -> Column:
    """Up to where a fingerprint knows all hashes of its text."""
    last = F.greatest(F.element_at(kept, FLOOR), F.lit(bound))
    return F.when(F.size(kept) < FLOOR, _END).when(F.size(kept) == FLOOR, last).otherwise(bound)


def _reach_of_both(one: Column, other: Column, bound: str) -> Column:
    return F.least(_reach(one, bound), _reach(other, bound))


def containment(one: Column, other: Column, bound: str = BOUND) -> Column:
    """The share of the first text's hashes that the second holds, from 0 to 1.

    Equal fingerprints give 1; nothing to compare otherwise gives 0.
    """
    known = _let(_reach_of_both(one, other, bound), lambda end: F.filter(one, lambda h: h <= end))
    share = _let(known, lambda own: F.when(F.size(own) > 0, F.size(F.array_intersect(own, other)) / F.size(own)))
    return F.when(one == other, 1.0).otherwise(F.coalesce(share, F.lit(0.0)))


def shown(kept: Column) -> Column:
    """A fingerprint as text: its hashes, joined."""
    return F.array_join(kept, ",")


_KEY = "known boolean, id long, place long"


def _bucket(key: Column, bounds: list[tuple]) -> Column:
    """The number of bounds up to a key; looked up in every n-th first, then between two of those."""
    step = max(int(len(bounds) ** 0.5), 1)

    def listed(some: list[tuple]) -> Column:
        rows = [{"known": known, "id": id_, "place": place} for known, id_, place in some]
        return F.from_json(F.lit(json.dumps(rows)), f"array<struct<{_KEY.replace(' ', ':')}>>".replace(",:", ","))

    def upto(some: Column, one: Column) -> Column:
        return F.size(F.filter(some, lambda b: b <= one))

    def found(one: Column) -> Column:
        return _let(
            (upto(listed(bounds[::step]), one) - 1) * step,
            lambda before: before + upto(F.slice(listed(bounds), before + 1, step), one),
        )

    return _let(key, found)


def with_next(docs: DataFrame, order: str, carried: dict[str, Column]) -> DataFrame:
    """Every row with the columns ``carried``, and ``next_...`` of the row after it, by rising ``order``.

    The last row is followed by the first. Rows are dealt into ranges; the first row of each stands
    once more at the end of the range before it, so that rows are shuffled once and no task sees more
    than a range. Nulls come first; rows of one value follow one another as they are read.
    """
    id_ = F.col(order)
    key = F.struct(
        id_.isNotNull().alias("known"), F.coalesce(id_, F.lit(0)).cast("long").alias("id"), F.monotonically_increasing_id().alias("place")
    )
    keyed = settled(docs).withColumn("_key", key)
    ranges = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # One row per range: the least key in it.
    least = keyed.select("_key").repartitionByRange(ranges, "_key").groupBy(F.spark_partition_id()).agg(F.min("_key").alias("_key"))
    bounds = sorted(tuple(row["_key"]) for row in least.collect())
    if not bounds:
        return docs.withColumns(carried | {f"next_{name}": value for name, value in carried.items()})
    before = [(*key, (n - 1) % len(bounds) + 1 if n else len(bounds)) for n, key in enumerate(bounds)]
    firsts = docs.sparkSession.createDataFrame(before, f"{_KEY}, _range int").select(
        F.struct("known", "id", "place").alias("_key"), "_range"
    )
    own = keyed.withColumn("_range", _bucket(F.col("_key"), bounds)).withColumn("_again", F.lit(False))
    again = keyed.join(F.broadcast(firsts), "_key").withColumn("_again", F.lit(True))
    both = own.unionByName(again.select(*own.columns)).withColumns(carried)
    following = Window.partitionBy("_range").orderBy("_again", "_key")
    led = {f"next_{name}": F.lead(name).over(following) for name in carried}
    return both.withColumns(led).where(~F.col("_again")).drop("_again", "_range", "_key")


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) per document.

    The edited text is the document with its last half replaced by the beginning of the next document
    by id (the first follows the last). ``near_edited`` and ``near_next`` are the shares of the document
    that, by their fingerprints, the edited text and the next document contain.

    Every row has a result, also repeated ones; null texts count as empty, and empty texts are alike
    wholly. Null ids come first, rows of one id follow one another as they are read. Texts of any length
    are hashed whole, in a time that grows with their length. An empty table gives no rows. Other
    columns are not read, whatever their names.
    """
    plain = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text")
    )
    beside = with_next(plain, "id", {"text": F.col("text"), "kept": sketch(F.col("text"))})
    n_chars = F.char_length("text")
    half = F.floor(n_chars / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n_chars - half), F.substring("next_text", F.lit(1), half))
    changed = beside.select("id", n_chars.cast("long").alias("n_chars"), "kept", "next_kept", edited.alias("edited"))
    hashed = changed.select(
        "id", "n_chars", "kept", "next_kept", F.sha2("edited", 256).alias("edited_sha256"), sketch(F.col("edited")).alias("edited_kept")
    )
    return hashed.select(
        F.col("id").alias(id_column),
        "n_chars",
        "edited_sha256",
        shown(F.col("kept")).alias("fingerprint"),
        shown(F.col("edited_kept")).alias("edited_fingerprint"),
        containment(F.col("kept"), F.col("edited_kept")).alias("near_edited"),
        containment(F.col("kept"), F.col("next_kept")).alias("near_next"),
    )
