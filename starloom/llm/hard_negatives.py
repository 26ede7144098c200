"""Hard negatives: for each anchor and each of its positives, the best rows of other labels in a band of scores.

Vectors are cut into segments, and of each segment its mean and deviation are stored. The product
of two vectors lies within the product of their segments' means plus or minus the product of their
deviations. Pairs are bounded with few long segments first and with more and shorter ones for those
that are left; only pairs that can still be among the best of a band are scored exactly.

All rows are packed into blocks, which are written once. Anchors, a fraction of the rows, are the side
that is repeated: every group of anchors passes every part of the blocks, and a part's blocks are held
while the groups stream past. A group keeps its best so far from block to block, so later blocks are
cut by what earlier ones gave. The same pass runs twice: for the positives, whose band is open and
whose label is the anchor's, and for the negatives, in the bands that the positives give.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starloom.llm.tables import ship, stored
from starloom.llm.topk import whole_numbers

#: Rows in a block, anchors in a group, and bytes of blocks in a part.
BLOCK, GROUP, PART_BYTES = 8192, 512, 16 << 20
#: Bytes of unpacked blocks that a task holds.
HELD_BYTES = 128 << 20
#: Segments, from coarse to fine.
LEVELS = (4, 16)
#: Scores below it are whole numbers as doubles.
_EXACT = 2.0**53
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def summary(rows: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row's segments the means and the deviations, so scaled that their products add up to bounds."""
    cuts = np.unique(np.linspace(0, rows.shape[1], segments + 1).astype(int))
    sizes = np.diff(cuts)
    means = np.add.reduceat(rows, cuts[:-1], axis=1) / sizes
    rest = rows - np.repeat(means, sizes, axis=1)
    return means * np.sqrt(sizes), np.sqrt(np.add.reduceat(rest * rest, cuts[:-1], axis=1))


class Block:
    """Rows of one width in order of their ids, with their summaries on every level."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.rows = ids[order], labels[order], rows[order]
        width = rows.shape[1]
        self.levels = [summary(self.rows, s) for s in LEVELS if s < width]
        self.longest = float(np.sqrt((self.rows**2).sum(1)).max(initial=0.0))


class Best:
    """Of one anchor and each of its bands the best rows so far, by falling score, then rising id."""

    def __init__(self, k: int, lows: list[int], highs: list[int]):
        self.k, self.lows, self.highs = k, lows, highs
        self.ids = [np.zeros(0, np.int64) for _ in lows]
        self.scores = [np.zeros(0, np.int64) for _ in lows]

    def wanted(self) -> tuple[int, int]:
        """The scores that can change anything: from, to."""
        floors = [max(low, int(s[-1])) if len(s) == self.k else low for low, s in zip(self.lows, self.scores, strict=True)]
        return min(floors), max(self.highs)

    def take(self, ids: np.ndarray, scores: np.ndarray) -> None:
        for n, (low, high) in enumerate(zip(self.lows, self.highs, strict=True)):
            fits = (scores >= low) & (scores <= high)
            if not fits.any():
                continue
            all_ids = np.concatenate([self.ids[n], ids[fits]])
            all_scores = np.concatenate([self.scores[n], scores[fits]])
            if len(all_scores) > 4 * self.k:
                least = np.partition(all_scores, len(all_scores) - self.k)[-self.k]
                near = all_scores >= least
                all_ids, all_scores = all_ids[near], all_scores[near]
            order = np.lexsort((all_ids, ~all_scores))[: self.k]
            self.ids[n], self.scores[n] = all_ids[order], all_scores[order]


def _exact(rows: np.ndarray, anchor: np.ndarray, limit: float) -> np.ndarray:
    if limit < _EXACT:
        return (rows @ anchor).astype(np.int64)
    whole = [int(x) for x in anchor]
    sums = [sum(int(x) * y for x, y in zip(row, whole, strict=True)) for row in rows]
    return np.array([min(max(s, _LEAST), _MOST) for s in sums], np.int64)


def meet(anchors: Block, bests: list[Best | None], block: Block, same: bool) -> None:
    """Lets a group of anchors take what they want from a block, of their label or of the others."""
    limit = anchors.longest * block.longest
    margin = 1e-9 * limit + 1e-6
    bounded = bool(block.levels) and limit < _EXACT
    if bounded:
        (am, ad), (bm, bd) = anchors.levels[0], block.levels[0]
        middle, reach = am @ bm.T, ad @ bd.T + margin
    for n, best in enumerate(bests):
        if best is None:
            continue
        fits = (block.labels == anchors.labels[n]) if same else (block.labels != anchors.labels[n])
        fits &= block.ids != anchors.ids[n]
        if bounded:
            low, high = best.wanted()
            fits &= (middle[n] + reach[n] >= low) & (middle[n] - reach[n] <= high)
            if len(best.lows) == 1 and len(best.scores[0]) < best.k:  # first a few likely ones, for a floor
                found = np.flatnonzero(fits)
                if len(found) > 8 * best.k:
                    likely = found[np.argpartition(-middle[n][found], 4 * best.k)[: 4 * best.k]]
                    best.take(block.ids[likely], _exact(block.rows[likely], anchors.rows[n], limit))
                    fits[likely] = False
                    fits &= middle[n] + reach[n] >= best.wanted()[0]
        left = np.flatnonzero(fits)
        if bounded:
            low, high = best.wanted()
            for (am, ad), (bm, bd) in zip(anchors.levels[1:], block.levels[1:], strict=True):
                centre, spread = bm[left] @ am[n], bd[left] @ ad[n] + margin
                left = left[(centre + spread >= low) & (centre - spread <= high)]
        if len(left):
            best.take(block.ids[left], _exact(block.rows[left], anchors.rows[n], limit))


_PACKED = "number long, width int, kind string, ids binary, labels binary, rows binary"


def _packed(vectors: DataFrame, size: int) -> DataFrame:
    """(id, label, row) packed by width, in the smallest kind of number that holds the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        made = TaskContext.get().partitionId() << 32
        names = [x.split()[0] for x in _PACKED.split(", ")]
        kinds = (pa.int64(), pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.binary())

        def block(width: int) -> pa.RecordBatch:
            nonlocal made
            ids, labels, rows = zip(*held.pop(width), strict=True)
            rows = np.array(rows, np.float64).reshape(len(ids), width)
            most = float(np.abs(rows).max(initial=0.0))
            kind = "int16" if most < 1 << 15 else "int32" if most < 1 << 31 else "float64"
            made += 1
            columns = [made, width, kind, np.array(ids, np.int64).tobytes(), np.array(labels, np.int64).tobytes(), rows.astype(kind).tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            ids, labels, rows = batch.columns
            for id_, label, row in zip(ids.to_pylist(), labels.to_pylist(), rows, strict=True):
                row = row.values.to_numpy(zero_copy_only=False)
                held.setdefault(len(row), []).append((id_, label, row))
                if len(held[len(row)]) == size:
                    yield block(len(row))
        for width in list(held):
            yield block(width)

    return stored(vectors.mapInArrow(run, _PACKED))


def _unpacked(width: int, kind: str, ids: bytes, labels: bytes, rows: bytes) -> Block:
    ids = np.frombuffer(ids, np.int64)
    return Block(ids, np.frombuffer(labels, np.int64), np.frombuffer(rows, kind).astype(np.float64).reshape(len(ids), width))


def _best(groups: DataFrame, blocks: DataFrame, parts: int, k: int, same: bool) -> DataFrame:
    """(number, place, anchor_id, band, id, score, rank): the k best rows per anchor and band.

    ``groups`` has in ``bands`` an array per anchor of (low, high), null for all scores.
    """
    turns = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))
    passing = groups.withColumn("part", turns)
    waiting = blocks.withColumn("part", F.pmod(F.xxhash64("number"), F.lit(parts)))
    waiting = waiting.select("part", "width", *[F.col(c).alias(f"b_{c}") for c in ("number", "kind", "ids", "labels", "rows")])
    # A merge join holds the matches of its right side, here a part's blocks, and streams its left side.
    met = passing.hint("merge").join(waiting, ["part", "width"])
    names = ["number", "place", "anchor_id", "band", "id", "score"]
    columns = ["number", "width", "kind", "ids", "labels", "rows", "bands", "b_number", "b_kind", "b_ids", "b_labels", "b_rows"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks_of: dict[int, Block] = {}
        number, anchors, bests = None, None, []

        def found() -> Iterator[pa.RecordBatch]:
            rows = []
            for place, best in enumerate(bests):
                for band in range(len(best.lows) if best else 0):
                    same_in_all = (number, place, int(anchors.ids[place]), band)
                    rows += [(*same_in_all, id_, score) for id_, score in zip(best.ids[band].tolist(), best.scores[band].tolist(), strict=True)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], names)

        for batch in batches:
            numbers, b_numbers = batch.column(0).to_pylist(), batch.column(7).to_pylist()
            for n in range(batch.num_rows):
                at = [c[n] for c in batch.columns]
                width = at[1].as_py()
                if numbers[n] != number:
                    yield from found()
                    number = numbers[n]
                    anchors = _unpacked(width, at[2].as_py(), *[x.as_buffer() for x in at[3:6]])
                    given = at[6].as_py()
                    # The group's rows were put in order of their ids; the bands came in that order.
                    bests = [
                        Best(k, [_LEAST], [_MOST]) if given is None else (Best(k, [b["low"] for b in own], [b["high"] for b in own]) if own else None)
                        for own in (given or [None] * len(anchors.ids))
                    ]
                if b_numbers[n] not in blocks_of:
                    if sum(b.rows.nbytes for b in blocks_of.values()) > HELD_BYTES:
                        blocks_of.clear()
                    blocks_of[b_numbers[n]] = _unpacked(width, at[8].as_py(), *[x.as_buffer() for x in at[9:12]])
                meet(anchors, bests, blocks_of[b_numbers[n]], same)
        yield from found()

    best = met.select(*columns).mapInArrow(run, ", ".join(f"{name} long" for name in names))
    order = Window.partitionBy("number", "place", "band").orderBy(F.desc("score"), "id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def shifted_label(id_: Column, label: Column, every: int = 7, labels: int = 10) -> Column:
    """The next of so many labels where the id is divisible by ``every``."""
    return F.when(id_ % every == 0, (label.cast("long") + 1) % labels).otherwise(label.cast("long"))


def hard_negatives(
    vectors: DataFrame,
    positives: int = 5,
    negatives: int = 3,
    every: int = 50,
    scale: int = 256,
    low: int = 50,
    high: int = 95,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label: Column | None = None,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components become floor(scale * x); a score is the inner product with the anchor. Anchors are rows
    whose id is divisible by ``every``, their positives the ``positives`` best other rows of the same
    label. A negative's score is between ``low`` and ``high`` percent of the positive's; the best
    ``negatives`` of other labels are returned. Ties go to smaller ids. ``label`` is the column ``label``
    unless given.

    Rows with a null id, label, vector or component, or a component that is not finite, take no part; only
    rows of one width meet. Repeated rows each count, but rows of an anchor's own id are neither its
    positives nor its negatives, and an anchor that stands there several times alike is asked once. An
    anchor without other rows of its label, and a positive without rows in its band, have no rows; so has an
    empty table. Scores beyond 64 bits are cut to their range. Other columns are not read.
    """
    spark = vectors.sparkSession
    ship(spark)
    id_, vector = F.col(f"`{id_column}`").cast("long"), F.col(f"`{vector_column}`")
    label = F.col("label") if label is None else label
    fine = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    rows = vectors.where(id_.isNotNull() & label.isNotNull() & vector.isNotNull() & fine).select(
        id_.alias("id"), label.cast("long").alias("label"), whole_numbers(vector, scale).alias("row")
    )
    blocks = _packed(rows, BLOCK)
    n_bytes = blocks.agg(F.sum(F.octet_length("rows"))).first()[0] or 0
    parts = max(int(n_bytes // PART_BYTES) + 1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    asked = rows.where(F.col("id") % every == 0).distinct()
    n_groups = asked.count() // GROUP + 1
    groups = _packed(asked.repartition(int(n_groups), F.xxhash64("id")), GROUP)

    # An anchor is known by its group and its place in the order of the group's ids.
    open_ = groups.withColumn("bands", F.lit(None).cast("array<array<struct<low:long,high:long>>>"))
    own = stored(_best(open_, blocks, parts, positives, same=True).select("number", "place", "rank", "id", "score"))

    def band_end(percent: int, up: bool) -> Column:
        """Of positive scores, in whole numbers: the least score at or above, or the most at or below."""
        exact = F.col("score").cast("decimal(20,0)") * percent
        whole = F.ceil(exact / 100) if up else F.floor(exact / 100)
        return whole.cast("long")

    bands = own.groupBy("number", "place").agg(
        F.array_sort(F.collect_list(F.struct("rank", band_end(low, True).alias("low"), band_end(high, False).alias("high")))).alias("own")
    )
    per_group = bands.groupBy("number").agg(F.collect_list(F.struct("place", "own")).alias("all"))
    n_anchors = (F.octet_length("ids") / 8).cast("int")
    mine = F.map_from_entries("all")
    wanted = F.transform(
        F.sequence(F.lit(0).cast("long"), n_anchors.cast("long") - 1),
        lambda place: F.transform(F.coalesce(F.element_at(mine, place), F.array()), lambda b: F.struct(b["low"].alias("low"), b["high"].alias("high"))),
    )
    banded = groups.join(per_group, "number").withColumn("bands", wanted).drop("all")
    others = _best(stored(banded), blocks, parts, negatives, same=False).withColumnsRenamed({"id": "negative_id", "score": "negative_score"})
    positive = own.select("number", "place", (F.col("rank") - 1).cast("long").alias("band"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    found = others.join(positive, ["number", "place", "band"])
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")

