"""Exact top-k by inner product, pruned by segment statistics from coarse to fine.

A vector is cut into segments. Of each segment the mean and the deviation from it bound what the
segment can add to an inner product (Cauchy-Schwarz on the deviations), which is the same as a
lower bound on the distance. Pairs are bounded with few long segments first, then with more and
shorter ones; only pairs that can still be among a query's best are computed exactly.

Vectors are packed into blocks, which are written once and dealt into parts. Queries, a fraction of the
rows, are the side that is repeated: every group of them passes every part, and a part's blocks are held
while the groups stream past. A group keeps its best so far from block to block. Before that each group
meets the blocks of one part alone; the k-th best score there is a floor that its full pass starts from.
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

#: Vectors in a block of queries and of candidates, and bytes of candidates in a part.
QUERY_BLOCK = 512
BLOCK = 8192
PART_BYTES = 16 << 20
#: Bytes of unpacked blocks that a task holds.
HELD_BYTES = 128 << 20
#: Segments on each level.
LEVELS = (4, 16)
_EXACT = 2.0**53


def _statistics(rows: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Means and root sums of squared deviations of each segment, both scaled by the root of its length."""
    width = rows.shape[1]
    cuts = np.unique(np.linspace(0, width, segments + 1).astype(int))
    sizes = np.diff(cuts)
    means = np.add.reduceat(rows, cuts[:-1], axis=1) / sizes
    squares = np.add.reduceat((rows - np.repeat(means, sizes, axis=1)) ** 2, cuts[:-1], axis=1)
    return means * np.sqrt(sizes), np.sqrt(squares)


def _products(rows: np.ndarray, query: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products of rows with a query, in whole numbers."""
    if exact:
        return (rows @ query).astype(np.int64)
    own = [int(x) for x in query]
    whole = [sum(int(x) * y for x, y in zip(row, own, strict=True)) for row in rows]
    return np.array([min(max(x, -(1 << 63)), (1 << 63) - 1) for x in whole], np.int64)


class Block:
    """Vectors of one width by ascending id, with their statistics on every level."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, levels: tuple = LEVELS):
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], rows[order]
        width = rows.shape[1]
        self.levels = [_statistics(self.rows, s) for s in levels if s < width] if width else []
        self.longest = float(np.sqrt((self.rows**2).sum(1)).max(initial=0))


class Best:
    """The k best rows of a query so far: by falling score, then rising id; ``floor`` is a score they reach."""

    def __init__(self, k: int, floor: int | None):
        self.k, self.floor = k, floor
        self.ids, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def least(self) -> float:
        """No score below it can change anything."""
        own = int(self.scores[-1]) if len(self.scores) == self.k else None
        known = [x for x in (own, self.floor) if x is not None]
        return float(max(known)) if known else -np.inf

    def take(self, ids: np.ndarray, scores: np.ndarray) -> None:
        ids, scores = np.concatenate([self.ids, ids]), np.concatenate([self.scores, scores])
        order = np.lexsort((ids, ~scores))[: self.k]
        self.ids, self.scores = ids[order], scores[order]


def meet(queries: Block, bests: list[Best], block: Block) -> None:
    """Lets each query take what is among its best from a block, but rows of its own id."""
    limit = queries.longest * block.longest
    exact = limit < _EXACT
    margin = 1e-9 * limit + 1e-6
    bounded = exact and bool(block.levels)
    if bounded:
        (qm, qd), (rm, rd) = queries.levels[0], block.levels[0]
        coarse = qm @ rm.T + qd @ rd.T
    for n, best in enumerate(bests):
        fits = block.ids != queries.ids[n]
        if bounded and len(best.scores) < best.k and len(block.ids) > 8 * best.k:  # first some likely ones, for a floor
            bound = np.where(fits, coarse[n], -np.inf)
            likely = np.argpartition(-bound, 4 * best.k)[: 4 * best.k]
            likely = likely[fits[likely]]
            best.take(block.ids[likely], _products(block.rows[likely], queries.rows[n], exact))
            fits[likely] = False
        if bounded:
            least = best.least() - margin
            left = np.flatnonzero(fits & (coarse[n] >= least))
            for (qm, qd), (rm, rd) in zip(queries.levels[1:], block.levels[1:], strict=True):
                left = left[rm[left] @ qm[n] + rd[left] @ qd[n] >= least]
        else:
            left = np.flatnonzero(fits)
        if len(left):
            best.take(block.ids[left], _products(block.rows[left], queries.rows[n], exact))


def whole_numbers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component as a double."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double"))


_PACKED = "number long, width int, kind string, ids binary, rows binary"


def _packed(vectors: DataFrame, size: int) -> DataFrame:
    """(id, row) packed by width, in the smallest kind of number that holds the rows, and written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}
        made = TaskContext.get().partitionId() << 32
        names = [x.split()[0] for x in _PACKED.split(", ")]
        kinds = (pa.int64(), pa.int32(), pa.string(), pa.binary(), pa.binary())

        def block(width: int) -> pa.RecordBatch:
            nonlocal made
            ids, rows = held.pop(width)
            rows = np.array(rows, np.float64).reshape(len(ids), width)
            most = float(np.abs(rows).max(initial=0.0))
            kind = "int16" if most < 1 << 15 else "int32" if most < 1 << 31 else "float64"
            made += 1
            columns = [made, width, kind, np.array(ids, np.int64).tobytes(), rows.astype(kind).tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            for one, row in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                row = row.values.to_numpy(zero_copy_only=False)
                ids, rows = held.setdefault(len(row), ([], []))
                ids.append(one)
                rows.append(row)
                if len(ids) == size:
                    yield block(len(row))
        for width in list(held):
            yield block(width)

    return stored(vectors.mapInArrow(run, _PACKED))


def _best(groups: DataFrame, waiting: DataFrame, k: int, levels: tuple) -> DataFrame:
    """(number, place, query_id, id, score): per part, the k best rows of each query.

    ``groups`` and ``waiting`` have the column ``part``, by which they meet; ``floors`` of a group has per
    place a score that its k best reach, or null.
    """
    waiting = waiting.select("part", "width", *[F.col(c).alias(f"b_{c}") for c in ("number", "kind", "ids", "rows")])
    # A merge join holds the matches of its right side, here a part's blocks, and streams its left side.
    met = groups.hint("merge").join(waiting, ["part", "width"])
    columns = ["part", "number", "width", "kind", "ids", "rows", "floors", "b_number", "b_kind", "b_ids", "b_rows"]
    names = ["number", "place", "query_id", "id", "score"]

    def unpacked(width: int, kind: pa.Scalar, ids: pa.Scalar, rows: pa.Scalar) -> Block:
        ids = np.frombuffer(ids.as_buffer(), np.int64)
        rows = np.frombuffer(rows.as_buffer(), kind.as_py()).astype(np.float64)
        return Block(ids, rows.reshape(len(ids), width), levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks_of: dict[int, Block] = {}
        at, queries, bests = None, None, []

        def found() -> Iterator[pa.RecordBatch]:
            counts = [len(best.ids) for best in bests]
            if sum(counts):
                places = np.repeat(np.arange(len(bests)), counts)
                cells = [
                    np.full(len(places), at[1]),
                    places,
                    queries.ids[places],
                    np.concatenate([best.ids for best in bests]),
                    np.concatenate([best.scores for best in bests]),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in cells], names)

        for batch in batches:
            for part, number, width, kind, ids, rows, floors, b_number, *b in zip(*batch.columns, strict=True):
                width, b_number = width.as_py(), b_number.as_py()
                if (part.as_py(), number.as_py()) != at:
                    yield from found()
                    at = part.as_py(), number.as_py()
                    queries = unpacked(width, kind, ids, rows)
                    # A place is one in the order of ids, which is that of the group unpacked.
                    bests = [Best(k, floor) for floor in floors.as_py() or [None] * len(queries.ids)]
                if b_number not in blocks_of:
                    if sum(x.rows.nbytes for x in blocks_of.values()) > HELD_BYTES:
                        blocks_of.clear()
                    blocks_of[b_number] = unpacked(width, *b)
                meet(queries, bests, blocks_of[b_number])
        yield from found()

    return met.select(*columns).mapInArrow(run, ", ".join(f"{name} long" for name in names))


def top_k(
    vectors: DataFrame,
    k: int = 10,
    every: int = 100,
    scale: int = 1024,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    levels: tuple = LEVELS,
    candidate_block: int = BLOCK,
) -> DataFrame:
    """(query_id, rank, id, score): the k best candidates of each query, in whole numbers.

    Components become floor(scale * x). Queries are the rows whose id is divisible by ``every``,
    candidates all rows of the same width but those of the query's own id. Ties go to smaller ids; a
    query with fewer candidates has them all. Null vectors, vectors with null or non-finite components
    and null ids take no part. Of repeated rows of one id each is a candidate; a query is asked once
    per different vector of its id and keeps its best k of all. Scores beyond 64 bits are cut to their
    range. Other columns are not read. An empty table gives no rows.
    """
    ship(vectors.sparkSession)
    vector = F.col(vector_column)
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    )
    usable = vectors.where(F.col(id_column).isNotNull() & vector.isNotNull() & finite).select(
        F.col(id_column).cast("long").alias("id"), whole_numbers(vector, scale).alias("row")
    )
    blocks = _packed(usable, candidate_block)
    n_bytes = blocks.agg(F.sum(F.octet_length("rows"))).first()[0] or 0
    parts = max(int(n_bytes // PART_BYTES) + 1, int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    waiting = blocks.withColumn("part", F.pmod(F.xxhash64("number"), F.lit(parts)))
    queries = usable.where(F.col("id") % every == 0).distinct()
    # Groups of rows that a hash deals evenly; their number follows that of the queries.
    n_groups = int(queries.count() // QUERY_BLOCK + 1)
    groups = _packed(queries.repartition(n_groups, F.xxhash64("id")), QUERY_BLOCK)

    # A query is known by its group and its place there. Any k scores of it give a floor for its best.
    unknown = F.lit(None).cast("array<long>")
    one_part = groups.withColumn("part", F.pmod(F.xxhash64("number", F.lit(1)), F.lit(parts))).withColumn("floors", unknown)
    first = _best(one_part, waiting, k, levels).groupBy("number", "place").agg(F.min("score").alias("floor"), F.count(F.lit(1)).alias("n"))
    floors = first.where(F.col("n") == k).groupBy("number").agg(F.map_from_entries(F.collect_list(F.struct("place", "floor"))).alias("floors"))
    places = F.sequence(F.lit(0).cast("long"), (F.octet_length("ids") / 8).cast("long") - 1)
    known = F.transform(places, lambda place: F.element_at("floors", place))
    floored = stored(groups.join(floors, "number", "left").withColumn("floors", known))
    turns = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))
    best = _best(floored.withColumn("part", turns), waiting, k, levels)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_column if id_column != "query_id" else "id"), "score")
