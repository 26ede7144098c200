"""Quality classifier: random-indexing word vectors, pooled per text, and a two-layer network.

Every token has a sparse random index vector, fixed by its hash. The vector of a token is the sum of
the index vectors of its neighbours in all texts, so tokens of like surroundings have like
vectors; tokens share a table of fixed size by hash. A text is the mean of its tokens' vectors and
of its tokens' own index vectors, and a few rates. A network of two layers, in numpy, gives a
logit, which a temperature fitted on a part of the training rows turns into a probability.

Only the training rows are a sample, of a documented number at most; every text is scored whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.bytewise import BLANK, LOWER, cache_of, mix, row_bounds, slices, span_hashes, words
from starloom.llm.tables import beside, carried, quoted, ship, stored

#: Labelled rows that are learned from at most, those of the smallest hashes.
TRAIN_ROWS = 12_000
#: Rows of the table of token vectors, their width, and entries that are not 0 in an index vector.
BUCKETS, WIDTH, SPARSE = 1 << 14, 48, 4
#: Neighbours on either side.
REACH = 2
#: Tokens whose neighbours are added up at a time, and tasks that add up the sums of all tasks.
CONTEXT_TOKENS, ADDERS = 1 << 16, 16
HIDDEN, ROUNDS, BATCH, RATE = 32, 40, 256, 3e-3
EXTRA = 10


def index_entries() -> tuple[np.ndarray, np.ndarray]:
    """Of the random index vector of every bucket the places of its SPARSE entries, and these: 1 or -1."""
    rows = np.arange(BUCKETS, dtype=np.uint64)
    drawn = [mix(rows * np.uint64(SPARSE) + np.uint64(k + 1)) for k in range(SPARSE)]
    places = np.stack([(d % np.uint64(WIDTH)).astype(np.int64) for d in drawn], axis=1)
    return places, np.stack([np.where(d >> np.uint64(63), 1.0, -1.0) for d in drawn], axis=1)


def index_vectors() -> np.ndarray:
    """The random index vector of every bucket, written out."""
    out = np.zeros((BUCKETS, WIDTH), np.float32)
    for place, sign in zip(*(x.T for x in index_entries()), strict=True):
        out[np.arange(BUCKETS), place] += sign.astype(np.float32)
    return out


def _token_buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket, last byte and row of each token: a run between blanks, letters in lower case."""
    starts, ends, row = words(data, offsets, BLANK)
    return (span_hashes(LOWER[data], starts, ends) % np.uint64(BUCKETS)).astype(np.int64), ends - 1, row


def token_rows(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket of each token, rates) of each text.

    Rates are about form: length, the parts of bytes that are capitals, digits, marks or blanks, the
    part of tokens that repeat the one before, that differ at all, that end in a mark, and the mean
    length of tokens and lines.
    """
    for first, end, data, offsets in slices(texts):
        buckets, last, row = _token_buckets(data, offsets)
        capital = (data >= 65) & (data <= 90)
        digit = (data >= 48) & (data <= 57)
        mark = (data < 128) & ~BLANK[data] & ~digit & ~capital & ~((data >= 97) & (data <= 122))
        flags = {"capital": capital, "digit": digit, "mark": mark, "blank": BLANK[data], "line": data == 10}
        marked = mark[last]
        same = np.zeros(len(buckets), bool)
        same[1:] = (buckets[1:] == buckets[:-1]) & (row[1:] == row[:-1])
        bounds = row_bounds(row, end - first).tolist()
        for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
            low, high = int(offsets[k]), int(offsets[k + 1])
            size, count = max(1, high - low), max(1, b - a)
            found = {name: np.count_nonzero(flag[low:high]) for name, flag in flags.items()}
            tokens = buckets[a:b]
            rates = [
                np.log1p(high - low) / 10,
                *[found[name] / size for name in ("capital", "digit", "mark", "blank")],
                np.count_nonzero(same[a:b]) / count,
                len(np.unique(tokens)) / count,
                np.count_nonzero(marked[a:b]) / count,
                min(size / count, 50) / 50,
                min(size / (found["line"] + 1), 2000) / 2000,
            ]
            yield tokens, np.array(rates, np.float32)


def context_sums(texts: pa.Array, into: np.ndarray) -> None:
    """Adds the index vectors of each token's neighbours in its text to the row of its bucket; whole numbers."""
    places, signs = _entries()
    for _, _, data, offsets in slices(texts):
        buckets, _, row = _token_buckets(data, offsets)
        for begin in range(0, len(buckets), CONTEXT_TOKENS):
            some, of = (x[begin : begin + CONTEXT_TOKENS + REACH] for x in (buckets, row))
            cells, values = [], []
            for gap in range(1, REACH + 1):
                # Pairs belong to the run in which the first of the two lies.
                near = np.flatnonzero(of[gap:] == of[:-gap])
                near = near[near < CONTEXT_TOKENS]
                left, right = some[near], some[near + gap]
                for token, neighbour in ((left, right), (right, left)):
                    cells.append((token[:, None] * WIDTH + places[neighbour]).ravel())
                    values.append(signs[neighbour].ravel())
            if cells:
                into += np.bincount(np.concatenate(cells), np.concatenate(values), len(into)).astype(np.int64)


def pooled(tokens: np.ndarray, rates: np.ndarray, vectors: np.ndarray, indexes: np.ndarray) -> np.ndarray:
    """A text as one vector; one without tokens has zeros for its tokens."""
    if not len(tokens):
        return np.concatenate((np.zeros(2 * WIDTH, np.float32), rates))
    if len(tokens) > BUCKETS:
        counts = np.bincount(tokens, minlength=BUCKETS) / len(tokens)
        return np.concatenate((counts @ vectors, counts @ indexes, rates)).astype(np.float32)
    return np.concatenate((vectors[tokens].mean(0), indexes[tokens].mean(0), rates))


@dataclass
class Network:
    """Two layers: tanh, then a logit; ``temperature`` divides the logit."""

    shift: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, rows: np.ndarray) -> np.ndarray:
        hidden = np.tanh((rows - self.shift) / self.scale @ self.w1 + self.b1)
        return hidden @ self.w2 + self.b2

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(rows) / self.temperature, -40, 40)))


def train(rows: np.ndarray, marks: np.ndarray, weights: np.ndarray, seed: int = 7) -> Network:
    """Fits the network by Adam to the weighted cross-entropy."""
    random = np.random.default_rng(seed)
    shift, scale = rows.mean(0), rows.std(0) + 1e-4
    scaled = (rows - shift) / scale
    parts = [
        random.normal(0, 1 / np.sqrt(rows.shape[1]), (rows.shape[1], HIDDEN)),
        np.zeros(HIDDEN),
        random.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN),
        np.zeros(1),
    ]
    first, second, step = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts], 0
    for _ in range(ROUNDS):
        order = random.permutation(len(rows))
        for begin in range(0, len(rows), BATCH):
            taken = order[begin : begin + BATCH]
            x, y, w = scaled[taken], marks[taken], weights[taken]
            hidden = np.tanh(x @ parts[0] + parts[1])
            out = 1 / (1 + np.exp(-np.clip(hidden @ parts[2] + parts[3][0], -40, 40)))
            error = w * (out - y) / len(taken)
            back = np.outer(error, parts[2]) * (1 - hidden**2)
            slopes = [x.T @ back + 1e-4 * parts[0], back.sum(0), hidden.T @ error + 1e-4 * parts[2], np.array([error.sum()])]
            step += 1
            for k, slope in enumerate(slopes):
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.999 * second[k] + 0.001 * slope**2
                parts[k] = parts[k] - RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Network(shift, scale, parts[0], parts[1], parts[2], float(parts[3][0]))


def calibrate(network: Network, rows: np.ndarray, marks: np.ndarray) -> None:
    """Sets the temperature of the least cross-entropy on rows that were not learned from."""
    if not len(rows):
        return
    logits = network.logits(rows)
    best = None
    for temperature in np.geomspace(0.25, 8, 61):
        p = np.clip(1 / (1 + np.exp(-np.clip(logits / temperature, -40, 40))), 1e-12, 1 - 1e-12)
        loss = -(marks * np.log(p) + (1 - marks) * np.log(1 - p)).mean()
        if best is None or loss < best[0]:
            best = (loss, float(temperature))
    network.temperature = best[1]


@dataclass
class Model:
    vectors: np.ndarray
    network: Network | None
    rate: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        indexes = _indexes()
        rows = [pooled(tokens, rates, self.vectors, indexes) for tokens, rates in token_rows(texts)]
        if self.network is None or not rows:
            return np.full(len(rows), self.rate)
        return self.network.scores(np.array(rows))


def _indexes() -> np.ndarray:
    kept = cache_of("quality")
    if "indexes" not in kept:
        kept["indexes"] = index_vectors()
    return kept["indexes"]


def _entries() -> tuple[np.ndarray, np.ndarray]:
    kept = cache_of("quality")
    if "entries" not in kept:
        kept["entries"] = index_entries()
    return kept["entries"]


def context_vectors(texts: DataFrame) -> np.ndarray:
    """The vector of every bucket, of length 1, from the neighbours of its tokens in all ``texts`` (one column).

    Each task adds up its texts, some tasks add up theirs, a last one adds up these. Sums are whole
    numbers, so the vectors do not depend on how texts are dealt.
    """
    size = BUCKETS * WIDTH
    schema = "slot int, sums binary"

    def row(total: np.ndarray) -> pa.RecordBatch:
        slot = TaskContext.get().partitionId()
        return pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["slot", "sums"])

    def of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            context_sums(batch.column(0), total)
        yield row(total)

    def of_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        some = False
        for batch in batches:
            for one in batch.column(1):
                total += np.frombuffer(one.as_buffer(), np.int64)
                some = True
        if some:
            yield row(total)

    # At first as many tasks as shuffles have, then few, then one: none adds up very many.
    parts = texts.mapInArrow(of_texts, schema)
    shuffled = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for adders in (shuffled, ADDERS) if shuffled > ADDERS else (ADDERS,):
        parts = parts.repartition(adders, "slot").mapInArrow(of_sums, schema)
    found = parts.repartition(1).mapInArrow(of_sums, schema).first()
    whole = np.frombuffer(found["sums"], np.int64) if found else np.zeros(size, np.int64)
    vectors = whole.reshape(BUCKETS, WIDTH).astype(np.float32)
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-6)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    train_rows: int = TRAIN_ROWS,
) -> Model:
    """Learns from labelled rows whose crc32(id) mod 5 is not 0, ``train_rows`` of them at most.

    The context vectors of words need no labels and are summed over the texts of all rows. The rows of the smallest hashes of their ids are taken; those with crc32 mod 5 = 1 set the
    temperature only. An id with several labels counts as bad if one says so; null labels and ids say
    nothing. With no rows, or only one label among them, the score is the rate of good ones (0.5
    without rows).
    """
    ship(docs.sparkSession)
    fold = F.crc32(F.col("id").cast("string")) % 5
    marks = labels.where(F.col(label_column).isNotNull()).groupBy(F.col(id_column).cast("long").alias("id")).agg(
        F.min(F.col(label_column)).cast("int").alias("mark")
    )
    chosen = marks.where(F.col("id").isNotNull() & (fold != 0)).orderBy(F.xxhash64("id"), "id").limit(train_rows)
    chosen = beside(stored(chosen.withColumn("fold", fold.cast("int"))))
    source = docs.select(F.col(quoted(id_column)).cast("long").alias("id"), F.col(quoted(text_column)).cast("string").alias("text"))
    sample = stored(source.join(chosen, "id").select("text", "mark", "fold"))

    vectors = context_vectors(source.select("text"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [pooled(t, r, vectors, _indexes()).astype("<f4").tobytes() for t, r in token_rows(batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), batch.column(1), batch.column(2)], ["x", "mark", "fold"])

    table = sample.mapInArrow(features, "x binary, mark int, fold int").toArrow()  # train_rows at most
    if not table.num_rows:
        return Model(vectors, None, 0.5)
    width = 2 * WIDTH + EXTRA
    x = np.frombuffer(b"".join(table.column(0).to_pylist()), "<f4").reshape(-1, width).astype(np.float64)
    order = np.lexsort((*x.T[:3], table.column(1).to_numpy()))  # the order that rows come in does not matter
    x, y = x[order], (table.column(1).to_numpy() > 0).astype(float)[order]
    learns = (table.column(2).to_numpy() != 1)[order]
    if len(np.unique(y[learns])) < 2:
        return Model(vectors, None, float(y.mean()))
    network = train(x[learns], y[learns], np.ones(learns.sum()))
    calibrate(network, x[~learns], y[~learns])
    return Model(vectors, network, float(y.mean()))


def scored(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text", least: float = 0.3) -> DataFrame:
    """(row, id, held_out, score, predicted): ``docs`` as structs, with crc32(id) mod 5 = 0, and 1 from ``least`` on.

    ``row`` has every column as it was, also columns of the names of results. Null and empty texts have
    a score like others; a null id is not held out; repeated rows score alike; an empty table gives no
    rows. Texts of any length are scored whole, in slices with the others of their batch.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def of_text(texts: pa.Array) -> pa.Array:
        return pa.array(shared.value.scores(texts), pa.float64())

    id_ = F.col(quoted(id_column))
    held_out = F.coalesce(F.crc32(id_.cast("string")) % 5 == 0, F.lit(False))
    out = carried(docs, id=id_, held_out=held_out, score=of_text(F.coalesce(F.col(quoted(text_column)).cast("string"), F.lit(""))))
    return out.withColumn("predicted", (F.col("score") >= least).cast("int"))


def classify(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", train_rows: int = TRAIN_ROWS
) -> DataFrame:
    """(id, held_out, score, predicted) of each row, by a model that ``fit`` learns from the labels.

    Only the text is an input of the score. Null and empty texts have a score like others, from no
    tokens. A null id is not held out. Repeated rows are kept and score alike. Other columns are not
    read. An empty table gives no rows.
    """
    model = fit(docs, labels, id_column, text_column, train_rows=train_rows)
    found = scored(docs.select(quoted(id_column), quoted(text_column)), model, id_column, text_column)
    return found.select(F.col("id").alias(id_column), "held_out", "score", "predicted")


def fold_of(number: int) -> int:
    """crc32 of a number's text, mod 5."""
    return zlib.crc32(str(number).encode()) % 5
