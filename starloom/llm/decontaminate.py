"""Benchmark items found in training texts, also when edited.

1. One pass over the texts counts in how many of them each n-gram of words of an item occurs.
2. The n-grams join texts to items: a text is a candidate for every item of which it has an n-gram. Its
   seeds are these n-grams in the order of their rarity. None is left out, however common it is, so an
   edited copy is found by any n-gram that the edit has left.
3. A candidate that has too few of the item's words for the threshold, wherever they stand, is
   dropped; no alignment could score enough.
4. Around the rarest seed the text's words are aligned with the item's by Smith-Waterman, as far to
   either side as an alignment of enough score can reach; around the other seeds too, unless the first
   has shown all of the item. The score is that of the best local alignment, as a part of the item's
   score against itself.

Items too short for seeds are found as they are, all their words in a row. Items are taken in
blocks of bounded size, a block's n-grams and words being copied to the executors; texts are read
twice for each block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.bytewise import ALNUM, cache_of, folded, ngram_hashes, row_bounds, slices, span_hashes, words
from starloom.llm.tables import beside, carried, quoted, ship, stored

MATCH, MISMATCH, GAP = 2, -1, -1
#: Words of benchmark items in a block.
BLOCK_WORDS = 200_000


def word_rows(texts: pa.Array) -> Iterator[np.ndarray]:
    """The hashes of each text's words: runs of letters and digits in lower case."""
    for first, end, data, offsets in slices(texts):
        data = folded(data)
        starts, ends, row = words(data, offsets, ~ALNUM)
        hashes = span_hashes(data, starts, ends)
        bounds = row_bounds(row, end - first).tolist()
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            yield hashes[a:b]


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """(score, end in the text) of the best local alignment by Smith-Waterman, with linear gaps."""
    best, end = 0, 0
    steps = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for word in item:
        fresh = np.empty_like(row)
        fresh[0] = 0
        diagonal = row[:-1] + np.where(text == word, MATCH, MISMATCH)
        fresh[1:] = np.maximum(np.maximum(diagonal, row[1:] + GAP), 0)
        # A gap in the item: the best cell to the left, less one for each step.
        row = np.maximum.accumulate(fresh - GAP * steps) + GAP * steps
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
    return best, end


def best_window(item: np.ndarray, text: np.ndarray, lows: np.ndarray, highs: np.ndarray, threshold: float) -> tuple[float, int, int]:
    """(score of 0 to 1, first word, end word) of the best alignment of ``threshold`` or more in the windows, else zeros."""
    order = np.argsort(lows, kind="stable")
    lows, reach = lows[order], np.maximum.accumulate(highs[order])
    # Windows that meet are one.
    last = np.append(lows[1:] > reach[:-1], True)
    first = np.append(True, last[:-1])
    found = (0.0, 0, 0)
    for low, high in zip(lows[first].tolist(), reach[last].tolist(), strict=True):
        low, high = max(0, low), min(len(text), high)
        if np.isin(item, text[low:high]).sum() / len(item) < max(threshold, found[0]):
            continue
        score, end = align(item, text[low:high])
        if score / (MATCH * len(item)) > found[0] and score / (MATCH * len(item)) >= threshold:
            back, length = align(item[::-1], text[low : low + end][::-1])
            found = (score / (MATCH * len(item)), low + end - length, low + end)
    return found


def _gathered(offsets: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the entries of some keys in a flat list whose parts begin at ``offsets``, and where each key's begin."""
    lengths = offsets[keys + 1] - offsets[keys]
    begins = np.cumsum(lengths) - lengths
    return np.repeat(offsets[keys] - begins, lengths) + np.arange(lengths.sum()), begins


class _Block:
    """A block of items by their n-grams and by their words."""

    def __init__(self, rows: list, n: int, threshold: float):
        self.threshold = threshold
        self.frequency = None  # of each n-gram, in texts
        self.ids = [r["item"] for r in rows]
        self.words = list(word_rows(pa.array([r["text"] for r in rows], pa.string())))
        grams = [ngram_hashes(w, n) for w in self.words]
        self.grams = np.unique(np.concatenate(grams))
        # Of each item its n-grams by number, with the first and the last place of each.
        self.of_item = []
        for found in grams:
            numbers, first = np.unique(np.searchsorted(self.grams, found), return_index=True)
            _, behind = np.unique(found[::-1], return_index=True)
            self.of_item.append((numbers, first, len(found) - 1 - behind))
        numbers = np.concatenate([x[0] for x in self.of_item])
        order = np.argsort(numbers, kind="stable")
        self.items = np.repeat(np.arange(len(rows)), [len(x[0]) for x in self.of_item])[order]
        self.items_at = np.searchsorted(numbers[order], np.arange(len(self.grams) + 1))
        self.vocabulary, flat = np.unique(np.concatenate(self.words), return_inverse=True)
        self.word_numbers = flat
        self.lengths = np.array([len(w) for w in self.words])
        self.words_at = np.concatenate(([0], np.cumsum(self.lengths)))

    def in_text(self, text: np.ndarray, numbers: np.ndarray, places: np.ndarray) -> Iterator[tuple[int, float, int, int]]:
        """(item, score, first word, end word) by a text's words and its n-grams of the block with their places."""
        items = np.unique(self.items[_gathered(self.items_at, np.unique(numbers))[0]])
        number = np.searchsorted(self.vocabulary, text)
        number[number == len(self.vocabulary)] = 0
        present = np.zeros(len(self.vocabulary), bool)
        present[number[self.vocabulary[number] == text]] = True
        flat, begins = _gathered(self.words_at, items)
        matched = np.add.reduceat(present[self.word_numbers[flat]].astype(np.int64), begins)
        for item in items[matched / self.lengths[items] >= self.threshold].tolist():
            own, first, last = self.of_item[item]
            at = np.searchsorted(own, numbers)
            at[at == len(own)] = 0
            hit = own[at] == numbers
            place, at, length = places[hit], at[hit], len(self.words[item])
            # An alignment loses at least one for each word it inserts, so it can hold no more of them than this.
            slack = int(MATCH * length * max(0.0, 1 - self.threshold) / -GAP) + 1
            lows, highs = place - last[at] - slack, place - first[at] + length + slack
            common = self.frequency[numbers[hit]]
            rarest = common == common.min()
            score, begin, end = best_window(self.words[item], text, lows[rarest], highs[rarest], self.threshold)
            # Undecided unless all words of the item stand there; then only an earlier copy would count.
            open_ = ~rarest if score < 1 else ~rarest & (lows < begin)
            if open_.any():
                every = rarest | open_
                score, begin, end = best_window(self.words[item], text, lows[every], highs[every], self.threshold)
            if end and score >= self.threshold:
                yield item, score, begin, end


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = 0.42,
    n: int = 3,
    min_words: int = 8,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """(id, item, score, first_word, end_word): items that texts contain, one row per id and item.

    A word is a run of letters and digits in lower case. Rows are those whose best alignment scores
    ``threshold`` or more of the item's score against itself (1.0: all its words in a row); the place
    is given in words of the text, and is that of the first of several best ones. Items with fewer
    than ``min_words`` words are found only where all their words stand in a row; items without words
    identify nothing. Null texts and items are empty, texts of any length are searched whole.
    Repeated rows and rows of one id give one row per item, the best; a null id is kept as an id.
    Other columns are not read. Without items or without texts there are no rows.
    """
    source, items = _source(docs, id_column, text_column), _items(benchmark, item_column, item_text_column)
    found = _found(source, items, threshold, n, min_words)
    place = F.struct("score", (-F.col("first_word")).alias("back"), "end_word")
    best = found.groupBy("id", "item").agg(F.max(place).alias("best"))
    return best.select(
        F.col("id").alias(id_column),
        F.col("item").alias(item_column),
        "best.score",
        (-F.col("best.back")).alias("first_word"),
        "best.end_word",
    )


def without_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = 0.42,
    n: int = 3,
    min_words: int = 8,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """``docs`` without the rows whose texts contain an item, as ``contaminated`` finds them.

    Columns and their order stay, whatever their names, and so do null and empty texts, repeated rows of
    clean texts and an empty table.
    """
    source, items = _source(docs, id_column, text_column), _items(benchmark, item_column, item_text_column)
    found = _found(source, items, threshold, n, min_words)
    gone = found.select(F.col("id").alias("its_id"), F.col("text_hash").alias("its_hash")).distinct()
    text = F.col(quoted(text_column)).cast("string")
    rows = carried(docs, id=F.col(quoted(id_column)).cast("long"), text_hash=F.xxhash64(text))
    same = F.col("id").eqNullSafe(F.col("its_id")) & (F.col("text_hash") == F.col("its_hash"))
    return rows.join(beside(stored(gone)), same, "left_anti").select("row.*")


def _source(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.col(text_column).cast("string")
    return docs.select(F.col(id_column).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))


def _items(benchmark: DataFrame, item_column: str, item_text_column: str) -> DataFrame:
    text = F.coalesce(F.col(item_text_column).cast("string"), F.lit(""))
    return benchmark.select(F.col(item_column).cast("long").alias("item"), text.alias("text")).distinct()


_FOUND = "id long, text_hash long, item long, score double, first_word long, end_word long"


def _found(source: DataFrame, items: DataFrame, threshold: float, n: int, min_words: int) -> DataFrame:
    ship(source.sparkSession)
    found = source.sparkSession.createDataFrame([], _FOUND)
    for rows in _blocks(items):
        item_words = list(word_rows(pa.array([r["text"] for r in rows], pa.string())))
        long = [r for r, w in zip(rows, item_words, strict=True) if len(w) >= max(n, min_words)]
        short = [(r["item"], w) for r, w in zip(rows, item_words, strict=True) if 0 < len(w) < max(n, min_words)]
        if long:
            found = found.unionAll(_in_block(source, _Block(long, n, threshold), n))
        if short:
            found = found.unionAll(_as_they_are(source, short))
    return found


def _blocks(items: DataFrame) -> Iterator[list]:
    """Items in lists of some BLOCK_WORDS words, read one after the other."""
    size = F.sum(F.octet_length("text")).alias("bytes")
    blocks = int((items.agg(size).first()["bytes"] or 0) // (4 * BLOCK_WORDS)) + 1
    for block in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        yield part.orderBy("item", "text").collect()


def _hits(texts: pa.Array, known: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, word hashes, numbers, places) of each text that has some of the n-grams ``known``, by their numbers."""
    cache_of("items")
    at = 0
    for first, end, data, offsets in slices(texts):
        data = folded(data)
        starts, ends, row = words(data, offsets, ~ALNUM)
        hashes = span_hashes(data, starts, ends)
        found = ngram_hashes(hashes, n)
        number = np.searchsorted(known, found)
        number[number == len(known)] = 0
        hit = (known[number] == found) & (row[: len(found)] == row[n - 1 : n - 1 + len(found)])
        place = np.flatnonzero(hit)
        bounds = row_bounds(row, end - first)
        cuts = row_bounds(row[place], end - first).tolist()
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if b > a:
                yield at + k, hashes[bounds[k] : bounds[k + 1]], number[place[a:b]], place[a:b] - bounds[k]
        at += end - first


def _frequencies(source: DataFrame, grams: np.ndarray, n: int) -> np.ndarray:
    """In how many texts each n-gram occurs."""
    shared = source.sparkSession.sparkContext.broadcast(grams)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(shared.value), np.int64)
        for batch in batches:
            for _, _, numbers, _ in _hits(batch.column(0), shared.value, n):
                counts[np.unique(numbers)] += 1
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(counts[seen])], ["number", "texts"])

    counted = source.select("text").mapInArrow(run, "number int, texts long").groupBy("number").agg(F.sum("texts").alias("texts"))
    table, out = counted.toArrow(), np.zeros(len(grams), np.int64)  # a row per n-gram of the block at most
    out[table.column("number").to_numpy()] = table.column("texts").to_numpy()
    return out


_RESULT = ["id", "text_hash", "item", "score", "first_word", "end_word"]


def _result(batch: pa.RecordBatch, found: list[tuple]) -> pa.RecordBatch:
    """Rows (row of the batch, item, score, first word, end word) with the ids of their texts."""
    rows, *out = zip(*found, strict=True) if found else [()] * 5
    taken = pa.array(rows, pa.int64())
    kinds = (pa.int64(), pa.float64(), pa.int64(), pa.int64())
    columns = [batch.column(0).take(taken), batch.column(2).take(taken)]
    return pa.RecordBatch.from_arrays([*columns, *[pa.array(x, k) for x, k in zip(out, kinds, strict=True)]], _RESULT)


def _in_block(source: DataFrame, block: _Block, n: int) -> DataFrame:
    block.frequency = _frequencies(source, block.grams, n)
    shared = source.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in batches:
            found = []
            for row, text, numbers, places in _hits(batch.column(1), block.grams, n):
                for item, *place in block.in_text(text, numbers, places):
                    found.append((row, block.ids[item], *place))
            yield _result(batch, found)

    return source.mapInArrow(run, _FOUND)


def _as_they_are(source: DataFrame, items: list[tuple[int, np.ndarray]]) -> DataFrame:
    """Items whose words all stand in a text in a row, with the first place of each; the score is 1."""
    by_length: dict[int, tuple[list, list]] = {}
    for item, item_words in items:
        hashes, ids = by_length.setdefault(len(item_words), ([], []))
        hashes.append(ngram_hashes(item_words, len(item_words))[0])
        ids.append(item)
    known = {}
    for length, (hashes, ids) in by_length.items():
        grams, number = np.unique(np.array(hashes, np.uint64), return_inverse=True)
        known[length] = grams, [[i for i, k in zip(ids, number, strict=True) if k == m] for m in range(len(grams))]
    shared = source.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for length, (grams, ids) in shared.value.items():
                for row, _, numbers, places in _hits(batch.column(1), grams, length):
                    for number, first in zip(*np.unique(numbers, return_index=True), strict=True):
                        found += [(row, item, 1.0, int(places[first]), int(places[first]) + length) for item in ids[number]]
            yield _result(batch, found)

    return source.mapInArrow(run, _FOUND)
