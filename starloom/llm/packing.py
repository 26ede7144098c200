"""Packing of texts into windows at given token proportions, by deficit round-robin.

Every source has a queue of its texts' ids. A round visits the queues in turn and fills one
window: each queue is credited its share of the window on top of the deficit it carries, gives as
many whole ids as the credit covers, and carries what is left to the next window; places that
remain go to the queues with the largest deficits. Texts are cut freely at the ends of windows.

To run it in parallel, windows are grouped into spans. What each queue has given by the end of a
span follows in closed form from the queues' lengths and the target shares (whole ids, the
fraction being the deficit that the next span takes over), so every task can play the rounds of
just the spans that its texts fall in. Queues get ahead of each other by more spans the longer they
are, so a batch of texts is cut span by span: each span that it touches is played once for all its
texts, many spans side by side, however far apart its queues stand.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starloom.llm.bytewise import give_back, portions
from starloom.llm.pieces import encoder
from starloom.llm.tables import beside, ship, stored

WINDOW = 2048
#: Windows in a span. Only the last window of a span may be short.
SPAN = 1024
#: Queues, if not more sources have a target share: those and the most frequent ones have a queue of
#: their own, any others have the last one in common.
QUEUES = 1024
#: Places (windows times queues) of spans that are played side by side; twice as many are kept for the next batch.
PLAYED = 1 << 20
#: Pieces that make up a batch of results.
BATCH = 50_000


class Rounds(NamedTuple):
    """A span's rounds, flat by queue and window."""

    #: Ids the queue has given by the end of the window, on top of ``stride`` for each queue before it.
    given: np.ndarray
    #: Where the queue's ids begin in the window.
    places: np.ndarray
    windows: int
    total: int
    stride: int


class Mixture:
    """What each queue has given after any number of spans.

    While no queue is empty each gives in proportion to its share; when one is empty the others
    go on in proportion to theirs. By default shares are the queues' lengths, so that all end
    together and every window has the proportions of the whole.
    """

    def __init__(self, lengths: list[int], shares: list[float] | None = None, window: int = WINDOW, span: int = SPAN):
        self.lengths = list(lengths)
        shares = [Fraction(s) for s in (lengths if shares is None else shares)]
        # The least share keeps a queue without one from waiting for ever.
        least = min((s for s in shares if s > 0), default=Fraction(1)) / 1_000_000
        self.shares = [max(s, least) for s in shares]
        self.window, self.span, self.total = window, span, sum(self.lengths)
        # Whole ids are given at the end of a span, so up to one id a queue comes on top.
        self.step = max(window, window * span - len(lengths))
        self.spans = -(-self.total // self.step)
        self.phases = self._phases()
        self.starts = [p[0] for p in self.phases]
        self.rounds: dict[int, Rounds] = {}

    def _phases(self) -> list[tuple[Fraction, Fraction, dict[int, Fraction]]]:
        """(ids given in all before the phase, virtual time then, share of each queue still filled)."""
        order = sorted((Fraction(n) / s, k) for k, (n, s) in enumerate(zip(self.lengths, self.shares, strict=True)) if n)
        rest = sum(self.shares[k] for _, k in order)
        phases, given, time = [], Fraction(0), Fraction(0)
        for end, k in order:
            if end > time:
                phases.append((given, time, rest))
                given, time = given + (end - time) * rest, end
            rest -= self.shares[k]
        return phases

    def _time(self, spans: int) -> Fraction | None:
        """The virtual time after so many spans; None if all is given."""
        target = spans * self.step
        if target >= self.total:
            return None
        before, time, rest = self.phases[bisect_right(self.starts, target) - 1]
        return time + (target - before) / rest

    def given(self, spans: int) -> list[int]:
        """Ids that each queue has given after so many spans."""
        time = self._time(spans)
        if time is None:
            return self.lengths
        return [min(n, int(time * s)) for n, s in zip(self.lengths, self.shares, strict=True)]

    def given_by(self, queue: int, spans: int) -> int:
        """Ids that one queue has given after so many spans."""
        time = self._time(spans)
        return self.lengths[queue] if time is None else min(self.lengths[queue], int(time * self.shares[queue]))

    def schedules(self, spans: list[int]) -> Iterator[tuple[int, Rounds]]:
        """The rounds of each of these spans, which ascend; the last ones are kept for the next call."""
        many = max(1, PLAYED // (self.span * len(self.lengths)))
        self.rounds = {k: self.rounds[k] for k in spans if k in self.rounds}
        missing = [k for k in spans if k not in self.rounds]
        for span in spans:
            if span not in self.rounds:
                at = missing.index(span)
                self.rounds |= self._played(missing[at : at + many])
            yield span, self.rounds[span]
            for old in sorted(self.rounds)[: max(0, len(self.rounds) - 2 * many)]:
                if old <= span:
                    del self.rounds[old]

    def _played(self, spans: list[int]) -> dict[int, Rounds]:
        given = {k: np.array(self.given(k), np.int64) for n in spans for k in (n, n + 1)}
        quotas = np.stack([given[k + 1] - given[k] for k in spans])
        totals = quotas.sum(axis=1)
        windows = -(-totals // self.window)
        found = {}
        for count in np.unique(windows).tolist():
            alike = np.flatnonzero(windows == count)
            for k, served in zip(alike.tolist(), play(quotas[alike], self.window), strict=True):
                stride = int(totals[k]) + 1
                flat = np.cumsum(served, axis=0) + stride * np.arange(len(self.lengths))
                places = np.cumsum(served, axis=1) - served
                found[spans[k]] = Rounds(flat.T.ravel(), places.T.ravel(), count, int(totals[k]), stride)
        return found

    def span_of(self, queue: int, position: int) -> int:
        low, high = 0, self.spans - 1
        while low < high:
            middle = (low + high) // 2
            if self.given_by(queue, middle + 1) > position:
                high = middle
            else:
                low = middle + 1
        return low

    def parts(self, queues: list[int], positions: list[int], lengths: list[int]) -> np.ndarray:
        """What each text has in each span, by span: [(span, text, queue, first and end in the queue's quota, start in the text)]."""
        at: dict[int, tuple[int, int, int]] = {}
        found = []
        for text, (queue, spot, length) in enumerate(zip(queues, positions, lengths, strict=True)):
            begin, end = spot, spot + length
            while spot < end:
                number, first, last = at.get(queue, (0, 0, 0))
                if not first <= spot < last:
                    number = self.span_of(queue, spot)
                    first, last = self.given_by(queue, number), self.given_by(queue, number + 1)
                    at[queue] = number, first, last
                high = min(end, last)
                found.append((number, text, queue, spot - first, high - first, spot - begin))
                spot = high
        parts = np.array(found, np.int64).reshape(-1, 6)
        return parts[np.argsort(parts[:, 0], kind="stable")]


def play(quotas: np.ndarray, window: int) -> np.ndarray:
    """Deficit round-robin over windows until every queue has given its quota: [window, queue].

    Spans of as many windows each are played side by side: [span, queue] gives [span, window, queue].
    """
    if quotas.ndim == 1:
        return play(quotas[None], window)[0]
    quotas = quotas.astype(np.int64)
    total = quotas.sum(axis=1, keepdims=True)
    rest, credit = quotas.copy(), np.zeros_like(quotas)
    spans, queues = quotas.shape
    rounds = -(-int(total.max(initial=0)) // window)
    served = np.zeros((spans, rounds, queues), np.int64)
    for k in range(rounds - 1):
        credit += quotas * window
        give = np.minimum(np.maximum(credit // total, 0), rest)
        left = window - give.sum(axis=1)
        if (left < 0).any():
            excess = np.maximum(-left, 0)[:, None]
            over = np.cumsum(give[:, ::-1], axis=1)[:, ::-1]
            give -= np.minimum(give, np.maximum(0, np.minimum(excess - (over - give), give)))
            left = np.maximum(left, 0)
        while left.any():
            open_queues = rest > give
            ahead = np.where(open_queues, give * total - credit, np.iinfo(np.int64).max)
            many = np.minimum(left, open_queues.sum(axis=1))[:, None]
            # The least so many, of equal ones the first.
            most = np.take_along_axis(np.sort(ahead, axis=1), np.maximum(many - 1, 0), axis=1)
            less, equal = ahead < most, ahead == most
            equal &= np.cumsum(equal, axis=1) <= many - less.sum(axis=1, keepdims=True)
            give += (less | equal) & (many > 0)
            left = left - many[:, 0]
        served[:, k] = give
        credit -= give * total
        rest -= give
    if rounds:
        served[:, -1] = rest
    return served


KEPT = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padded_length", "queue"]


def cut(mixture: Mixture, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces of texts (id, queue, position in the queue, number of ids, ids in two planes)."""
    for batch in batches:
        queues, positions, lengths = (batch.column(k).to_numpy() for k in (1, 2, 3))
        parts = mixture.parts(queues.tolist(), positions.tolist(), lengths.tolist())
        spans, begins = np.unique(parts[:, 0], return_index=True)
        bounds = np.append(begins, len(parts))
        out: list[tuple[np.ndarray, ...]] = []
        for k, (span, rounds) in enumerate(mixture.schedules(spans.tolist())):
            found = parts[bounds[k] : bounds[k + 1]]
            most = np.cumsum(np.minimum(found[:, 4] - found[:, 3], rounds.windows))
            few = np.split(found, np.flatnonzero(np.diff(most // (4 * BATCH))) + 1)
            for n, some in enumerate(few):
                out.append(_cut_span(mixture, span, rounds, some, batch.column(4)))
                if (k, n) == (len(spans) - 1, len(few) - 1) or sum(len(x[0]) for x in out) > BATCH:
                    text, *columns = (np.concatenate(x) for x in zip(*out, strict=True))
                    columns = [pa.array(x) for x in (*columns[:3], lengths[text], *columns[3:], queues[text].astype(np.int64))]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(text)), *columns], KEPT)
                    out = []
    mixture.rounds = {}
    give_back()


def _cut_span(mixture: Mixture, span: int, rounds: Rounds, parts: np.ndarray, ids: pa.Array) -> tuple[np.ndarray, ...]:
    """(text, start, length, crc32 of the ids, sequence, offset, padded length) of a span's pieces."""
    _, texts, queues, lows, highs, dones = parts.T
    flat = queues * rounds.stride
    first = np.searchsorted(rounds.given, flat + lows, side="right")
    counts = np.searchsorted(rounds.given, flat + highs - 1, side="right") - first + 1
    part = np.repeat(np.arange(len(parts)), counts)
    cell = np.arange(len(part)) - np.repeat(np.cumsum(counts) - counts - first, counts)
    window = cell - queues[part] * rounds.windows
    before = np.where(window > 0, rounds.given[cell - 1] - flat[part], 0)
    begins, ends = np.maximum(before, lows[part]), np.minimum(rounds.given[cell] - flat[part], highs[part])
    held = ends > begins
    part, cell, window, before, begins, ends = (x[held] for x in (part, cell, window, before, begins, ends))
    sizes = ends - begins
    crcs = np.zeros(len(part), np.int64)
    edges = np.searchsorted(part, np.arange(len(parts) + 1)).tolist()
    froms, untils = (4 * (begins - lows[part])).tolist(), (4 * (ends - lows[part])).tolist()
    for k, (text, done, size) in enumerate(zip(texts.tolist(), dones.tolist(), (highs - lows).tolist(), strict=True)):
        planes = np.frombuffer(ids[text].as_buffer(), "<u2").reshape(2, -1)
        raw, some = planes[:, done : done + size].T.tobytes(), slice(edges[k], edges[k + 1])
        crcs[some] = [zlib.crc32(raw[a:b]) for a, b in zip(froms[some], untils[some], strict=True)]
    last = rounds.windows - 1
    short = rounds.total - last * mixture.window
    padded = np.where(window < last, mixture.window, min(mixture.window, 1 << (short - 1).bit_length()))
    places = rounds.places[cell] + begins - before
    return texts[part], begins - lows[part] + dones[part], sizes, crcs, span * mixture.span + window, places, padded


def pack(
    docs: DataFrame,
    tokenizer: str,
    shares: dict[str, float] | None = None,
    end_id: int = 1,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    window: int = WINDOW,
    span: int = SPAN,
) -> DataFrame:
    """Pieces of all texts: (id, start, length, ids_crc32, doc_tokens, sequence_id, offset, padded_length, queue).

    A text is the library's ids and ``end_id``; every id is in exactly one piece. ``start`` counts
    from the text's beginning, ``offset`` within the sequence, where pieces follow each other without
    a gap from 0. ``padded_length`` is the window, or for a span's short last sequence the least power
    of two that holds it. ``shares`` gives target proportions by source (missing: 0, served last);
    without it they are those of the whole table. Sources beyond QUEUES without a share have one queue. A null text counts as empty and has the end id alone.
    A null source is a queue of its own. Repeated rows and null ids are packed like others. An empty
    table gives no pieces. Other columns are not read.
    """
    ship(docs.sparkSession)
    source = docs.select(
        F.col(id_column).cast("long").alias("id"),
        F.col(text_column).cast("string").alias("text"),
        F.col(source_column).cast("string").alias("source"),
    )
    targets = [n for n in shares or {} if n is not None]
    has_share = F.coalesce(F.col("source").isin(targets), F.lit(None in (shares or {})))
    counted = source.groupBy("source").count().orderBy(has_share.desc(), F.desc("count"), F.asc_nulls_first("source"))
    names = [r["source"] for r in counted.limit(max(QUEUES - 1, len(shares or {}))).collect()]
    queue_of = {name: k for k, name in enumerate(names)}

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part = encoder(tokenizer), TaskContext.get().partitionId()
        before = np.zeros(len(names) + 1, np.int64).tolist()
        for batch in (few for batch in batches for few in portions(batch)):
            queues = [queue_of.get(s, len(names)) for s in batch.column(2).to_pylist()]
            starts, lengths, contents = [], [], []
            for queue, ids in zip(queues, tokens.ids(batch.column(1)), strict=True):
                starts.append(before[queue])
                lengths.append(len(ids) + 1)
                before[queue] += len(ids) + 1
                contents.append(np.append(ids, np.uint32(end_id)).astype("<u4").view("<u2").reshape(-1, 2).T.tobytes())
            columns = [
                batch.column(0),
                pa.array(queues, pa.int32()),
                pa.array([part] * len(queues), pa.int32()),
                pa.array(starts, pa.int64()),
                pa.array(lengths, pa.int64()),
                pa.array(contents, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "queue", "part", "start", "n_ids", "ids"])

    encoded = stored(
        source.mapInArrow(encode, "id long, queue int, part int, start long, n_ids long, ids binary"), "zstd"
    )
    totals = encoded.groupBy("queue", "part").agg(F.sum("n_ids").alias("n"))
    before = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    places = stored(totals.select("queue", "part", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")))
    lengths = [0] * (len(names) + 1)
    for row in places.groupBy("queue").agg(F.sum("n").alias("n")).collect():
        lengths[row["queue"]] = row["n"]
    wanted = None if shares is None else [shares.get(n, 0.0) for n in names] + [0.0]
    mixture = Mixture(lengths, wanted, window, span)
    placed = encoded.join(beside(places.select("queue", "part", "before")), ["queue", "part"])
    pieces = placed.select("id", "queue", (F.col("before") + F.col("start")).alias("position"), "n_ids", "ids").mapInArrow(
        lambda batches: cut(mixture, batches), ", ".join(f"{x} long" for x in KEPT)
    )
    return pieces.withColumnRenamed("id", id_column)
