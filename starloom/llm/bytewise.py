"""Texts of an Arrow batch as flat numpy arrays, and hashes of their words and pieces.

Everything works on slices of half a million bytes at a time, so memory does not grow
with the batch; a single longer text is a slice of its own.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 500_000
_caches: dict[str, dict] = {}
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {"forward": np.ones(1, np.uint64), "backward": np.ones(1, np.uint64)}

#: 1 where a byte is white space: the space and U+0009 to U+000D.
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True

#: Bytes with A-Z in lower case.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

#: 1 where a byte belongs to a word of letters and digits; all of UTF-8's longer forms do.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
ALNUM[0x80:] = True


def cache_of(owner: str) -> dict:
    """What a worker keeps between the tasks of one operator; what another has left there is dropped first."""
    if owner not in _caches:
        _caches.clear()
        for powers in _powers:
            _powers[powers] = np.ones(1, np.uint64)
        gc.collect()
        give_back()
        _caches[owner] = {}
    return _caches[owner]


def give_back() -> None:
    """Returns freed memory to the system: workers live on, idle, beside tasks that need it."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def portions(batch: pa.RecordBatch, rows: int = 500) -> Iterator[pa.RecordBatch]:
    """A batch in parts of a few rows, for results that are larger than the texts they come from."""
    for first in range(0, batch.num_rows, rows):
        yield batch.slice(first, rows)


def folded(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with A-Z and the capitals of Latin-1 in lower case, each at its place."""
    data = LOWER[data]
    after = np.flatnonzero(data[:-1] == 0xC3) + 1
    after = after[(data[after] >= 0x80) & (data[after] <= 0x9E) & (data[after] != 0x97)]
    data[after] += 0x20
    return data


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (splitmix64's finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["forward"]) < n:
        size = max(n, 2 * len(_powers["forward"]))
        for name, base in (("forward", _BASE), ("backward", _INVERSE)):
            steps = np.full(size, base & _MASK, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["forward"], _powers["backward"]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of ``values[start:end]`` for each span, equal for equal spans anywhere."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    forward, backward = _powers_to(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * forward[: len(values)], out=sums[1:])
    found = (sums[ends] - sums[starts]) * backward[starts]
    return mix(found ^ ((ends - starts).astype(np.uint64) << np.uint64(40)))


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array and the offsets of its rows; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    buffer = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buffer, offsets.astype(np.int64)


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets of rows in these bytes), a bounded number of bytes each."""
    buffer, offsets = utf8(texts)
    first, rows = 0, len(offsets) - 1
    while first < rows:
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(max(end, first + 1), rows)
        yield first, end, buffer[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end
    give_back()


def words(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of bytes that are no separators, and the row of each."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~separator[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    cuts = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    starts[cuts] = inside[cuts]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[cuts - 1] = inside[cuts - 1]
    first = np.flatnonzero(starts)
    return first, np.flatnonzero(ends) + 1, np.searchsorted(offsets, first, side="right") - 1


def row_bounds(row: np.ndarray, rows: int) -> np.ndarray:
    """For items sorted by row: where each row's items begin; one more entry at the end."""
    return np.searchsorted(row, np.arange(rows + 1))


def ngram_hashes(word_hashes: np.ndarray, n: int) -> np.ndarray:
    """The hash of each n words in a row, in order; n - 1 fewer than words."""
    count = len(word_hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(count, np.uint64)
    for k in range(n):
        out = out * np.uint64(0xD6E8FEB86659FD93) + word_hashes[k : k + count]
    return mix(out)


def codepoints(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes, and the offsets of rows in them; broken bytes become U+FFFD."""
    raw = data.tobytes()
    try:
        points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
    except UnicodeDecodeError:
        rows = [raw[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        return (
            np.frombuffer("".join(rows).encode("utf-32-le"), np.uint32),
            np.concatenate(([0], np.cumsum([len(x) for x in rows]))).astype(np.int64),
        )
    chars = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=chars[1:])
    return points, chars[offsets]
