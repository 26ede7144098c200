"""Pre-tokens of two public byte-pair vocabularies, split in numpy, merged once each.

A text is cut into pre-tokens for a whole slice of texts at a time. Each different
pre-token goes through the ``tokenizers`` library once per worker; its ids are kept by the
hash of its characters. The classes and lower cases of all code points are those of the library. Words
of the lower-casing vocabulary that its normalization may join or rewrite, such as letters with
marks of their own, go through the library one by one, and so do texts that hold special strings or,
in the other vocabulary, unassigned code points. The ids are those of the library in every case.

A text of any length is worked on as it is, in a time that grows with its length; null counts as empty.
"""

from __future__ import annotations

import json
import os
import unicodedata
from functools import lru_cache
from itertools import chain, repeat

os.environ["TOKENIZERS_PARALLELISM"] = "false"

import numpy as np  # noqa: E402
import pyarrow as pa  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from starloom.llm.bytewise import cache_of, codepoints, give_back, slices, span_hashes  # noqa: E402

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
#: Code points, and what marks those of words that the library takes whole.
POINTS = 0x110000
#: Code points of white space (fixed values).
BLANKS = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: More different pre-tokens than this are not kept; those used most stay, at most half as many.
MAX_KEPT = 250_000

#: How the two known files cut texts (fixed values of the vocabularies).
GPT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CLIP_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(0x100)]


#: Their code points, by byte.
BYTE_LETTERS = np.frombuffer("".join(byte_letters()).encode("utf-32-le"), "<u4")


def categories() -> np.ndarray:
    """The two letters of every code point's category, as bytes."""
    names = "".join(map(unicodedata.category, map(chr, range(POINTS))))
    return np.frombuffer(names.encode(), np.uint8).reshape(POINTS, 2)


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of every code point."""
    first = categories()[:, 0]
    table = np.full(POINTS, OTHER, np.uint8)
    table[first == ord("L")] = LETTER
    table[first == ord("N")] = NUMBER
    table[BLANKS] = SPACE
    return table


@lru_cache(maxsize=1)
def unassigned() -> np.ndarray:
    """Where a code point has no character here; the library may know one."""
    return (categories() == np.frombuffer(b"Cn", np.uint8)).all(axis=1)


@lru_cache(maxsize=1)
def lowered() -> np.ndarray:
    """The lower case of every code point that has one of a single code point; others stay."""
    table = np.arange(POINTS, dtype=np.uint32)
    for k in range(POINTS):
        lower = chr(k).lower()
        if len(lower) == 1:
            table[k] = ord(lower)
    return table


@lru_cache(maxsize=1)
def unsettled() -> np.ndarray:
    """Where lower-casing and canonical composition may do more than ``lowered`` says, but for white space."""
    table = unassigned().copy()
    for k in np.flatnonzero(~table).tolist():
        char = chr(k)
        parts = unicodedata.decomposition(char)
        if parts and not parts.startswith("<"):
            table[int(parts.split()[-1], 16)] = True  # it may be joined to what stands before it
        if unicodedata.combining(char) or len(char.lower()) > 1 or not unicodedata.is_normalized("NFC", char):
            table[k] = True
    table[[*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)]] = True  # Hangul vowels and final consonants
    table[BLANKS] = False
    return table


@lru_cache(maxsize=2)
def first_of(table: str) -> int:
    """The first code point that a table marks; texts below it need not be looked up."""
    return int({"unassigned": unassigned, "unsettled": unsettled}[table]().argmax())


def _mark_contractions(points: np.ndarray, kinds: np.ndarray, begins: np.ndarray, row_start: np.ndarray) -> None:
    """An apostrophe that begins a piece takes s, t, m, d, re, ve or ll along."""
    at = np.flatnonzero((points == 39) & begins)
    at = at[at + 1 < len(points)]
    at = at[(kinds[at + 1] == LETTER) & ~row_start[at + 1]]
    if not len(at):
        return
    after = points[at + 1]
    second = np.minimum(at + 2, len(points) - 1)
    same = (at + 2 < len(points)) & ~row_start[second]
    two = points[second]
    one_letter = np.isin(after, [ord(c) for c in "stmd"])
    pair = ((after == ord("r")) | (after == ord("v"))) & (two == ord("e")) | (after == ord("l")) & (two == ord("l"))
    pair &= same
    for found, width in ((one_letter, 2), (pair, 3)):
        where = at[found]
        begins[where + 1] = False
        end = where + width
        begins[end[end < len(points)]] = True


def split_gpt(points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pre-tokens of byte_bpe files."""
    kinds = classes()[points]
    row_start = np.zeros(len(points) + 1, bool)
    row_start[offsets] = True
    row_start = row_start[:-1]
    begins = row_start.copy()
    begins[1:] |= kinds[1:] != kinds[:-1]
    begins[0] = True
    # The last blank before a word stands alone, or joins the word if it is a space.
    at = np.flatnonzero(begins & (kinds != SPACE) & ~row_start)
    at = at[at > 0]
    at = at[kinds[at - 1] == SPACE]
    begins[at - 1] = True
    begins[at[points[at - 1] == 32]] = False
    _mark_contractions(points, kinds, begins, row_start)
    starts = np.flatnonzero(begins)
    return starts, np.append(starts[1:], len(points))


def split_clip(
    points: np.ndarray, offsets: np.ndarray, whole: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pre-tokens of word_bpe files in lowered text; blanks are in none.

    Words marked in ``whole`` are not cut.
    """
    kinds = classes()[points]
    row_start = np.zeros(len(points) + 1, bool)
    row_start[offsets] = True
    row_start = row_start[:-1]
    begins = row_start | (kinds == NUMBER)
    begins[1:] |= kinds[1:] != kinds[:-1]
    begins[0] = True
    _mark_contractions(points, kinds, begins, row_start)
    if whole is not None and whole.any():
        blank = kinds == SPACE
        word_start = row_start | blank
        word_start[1:] |= blank[:-1]
        begins = np.where(whole, word_start, begins)
    starts = np.flatnonzero(begins)
    ends = np.append(starts[1:], len(points))
    kept = kinds[starts] != SPACE
    return starts[kept], ends[kept]


def in_words_with(points: np.ndarray, offsets: np.ndarray, marked: np.ndarray) -> np.ndarray:
    """Whether each code point is in a word, between blanks of its row, that has a marked code point."""
    blank = classes()[points] == SPACE
    starts = blank.copy()
    starts[1:] |= blank[:-1]
    starts[offsets[:-1][offsets[:-1] < len(points)]] = True
    word = np.cumsum(starts)
    found = np.zeros(int(word[-1]) + 1, bool)
    found[word[marked]] = True
    return found[word] & ~blank


class Encoder:
    """Ids of whole texts as the library gives them for one vocabulary file, without added ids.

    ``known`` maps pre-tokens to ids that were proven beforehand.
    """

    def __init__(self, path: str, known: dict[str, int] | None = None):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t["content"] for t in described["added_tokens"]]
        self.kind = pattern_kind(described)
        self.known = known or {}
        self.entries: dict[int, int] = {}
        self.lengths = np.zeros(1 << 16, np.int64)
        self.begins = np.zeros(1 << 16, np.int64)
        self.uses = np.zeros(1 << 16, np.int64)
        self.pool = np.zeros(1 << 18, np.uint32)
        self.pooled = 0
        del described
        give_back()
        if self.known:
            self._keep(text_hashes(list(self.known)), [[k] for k in self.known.values()])

    def _keep(self, hashes: list[int], ids: list[list[int]]) -> None:
        count = len(self.entries)
        flat = np.array(list(chain.from_iterable(ids)), np.uint32)
        while count + len(ids) > len(self.lengths):
            more = np.zeros_like(self.lengths)
            self.lengths, self.begins, self.uses = (np.concatenate((x, more)) for x in (self.lengths, self.begins, self.uses))
        while self.pooled + len(flat) > len(self.pool):
            self.pool = np.concatenate((self.pool, np.zeros_like(self.pool)))
        lengths = np.fromiter((len(x) for x in ids), np.int64, len(ids))
        self.lengths[count : count + len(ids)] = lengths
        self.begins[count : count + len(ids)] = self.pooled + np.cumsum(lengths) - lengths
        self.pool[self.pooled : self.pooled + len(flat)] = flat
        self.pooled += len(flat)
        self.uses[count : count + len(ids)] = 0
        self.entries.update(zip(hashes, range(count, count + len(ids)), strict=True))

    def _thin(self) -> None:
        """Keeps the proven pieces and, of the others, those that several slices used, the most used first."""
        hashes = np.fromiter(self.entries, np.uint64, len(self.entries))
        self.entries = {}
        uses = self.uses[: len(hashes)].copy()
        uses[: len(self.known)] = uses.max(initial=0) + MAX_KEPT
        order = np.argsort(-uses, kind="stable")[: len(self.known) + MAX_KEPT // 2]
        kept = np.sort(order[uses[order] > 1])
        lengths, begins = self.lengths[kept], self.begins[kept]
        ends = np.cumsum(lengths)
        flat = self.pool[np.repeat(begins - (ends - lengths), lengths) + np.arange(int(lengths.sum()))]
        self.pool[: len(flat)] = flat
        self.pooled = len(flat)
        self.lengths[: len(kept)], self.begins[: len(kept)] = lengths, ends - lengths
        # Halved, so that pieces of earlier texts give way in time.
        self.uses[: len(kept)] = self.uses[kept] // 2
        self.entries = dict(zip(hashes[kept].tolist(), range(len(kept)), strict=True))

    def _library_ids(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _piece_ids(self, pieces: list[str]) -> list[list[int]]:
        """The library's merges of single pre-tokens, without splitting them again."""
        merge = self.library.model.tokenize
        raw = np.frombuffer("".join(pieces).encode(), np.uint8)
        letters = BYTE_LETTERS[raw].tobytes().decode("utf-32-le")
        ends = np.cumsum([len(p) if p.isascii() else len(p.encode()) for p in pieces]).tolist()
        return [[t.id for t in merge(letters[a:b])] for a, b in zip([0, *ends], ends, strict=False)]

    def _entries_of(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The entry of each piece; pieces seen for the first time are merged by the library."""
        hashes, first, inverse = np.unique(span_hashes(points, starts, ends), return_index=True, return_inverse=True)
        keys = hashes.tolist()

        def looked_up() -> tuple[np.ndarray, np.ndarray]:
            entries = np.fromiter(map(self.entries.get, keys, repeat(-1)), np.int64, len(keys))
            return entries, np.flatnonzero(entries < 0)

        found, missing = looked_up()
        if len(missing) and len(self.entries) + len(missing) > MAX_KEPT + len(self.known):
            self._thin()
            found, missing = looked_up()
        if len(missing):
            where = first[missing]
            whole = points[starts[where]] >= POINTS
            plain = np.where(points >= POINTS, points - np.uint32(POINTS), points).astype("<u4", copy=False).tobytes().decode("utf-32-le")
            texts = [plain[a:b] for a, b in zip(starts[where].tolist(), ends[where].tolist(), strict=True)]
            count = len(self.entries)
            if whole.any():
                words = iter(self._library_ids([t for t, w in zip(texts, whole, strict=True) if w]))
                cut = iter(self._piece_ids([t for t, w in zip(texts, whole, strict=True) if not w]))
                merged = [next(words if w else cut) for w in whole]
            else:
                merged = self._piece_ids(texts)
            self._keep(hashes[missing].tolist(), merged)
            found[missing] = np.arange(count, count + len(missing))
        self.uses[found] += 1
        return found[inverse]

    def _slice(self, points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(entry of each piece, ids in each piece, pieces before each row)."""
        if self.kind == "clip":
            marked = unsettled()[points] if points.max() >= first_of("unsettled") else np.zeros(0, bool)
            whole = in_words_with(points, offsets, marked) if marked.any() else None
            raw, points = points, lowered()[points]
            starts, ends = split_clip(points, offsets, whole)
            if whole is not None:  # as they are in the text, and apart from lowered pieces
                points = np.where(whole, raw + np.uint32(POINTS), points)
        else:
            starts, ends = split_gpt(points, offsets)
        entries = self._entries_of(points, starts, ends)
        return entries, self.lengths[entries], np.searchsorted(starts, offsets)

    def _parts(self, texts: pa.Array):
        """(first row, proven rows as a mask, code points and offsets of proven rows, other texts)."""
        for first, end, data, offsets in slices(texts):
            points, at = codepoints(data, offsets)
            rows = end - first
            plain = np.full(rows, self.kind is not None)
            high = self.kind == "gpt" and len(points) and points.max() >= first_of("unassigned")
            if high and (bad := unassigned()[points]).any():
                plain[np.searchsorted(at, np.flatnonzero(bad), side="right") - 1] = False
            raw = data.tobytes()
            for mark in self.special:
                code, where = mark.encode(), -1
                while (where := raw.find(code, where + 1)) >= 0:
                    plain[np.searchsorted(offsets, where, side="right") - 1] = False
            others = {}
            if not plain.all():
                for k in np.flatnonzero(~plain).tolist():
                    others[k] = raw[offsets[k] : offsets[k + 1]].decode("utf-8", "replace")
                lengths = np.diff(at)
                points = points[np.repeat(plain, lengths)]
                lengths = np.where(plain, lengths, 0)
                at = np.concatenate(([0], np.cumsum(lengths)))
            yield rows, points, at, others

    def counts(self, texts: pa.Array) -> np.ndarray:
        """The number of ids of each text; null counts as empty."""
        out = []
        for rows, points, at, others in self._parts(texts):
            counts = np.zeros(rows, np.int64)
            if len(points):
                _, lengths, bounds = self._slice(points, at)
                sums = np.concatenate(([0], np.cumsum(lengths)))
                counts = sums[bounds[1:]] - sums[bounds[:-1]]
            for k, text in others.items():
                counts[k] = len(self._library_ids([text])[0])
            out.append(counts)
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def ids(self, texts: pa.Array):
        """The ids of each text in turn, as uint32 arrays; null counts as empty."""
        for rows, points, at, others in self._parts(texts):
            flat, cuts = np.zeros(0, np.uint32), np.zeros(rows + 1, np.int64)
            if len(points):
                entries, lengths, bounds = self._slice(points, at)
                sums = np.concatenate(([0], np.cumsum(lengths)))
                source = np.repeat(self.begins[entries] - sums[:-1], lengths) + np.arange(sums[-1])
                flat, cuts = self.pool[source], sums[bounds]
            for k in range(rows):
                if k in others:
                    yield np.array(self._library_ids([others[k]])[0], np.uint32)
                else:
                    yield flat[cuts[k] : cuts[k + 1]]


def pattern_kind(described: dict) -> str | None:
    """Which of the two known splits a tokenizer file asks for; None: another, use the library only."""
    if any(not t["special"] or t["normalized"] for t in described["added_tokens"]) or described.get("post_processor"):
        return None
    before, normalizer = described["pre_tokenizer"], described["normalizer"]
    if before == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}:
        return "gpt" if normalizer is None else None
    steps = [x["type"] for x in (normalizer or {}).get("normalizers", [])]
    if steps == ["NFC", "Replace", "Lowercase"] and before.get("type") == "Sequence":
        cut = before["pretokenizers"][0]
        if cut.get("pattern") == {"Regex": CLIP_PATTERN} and cut.get("behavior") == "Removed" and cut.get("invert"):
            return "clip"
    return None


def text_hashes(texts: list[str]) -> list[int]:
    """The hashes that ``Encoder`` gives to these texts as pieces."""
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    ends = np.cumsum([len(x) for x in texts])
    starts = np.concatenate(([0], ends[:-1]))
    return span_hashes(points, starts, ends).tolist()


def encoder(path: str, known: dict[str, int] | None = None) -> Encoder:
    """One encoder per worker process, file and set of proven pieces."""
    kept, key = cache_of("pieces"), (path, len(known or ()))
    if key not in kept:
        kept[key] = Encoder(path, known)
    return kept[key]
