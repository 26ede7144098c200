"""Token counts by the whole-token shortcut.

Offline, every string of the vocabulary is tried: if the split leaves it in one piece and the
library gives it its own id alone, the string is proven to be one whole token. Texts are then
cut into pieces; a piece that is a proven string counts one without any merging, and only the
rest is merged, once per worker and piece.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.bytewise import utf8
from starloom.llm.pieces import Encoder, byte_letters, encoder, lowered, split_clip, split_gpt, unassigned, unsettled
from starloom.llm.tables import ship


@lru_cache(maxsize=4)
def whole_tokens(path: str) -> dict[str, int]:
    """The strings of the vocabulary that are proven to be one token when they stand as one piece."""
    tokens = Encoder(path)
    if tokens.kind is None:
        return {}
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    open_ = unsettled() if tokens.kind == "clip" else unassigned()
    letters = {letter: byte for byte, letter in enumerate(byte_letters())}
    candidates = {}
    for token, number in vocabulary.items():
        token = token.removesuffix("</w>") if tokens.kind == "clip" else token
        try:
            text = bytes(letters[c] for c in token).decode("utf-8")
        except (KeyError, UnicodeDecodeError):
            continue
        if text and text not in tokens.special and not any(open_[ord(c)] for c in text):
            candidates.setdefault(text, []).append(number)
    texts = list(candidates)
    proven = {}
    for text, ids in zip(texts, tokens._library_ids(texts), strict=True):
        if len(ids) == 1 and ids[0] in candidates[text] and _one_piece(text, tokens.kind):
            proven[text] = ids[0]
    return proven


def _one_piece(text: str, kind: str) -> bool:
    points = np.array([ord(c) for c in text], np.uint32)
    bounds = np.array([0, len(text)])
    if kind == "clip":
        if (lowered()[points] != points).any():
            return False
        starts, ends = split_clip(points, bounds)
    else:
        starts, ends = split_gpt(points, bounds)
    return len(starts) == 1 and starts[0] == 0 and ends[0] == len(text)


def count_tokens(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", limit: int = 1024
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of each row, in any order.

    ``n_tokens`` is what the library gives for the whole text without begin, end or other added
    tokens. A null or empty text has 0 bytes and 0 tokens. Repeated rows and null ids are kept;
    other columns of ``docs`` are not read, whatever they are called. An empty table gives none.
    """
    spark = docs.sparkSession
    ship(spark)
    known = spark.sparkContext.broadcast(whole_tokens(path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(path, known.value)
        for batch in batches:
            _, offsets = utf8(batch.column(1))
            counts = tokens.counts(batch.column(1))
            columns = [batch.column(0), np.diff(offsets), counts, counts > limit]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["id", "n_bytes", "n_tokens", "over_limit"])

    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    counted = source.mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean")
    return counted.withColumnRenamed("id", id_column)
