"""Token ids in files of bit or byte planes.

A file (``shard``) holds the ids of consecutive texts. Ids are cut into blocks of a fixed
number; each block is transposed, so that all first bytes (or bits) lie together, then all second
ones, and so on; each plane is compressed by zstandard on its own, planes of zeros are left out.
Layout, all integers little-endian:

    magic "SLTP0001"
    the compressed planes, one after the other
    texts: their ids (int64), a byte each that is 1 if the id is null, lengths in ids (int64)
    chunk index: per block the number of ids (uint32), their crc32 (uint32), and per plane its
        place in the file (uint64) and its length (uint32; 0: all zeros)
    trailer: shard, texts, ids, blocks, block size, planes, place of texts, place of the chunk
        index (eight int64), magic
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.pieces import encoder
from starloom.llm.tables import read_files, running_total, ship, write_files

MAGIC = b"SLTP0001"
BLOCK = 1 << 16
#: Ids in a file at most, unless a single text has more.
SHARD_IDS = 1 << 22
PLANES = {"byte": 4, "bit": 32}
_TRAILER = struct.Struct("<8q8s")
_PLACE = np.dtype([("place", "<u8"), ("length", "<u4")])


def planes_of(ids: np.ndarray, planes: int) -> np.ndarray:
    """A row of bytes per plane; ids are uint32."""
    as_bytes = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if planes == 4:
        return np.ascontiguousarray(as_bytes.T)
    bits = np.unpackbits(as_bytes, axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")


def ids_of(rows: np.ndarray, count: int) -> np.ndarray:
    """The inverse of ``planes_of``."""
    if len(rows) == 4:
        return np.ascontiguousarray(rows.T).view("<u4").reshape(-1)[:count]
    bits = np.unpackbits(rows, axis=1, bitorder="little")[:, :count]
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u4").reshape(-1)


def encode_shard(
    shard: int, ids: np.ndarray, text_ids: list, lengths: list[int], planes: int = 4, block: int = BLOCK
) -> bytes:
    """One file's bytes."""
    squeeze = zstandard.ZstdCompressor(level=3)
    body, place, index = [MAGIC], len(MAGIC), []
    for begin in range(0, len(ids), block):
        part = ids[begin : begin + block]
        index.append(struct.pack("<II", len(part), zlib.crc32(np.ascontiguousarray(part, "<u4").tobytes())))
        for plane in planes_of(part, planes):
            packed = squeeze.compress(plane.tobytes()) if plane.any() else b""
            index.append(struct.pack("<QI", place, len(packed)))
            body.append(packed)
            place += len(packed)
    texts = (
        np.array([k or 0 for k in text_ids], "<i8").tobytes()
        + bytes(k is None for k in text_ids)
        + np.array(lengths, "<i8").tobytes()
    )
    chunks = b"".join(index)
    blocks = -(-len(ids) // block)
    trailer = _TRAILER.pack(
        shard, len(text_ids), len(ids), blocks, block, planes, place, place + len(texts), MAGIC
    )
    return b"".join([*body, texts, chunks, trailer])


class Shard:
    """A file's bytes, read by its chunk index."""

    def __init__(self, content: bytes):
        (
            self.number,
            texts,
            self.count,
            blocks,
            self.block,
            self.planes,
            place,
            chunks,
            magic,
        ) = _TRAILER.unpack(content[-_TRAILER.size :])
        if magic != MAGIC or content[: len(MAGIC)] != MAGIC:
            raise ValueError("not a file of token planes")
        self.content = content
        raw = np.frombuffer(content, "<i8", texts, place)
        null = np.frombuffer(content, np.uint8, texts, place + 8 * texts)
        self.text_ids = [None if n else k for k, n in zip(raw.tolist(), null.tolist(), strict=True)]
        self.lengths = np.frombuffer(content, "<i8", texts, place + 9 * texts)
        row = np.dtype([("ids", "<u4"), ("crc", "<u4"), ("planes", _PLACE, self.planes)])
        self.index = np.frombuffer(content, row, blocks, chunks)

    def block_ids(self, number: int) -> np.ndarray:
        """The ids of one block, checked; only this block's planes are unpacked."""
        entry = self.index[number]
        count = int(entry["ids"])
        width = count if self.planes == 4 else -(-count // 8)
        rows = np.zeros((self.planes, width), np.uint8)
        for k, (place, length) in enumerate(entry["planes"].tolist()):
            if length:
                plane = zstandard.ZstdDecompressor().decompress(self.content[place : place + length], width)
                rows[k] = np.frombuffer(plane, np.uint8)
        ids = ids_of(rows, count)
        if zlib.crc32(ids.tobytes()) != entry["crc"]:
            raise ValueError(f"block {number} of file {self.number} is damaged")
        return ids

    def ids(self) -> np.ndarray:
        blocks = [self.block_ids(k) for k in range(len(self.index))]
        return np.concatenate(blocks) if blocks else np.zeros(0, "<u4")


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 1,
    id_column: str = "doc_id",
    text_column: str = "text",
    planes: str = "byte",
    shard_ids: int = SHARD_IDS,
) -> None:
    """Writes the ids of all texts below ``path``, texts in ascending order of their ids.

    Each text's ids (the library's, without added ones) are followed by ``end_id``. A null text
    counts as empty and has the end id alone; a null id comes first; rows of one id follow each
    other in the order of a hash of their texts. Files are numbered in this order: the range of ids
    in the upper bits, the file within it in the lower 20. Other columns are not read.
    """
    n_planes = PLANES[planes]
    ship(docs.sparkSession)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part, number = encoder(tokenizer), TaskContext.get().partitionId(), 0
        ids, text_ids, lengths, held = [], [], [], 0

        def flush():
            flat = np.concatenate(ids)
            content = encode_shard(part << 20 | number, flat, text_ids, lengths, n_planes)
            return pa.RecordBatch.from_arrays([pa.array([content], pa.binary())], ["content"])

        for batch in batches:
            for text_id, found in zip(batch.column(0).to_pylist(), tokens.ids(batch.column(1)), strict=True):
                if held and held + len(found) + 1 > shard_ids:
                    yield flush()
                    number += 1
                    ids, text_ids, lengths, held = [], [], [], 0
                ids.append(np.append(found, np.uint32(end_id)))
                text_ids.append(text_id)
                lengths.append(len(found) + 1)
                held += len(found) + 1
        if held:
            yield flush()

    source = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    tie = F.xxhash64("text")
    ordered = source.repartitionByRange("id", tie).sortWithinPartitions("id", tie)
    write_files(ordered.mapInArrow(shards, "content binary"), "content", path)


def read_token_files(spark: SparkSession, path: str, id_column: str = "doc_id") -> DataFrame:
    """Per text of the files: (id, shard, position, n_tokens, ids_crc32, start).

    ``start`` is the number of ids of all texts before it, ``ids_crc32`` the unsigned crc32 of its
    ids as little-endian unsigned 32-bit integers. Every block is unpacked and checked.
    """

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                shard = Shard(content.as_py())
                raw, lengths = memoryview(shard.ids().tobytes()), shard.lengths
                ends = np.cumsum(lengths)
                crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip((ends - lengths).tolist(), ends.tolist(), strict=True)]
                count = len(lengths)
                columns = [
                    pa.array(shard.text_ids, pa.int64()),
                    pa.array(np.full(count, shard.number, np.int64)),
                    pa.array(np.arange(count)),
                    pa.array(lengths),
                    pa.array(crcs, pa.int64()),
                    pa.array(ends - lengths),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    ship(spark)
    names = ["id", "shard", "position", "n_tokens", "ids_crc32", "inside"]
    kinds = ", ".join(f"{x} long" for x in names)
    found = read_files(spark, path).select("content").mapInArrow(texts, kinds)
    files = found.groupBy("shard").agg(F.sum("n_tokens").alias("file_ids"))
    placed = running_total(files, F.shiftright("shard", 20), [F.col("shard")], F.col("file_ids"), "before")
    result = found.join(placed.select("shard", "before"), "shard")
    return result.select(
        F.col("id").alias(id_column), "shard", "position", "n_tokens", "ids_crc32", (F.col("before") + F.col("inside")).alias("start")
    )
