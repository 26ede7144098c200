"""Web archives: records written to WARC files, read back, and their index merged.

Files are gzip, one member per record, so a record can be read by its offset alone. A record whose
payload another record holds is a revisit without the payload. Each file, when read, gives a run of
captures sorted by URL key and time; runs are cut at common boundaries and each range of keys is
merged from its runs by a loser tree, which gives the captures of all files in one global order.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime, timedelta
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.tables import beside, read_files, ship, stored, write_files

#: Bytes of a file before the next one is begun.
FILE_BYTES = 8 << 20
#: Payloads shorter than this are never revisits.
SHORTEST_REVISIT = 1000
#: Captures that a task merges, about.
MERGED_ROWS = 200_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_EPOCH = datetime(1970, 1, 1, tzinfo=UTC)
_CHUNK = 1 << 16


def url_key(url: str) -> str:
    """The sort key of a URL: host labels from right to left, then path and query, in lower case."""
    _, found, rest = url.partition("://")
    rest = rest if found else url
    cut = min((k for k in map(rest.find, "/?#") if k >= 0), default=len(rest))
    host, path = rest[:cut].lower(), rest[cut:].partition("#")[0].lower()
    return f"{','.join(reversed(host.rpartition('@')[2].split('.')))}){path or '/'}"


def record(kind: str, fields: dict[str, str], block: bytes) -> bytes:
    """One WARC record."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *[f"{k}: {v}" for k, v in fields.items()], f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def packed(data: bytes) -> bytes:
    """One gzip member without a time of its own."""
    squeeze = zlib.compressobj(4, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


def members(content: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, data) of each gzip member, reading a little at a time."""
    view, at = memoryview(content), 0
    while at < len(view):
        begin, opened, parts = at, zlib.decompressobj(31), []
        while not opened.eof:
            if at >= len(view):
                raise ValueError("a record is cut off")
            piece = view[at : at + _CHUNK]
            parts.append(opened.decompress(piece))
            at += len(piece) - len(opened.unused_data)
        yield begin, at - begin, b"".join(parts)


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Fields (``WARC-Type`` among them) and block of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    length = int(fields["Content-Length"])
    if rest[length:] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    return fields, rest[:length]


def _name(page) -> str:
    return f"<urn:page:{'null' if page is None else page}>"


def _page(name: str) -> int | None:
    number = name.removeprefix("<urn:page:").removesuffix(">")
    return None if number == "null" else int(number)


def write_archives(
    pages: DataFrame,
    path: str,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
    seconds: Column | None = None,
    file_bytes: int = FILE_BYTES,
) -> None:
    """Writes a record per row to files below ``path``. ``seconds``: the time of capture since 1970 (default: 0)."""
    ship(pages.sparkSession)
    payload = F.coalesce(F.col(payload_column).cast("string"), F.lit(""))
    source = pages.select(
        F.col(id_column).cast("long").alias("id"),
        F.col(url_column).cast("string").alias("url"),
        F.coalesce(F.lit(0) if seconds is None else seconds, F.lit(0)).cast("long").alias("seconds"),
        payload.alias("payload"),
        F.octet_length(payload).alias("size"),
        F.sha1(payload).alias("digest"),
    )
    long = source.where(F.col("size") >= SHORTEST_REVISIT)
    first = long.groupBy("digest").agg(F.max("id").alias("first"), F.count(F.lit(1)).alias("n"))
    first = beside(stored(first.where("n > 1 AND first IS NOT NULL").select("digest", "first")))
    joined = source.join(first, "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    rows = joined.select(
        "id", "url", "seconds", "digest", "size", F.when(again, F.col("first")).alias("refers"), F.when(~again, F.col("payload")).alias("payload")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held, size = TaskContext.get().partitionId(), 0, [], 0

        def flush():
            name = f"starloom-{part:05d}-{number:05d}.warc.gz"
            first = {"WARC-Record-ID": f"<urn:file:{part << 20 | number}>", "WARC-Date": "1970-01-01T00:00:00Z", "WARC-Filename": name}
            content = b"".join([packed(record("warcinfo", first, b"")), *held])
            return pa.RecordBatch.from_arrays([pa.array([content], pa.binary())], ["content"])

        for batch in batches:
            for page, url, seconds, digest, length, refers, payload in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                date = (_EPOCH + timedelta(seconds=seconds)).strftime("%Y-%m-%dT%H:%M:%SZ")
                fields = {"WARC-Record-ID": _name(page), "WARC-Date": date}
                if url is not None:
                    fields["WARC-Target-URI"] = quote(url, safe="".join(map(chr, range(0x20, 0x7F))))
                fields |= {"WARC-Payload-Digest": f"sha1:{digest}", "Content-Type": "application/http;msgtype=response"}
                block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
                if payload is None:
                    fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": _name(refers)}
                else:
                    block += payload.encode()
                member = packed(record("response" if payload is not None else "revisit", fields, block))
                held.append(member)
                size += len(member)
                if size >= file_bytes:
                    yield flush()
                    number, held, size = number + 1, [], 0
        if held:
            yield flush()

    write_files(rows.mapInArrow(write, "content binary"), "content", path)


_CAPTURE = {
    "id": pa.int64(),
    "url_key": pa.string(),
    "seconds": pa.int64(),
    "payload_bytes": pa.int64(),
    "payload_digest": pa.string(),
    "record_type": pa.string(),
    "refers_to": pa.int64(),
    "file": pa.int64(),
    "record_offset": pa.int64(),
    "record_length": pa.int64(),
    "turn": pa.int64(),
}
_CAPTURE_SQL = ", ".join(f"{k} {'string' if pa.types.is_string(t) else 'long'}" for k, t in _CAPTURE.items())


def _order(capture: tuple) -> tuple:
    """By URL key and time, then id (null first) and place."""
    return capture[1], capture[2], capture[0] is not None, capture[0] or 0, capture[7], capture[8]


def captures_of(content: bytes) -> list[tuple]:
    """The captures of one file in the order of the index. Payloads are checked against their digests."""
    file, found = None, []
    for offset, length, data in members(content):
        fields, block = parsed(data)
        kind = fields["WARC-Type"]
        if kind == "warcinfo":
            file = int(fields["WARC-Record-ID"].removeprefix("<urn:file:").removesuffix(">"))
            continue
        head, _, payload = block.partition(b"\r\n\r\n")
        size = int(head.rpartition(b"Content-Length: ")[2])
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
            raise ValueError(f"record {fields['WARC-Record-ID']} does not match its digest")
        moment = datetime.strptime(fields["WARC-Date"], "%Y-%m-%dT%H:%M:%SZ").replace(tzinfo=UTC)
        refers = _page(fields["WARC-Refers-To"]) if kind == "revisit" else None
        key = url_key(fields["WARC-Target-URI"]) if "WARC-Target-URI" in fields else ""
        seconds = (moment - _EPOCH) // timedelta(seconds=1)
        found.append((_page(fields["WARC-Record-ID"]), key, seconds, size, digest, kind, refers, file, offset, length))
    found.sort(key=_order)
    return found


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The captures of all files; ``file`` names the run that a capture is in and ``turn`` its place there."""
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                found = captures_of(content.as_py())
                columns = [*zip(*found, strict=True)] if found else [[] for _ in range(10)]
                columns.append(range(len(found)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(x), t) for x, t in zip(columns, _CAPTURE.values(), strict=True)], list(_CAPTURE)
                )

    return read_files(spark, path).select("content").mapInArrow(run, _CAPTURE_SQL)


class LoserTree:
    """Merges sorted runs: each inner node holds the run that lost there, the top the next to come."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs, self.places = runs, [0] * len(runs)
        self.heads = [run[0] if run else None for run in runs]
        self.losers = [-1] * max(1, len(runs))
        self.winner = self._play(1) if runs else -1

    def _wins(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and (x, a) <= (y, b))

    def _play(self, node: int) -> int:
        if node >= len(self.runs):
            return node - len(self.runs)
        left, right = self._play(2 * node), self._play(2 * node + 1)
        won, lost = (left, right) if self._wins(left, right) else (right, left)
        self.losers[node] = lost
        return won

    def __iter__(self) -> Iterator[tuple[int, int]]:
        """(run, place in it), in the order of the keys."""
        while self.winner >= 0 and self.heads[self.winner] is not None:
            run = self.winner
            yield run, self.places[run]
            self.places[run] += 1
            rest = self.runs[run]
            self.heads[run] = rest[self.places[run]] if self.places[run] < len(rest) else None
            node = (run + len(self.runs)) // 2
            while node:
                if self._wins(self.losers[node], run):
                    run, self.losers[node] = self.losers[node], run
                node //= 2
            self.winner = run


def merged(captures: DataFrame) -> DataFrame:
    """The captures in the global order of URL key, time and id: by ``part``, then ``place``."""
    captures = stored(captures)
    parts = int(captures.count() // MERGED_ROWS + 1)
    ranged = captures.repartitionByRange(parts, "url_key", "seconds", "id", "file", "record_offset")
    runs = ranged.sortWithinPartitions("file", "turn")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(batches)  # a range of keys of bounded size
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        rows = list(zip(*[c.to_pylist() for c in table.columns], strict=True))
        runs: dict[int, list[int]] = {}
        for n, row in enumerate(rows):
            runs.setdefault(row[7], []).append(n)
        numbers = list(runs.values())
        tree = LoserTree([[_order(rows[n]) for n in run] for run in numbers])
        taken = [numbers[run][place] for run, place in tree]
        table = table.take(pa.array(taken, pa.int64())).drop_columns(["turn"])
        table = table.append_column("part", pa.array([TaskContext.get().partitionId()] * len(taken), pa.int64()))
        yield from table.append_column("place", pa.array(range(len(taken)), pa.int64())).to_batches()

    return runs.mapInArrow(merge, _CAPTURE_SQL.replace("turn long", "part long, place long"))


def archive_round_trip(
    pages: DataFrame, path: str, id_column: str = "page_id", seconds: Column | None = None, **options
) -> DataFrame:
    """Writes the archives, reads them back and merges their index; a row per record.

    (id, payload_bytes, payload_digest, record_type, refers_to, url_key, seconds, file, record_offset,
    record_length, part, place). Of records with equal payloads of SHORTEST_REVISIT bytes or more,
    that with the largest id is the response and the others revisit it; shorter ones are all
    responses. Rows that repeat the largest id are responses as well. A null id counts as the smallest;
    if all ids of equal payloads are null, all are responses. A null payload is empty, a null URL has
    an empty key. Other columns are not read. An empty table gives no rows.
    """
    write_archives(pages, path, id_column, seconds=seconds, **options)
    return merged(read_archives(pages.sparkSession, path)).withColumnRenamed("id", id_column)
