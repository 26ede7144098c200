"""Whitening of vectors by principal components, found by spectral divide and conquer.

Sums and products are taken over all vectors: a task adds up its rows, tasks' totals are added in
two further steps, and only one matrix per vector width reaches the driver. Entries are whole
numbers, so these totals are exact, whatever the order in which they are added.

The covariance is split by QDWH: the polar factor of the covariance less a shift has the
eigenvalues 1 and -1, so it gives the projector on the components above the shift. Bases of
its range and of the rest make two smaller matrices, which are split in the same way down to
single components. The finished projection is broadcast and applied to every vector.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.tables import ship

#: Tasks that add up the totals of all tasks, before a last one adds up theirs.
ADDERS = 32
#: Rows that are worked on at a time.
ROWS = 2048
#: Entries are cut to this size; sums then stay whole numbers.
_LARGEST = 2.0**60
_LOW = (1 << 32) - 1
_EPS = float(np.finfo(np.float64).eps)


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by QDWH (weighted Halley steps)."""
    size = len(a)
    one = np.eye(size)
    x = a / np.linalg.norm(a)
    low = _EPS / 4  # no larger than the smallest singular value that can be told from 0
    for _ in range(40):
        square = low * low
        d = np.cbrt(4 * (1 - square) / square**2)
        root = np.sqrt(1 + d)
        weight = root + 0.5 * np.sqrt(max(8 - 4 * d + 8 * (2 - square) / (square * root), 0.0))
        b = (weight - 1) ** 2 / 4
        c = weight + b - 1
        if c > 100:  # the form by QR stays stable far from convergence
            q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, one]))
            new = b / c * x + (weight - b / c) / np.sqrt(c) * (q[:size] @ q[size:].T)
        else:
            new = b / c * x + (weight - b / c) * np.linalg.solve(one + c * (x.T @ x), x.T).T
        new = (new + new.T) / 2
        low = min(low * (weight + b * square) / (1 + c * square), 1.0)
        moved = np.linalg.norm(new - x)
        x = new
        if moved < np.cbrt(_EPS) and 1 - low < 10 * _EPS:
            break
    return x


def _bases(a: np.ndarray, shift: float) -> tuple[np.ndarray, int] | None:
    """An orthogonal basis whose first columns span the components above the shift, and their number.

    None if the shift does not part the components cleanly.
    """
    size = len(a)
    upper = (polar(a - shift * np.eye(size)) + np.eye(size)) / 2
    count = int(round(float(np.trace(upper))))
    if not 0 < count < size or np.linalg.norm(upper @ upper - upper) > 1e-8:
        return None
    found = np.random.default_rng(size).standard_normal((size, count))
    for _ in range(3):
        found = np.linalg.qr(upper @ found)[0]
    return np.linalg.qr(found, mode="complete")[0], count


def components(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in falling order and unit eigenvectors, in columns, of a symmetric matrix."""
    small = 4 * _EPS * float(np.linalg.norm(v))
    values, vectors = [], []
    open_ = [(v, np.eye(len(v)))]
    while open_:
        a, basis = open_.pop()
        size = len(a)
        middle = float(np.trace(a)) / size if size else 0.0
        if size < 2 or np.linalg.norm(a - middle * np.eye(size)) <= small:
            values.extend(np.diag(a))
            vectors.extend(basis.T)
            continue
        # A shift at the mean always has components on both sides; others serve if one lies on it.
        spread = float(np.linalg.norm(a - middle * np.eye(size))) / size
        shifts = [float(np.median(np.diag(a))), middle, *[middle + spread * s for s in (0.01, -0.01, 0.1, -0.1, 0.3, -0.3)]]
        parts = None
        for shift in shifts:
            if np.linalg.norm(a - shift * np.eye(size)) > 0 and (parts := _bases(a, shift)):
                q, count = parts
                turned = q.T @ a @ q
                if np.linalg.norm(turned[count:, :count]) <= 64 * small:
                    break
                parts = None
        if parts is None:  # components that doubles cannot tell apart
            values.extend(np.diag(a))
            vectors.extend(basis.T)
            continue
        turned = (turned + turned.T) / 2
        turned_basis = basis @ q
        open_.append((turned[:count, :count], turned_basis[:, :count]))
        open_.append((turned[count:, count:], turned_basis[:, count:]))
    vectors = np.array(vectors).reshape(len(values), len(v))
    # Rayleigh quotients of the finished vectors are right to twice their digits.
    values = np.einsum("ij,ij->i", vectors @ v, vectors) if len(values) else np.zeros(0)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[order].T


class _Total:
    """Sums of whole numbers in two halves, which do not overflow, and of other numbers."""

    def __init__(self, size: int):
        self.high, self.low, self.other = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size)

    def add(self, whole: np.ndarray) -> None:
        self.high += whole >> 32
        self.low += whole & _LOW
        self._carry()

    def _carry(self) -> None:
        self.high += self.low >> 32
        self.low &= _LOW

    def add_bytes(self, content: bytes) -> None:
        high, low, other = np.frombuffer(content, np.int64).reshape(3, -1)
        self.high, self.low = self.high + high, self.low + low
        self.other = self.other + other.view(np.float64)
        self._carry()

    def to_bytes(self) -> bytes:
        return self.high.tobytes() + self.low.tobytes() + self.other.tobytes()

    def whole(self) -> list[int]:
        return [(h << 32) + low for h, low in zip(self.high.tolist(), self.low.tolist(), strict=True)]


def _totals(vectors: DataFrame, size_of: Callable[[int], int], add: Callable[[int, np.ndarray, _Total], None]) -> dict[int, _Total]:
    """``add`` over all rows of each width, added up task by task."""
    schema = "width int, slot int, total binary"

    def emitted(totals: dict[int, _Total]) -> pa.RecordBatch:
        part = TaskContext.get().partitionId()
        columns = [list(totals), [part] * len(totals), [t.to_bytes() for t in totals.values()]]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.binary()), strict=True)], ["width", "slot", "total"])

    def of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, _Total] = {}
        for _, rows in whole_rows(batches):
            width = rows.shape[1]
            add(width, rows, totals.setdefault(width, _Total(size_of(width))))
        yield emitted(totals)

    def of_totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, _Total] = {}
        for batch in batches:
            for width, content in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
                content = content.as_buffer().to_pybytes()
                totals.setdefault(width, _Total(len(content) // 24)).add_bytes(content)
        yield emitted(totals)

    parts = vectors.mapInArrow(of_rows, schema).repartition(ADDERS, "slot").mapInArrow(of_totals, schema)
    out: dict[int, _Total] = {}
    for row in parts.repartition(1).mapInArrow(of_totals, schema).collect():  # one row per width
        out.setdefault(row["width"], _Total(len(row["total"]) // 24)).add_bytes(bytes(row["total"]))
    return out


def whole_rows(batches: Iterator[pa.RecordBatch], scale: float = 64.0, lift: int = 1_000_000) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of a few rows of one width, and their vectors (the last column) as floor(scale * c) + lift."""
    for batch in batches:
        for first in range(0, batch.num_rows, ROWS):
            part = batch.slice(first, ROWS)
            column = part.column(part.num_columns - 1)
            lengths = np.diff(np.asarray(column.offsets))
            for width in np.unique(lengths):
                here = np.flatnonzero(lengths == width)
                taken = part if len(here) == part.num_rows else part.take(pa.array(here))
                values = taken.column(taken.num_columns - 1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                cut = np.clip(np.floor(scale * values), -_LARGEST, _LARGEST)
                yield taken, cut.astype(np.int64).reshape(len(here), int(width)) + lift


class Whitener:
    """Of vectors of one width: their number, mean, leading components and projection."""

    def __init__(self, n: int, sums: list[int], products: _Total, limit: int):
        self.n = n
        self.centre = np.array([s // n for s in sums], np.int64)
        self.rest = [s % n for s in sums]
        self.rest_share = np.array([r / n for r in self.rest], np.float64)
        width = len(sums)
        whole = products.whole()
        cells = [
            (n * whole[i * width + j] - self.rest[i] * self.rest[j]) / (n * n) for i in range(width) for j in range(width)
        ]
        v = np.array(cells, np.float64).reshape(width, width) + products.other.reshape(width, width) / n
        v = (v + v.T) / 2
        trace = float(np.trace(v))
        values, vectors = components(v)
        kept = int((values > width * _EPS * max(float(values[0]), 0.0)).sum()) if width else 0
        self.values = values[: min(kept, limit)]
        self.explained = self.values / trace if trace else self.values
        self.projection = vectors[:, : len(self.values)] / np.sqrt(self.values)

    def centred(self, rows: np.ndarray) -> np.ndarray:
        return rows - self.centre

    def whitened(self, near: np.ndarray) -> np.ndarray:
        """Of rows less the whole part of the mean."""
        return (near - self.rest_share) @ self.projection

    def deviations(self, near: np.ndarray) -> list[int]:
        """Sums of (n * x - S) ** 2, exact; beyond 64 bits they are cut to the largest long."""
        n, width = self.n, near.shape[1]
        most = int(np.abs(near).max(initial=0))
        rest = np.array(self.rest, dtype=np.int64 if n < 1 << 62 else object)
        if most * max(most, n) * max(width, 1) >= 1 << 62:
            near, rest = near.astype(object), rest.astype(object)
        squares, mixed = (near * near).sum(axis=1).tolist(), (near * rest).sum(axis=1).tolist()
        last = sum(r * r for r in self.rest)
        return [min(n * n * int(a) - 2 * n * int(b) + last, (1 << 63) - 1) for a, b in zip(squares, mixed, strict=True)]


def _products(models: dict) -> Callable[[int, np.ndarray, _Total], None]:
    """Adds the products of entries less the whole part of their mean."""

    def add(width: int, rows: np.ndarray, total: _Total) -> None:
        near = rows - models[width]
        most = float(np.abs(near).max(initial=0))
        product = near.astype(np.float64).T @ near.astype(np.float64)
        if most * most * len(rows) < 2.0**53:  # then these doubles are whole numbers
            total.add(product.astype(np.int64).ravel())
        else:
            total.other += product.ravel()

    return add


def fit(vectors: DataFrame, limit: int = 32) -> dict[int, Whitener]:
    """A ``Whitener`` for each width in ``vectors`` (a last column of usable vectors); reads it twice."""

    def add_sums(width: int, rows: np.ndarray, total: _Total) -> None:
        total.high += np.append((rows >> 32).sum(0), 0)
        total.low += np.append((rows & _LOW).sum(0), len(rows))
        total._carry()

    sums = {width: total.whole() for width, total in _totals(vectors, lambda width: width + 1, add_sums).items()}
    centres = {width: np.array([s // of[-1] for s in of[:-1]], np.int64) for width, of in sums.items()}
    products = _totals(vectors, lambda width: width * width, _products(centres))
    return {width: Whitener(of[-1], of[:-1], products[width], limit) for width, of in sums.items()}


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, row): rows whose vectors hold finite numbers only."""
    vector = F.col(f"`{vector_column}`")
    fine = F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")))
    return vectors.where(vector.isNotNull() & fine).select(
        F.col(f"`{id_column}`").cast("long").alias("id"), F.transform(vector, lambda c: c.cast("double")).alias("row")
    )


def whiten(vectors: DataFrame, limit: int = 32, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) per vector and component.

    An entry c becomes x = floor(64 * c) + 1000000. ``n`` vectors have the sums S; ``deviation`` is
    the sum of (n * x - S) ** 2, cut to the largest long; ``whitened`` is x - S / n on the component,
    over the root of its eigenvalue; ``explained`` is the eigenvalue's share of all; ``identity_error``
    is measured on the whitened vectors themselves.

    Null vectors and vectors with null or non-finite entries are left out. Repeated rows count as often
    as they stand there; null ids are kept. Vectors of each width are fitted by themselves. Components
    without variance (of repeated vectors, or beyond the number of vectors) cannot be whitened and have
    no rows; empty vectors and empty tables have none either. Entries beyond 2 ** 60 / 64 are cut to it.
    Other columns are not read, whatever their names. ``vectors`` is read four times.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = usable(vectors, id_column, vector_column)
    models = fit(rows.select("row"), limit)
    known = spark.sparkContext.broadcast(models)  # limit x width numbers per width

    def add_whitened(width: int, some: np.ndarray, total: _Total) -> None:
        model = known.value[width]
        w = model.whitened(model.centred(some))
        total.other += np.append(w.sum(0), (w.T @ w).ravel())

    sizes = {width: len(model.values) for width, model in models.items()}
    seen = _totals(rows.select("row"), lambda width: sizes[width] * (sizes[width] + 1), add_whitened)
    errors = {}
    for width, total in seen.items():
        count, n = sizes[width], models[width].n
        mean, square = total.other[:count] / n, total.other[count:].reshape(count, count) / n
        errors[width] = float(np.abs(square - np.outer(mean, mean) - np.eye(count)).max(initial=0.0))

    names = [id_column, "component", "n", "deviation", "whitened", "explained", "identity_error"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, some in whole_rows(batches):
            width = some.shape[1]
            model = known.value[width]
            near, count = model.centred(some), len(model.values)
            if not count:
                continue
            total = len(some) * count
            columns = [
                batch.column(0).take(pa.array(np.repeat(np.arange(len(some)), count))),
                pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(some))),
                pa.array(np.full(total, model.n)),
                pa.array(np.repeat(np.array(model.deviations(near), np.int64), count)),
                pa.array(model.whitened(near).ravel()),
                pa.array(np.tile(model.explained, len(some))),
                pa.array(np.full(total, errors[width])),
            ]
            yield pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, types, strict=True)], names)

    quoted = id_column.replace("`", "``")
    return rows.mapInArrow(
        run, f"`{quoted}` long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
