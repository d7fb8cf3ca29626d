"""Embedding whitening by Chebyshev-filtered subspace iteration.

The covariance V of the vectors is never formed.  A pass over the vectors gives
V Q = Xᵀ(XQ) / n for a block Q of a few columns, X the centred vectors: every
task multiplies its rows, and the products are summed.  A Chebyshev polynomial of
V, applied by its three-term recurrence, one pass per degree, grows what lies
above the unwanted part of the spectrum and damps that part evenly.  QR makes the
columns orthonormal again, Rayleigh-Ritz turns them to eigenvectors, and this is
repeated until the residuals certify them.

Entries become integers first, so that sizes, sums and deviations are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import staged

COMPONENTS = 32
# Columns of the block beyond the wanted ones; the last of them bounds the unwanted spectrum.
GUARD = 16
DEGREE = 12
# Largest residual of a wanted pair, relative to the largest eigenvalue.
TOLERANCE = 1e-12
# A residual above it certifies nothing.
CERTIFIED = 1e-8
# Rounds of filter, QR and Rayleigh-Ritz at most; without progress they end earlier.
ROUNDS = 60
SCALE, SHIFT = 64, 1_000_000
# Eigenvalues below this share of the largest are no variance.
LEAST = 1e-12
# Vectors of one stored block.
BLOCK_ROWS = 4096
# Entries at most this large, so that exact sums stay in 64 bits.
LARGEST = 2.0**40
SEED = 7


@dataclass(frozen=True)
class Vectors:
    """Integer vectors, stored in ``blocks(n_rows, data)``: their number, dimensions and sums per dimension."""

    blocks: DataFrame
    n: int
    sums: np.ndarray

    @property
    def dims(self) -> int:
        return len(self.sums)


def _kept(rows: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors of a column are whole and finite, and these as integers, one per row."""
    lengths = rows.value_lengths().to_numpy(zero_copy_only=False)
    lengths = np.where(np.isnan(lengths.astype(float)), -1, lengths).astype(np.int64)
    values = rows.flatten()
    entries = values.to_numpy(zero_copy_only=False).astype(np.float64)  # null entries become NaN
    owner = np.repeat(np.arange(len(rows)), np.maximum(lengths, 0))
    bad = np.bincount(owner, ~np.isfinite(entries), len(rows)) > 0
    good = (lengths >= 0) & ~bad
    found = entries[good[owner]] if len(entries) else entries
    widths = np.unique(lengths[good])
    if len(widths) > 1:
        raise ValueError(f"vectors of different lengths: {widths.tolist()}")
    if len(found) and np.abs(found).max() * SCALE >= LARGEST:
        raise OverflowError("entries are too large for exact sums in 64 bits")
    integers = np.floor(SCALE * found).astype(np.int64) + SHIFT
    return good, integers.reshape(int(good.sum()), int(widths[0]) if len(widths) else 0)


def vectors(rows: DataFrame, column: str = "embedding") -> Vectors:
    """The whole and finite vectors of ``rows`` as integers, in stored blocks, with exact sums per dimension."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def block() -> pa.RecordBatch:
            data = np.concatenate(held)
            columns = [[len(data)], [data.shape[1]], [data.sum(axis=0)], [data.tobytes()]]
            types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["n", "dims", "sums", "data"])

        for batch in batches:
            _, found = _kept(batch.column(0))
            if len(found):
                held.append(found)
            if sum(map(len, held)) >= BLOCK_ROWS:
                yield block()
                held = []
        if held:
            yield block()

    blocks = staged(rows.select(column).mapInArrow(work, "n long, dims long, sums array<long>, data binary"), "whitening")
    n, least, dims = blocks.agg(F.sum("n"), F.min("dims"), F.max("dims")).first()
    if least != dims:
        raise ValueError(f"vectors of different lengths: {least} and {dims}")
    totals = blocks.select(F.posexplode("sums").alias("dimension", "part")).groupBy("dimension").agg(F.sum("part").alias("total"))
    sums = np.zeros(dims or 0, np.int64)
    for row in totals.collect():  # one row per dimension
        sums[row["dimension"]] = row["total"]
    return Vectors(blocks.select("n", "data"), n or 0, sums)


def centred(data: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S / n, exact up to the last rounding."""
    return (n * data - sums) / n


def products(held: Vectors, columns: np.ndarray, *, of_projections: bool = False) -> np.ndarray:
    """V times the columns, by one pass over the vectors; or the second moments of the vectors' projections on them.

    Every task sends one row per row of its product, and Spark adds them, so
    what is added in one place does not grow with the number of tasks.
    """
    spark = held.blocks.sparkSession
    sent = spark.sparkContext.broadcast((held.n, held.sums, columns))
    width = columns.shape[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, columns = sent.value
        total = np.zeros((width if of_projections else len(columns), width))
        seen = False
        for batch in batches:
            for data in batch.column(0):
                x = centred(np.frombuffer(data.as_buffer(), np.int64).reshape(-1, len(sums)), n, sums)
                projected = x @ columns
                total += (projected if of_projections else x).T @ projected
                seen = True
        if seen:
            names = ["row", *[f"c{k}" for k in range(width)]]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), *[pa.array(c) for c in total.T]], names)

    schema = ", ".join(["row long", *[f"c{k} double" for k in range(width)]])
    parts = held.blocks.select("data").mapInArrow(work, schema).groupBy("row").agg(*[F.sum(f"c{k}").alias(f"c{k}") for k in range(width)])
    found = parts.toArrow().sort_by("row")  # as many rows as dimensions
    sent.unpersist()
    return np.column_stack([found.column(f"c{k}").to_numpy() for k in range(width)]) / held.n


@dataclass(frozen=True)
class Spectrum:
    """Eigenvalues, falling, and unit eigenvectors of V, its trace, residuals relative to the first eigenvalue, and passes."""

    values: np.ndarray
    components: np.ndarray
    trace: float
    residuals: np.ndarray
    passes: int


def chebyshev(apply, block: np.ndarray, low: float, cut: float, top: float, degree: int) -> np.ndarray:
    """A scaled Chebyshev polynomial of V applied to a block: even and small on [``low``, ``cut``], largest at ``top``."""
    half, middle = (cut - low) / 2, (cut + low) / 2
    scale = first = half / (top - middle)
    now = (apply(block) - middle * block) * (scale / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - scale)
        block, now = now, (apply(now) - middle * now) * (2 * following / half) - scale * following * block
        scale = following
    return now


def spectrum(held: Vectors, components: int = COMPONENTS, *, guard: int = GUARD, degree: int = DEGREE, tolerance: float = TOLERANCE) -> Spectrum:
    """The leading eigenpairs of V by Chebyshev-filtered subspace iteration.

    The unwanted spectrum lies between 0 and the last Ritz value of the block.
    Iteration ends when all wanted residuals are within the tolerance, or have
    stopped falling at the accuracy of the sums.  What is not certified by then
    is refused with an error.
    """
    passes = 0

    def apply(columns: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        return products(held, columns)

    width = min(held.dims, components + guard)
    wanted = min(held.dims, components)
    block = np.linalg.qr(np.random.default_rng(SEED).standard_normal((held.dims, width)))[0]
    trace = float(np.square(_deviations(held)).sum())
    best: tuple[float, Spectrum] | None = None
    stalled = 0
    for _ in range(ROUNDS):
        image = apply(block)
        small = block.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        block, image = block @ turn, image @ turn
        top = max(values[0], 0.0)
        residuals = np.linalg.norm(image - block * values, axis=0)[:wanted] / (top or 1.0)
        found = Spectrum(values[:wanted], block[:, :wanted], trace, residuals, passes)
        worst = float(residuals.max(initial=0.0))
        stalled = stalled + 1 if best is not None and worst > best[0] / 2 else 0
        if best is None or worst < best[0]:
            best = worst, found
        if worst <= tolerance or width == held.dims or (stalled >= 3 and worst <= CERTIFIED):
            break
        cut = values[-1]  # no eigenvalue is below 0
        block = np.linalg.qr(chebyshev(apply, block, 0.0, cut, top, degree) if cut > LEAST * top else image)[0]
    if best[0] > CERTIFIED:
        raise ArithmeticError(f"eigenvectors are not certified: a residual of {best[0]:.1e} is left after {passes} passes")
    return best[1]


def _deviations(held: Vectors) -> np.ndarray:
    """Standard deviations per dimension; their squares sum to the trace of V."""
    spark = held.blocks.sparkSession
    sent = spark.sparkContext.broadcast((held.n, held.sums))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = sent.value
        total, seen = np.zeros(len(sums)), False
        for batch in batches:
            for data in batch.column(0):
                x = centred(np.frombuffer(data.as_buffer(), np.int64).reshape(-1, len(sums)), n, sums)
                total += np.einsum("ij,ij->j", x, x)
                seen = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["row", "part"])

    parts = held.blocks.select("data").mapInArrow(work, "row long, part double").groupBy("row").agg(F.sum("part").alias("total"))
    return np.sqrt(parts.toArrow().sort_by("row").column("total").to_numpy() / held.n)


def whitened(rows: DataFrame, components: int = COMPONENTS, *, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: a row per whole vector and component.

    A vector that is null, or holds a null or a non-finite entry, is left out.
    Vectors of different lengths, and entries beyond `LARGEST` after scaling,
    are refused with an error, as is a deviation beyond 64 bits.  Repeated rows
    and rows without an id are vectors of their own.  Where the vectors have
    less variance than ``components`` dimensions, only components with an
    eigenvalue above `LEAST` of the largest are returned: none for a single
    vector, equal vectors or an empty table.  Other columns are ignored.
    """
    spark = rows.sparkSession
    id_type = rows.schema[id_column].dataType.simpleString()
    schema = (
        f"{id_column} {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    held = vectors(rows, column)
    if not held.n or not held.dims:
        return spark.createDataFrame([], schema)
    found = spectrum(held, components)
    some = found.values > LEAST * max(found.values[0], 0.0)
    if not found.trace or not some.any():
        return spark.createDataFrame([], schema)
    projection = found.components[:, some] / np.sqrt(found.values[some])
    error = float(np.abs(products(held, projection, of_projections=True) - np.eye(projection.shape[1])).max())
    explained = np.minimum(found.values[some] / found.trace, 1.0)
    sent = spark.sparkContext.broadcast((held.n, held.sums, projection, explained, error))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, projection, explained, error = sent.value
        count = projection.shape[1]
        for batch in batches:
            good, data = _kept(batch.column(1))
            if not len(data):
                continue
            away = n * data - sums
            if float(np.abs(away).max()) ** 2 * len(sums) >= 2.0**63:
                deviation = [sum(int(v) ** 2 for v in row) for row in away]  # an error beyond 64 bits
            else:
                deviation = np.einsum("ij,ij->i", away, away)
            ids = batch.column(0).filter(pa.array(good))
            each = np.repeat(np.arange(len(data)), count)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(data))),
                    pa.array(np.full(len(each), n)),
                    pa.array(deviation, pa.int64()).take(pa.array(each)),
                    pa.array((away / n @ projection).ravel()),
                    pa.array(np.tile(explained, len(data))),
                    pa.array(np.full(len(each), error)),
                ],
                [id_column, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.select(id_column, column).mapInArrow(work, schema)
