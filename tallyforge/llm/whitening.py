"""Whitening of vectors by spectral divide and conquer.

Entries become whole numbers of a fixed step, each distinct vector counts once, and the covariance
of this list comes from two passes: exact sums, then products of centred entries, summed per task.
Its eigenvectors are found by halving the space: the polar factor of the covariance less a shift
has eigenvalues 1 and -1, so half of it plus the identity projects on the vectors above the shift.
Bases of that space and of the rest cut the matrix into two smaller ones, and so on down to single
components. Polar factors are computed with QDWH, dynamically weighted Halley steps by QR or
Cholesky. The matrix has as many rows as the vectors have entries; only it reaches the driver.

Vectors that are NULL, hold a NULL or an entry that is not finite or beyond 64 bits, or are not of
the commonest length, are left out. Fewer entries than components give fewer components. A
component along which the list does not vary beyond rounding has ``whitened`` NULL; so has
``explained`` where nothing varies. A deviation beyond 64 bits is NULL. Without vectors the result is empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructType

from tallyforge.llm.vectors import common_length, finite_rows
from tallyforge.sources.storage import materialize

#: Steps of an entry to one, and components that the report shows.
SCALE, COMPONENTS = 256, 4
WIDTHS = ("<i2", "<i4", "<i8")
EPS = float(np.finfo(np.float64).eps)


def whole_rows(column: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and whole-number entries of the usable vectors."""
    places, values = finite_rows(column, length)
    with np.errstate(over="ignore"):
        steps = np.floor(SCALE * values)
    fits = (np.abs(steps) < 2.0**63).all(axis=1)
    return places[fits], steps[fits].astype(np.int64)


def pack(rows: np.ndarray) -> list[bytes]:
    """Each row's numbers in the narrowest of three widths that holds them all."""
    high, low = rows.max(axis=1, initial=0), rows.min(axis=1, initial=0)
    width = np.zeros(len(rows), np.int64)
    for kind in WIDTHS[:-1]:
        bounds = np.iinfo(kind)
        width += (high > bounds.max) | (low < bounds.min)
    made = [rows.astype(kind) for kind in WIDTHS]
    return [made[kind][row].tobytes() for row, kind in enumerate(width.tolist())]


def unpack(column: pa.Array, length: int) -> np.ndarray:
    """The rows of a batch that ``pack`` made, in any order."""
    values, parts = column.to_pylist(), []
    for kind in WIDTHS:
        size = length * np.dtype(kind).itemsize
        found = b"".join(value for value in values if len(value) == size)
        parts.append(np.frombuffer(found, kind).astype(np.int64).reshape(-1, length))
    return np.concatenate(parts)


def distinct_vectors(df: DataFrame, vector: str, length: int) -> DataFrame:
    """Every distinct whole-number vector once, packed and written out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = pack(whole_rows(batch.column(0), length)[1])
            yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary())], names=["packed"])

    return materialize(df.select(vector).mapInArrow(run, "packed binary").distinct())


def column_sums(rows: np.ndarray) -> list[int]:
    """Exact sums per column."""
    largest = max(int(rows.max(initial=0)), -int(rows.min(initial=0)), 1)
    wide = largest * max(1, len(rows)) >= 1 << 63
    return [int(total) for total in (rows.astype(object) if wide else rows).sum(axis=0)]


def exact_sums(listed: DataFrame, length: int) -> tuple[int, list[int]]:
    """Number of vectors and the exact sum of each entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [0] * (length + 1)
        for batch in batches:
            rows = unpack(batch.column(0), length)
            totals = [a + b for a, b in zip(totals, [*column_sums(rows), len(rows)])]
        arrays = [pa.array(range(length + 1)), pa.array([Decimal(total) for total in totals], pa.decimal128(38, 0))]
        yield pa.RecordBatch.from_arrays(arrays, names=["entry", "total"])

    parts = listed.mapInArrow(run, "entry long, total decimal(38,0)").groupBy("entry").agg(F.sum("total").alias("total"))
    found = {row["entry"]: int(row["total"]) for row in parts.collect()}
    return found.get(length, 0), [found.get(entry, 0) for entry in range(length)]


def mean_products(listed: DataFrame, length: int, count: int, mean: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """Mean over the list of the products of all pairs of entries of (vector - mean) @ turn, and of 1."""
    width = turn.shape[1] + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            rows = (unpack(batch.column(0), length) - mean) @ turn
            rows = np.hstack([rows, np.ones((len(rows), 1))])
            total += rows.T @ rows
        places = [pa.array(each.ravel()) for each in np.indices((width, width))]
        yield pa.RecordBatch.from_arrays([*places, pa.array(total.ravel())], names=["i", "j", "total"])

    parts = listed.mapInArrow(run, "i long, j long, total double").groupBy("i", "j").agg(F.sum("total").alias("total"))
    table = np.zeros((width, width))
    for row in parts.collect():
        table[row["i"], row["j"]] = row["total"]
    return table / count


def polar_factor(matrix: np.ndarray) -> np.ndarray:
    """The orthogonal factor of a symmetric matrix, by dynamically weighted Halley steps.

    ``least`` bounds the singular values from below and steers the weights; QR is used while the
    weights are large, then Cholesky.
    """
    size = len(matrix)
    x = matrix / np.linalg.norm(matrix, 1)
    try:
        least = 1 / np.linalg.norm(np.linalg.inv(x))
    except np.linalg.LinAlgError:
        least = EPS
    least, eye = min(1.0, max(least, EPS)), np.eye(size)
    for _ in range(30):
        square = least * least
        d = np.cbrt(4 * (1 - square) / (square * square))
        a = np.sqrt(1 + d) + np.sqrt(8 - 4 * d + 8 * (2 - square) / (square * np.sqrt(1 + d))) / 2
        b = (a - 1) ** 2 / 4
        c = a + b - 1
        if c > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, eye]))
            step = (a - b / c) / np.sqrt(c) * q[:size] @ q[size:].T
        else:
            root = np.linalg.cholesky(eye + c * x.T @ x)
            half = np.linalg.solve(root, x.T)
            step = (a - b / c) * np.linalg.solve(root.T, half).T
        new = b / c * x + step
        new = (new + new.T) / 2
        moved, x = np.linalg.norm(new - x), new
        least = min(1.0, least * (a + b * square) / (1 + c * square))
        if moved < 10 * EPS * size and 1 - least < 10 * EPS:
            break
    return x


def split_space(matrix: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the spaces of large and of small eigenvalues; None if they are all alike.

    The shift starts at the middle of the diagonal, which lies between the eigenvalues. One that
    meets an eigenvalue leaves no projector, and one beyond all of them no second space: the shift
    then halves what is left of their range.
    """
    size, diagonal = len(matrix), np.sort(np.diag(matrix))
    reach = np.abs(matrix).sum(axis=1) - np.abs(np.diag(matrix))
    low, high = float((np.diag(matrix) - reach).min()), float((np.diag(matrix) + reach).max())
    shift = float(diagonal[size // 2 - 1] + diagonal[size // 2]) / 2
    rng, eye = np.random.default_rng(size), np.eye(size)
    while high - low > 4 * EPS * size * scale:
        shifted = matrix - shift * eye
        if np.linalg.norm(shifted) <= 4 * EPS * size * scale:
            return None
        sign = polar_factor(shifted)
        if np.linalg.norm(sign @ sign - eye) > 1e-8:
            # An eigenvalue at the shift: go on a little beside it.
            shift += (high - low) * 1e-3 * rng.uniform(0.5, 1.0)
            continue
        projector = (sign + eye) / 2
        above = round(float(np.trace(projector)))
        if 0 < above < size:
            basis = np.linalg.qr(projector @ rng.standard_normal((size, above)))[0]
            whole = np.linalg.qr(projector @ basis, mode="complete")[0]
            return whole[:, :above], whole[:, above:]
        low, high = (low, shift) if above == 0 else (shift, high)
        shift = (low + high) / 2
    return None


def leading_components(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit eigenvectors as columns, largest entry positive."""
    scale, found = float(np.linalg.norm(matrix)), []
    spaces = [np.eye(len(matrix))]
    while spaces and len(found) < wanted:
        # The space of the largest eigenvalues is on top.
        basis = spaces.pop()
        inside = basis.T @ matrix @ basis
        halves = split_space((inside + inside.T) / 2, scale) if basis.shape[1] > 1 else None
        if halves is None:
            found += list(basis.T)
        else:
            spaces += [basis @ halves[1], basis @ halves[0]]
    vectors = np.array([vector / np.linalg.norm(vector) for vector in found]).reshape(len(found), len(matrix))
    values = np.einsum("ki,ij,kj->k", vectors, matrix, vectors)
    order = np.argsort(-values, kind="stable")[:wanted]
    vectors = vectors[order]
    signs = np.sign(np.take_along_axis(vectors, np.abs(vectors).argmax(axis=1, keepdims=True), axis=1))
    return values[order], (vectors * signs).T


@dataclass(frozen=True)
class Whitening:
    """What a list of distinct vectors determines: all of it small."""

    length: int
    count: int
    sums: list[int]
    eigenvalues: np.ndarray
    #: Eigenvectors as columns, and the sum of all eigenvalues.
    vectors: np.ndarray
    trace: float
    #: Largest difference of the whitened list's covariance from the identity.
    identity_error: float | None

    @property
    def mean(self) -> np.ndarray:
        return np.array([total / self.count for total in self.sums])

    @property
    def varies(self) -> np.ndarray:
        return self.eigenvalues > 4 * EPS * self.length * max(self.trace, 0.0)


def fit_whitening(df: DataFrame, vector: str, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct vectors of ``df``; None if there are none."""
    length = common_length(df, vector)
    if length == 0:
        return None
    listed = distinct_vectors(df, vector, length)
    count, sums = exact_sums(listed, length)
    if count == 0:
        return None
    mean = np.array([total / count for total in sums])
    covariance = mean_products(listed, length, count, mean, np.eye(length))[:length, :length]
    values, vectors = leading_components((covariance + covariance.T) / 2, min(components, length))
    fit = Whitening(length, count, sums, values, vectors, float(np.trace(covariance)), None)
    used = fit.varies
    if not used.any():
        return fit
    turn = vectors[:, used] / np.sqrt(values[used])
    products = mean_products(listed, length, count, mean, turn)
    # The last row holds the means, which are zero up to rounding.
    rest = products[:-1, :-1] - np.outer(products[-1, :-1], products[-1, :-1]) - np.eye(turn.shape[1])
    return Whitening(length, count, sums, values, vectors, fit.trace, float(np.abs(rest).max()))


def deviations(rows: np.ndarray, count: int, sums: list[int]) -> list[int | None]:
    """Sum over the entries of (count * entry - sum) squared, exact; None beyond 64 bits."""
    largest = max(int(rows.max(initial=0)), -int(rows.min(initial=0))) * count + max(map(abs, sums), default=0)
    if largest * largest * len(sums) < 1 << 63:
        return ((count * rows - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    exact = ((count * rows.astype(object) - np.array(sums, object)) ** 2).sum(axis=1).tolist()
    return [value if value < 1 << 63 else None for value in exact]


def whiten(df: DataFrame, vector: str, fit: Whitening) -> DataFrame:
    """The usable rows with ``whitened`` (an entry per component) and ``deviation`` in place of the vector.

    Columns of the input called so are replaced.
    """
    length, count, sums, mean = fit.length, fit.count, fit.sums, fit.mean
    varies = fit.varies
    turn = fit.vectors / np.sqrt(np.where(varies, fit.eigenvalues, 1.0))
    kept = [field for field in df.schema if field.name not in (vector, "whitened", "deviation")]
    schema = StructType([*kept]).add("whitened", ArrayType(DoubleType())).add("deviation", LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, rows = whole_rows(batch.column(vector), length)
            turned = (rows - mean) @ turn
            flat = pa.array(turned.ravel(), mask=np.broadcast_to(~varies, turned.shape).ravel())
            ends = pa.array(np.arange(len(rows) + 1) * turned.shape[1], pa.int32())
            arrays = [batch.column(field.name).take(pa.array(places)) for field in kept]
            arrays.append(pa.ListArray.from_arrays(ends, flat))
            arrays.append(pa.array(deviations(rows, count, sums), pa.int64()))
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return df.mapInArrow(run, schema)


def whitening_report(df: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """One row per vector and component."""
    named = df.select(F.col(key).alias("vec_id"), F.col(vector).alias("vector"))
    fit = fit_whitening(named, "vector")
    if fit is None:
        kind = named.schema["vec_id"].dataType.simpleString()
        columns = "component int, n long, deviation long, whitened double, explained double, identity_error double"
        return df.sparkSession.createDataFrame([], f"vec_id {kind}, {columns}")
    shares = [float(value) / fit.trace if fit.trace > 0 else None for value in fit.eigenvalues]
    share = F.get(F.array(*(F.lit(value).cast("double") for value in shares)), F.col("place"))
    rows = whiten(named, "vector", fit).select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return rows.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(fit.count).cast("long").alias("n"),
        "deviation",
        "whitened",
        share.alias("explained"),
        F.lit(fit.identity_error).cast("double").alias("identity_error"),
    )
