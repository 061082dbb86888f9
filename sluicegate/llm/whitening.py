"""Whitening of embeddings by the singular values of a bidiagonal matrix.

* Sums of all entries are exact integers; rows are centred before anything is multiplied.
* Every task reduces its centred rows to a triangle by blockwise QR; triangles are stacked and reduced
  again, sixteen at a time, until few are left. The covariance matrix is never formed, so small
  variances keep the accuracy that squaring would lose.
* The last triangle is brought to bidiagonal form by Householder reflections.
* Singular values come from the differential quotient-difference algorithm with shifts (dqds), which works
  on squares of the entries and loses no relative accuracy.
* Each direction comes from a twisted factorisation, which meets at the entry where the shifted matrix is
  nearest to singular. Directions of values that lie close together are made orthogonal to each other.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.llm.common import Batches, Scratch, fields, map_batches

# Rows of one QR step, and of one batch that leaves a task.
BLOCK_ROWS = 2048
# Results of tasks that are combined at once, and that the driver takes.
COMBINED = 16
MOST_TAKEN = 64
# Entries whose number would not fit into a long with room to spare have none.
MOST_NUMBER = float(1 << 62)
EPS = float(np.finfo(float).eps)


class Spectrum(NamedTuple):
    """Squared singular values, largest first, with their right singular vectors as columns."""

    squares: np.ndarray
    vectors: np.ndarray


# Bidiagonal form and its singular values


def bidiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and right factor Q of a square matrix U B Q'."""
    work = matrix.astype(float)
    size = len(work)
    right = np.eye(size)
    for i in range(size):
        v = _reflector(work[i:, i])
        work[i:, i:] -= np.outer(v, v @ work[i:, i:])
        if i + 1 < size:
            v = _reflector(work[i, i + 1 :])
            work[i:, i + 1 :] -= np.outer(work[i:, i + 1 :] @ v, v)
            right[:, i + 1 :] -= np.outer(right[:, i + 1 :] @ v, v)
    return np.diagonal(work).copy(), np.diagonal(work, 1).copy(), right


def _reflector(x: np.ndarray) -> np.ndarray:
    """v with (I - v v') x along the first axis."""
    v = x.copy()
    norm = np.linalg.norm(v)
    if not norm:
        return v
    v[0] += math.copysign(norm, v[0])
    return v * (math.sqrt(2) / np.linalg.norm(v))


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of a bidiagonal matrix, largest first."""
    found = []
    parts = [((diagonal**2).tolist(), (above**2).tolist(), 0.0)]
    negligible = (10 * EPS) ** 2
    sweeps = 200 * len(diagonal) + 1000
    while parts:
        q, e, shift = parts.pop()
        lowest = min(q)
        while len(q) > 1:
            cuts = [i for i in range(len(e)) if e[i] <= negligible * (shift + min(q[i], q[i + 1]))]
            if cuts:
                at = cuts[-1]
                parts.append((q[: at + 1], e[:at], shift))
                q, e = q[at + 1 :], e[at + 1 :]
                lowest = min(q)
                continue
            if 1.5 * q[0] < q[-1]:
                q, e = q[::-1], e[::-1]
            wanted = _shift(q, e, lowest)
            for s in (wanted, wanted / 4, 0.0):
                swept = _sweep(q, e, s)
                if swept:
                    break
            q, e, lowest = swept
            shift += s
            sweeps -= 1
            if not sweeps:
                raise ArithmeticError("singular values do not converge")
        found.append(q[0] + shift)
    return np.sort(np.array(found))[::-1]


def _shift(q: list[float], e: list[float], lowest: float) -> float:
    """A value that is probably below the smallest one left, and near it."""
    x, y, z = q[-2] + (e[-2] if len(e) > 1 else 0.0), q[-1] + e[-1], q[-2] * e[-1]
    half = (x - y) / 2
    smaller = (x * y - z) / ((x + y) / 2 + math.hypot(half, math.sqrt(z)))
    bound = smaller - math.sqrt(q[-3] * e[-2]) if len(e) > 1 else smaller * (1 - 8 * EPS)
    return max(bound, 0.0) or max(lowest, 0.0) / 4


def _sweep(q: list[float], e: list[float], s: float) -> tuple[list[float], list[float], float] | None:
    """One transform with a shift; None if the shift was above the smallest value."""
    d = lowest = q[0] - s
    new_q, new_e = [], []
    for i in range(len(e)):
        if d < 0 or d + e[i] <= 0:
            return None
        top = d + e[i]
        ratio = q[i + 1] / top
        new_q.append(top)
        new_e.append(e[i] * ratio)
        d = d * ratio - s
        lowest = min(lowest, d)
    if d < 0:
        return None
    return [*new_q, d], new_e, lowest


def spectrum(triangle: np.ndarray, count: int) -> Spectrum:
    """The ``count`` largest squared singular values with right vectors; those that are rounding errors go."""
    size = triangle.shape[1]
    square = np.zeros((size, size))
    square[: len(triangle)] = triangle
    norm = np.abs(square).max(initial=0)
    if not norm:
        return Spectrum(np.zeros(0), np.zeros((size, 0)))
    a, b, right = bidiagonal(square / norm)
    scale = max(np.abs(a).max(), np.abs(b).max(initial=0))
    a = np.where(np.abs(a) < EPS * EPS * scale, EPS * EPS * scale, a)
    bounds = [0, *(np.flatnonzero(np.abs(b) <= EPS * scale) + 1).tolist(), size]
    found = [
        (value, start, end)
        for start, end in zip(bounds[:-1], bounds[1:], strict=True)
        for value in dqds(a[start:end], b[start : end - 1])
    ]
    found.sort(key=lambda entry: -entry[0])
    least = (8 * size * EPS) ** 2 * found[0][0]
    found = [entry for entry in found if entry[0] > least][:count]
    vectors = np.zeros((size, len(found)))
    for i, (value, start, end) in enumerate(found):
        near = [j for j in range(i) if found[j][1] == start and found[j][0] - value <= 1e-3 * found[j][0]]
        others = vectors[start:end, near]
        vectors[start:end, i] = _direction(a[start:end], b[start : end - 1], value, others)
    # A direction has no sign of its own: its largest entry is positive.
    vectors = right @ vectors
    largest = np.abs(vectors).argmax(axis=0)
    vectors *= np.sign(vectors[largest, np.arange(len(found))])
    return Spectrum(np.array([value for value, _, _ in found]) * norm**2, vectors)


def _direction(a: np.ndarray, b: np.ndarray, value: float, others: np.ndarray) -> np.ndarray:
    """Unit right singular vector of a bidiagonal matrix, orthogonal to vectors of values close by."""
    z, kept = _orthogonal(_twisted(a, b, value), others)
    if kept > 0.5:
        return z
    # Values too close to tell directions apart: iterate within what is orthogonal to the others.
    size = len(a)
    matrix = np.diag(a) + np.diag(b, 1)
    gram = matrix.T @ matrix - np.eye(size) * value * (1 + 4 * EPS)
    start = np.random.default_rng(others.shape[1])
    for _ in range(8):
        z, _ = _orthogonal(start.standard_normal(size), others)
        for _ in range(4):
            try:
                z, kept = _orthogonal(np.linalg.solve(gram, z), others)
            except np.linalg.LinAlgError:
                gram += np.eye(size) * value * EPS
        if np.linalg.norm(gram @ z) <= 1e-8 * value:
            break
    return z


def _orthogonal(z: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, float]:
    """The unit vector of what is orthogonal to others, and how much of a vector that was."""
    z = z / np.linalg.norm(z)
    rest = z - others @ (others.T @ z)
    kept = float(np.linalg.norm(rest))
    rest = rest / (kept or 1)
    rest = rest - others @ (others.T @ rest)
    return rest / (np.linalg.norm(rest) or 1), kept


def _twisted(a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    """Solves N G N' z = g e_r, where the twist r has the smallest g."""
    size = len(a)
    d, l = (a * a).tolist(), (b / a[:-1]).tolist()
    tiny = EPS * EPS * max(value, max(d))
    down, s = [0.0] * (size - 1), [-value] * size
    for i in range(size - 1):
        pivot = d[i] + s[i] or tiny
        down[i] = d[i] * l[i] / pivot
        s[i + 1] = down[i] * l[i] * s[i] - value
    up, p = [0.0] * (size - 1), [0.0] * size
    p[-1] = d[-1] - value
    for i in range(size - 2, -1, -1):
        pivot = d[i] * l[i] * l[i] + p[i + 1] or tiny
        up[i] = d[i] * l[i] / pivot
        p[i] = p[i + 1] * d[i] / pivot - value
    gamma = np.abs(np.array(s) + np.array(p) + value)
    twist = int(np.argmin(np.where(np.isfinite(gamma), gamma, np.inf)))
    z = np.zeros(size)
    z[twist] = 1.0
    for i in range(twist - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(twist, size - 1):
        z[i + 1] = -up[i] * z[i]
    return z


# Rows as exact integers


def _numbers(batches: Batches, scale: int, offset: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Ids, lengths and numbers, end to end, of the rows whose entries all have one."""
    for whole in batches:
        for begin in range(0, len(whole), BLOCK_ROWS):
            batch = whole.slice(begin, BLOCK_ROWS)
            vectors = batch.column("vector")
            present = pc.greater(pc.fill_null(pc.list_value_length(vectors), 0), 0)
            ids, vectors = batch.column("id").filter(present), vectors.filter(present)
            lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
            values = vectors.flatten().fill_null(math.nan).to_numpy(zero_copy_only=False)
            scaled = np.floor(values * scale)
            fits = np.abs(scaled) < MOST_NUMBER
            owner = np.repeat(np.arange(len(lengths)), lengths)
            good = np.bincount(owner[~fits], minlength=len(lengths)) == 0
            if good.any():
                numbers = scaled[good[owner]].astype(np.int64) + offset
                yield ids.filter(pa.array(good)), lengths[good], numbers


class Centre(NamedTuple):
    """Number of rows, and the exact mean of each dimension as a whole part and a rest over that number."""

    n: int
    whole: np.ndarray
    rest: np.ndarray

    def rows(self, numbers: np.ndarray) -> np.ndarray:
        return (numbers - self.whole).astype(float) - self.rest.astype(float) / self.n

    def deviations(self, numbers: np.ndarray) -> pa.Array:
        """Sum over dimensions of (n x - S)^2, exact."""
        offsets = numbers - self.whole
        bound = self.n * (int(np.abs(offsets).max(initial=0)) + 1)
        if bound * bound * len(self.whole) < 1 << 63:
            return pa.array(((self.n * offsets - self.rest) ** 2).sum(axis=1)).cast(pa.decimal128(38, 0))
        squares = ((offsets.astype(object) * self.n - self.rest.astype(object)) ** 2).sum(axis=1)
        fits = [value if value < 10**38 else None for value in squares.tolist()]
        return pa.array([None if v is None else str(v) for v in fits], pa.string()).cast(pa.decimal128(38, 0))


def _sums(scale: int, offset: int):
    """A task's rows and exact sums for each length of vector."""

    def run(batches: Batches) -> Batches:
        totals: dict[int, list] = {}
        for _, lengths, numbers in _numbers(batches, scale, offset):
            starts = np.cumsum(lengths) - lengths
            for length in np.unique(lengths).tolist():
                rows = numbers[starts[lengths == length][:, None] + np.arange(length)]
                if int(np.abs(rows).max()) * len(rows) >= 1 << 62:
                    rows = rows.astype(object)
                sums = rows.sum(axis=0).tolist()
                n, before = totals.get(length, (0, [0] * length))
                totals[length] = n + len(rows), [x + y for x, y in zip(before, sums, strict=True)]
        if totals:
            yield _blob(json.dumps(totals).encode())

    return run


def _add_sums(blobs: list[bytes]) -> bytes:
    totals: dict[str, list] = {}
    for blob in blobs:
        for length, (n, sums) in json.loads(blob).items():
            before = totals.get(length, (0, [0] * len(sums)))
            totals[length] = before[0] + n, [x + y for x, y in zip(before[1], sums, strict=True)]
    return json.dumps(totals).encode()


def _triangles(centre: Centre, scale: int, offset: int):
    """A task's centred rows, reduced block by block."""

    def run(batches: Batches) -> Batches:
        held, width = None, len(centre.whole)
        for _, _, numbers in _numbers(batches, scale, offset):
            rows = centre.rows(numbers.reshape(-1, width))
            held = np.linalg.qr(rows if held is None else np.vstack([held, rows]), mode="r")
        if held is not None:
            yield _blob(held.tobytes())

    return run


def _stack(width: int):
    def run(blobs: list[bytes]) -> bytes:
        rows = [np.frombuffer(blob).reshape(-1, width) for blob in blobs]
        return np.linalg.qr(np.vstack(rows), mode="r").tobytes()

    return run


def _moments(centre: Centre, axes: np.ndarray, scale: int, offset: int):
    """Sums and sums of products of a task's whitened rows."""

    def run(batches: Batches) -> Batches:
        held = None
        for _, _, numbers in _numbers(batches, scale, offset):
            rows = centre.rows(numbers.reshape(-1, len(centre.whole))) @ axes
            part = np.vstack([rows.sum(axis=0), rows.T @ rows])
            held = part if held is None else held + part
        if held is not None:
            yield _blob(held.tobytes())

    return run


def _add(blobs: list[bytes]) -> bytes:
    return np.sum([np.frombuffer(blob) for blob in blobs], axis=0).tobytes()


def _blob(data: bytes) -> pa.RecordBatch:
    number = TaskContext.get().partitionId()
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([data], pa.binary())], names=["part", "blob"])


def _combined(scratch: Scratch, parts: DataFrame, combine: Callable[[list[bytes]], bytes], name: str) -> bytes | None:
    """The results of all tasks as one; they meet in groups of bounded size, level by level."""

    def group(key: tuple, part: pa.Table) -> pa.Table:
        data = combine(part.column("blob").to_pylist())
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "blob": pa.array([data], pa.binary())})

    level, number = scratch.table(parts, f"{name}_0"), 0
    while level.count() > MOST_TAKEN:
        number += 1
        key = F.expr(f"part div {COMBINED}").alias("upper")
        level = scratch.table(level.groupBy(key).applyInArrow(group, "part long, blob binary"), f"{name}_{number}")
    blobs = [row.blob for row in level.orderBy("part").collect()]
    return combine(blobs) if blobs else None


def whiten(
    df: DataFrame,
    components: int = 32,
    scale: int = 64,
    offset: int = 1_000_000,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Every vector in whitened coordinates, with the figures of the fit.

    An entry c counts as the integer floor(``scale`` * c) + ``offset``; the fit covers all vectors. Columns:
    ``id``, ``n`` (vectors of the fit), ``deviation`` (sum over dimensions of (n x - S)^2 with the sums S,
    exact, decimal; null beyond 38 digits), ``whitened`` (array, by falling variance, at most ``components``),
    ``explained`` (array, shares of the whole variance) and ``identity_error`` (the largest absolute entry of
    the whitened vectors' covariance minus the identity, from all rows).

    Vectors that are null or empty, or hold null, NaN, infinite entries or ones too large for a long, take
    no part and have no row. Vectors must have one length; others are a ValueError. Repeated vectors count each,
    repeated and null ids are kept, other columns are not read. Directions without variance (rounding aside)
    have no component, so equal vectors, or a single one, have empty arrays and no identity error. An empty
    table gives an empty result.
    """
    spark = df.sparkSession
    scratch = Scratch(spark)
    rows = df.select(df[id_col].alias("id"), df[vector_col].cast("array<double>").alias("vector"))
    blobs = "part long, blob binary"
    totals = _combined(scratch, map_batches(rows, _sums(scale, offset), blobs), _add_sums, "sums")
    lengths = json.loads(totals) if totals else {}
    if len(lengths) > 1:
        raise ValueError(f"vectors of one length are needed, not of {sorted(map(int, lengths))}")
    n, sums = next(iter(lengths.values()), (0, []))
    pairs = [divmod(s, n) for s in sums]
    centre = Centre(n, np.array([w for w, _ in pairs], np.int64), np.array([r for _, r in pairs], np.int64))
    explained, axes, error = [], np.zeros((len(sums), 0)), None
    if n:
        width = len(sums)
        blob = _combined(scratch, map_batches(rows, _triangles(centre, scale, offset), blobs), _stack(width), "triangles")
        triangle = np.frombuffer(blob).reshape(-1, width)
        squares, vectors = spectrum(triangle, components)
        explained = (squares / np.square(triangle).sum()).tolist() if len(squares) else []
        axes = vectors / np.sqrt(squares / n)
        if len(squares):
            moments = map_batches(rows, _moments(centre, axes, scale, offset), blobs)
            held = np.frombuffer(_combined(scratch, moments, _add, "moments")).reshape(-1, len(squares)) / n
            error = float(np.abs(held[1:] - np.outer(held[0], held[0]) - np.eye(len(squares))).max())
    scratch.drop(*list(scratch.names))

    def project(batches: Batches) -> Batches:
        for ids, _, numbers in _numbers(batches, scale, offset):
            numbers = numbers.reshape(len(ids), -1)
            whitened = (centre.rows(numbers) @ axes).ravel()
            ends = pa.array(np.arange(len(ids) + 1) * axes.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [ids, centre.deviations(numbers), pa.ListArray.from_arrays(ends, pa.array(whitened))],
                names=["id", "deviation", "whitened"],
            )

    schema = T.StructType(
        [
            *fields(df, {"id": id_col}),
            T.StructField("deviation", T.DecimalType(38, 0)),
            T.StructField("whitened", T.ArrayType(T.DoubleType())),
        ]
    )
    return map_batches(rows, project, schema).select(
        "id",
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.array(*map(F.lit, explained)).cast("array<double>").alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def by_component(whitened: DataFrame, id_name: str = "vec_id") -> DataFrame:
    """A row for every vector and component, numbered from 1; a deviation beyond a long is null."""
    return whitened.select(
        F.col("id").alias(id_name), "n", F.expr("try_cast(deviation AS long)").alias("deviation"), "explained", "identity_error",
        F.posexplode("whitened").alias("at", "whitened"),
    ).select(
        id_name,
        (F.col("at") + 1).alias("component"),
        "n",
        "deviation",
        "whitened",
        F.expr("explained[at]").alias("explained"),
        "identity_error",
    )
