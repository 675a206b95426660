"""Whitening of embeddings by shifted CholeskyQR.

Entries become fixed-point numbers ``x = floor(1024 c) + 100000``, whose sums are exact. With
``A`` the centred rows, ``A = Q R`` comes from passes over the rows: every pass adds up the
Gram matrix of the rows as orthogonalised so far (triangular solves with the factors found
before), and its Cholesky factor is the next factor of ``R``; the first Gram matrix gets a small
multiple of the identity, so an ill-conditioned one has a factor as well. The passes end when
the Gram matrix is the identity to ``ORTHOGONAL``. The singular values ``s`` and right vectors
of ``R``, a matrix as wide as the embeddings, are those of ``A``: eigenvalues ``s^2 / n`` and
eigenvectors of the covariance, whose condition number is never squared.

Spark holds the rows; a task sends one Gram matrix in blocks of rows, which are added up in two
rounds of a shuffle and reach the driver once (width x width numbers).

Defined results: vectors that are null, empty, hold null or non-finite entries or entries beyond
``LARGEST`` (their fixed-point form would not fit), or have another length than most vectors (the
longer one if two are as frequent) are dropped; repeated rows and null or repeated ids are kept
one by one; components without variance are left out, so a single row, equal rows or an empty
table give no rows; a ``deviation`` beyond 64 bits is null; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearloom.llm import textarrays as ta
from yearloom.session import materialize

SCALE = 1024
SHIFT = 100_000
LARGEST = 2.0 ** 40
COMPONENTS = 8
ORTHOGONAL = 1e-8
MAX_PASSES = 12
NO_VARIANCE = 1e-12  # singular values below this share of the largest
BLOCK_NUMBERS = 8192  # of a Gram matrix, in one row
SALTS = 32
SOLVE_AT_ONCE = 32


def fixed_point(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, x) of all vectors that are whole and of the usual length, written once."""
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("c"))
    # NaN is larger than any number for Spark
    whole = rows.where("size(c) > 0").where(F.forall("c", lambda c: c.isNotNull() & (F.abs(c) <= LARGEST)))
    length = whole.groupBy(F.size("c").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    usual = whole.where(F.size("c") == (length["d"] if length else 0))
    return materialize(usual.select("vec_id", F.transform("c", lambda c: F.floor(c * SCALE) + SHIFT).alias("x")))


def _vectors(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


@ta.released
def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, total = 0, None
    for batch in batches:
        if batch.num_rows:
            own = _vectors(batch.column(0))
            n, total = n + len(own), own.sum(0) + (0 if total is None else total)
    if n:
        yield pa.RecordBatch.from_pydict({"dimension": pa.array(range(len(total)), pa.int32()), "n": pa.array([n] * len(total), pa.int64()),
                                          "total": pa.array(total, pa.int64())})


class Centre:
    """Rows less the mean: exact whole parts, then the fraction."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        whole = [divmod(s, n) for s in sums]
        self.floor = np.array([q for q, _ in whole], np.int64)
        self.rest = np.array([r for _, r in whole], np.int64)
        self.fraction = np.array([r / n for _, r in whole])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.floor) - self.fraction

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of ``(n x - sums)^2``; None beyond 64 bits."""
        d = x - self.floor
        if not d.size:
            return [0] * len(x)
        reach = self.n * (int(np.abs(d).max()) + 1)
        if x.shape[1] * reach * reach < 1 << 63:
            return ((d * self.n - self.rest) ** 2).sum(1).tolist()
        out = ((d.astype(object) * self.n - self.rest.astype(object)) ** 2).sum(1).tolist()
        return [v if v < 1 << 63 else None for v in out]


def solve_right(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """The ``y`` with ``y @ factor = rows``, for an upper triangular factor."""
    out = np.empty_like(rows)
    for a in range(0, len(factor), SOLVE_AT_ONCE):
        b = min(a + SOLVE_AT_ONCE, len(factor))
        own = rows[:, a:b] - out[:, :a] @ factor[:a, a:b]
        for j in range(a, b):
            out[:, j] = (own[:, j - a] - out[:, a:j] @ factor[a:j, j]) / factor[j, j]
    return out


_BLOCKS = "block int, salt int, numbers binary"
_BLOCK_FIELDS = pa.schema([("block", pa.int32()), ("salt", pa.int32()), ("numbers", pa.binary())])


def _gram(rows_of, width: int):
    """Every task's sum of ``y^T y`` over its rows ``y``, in blocks of rows."""
    @ta.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            if batch.num_rows:
                y = rows_of(_vectors(batch.column(0)))
                total += y.T @ y
        salt, step = TaskContext.get().partitionId() % SALTS, max(1, BLOCK_NUMBERS // width)
        for k, a in enumerate(range(0, width, step)):
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([salt], pa.int32()),
                                              pa.array([total[a:a + step].tobytes()])], schema=_BLOCK_FIELDS)
    return run


@ta.released
def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for block, salt, raw in zip(*(c.to_pylist() for c in batch.columns)):
            own = np.frombuffer(raw)
            total[block, salt] = total[block, salt] + own if (block, salt) in total else own
    for (block, salt), own in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([salt], pa.int32()), pa.array([own.tobytes()])], schema=_BLOCK_FIELDS)


def gram(rows: DataFrame, rows_of, width: int) -> np.ndarray:
    """Sum over all rows of ``y^T y``, ``y = rows_of(x)``."""
    parts = rows.select("x").mapInArrow(_gram(rows_of, width), _BLOCKS)
    parts = parts.repartition("block", "salt").mapInArrow(_added, _BLOCKS)
    parts = parts.select("block", F.lit(0).alias("salt"), "numbers").repartition("block").mapInArrow(_added, _BLOCKS)
    found = sorted(parts.select("block", "numbers").toArrow().to_pylist(), key=lambda r: r["block"])
    return np.frombuffer(b"".join(r["numbers"] for r in found)).reshape(width, width)


def cholesky(matrix: np.ndarray, n_rows: int, shifted: bool) -> np.ndarray:
    """Upper factor of ``matrix``, plus a shift that grows until there is one."""
    d = len(matrix)
    shift = 11 * (n_rows * d + d * (d + 1)) * np.finfo(float).eps / 2 * np.trace(matrix) if shifted else 0.0
    while True:
        try:
            return np.linalg.cholesky(matrix + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift = max(shift * 100, 11 * d * (d + 1) * np.finfo(float).eps * np.trace(matrix))


def triangular_factor(rows: DataFrame, centre: Centre, used: np.ndarray) -> tuple[np.ndarray, int]:
    """``R`` of the centred rows' used dimensions, and the number of passes."""
    d, factors = int(used.sum()), []
    identity = np.eye(d)
    r = identity
    for k in range(MAX_PASSES):
        known = rows.sparkSession.sparkContext.broadcast(list(factors))

        def rows_of(x, known=known):
            y = centre(x)[:, used]
            for f in known.value:
                y = solve_right(y, f)
            return y

        g = gram(rows, rows_of, d)
        done = k and np.abs(g - identity).max() <= ORTHOGONAL
        factor = cholesky(g, centre.n, not k)
        r = factor @ r
        if done:
            return r, k + 1
        factors.append(factor)
    return r, MAX_PASSES


class Components:
    """Whitening components of the fit list: ``vectors`` (a row each), ``values`` and each one's share of the variance."""

    def __init__(self, r: np.ndarray, used: np.ndarray, n: int, count: int):
        _, s, right = np.linalg.svd(r)
        keep = np.flatnonzero(s > s[0] * NO_VARIANCE)[:count]
        self.values = s[keep] ** 2 / n
        self.explained = s[keep] ** 2 / (s ** 2).sum()
        self.vectors = np.zeros((len(keep), len(used)))
        self.vectors[:, used] = right[keep]
        most = np.abs(self.vectors).argmax(1)
        self.vectors *= np.sign(self.vectors[np.arange(len(keep)), most])[:, None]

    def project(self, centred: np.ndarray) -> np.ndarray:
        return centred @ self.vectors.T / np.sqrt(self.values)


def _output(centre: Centre, components: Components, error: float):
    k = len(components.values)

    @ta.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            x = _vectors(batch.column(1))
            row = pa.array(np.repeat(np.arange(rows), k))
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column(0).take(row), "component": pa.array(np.tile(np.arange(1, k + 1), rows), pa.int32()),
                "n": pa.array(np.full(rows * k, centre.n), pa.int64()), "deviation": pa.array(centre.deviations(x), pa.int64()).take(row),
                "whitened": pa.array(components.project(centre(x)).ravel()), "explained": pa.array(np.tile(components.explained, rows)),
                "identity_error": pa.array(np.full(rows * k, error))})
    return run


def whiten(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row for every vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = table.sparkSession
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = fixed_point(table, id_col, vector_col)
    sums = rows.select("x").mapInArrow(_sums, "dimension int, n long, total long")
    sums = sums.groupBy("dimension").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).orderBy("dimension").collect()  # one row a dimension
    if not sums:
        return spark.createDataFrame([], schema)
    centre = Centre(sums[0]["n"], [r["total"] for r in sums])
    spread = np.diag(gram(rows, centre, len(sums)))
    used = spread > 0
    if not used.any():
        return spark.createDataFrame([], schema)
    r, _ = triangular_factor(rows, centre, used)
    found = Components(r, used, centre.n, components)
    k = len(found.values)

    def extended(x):  # with a column of ones, for the means
        return np.column_stack([found.project(centre(x)), np.ones(len(x))])

    moments = gram(rows, extended, k + 1) / centre.n
    covariance = moments[:k, :k] - np.outer(moments[k, :k], moments[k, :k])
    error = float(np.abs(covariance - np.eye(k)).max())
    return rows.select("vec_id", "x").mapInArrow(_output(centre, found, error), schema)
