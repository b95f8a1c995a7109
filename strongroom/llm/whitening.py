"""Whitening of embedding vectors by incremental eigendecomposition.

1. The fit list is each distinct integer vector once, stored in many small
   partitions.  Its size and per-dimension sums are exact Spark aggregates.
2. Every partition keeps the eigenvalues and eigenvectors of the scatter
   matrix of the vectors seen so far.  A vector is a centred rank-one update:
   components without weight and equal eigenvalues are deflated, the secular
   equation gives the new eigenvalues, and their eigenvectors follow.
3. The partitions' spectra are combined, a few per task and level, by
   successive rank-one updates with the eigenpairs of one side and one more
   for the distance of the means.
4. A Rayleigh-Ritz step over the whole fit list in the combined basis gives
   the components to double precision: its sums are made by the partitions and
   added up level by level.

What comes to the driver is bounded by the square of the dimension.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strongroom.llm.common import stored
from strongroom.llm.vectors import int_matrix, is_finite, quantised

if TYPE_CHECKING:
    import numpy as np

#: Integers below it are exact doubles.
EXACT = 2.0**53
FAN_IN = 16


# -- rank-one updates ---------------------------------------------------------


def secular_roots(d: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Roots of ``1 + sum weight_j / (d_j - x)``, one right of each pole of the
    ascending, distinct ``d``; all weights are positive.

    Each root is given as its nearest pole's value and the offset from it, and
    the matrix ``gap[i, j] = root_i - d_j`` is made of these without cancellation.
    Interpolates the sums left and right of the root by one pole each, and bisects
    where that leaves the bracket.
    """
    import numpy as np

    k, total = len(d), weight.sum()
    right = np.append(d[1:], d[-1] + total)
    diff = d[None, :] - d[:, None]  # diff[i, j] = d_j - d_i
    half = (right - d) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        middle = 1 + (weight / (diff - half[:, None])).sum(axis=1)
    # A root in the left half is measured from its own pole, else from the next one (the last always from its own).
    near = np.arange(k) + ((middle < 0) & (np.arange(k) < k - 1))
    delta = diff[near]
    own = near == np.arange(k)
    last = np.arange(k) == k - 1
    lo = np.where(own, np.where(last & (middle < 0), half, 0.0), -half)
    hi = np.where(own, np.where(last & (middle < 0), 2 * half, half), 0.0)
    tau = (lo + hi) / 2
    left = np.arange(k)[None, :] <= np.arange(k)[:, None]
    pole = delta[np.arange(k), np.arange(k)]
    after = np.where(last, pole + total, delta[np.arange(k), np.minimum(np.arange(k) + 1, k - 1)])
    eps = np.finfo(float).eps
    for _ in range(100):
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            inv = 1 / (delta - tau[:, None])
            term = weight * inv
            f = 1 + term.sum(axis=1)
            slope = term * inv
            psi, phi = np.where(left, slope, 0).sum(axis=1), np.where(left, 0, slope).sum(axis=1)
            settled = np.abs(f) <= 4 * eps * (1 + np.abs(term).sum(axis=1))
            lo, hi = np.where(f < 0, tau, lo), np.where(f < 0, hi, tau)
            d1, d2 = pole - tau, after - tau
            a = (d1 + d2) * f - d1 * d2 * (psi + phi)
            b = d1 * d2 * f
            c = f - d1 * psi - d2 * phi
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a > 0, 2 * b / (a + root), (a - root) / (2 * c))
        new = tau + step
        inside = np.isfinite(new) & (new > lo) & (new < hi)
        new = np.where(inside, new, (lo + hi) / 2)
        done = settled | (np.abs(new - tau) <= eps * np.abs(tau)) | (hi - lo <= eps * np.maximum(np.abs(lo), np.abs(hi)))
        if done.all():
            break
        tau = np.where(done, tau, new)
    return d[near] + tau, near, tau[:, None] - delta


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenpairs (ascending, as columns) of ``vectors diag(values) vectors' + rho v v'``, rho >= 0."""
    import numpy as np

    z = vectors.T @ v
    size = float(z @ z)
    if rho <= 0 or size <= 0:
        return values, vectors
    rho, z = rho * size, z / np.sqrt(size)
    tol = 8 * np.finfo(float).eps * max(abs(values[-1]), abs(values[0]), rho)
    live = np.flatnonzero(rho * np.abs(z) > tol)
    # Equal eigenvalues: a rotation in their plane leaves one of the two without weight.
    if len(live) > 1 and (np.diff(values[live]) <= tol).any():
        values, vectors, z = values.copy(), vectors.copy(), z.copy()
        kept, at = [], live[0]
        for j in live[1:]:
            r = np.hypot(z[at], z[j])
            c, s = z[j] / r, z[at] / r
            if abs((values[j] - values[at]) * c * s) <= tol:
                one, two = vectors[:, at].copy(), vectors[:, j].copy()
                vectors[:, at], vectors[:, j] = c * one - s * two, s * one + c * two
                low, high = values[at], values[j]
                values[at], values[j] = low * c * c + high * s * s, low * s * s + high * c * c
                z[at], z[j] = 0.0, r
            else:
                kept.append(at)
            at = j
        live = np.array([*kept, at])
        live = live[np.argsort(values[live], kind="stable")]
    if not len(live):
        return values, vectors
    d, w = values[live], z[live]
    roots, near, gap = secular_roots(d, rho * w * w)
    # Weights for which these roots are exact, so that the eigenvectors are orthogonal.
    ratio = d[:, None] - d[None, :]
    np.fill_diagonal(ratio, 1.0)
    exact = np.sqrt(np.abs((gap / ratio).prod(axis=0)))
    with np.errstate(divide="ignore", invalid="ignore"):
        q = (np.copysign(exact, w)[None, :] / gap).T
    on_pole = ~np.isfinite(q).all(axis=0)
    if on_pole.any():  # a root that equals a pole in doubles: its own axis
        q[:, on_pole] = np.eye(len(d))[:, near[on_pole]]
    q /= np.sqrt((q * q).sum(axis=0))
    values, vectors = values.copy(), vectors.copy()
    vectors[:, live] = vectors[:, live] @ q
    values[live] = roots
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


@dataclass
class Spectrum:
    """Eigenpairs of the scatter matrix of ``n`` vectors around their mean."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @staticmethod
    def empty(width: int) -> Spectrum:
        import numpy as np

        return Spectrum(0, np.zeros(width), np.zeros(width), np.eye(width))

    def add(self, x: np.ndarray) -> None:
        """One more vector, as a centred rank-one update."""
        off = x - self.mean
        self.values, self.vectors = rank_one(self.values, self.vectors, off, self.n / (self.n + 1))
        self.n += 1
        self.mean = self.mean + off / self.n

    def merge(self, other: Spectrum) -> None:
        """The vectors of the other spectrum as well: its eigenpairs and the
        distance of the means are rank-one updates."""
        if not other.n:
            return
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, vector, float(value))
        both, off = self.n + other.n, other.mean - self.mean
        self.values, self.vectors = rank_one(self.values, self.vectors, off, self.n * other.n / both)
        self.mean = self.mean + off * (other.n / both)
        self.n = both

    def row(self, part: int) -> dict:
        return {"part": part, "n": self.n, "a": self.mean.tolist(), "b": self.values.tolist(), "c": self.vectors.ravel().tolist()}

    @staticmethod
    def of(row: dict) -> Spectrum:
        import numpy as np

        width = len(row["a"])
        return Spectrum(int(row["n"]), np.array(row["a"], float), np.array(row["b"], float), np.array(row["c"], float).reshape(width, width))


# -- over partitions ----------------------------------------------------------

#: What a partition says of its rows: its number and up to three arrays.
NOTES = "part long, n long, a array<double>, b array<double>, c array<double>"


def per_partition(fit: DataFrame, width: int, start: Callable[[], object], see: Callable[[object, np.ndarray], None], note: Callable[[object, int], dict]) -> DataFrame:
    """One row of NOTES per partition that has rows: ``see`` gets its vectors block by block."""

    def run(batches: Iterator):
        import pyarrow as pa
        from pyspark import TaskContext

        state, rows = start(), 0
        for batch in batches:
            rows += batch.num_rows
            if batch.num_rows:
                see(state, int_matrix(batch.column(0), width))
        if rows:
            yield pa.RecordBatch.from_pylist([note(state, TaskContext.get().partitionId())], schema=pa.schema(
                [("part", pa.int64()), ("n", pa.int64()), *[(c, pa.list_(pa.float64())) for c in "abc"]]))

    return fit.select("x").mapInArrow(run, NOTES)


def combined(notes: DataFrame, parts: int, join: Callable[[list[dict]], dict]) -> dict | None:
    """All rows of NOTES joined into one, ``FAN_IN`` neighbours per task and level; None without rows."""

    def group(pdf):
        import pandas as pd

        rows = pdf.sort_values("part").to_dict("records")
        return pd.DataFrame([{**join(rows), "part": rows[0]["part"] // FAN_IN}], columns=["part", "n", "a", "b", "c"])

    while True:
        notes = notes.groupBy(F.floor(F.col("part") / FAN_IN).cast("long").alias("_group")).applyInPandas(group, NOTES)
        parts = -(-parts // FAN_IN)
        if parts <= 1:
            break
    row = notes.first()
    return row.asDict() if row else None


def spectrum(fit: DataFrame, width: int, parts: int) -> Spectrum | None:
    """Spectrum of the whole fit list by rank-one updates."""

    def see(state: Spectrum, x) -> None:
        for v in x.astype(float):
            state.add(v)

    def join(rows: list[dict]) -> dict:
        total = Spectrum.of(rows[0])
        for r in rows[1:]:
            total.merge(Spectrum.of(r))
        return total.row(0)

    notes = per_partition(fit, width, lambda: Spectrum.empty(width), see, lambda state, part: state.row(part))
    row = combined(notes, parts, join)
    return Spectrum.of(row) if row else None


def moments(fit: DataFrame, width: int, parts: int, centre: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance (divisor n, centred before multiplying) of the fit
    list's vectors, less ``centre`` and projected on the columns of ``basis``.

    Blocks are centred on their own means; two blocks' products are joined by
    those of the distance of their means."""
    import numpy as np

    size = basis.shape[1]

    def together(n1, m1, s1, n2, m2, s2):
        n, off = n1 + n2, m2 - m1
        return n, m1 + off * (n2 / n), s1 + s2 + np.outer(off, off) * (n1 * n2 / n)

    def see(state: list, x) -> None:
        y = (x - centre) @ basis
        mean = y.mean(axis=0)
        y = y - mean
        state[:] = together(*state, len(y), mean, y.T @ y)

    def join(rows: list[dict]) -> dict:
        state = (0, np.zeros(size), np.zeros((size, size)))
        for r in rows:
            state = together(*state, int(r["n"]), np.array(r["a"], float), np.array(r["c"], float).reshape(size, size))
        return note(state, 0)

    def note(state, part: int) -> dict:
        return {"part": part, "n": int(state[0]), "a": state[1].tolist(), "b": [], "c": state[2].ravel().tolist()}

    row = combined(per_partition(fit, width, lambda: [0, np.zeros(size), np.zeros((size, size))], see, note), parts, join)
    return np.array(row["a"]), np.array(row["c"]).reshape(size, size) / row["n"]


# -- the operator -------------------------------------------------------------


@dataclass
class Whitening:
    """Fitted components: unit eigenvectors (rows) by falling eigenvalue.

    ``n`` and ``sums`` are exact; ``identity_error`` is the largest absolute
    entry of the whitened fit list's covariance minus the identity."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    v = F.col(vector_col)
    return df.where(is_finite(v)).select(F.col(id_col).alias("_id"), quantised(v, scale, EXACT).alias("x"))


def fit(vectors: DataFrame, k: int = 4, task_rows: int = 4096, most_tasks: int = 20000) -> Whitening | None:
    """Components of the distinct vectors ``x`` (arrays of longs) of the most
    common length (ties: the longer), at most ``k``; None where no vector
    differs from another.

    Eigenvalues within rounding of zero have no component, as nothing can be
    divided by them.  Of the two signs the one is taken whose largest entry is positive.
    """
    import numpy as np

    # One row comes: the most common length and its rows, a bound of the distinct ones.
    common = vectors.groupBy(F.size("x").alias("w")).count().orderBy(F.desc("count"), F.desc("w")).first()
    if common is None or not common["w"]:
        return None
    width = common["w"]
    parts = min(-(-common["count"] // task_rows), most_tasks)
    distinct = stored(vectors.where(F.size("x") == width).select("x").distinct().repartition(parts), "fit-list")
    sums = [F.sum(F.get("x", F.lit(i)).cast("decimal(20,0)")).alias(f"s{i}") for i in range(width)]
    n, *exact = distinct.agg(F.count(F.lit(1)).alias("n"), *sums).first()
    exact = [int(s) for s in exact]
    # The stored list may be read in more partitions than it was written in.
    parts = max(parts, distinct.rdd.getNumPartitions())
    found = spectrum(distinct, width, parts)
    centre = np.array([s / n for s in exact])
    basis = np.linalg.qr(found.vectors)[0]
    _, inner = moments(distinct, width, parts, centre, basis)
    values, turn = np.linalg.eigh((inner + inner.T) / 2)
    order = np.argsort(-values, kind="stable")
    values, vecs = values[order], (basis @ turn[:, order]).T
    trace = float(np.trace(inner))
    good = values[:k] > width * np.finfo(float).eps * max(values[0], 0.0)
    values, vecs = values[:k][good], vecs[:k][good]
    if not len(values):
        return None
    vecs = vecs / np.sqrt((vecs * vecs).sum(axis=1, keepdims=True))
    vecs = vecs * np.sign(vecs[np.arange(len(vecs)), np.abs(vecs).argmax(axis=1)])[:, None]
    _, check = moments(distinct, width, parts, centre, (vecs / np.sqrt(values)[:, None]).T)
    return Whitening(n, exact, vecs, values, trace, float(np.abs(check - np.eye(len(values))).max()))


def apply(vectors: DataFrame, model: Whitening) -> DataFrame:
    """``_id``, ``component``, ``deviation`` (exact) and ``whitened`` of every vector of the model's length."""
    n, sums, width = model.n, model.sums, len(model.sums)
    project = model.components / (model.eigenvalues**0.5)[:, None]
    k = len(project)
    schema = T.StructType([vectors.schema["_id"], *T._parse_datatype_string("deviation decimal(38,0), component int, whitened double").fields])

    def run(batches: Iterator):
        import decimal

        import numpy as np
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        centre, largest = np.array([s / n for s in sums]), max(map(abs, sums))
        digits = decimal.Context(prec=60)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = int_matrix(batch.column(1), width)
            bound = n * int(np.abs(x).max()) + largest
            if bound * bound * width < 2**63:
                off = n * x - np.array(sums, np.int64)
                deviation = pa.array((off * off).sum(axis=1)).cast(pa.decimal128(38, 0))
            else:  # beyond 64 bits: Python integers
                exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
                deviation = pa.array([digits.create_decimal(v) for v in exact], pa.decimal128(38, 0))
            white = (x - centre) @ project.T
            at = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(at), deviation.take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(white.ravel()),
            ], schema=arrow)

    return vectors.where(F.size("x") == width).select("_id", "x").mapInArrow(run, schema)


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 4, scale: int = 256) -> DataFrame:
    """Whitened coordinates of every vector without null or non-finite
    components, taken as the integers floor(scale * component).

    One row per vector and component (at most ``k``): the id, ``component``
    (from 1, by falling eigenvalue), ``n`` (distinct vectors), ``deviation``
    (sum of (n x - S)^2 over the dimensions, exact decimal), ``whitened``,
    ``eigenvalue``, ``explained`` (its share of the trace) and
    ``identity_error``.

    Null and repeated ids are kept, each row with its own results; equal
    vectors have equal results and count once in the fit.  Vectors of another length
    than the most common one have no coordinates and no rows.  Where there are
    no two different vectors (empty table, one vector, copies of one) nothing
    varies, and the result is empty.  A component too large for exact doubles is
    an error.  Results don't depend on the order of rows beyond rounding.
    """
    vectors = integer_vectors(df, id_col, vector_col, scale)
    model = fit(vectors, k)
    if model is None:
        fields = "component int, n long, deviation decimal(38,0), whitened double, eigenvalue double, explained double, identity_error double"
        return df.sparkSession.createDataFrame([], T.StructType([df.schema[id_col], *T._parse_datatype_string(fields).fields]))
    at = lambda values: F.get(F.array(*[F.lit(float(v)) for v in values]), F.col("component") - 1)
    return apply(vectors, model).select(
        F.col("_id").alias(id_col), "component", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        at(model.eigenvalues).alias("eigenvalue"), at(model.eigenvalues / model.trace).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
