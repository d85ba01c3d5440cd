"""Embedding whitening by Chebyshev-filtered subspace iteration over distributed passes.

Vectors become integers x = floor(64 c) + 1000000; the fit list is every
distinct x once, written as a table. One pass over it computes X'X Q / n for a
block Q of ``WANTED + EXTRA`` vectors, centred before multiplying: every task
sends d rows of partial sums, Spark adds them, and the driver keeps only d x
block numbers. The covariance itself is never formed.

An iteration applies a Chebyshev polynomial of degree ``DEGREE`` of the
covariance to the block by its three-term recurrence (a pass a degree). The
polynomial is small on [0, lowest Ritz value of the block], the unwanted
spectrum, and grows steeply above it. QR makes the block orthonormal again,
Rayleigh-Ritz (a pass that also gives the first step of the next polynomial)
rotates it to eigenvector estimates. Iterations end when every wanted vector v
is certified by its residual |Vv - ev| <= ``TOLERANCE`` e1, or, where rounding
stops a further fall, by ``CERTIFIED`` e1; otherwise it raises.

Exactness: sums are integers (DECIMAL), x - S/n is taken as the integer part
x - S div n and a remainder below one, so no digit is lost to the offset.

Defined results: rows whose vector is null, or holds a null, NaN or infinite
entry, go; so do vectors shorter than the table's longest, as their further
entries are missing. Entries beyond +-2^55 count as that limit. Repeated rows
and null ids keep their rows; other columns are not read. There are min(16, d)
components; where the eigenvalue is 0 (below 1e-12 of the largest: fewer
distinct vectors than components) whitened is NULL and the component is left
out of identity_error; explained is NULL when nothing varies. A deviation that
does not fit 64 bits is NULL.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, slices
from tidemark.session import materialize

WANTED, EXTRA = 16, 16
DEGREE = 16
TOLERANCE, CERTIFIED = 1e-13, 1e-9
MAX_ROUNDS = 200
LIFT = 1e8  # how far one polynomial may lift the largest eigenvalue above the unwanted ones
ZERO = 1e-12
OFFSET, LIMIT = 1_000_000, float(1 << 55)
OUT = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
)


def integer_vectors(table: DataFrame) -> DataFrame:
    """(vec_id, x) of the rows that stay."""
    v = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    whole = F.col("v").isNotNull() & F.forall(
        "v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    )
    v = v.where(F.coalesce(whole, F.lit(False)) & (F.size("v") > 0))
    longest = v.agg(F.max(F.size("v"))).first()[0] or 0
    edge = lambda c: F.when(c > 0, F.lit(1 << 55)).otherwise(F.lit(-(1 << 55)))
    floor = lambda c: F.when(F.abs(c) < LIMIT / 64, F.floor(64 * c)).otherwise(edge(c))
    return v.where(F.size("v") == longest).select("vec_id", F.transform("v", lambda c: floor(c) + OFFSET).alias("x"))


def _matrix(batch: pa.RecordBatch, at: int, d: int) -> np.ndarray:
    return batch.column(at).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


class Centre:
    """n, S and d of a fit list; x - S/n without loss."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums, self.d = n, sums, len(sums)
        self.base = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([(s % n) / n for s in sums])

    def of(self, x: np.ndarray) -> np.ndarray:
        return (x - self.base).astype(np.float64) - self.rest

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """sum of (n x - S)^2 in exact integers; None beyond 64 bits."""
        shift = x - self.base
        rest = [s % self.n for s in self.sums]
        if float(np.abs(shift).max(initial=0) + 1) * self.n * self.d**0.5 < 2**31:
            return (((shift * self.n) - np.array(rest, np.int64)) ** 2).sum(axis=1).tolist()
        wide = (shift.astype(object) * self.n - np.array(rest, object)) ** 2
        return [v if v < 1 << 63 else None for v in wide.sum(axis=1)]


def fit_list(vectors: DataFrame) -> DataFrame:
    """Every distinct x once."""
    return materialize(vectors.select("x").distinct())


def centre_of(fit: DataFrame) -> Centre | None:
    total = fit.select(F.posexplode("x").alias("i", "c")).groupBy("i").agg(
        F.sum(F.col("c").cast("decimal(38,0)")).alias("s"), F.count(F.lit(1)).alias("n")
    )
    rows = sorted(total.collect(), key=lambda r: r["i"])  # d rows
    return Centre(rows[0]["n"], [int(r["s"]) for r in rows]) if rows else None


def _summed(fit: DataFrame, rows: int, of_batch) -> np.ndarray:
    """Sum over all batches of the ``rows``-row matrices that ``of_batch`` gives; one matrix leaves a task."""

    def run(batches):
        total = None
        for batch in batches:
            for part in slices(batch):
                now = of_batch(part)
                total = now if total is None else total + now
        if total is not None:
            flat = pa.array(total.ravel())
            ends = pa.array(np.arange(rows + 1, dtype=np.int32) * total.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(rows), pa.int32()), pa.ListArray.from_arrays(ends, flat)], names=["i", "v"])

    sent = bounded_batches(fit.select("x")).mapInArrow(run, "i int, v array<double>")
    cells = sent.select("i", F.posexplode("v").alias("j", "c")).groupBy("i", "j").agg(F.sum("c").alias("c"))
    got = cells.groupBy("i").agg(F.sort_array(F.collect_list(F.struct("j", "c"))).alias("row")).collect()
    return np.array([[c["c"] for c in r["row"]] for r in sorted(got, key=lambda r: r["i"])])


def covariance_product(fit: DataFrame, centre: Centre):
    """Q -> V Q, one distributed pass a call."""

    def apply(q: np.ndarray) -> np.ndarray:
        def of_batch(batch):
            y = centre.of(_matrix(batch, 0, centre.d))
            return y.T @ (y @ q)

        return _summed(fit, centre.d, of_batch) / centre.n

    return apply


def _degree(top: float, cut: float, most: int) -> int:
    """The degree up to ``most`` at which the polynomial lifts ``top`` above the wanted by no more than ``LIFT``."""
    return max(1, min(most, int(np.log(LIFT) / np.arccosh(max(2 * top / cut - 1, 1 + 1e-9)))))


def _filter(apply, q: np.ndarray, vq: np.ndarray, cut: float, degree: int) -> np.ndarray:
    """Scaled Chebyshev polynomial of V on [0, cut], applied to q; ``vq`` is V q."""
    half = cut / 2  # centre and half width of the unwanted interval
    first = scale = half / (max(np.einsum("ij,ij->j", q, vq).max(), cut * (1 + 1e-9)) - half)
    old, new = q, (vq - half * q) * (scale / half)
    for _ in range(2, degree + 1):
        following = 1 / (2 / first - scale)
        old, new = new, 2 * following / half * (apply(new) - half * new) - scale * following * old
        scale = following
    return new


def filtered_subspace(apply, d: int, wanted: int = WANTED, extra: int = EXTRA, degree: int = DEGREE, seed: int = 13):
    """(eigenvalues, vectors as columns) of the largest ``wanted`` of a d x d covariance given by its products.

    Leading vectors that are certified stay as they are and are projected out of the polynomial, so a
    dominant direction does not drown the others.
    """
    block = min(d, wanted + extra)
    wanted = min(d, wanted)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, block)))[0]
    best, stale = np.inf, 0
    for _ in range(MAX_ROUNDS):
        vq = apply(q)
        values, turn = np.linalg.eigh((q.T @ vq + vq.T @ q) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        top = values[0]
        if top <= 0:
            return np.maximum(values[:wanted], 0), q[:, :wanted]
        residual = np.linalg.norm(vq - q * values, axis=0)[:wanted] / top
        stale = 0 if residual.max() < best / 2 else stale + 1
        best = min(best, residual.max())
        if best <= TOLERANCE or (stale >= 3 and best <= CERTIFIED):
            return np.maximum(values[:wanted], 0), q[:, :wanted]
        done = int(np.argmax(residual > TOLERANCE))
        kept = q[:, :done]
        cut = values[-1] if block < d else 0.0
        if cut <= ZERO * top:  # nothing unwanted is left beside the block: a power step is enough
            q = np.linalg.qr(vq)[0]
            continue
        outside = lambda m, kept=kept: m - kept @ (kept.T @ m)
        new = _filter(
            lambda m, outside=outside: outside(apply(m)), q[:, done:], outside(vq[:, done:]), cut,
            _degree(values[done], cut, degree),
        )
        q = np.linalg.qr(np.hstack([kept, new / np.linalg.norm(new, axis=0)]))[0]
    raise RuntimeError(f"not certified after {MAX_ROUNDS} rounds: residual {best:.1e} of the largest eigenvalue")


def whiten(table: DataFrame, wanted: int = WANTED) -> DataFrame:
    """One row per remaining row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = table.sparkSession
    vectors = materialize(integer_vectors(table))
    fit = fit_list(vectors)
    centre = centre_of(fit)
    if centre is None:
        return spark.createDataFrame([], OUT)
    d, n = centre.d, centre.n
    values, q = filtered_subspace(covariance_product(fit, centre), d, wanted)
    k = len(values)
    live = values > ZERO * max(values[0], 0)
    scale = np.where(live, 1 / np.sqrt(np.where(live, values, 1)), 0.0)

    def moments(batch):
        y = centre.of(_matrix(batch, 0, d))
        w = (y @ q) * scale
        return np.vstack([w.T @ w, w.sum(axis=0), np.full(k, (y * y).sum())])

    sums = _summed(fit, k + 2, moments) / n
    cov = sums[:k] - np.outer(sums[k], sums[k])
    error = float(np.abs(cov - np.eye(k))[np.ix_(live, live)].max(initial=0.0))
    trace = float(sums[k + 1][0])
    explained = [float(v) / trace if trace > 0 else None for v in values]

    def run(batches):
        for batch in batches:
            for part in slices(batch, 1 << 18):
                x = _matrix(part, 1, d)
                rows = len(x)
                white = (centre.of(x) @ q) * scale
                ids = np.repeat(np.arange(rows), k)
                columns = [
                    part.column(0).take(pa.array(ids)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, n, np.int64)),
                    pa.array(centre.deviations(x), pa.int64()).take(pa.array(ids)),
                    pa.array(white.ravel(), mask=np.tile(~live, rows)),
                    pa.array(explained * rows, pa.float64()),
                    pa.array(np.full(rows * k, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in OUT.split(", ")])

    return bounded_batches(vectors).mapInArrow(run, OUT)
