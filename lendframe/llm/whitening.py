"""Whitening of embeddings: the leading eigenvectors of their covariance by Chebyshev-filtered subspace iteration.

Rows whose vector is null or holds a null or non-finite entry take no part. Each entry c becomes the whole number
x = floor(SCALE * c) + SHIFT; sums, the mean and each row's deviation are exact integers. The d x d covariance is never built: one pass
multiplies a block Q of COMPONENTS + GUARD columns by it as sum of x'(x'Q) over the centred rows x', partition by partition.

A round maps the interval of the unwanted eigenvalues (from the lowest Ritz value down) to [-1, 1] and applies the Chebyshev polynomial of
DEGREE to the block by its three-term recurrence, a pass each, which shrinks what belongs to the interval and grows the rest; QR and
a Rayleigh-Ritz step follow. It ends when the residuals of all wanted pairs are at rounding (CERTIFIED of the largest eigenvalue), and a
fresh random block, kept orthogonal to them and filtered too, finds nothing above the last of them. A block that doesn't get there
in PATIENCE rounds is widened, at last to d columns, when the first step is exact.

Components are numbered by falling eigenvalue, with the largest entry of each positive. Eigenvalues below RANK of the largest count as
zero: their components cannot be whitened and give no rows, so a single row or equal rows give none. Vectors of different dimension
are lists of their own, each with its own fit; empty vectors have no component. Rows that repeat an id, or have none, are returned each.
64 * c is clamped to +-2**52; a deviation beyond a long is null. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendframe.llm.common import staged, table

COMPONENTS, GUARD, DEGREE = 32, 16, 8
SCALE, SHIFT = 64, 1_000_000
CERTIFIED, STALLED, RANK = 1e-14, 1e-11, 1e-10
#: An eigenvalue at that limit is known to 1e-6 of itself only; it counts as zero whichever way rounding takes it.
EDGE = 1 + 1e-4
PATIENCE, PROBES = 6, 8
#: Groups in which the partial products of all partitions are added up.
GROUPS = 16
LIMIT = float(1 << 52)
KIND = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def scaled(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and x, the whole numbers, of the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    whole = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    x = F.transform("v", lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(LIMIT)), F.lit(-LIMIT))) + SHIFT)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
    return rows.where(F.col("v").isNotNull() & whole & (F.size("v") > 0)).select("vec_id", x.alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


class Fit:
    """The fit list of one dimension: rows, exact sums, and products with its covariance."""

    def __init__(self, rows: DataFrame, n: int):
        self.rows, self.n = rows, n
        low = (1 << 26) - 1  # halves of the numbers, so that sums of longs stay exact
        sums = rows.select(F.posexplode("x").alias("i", "x")).groupBy("i").agg(F.sum(F.shiftright("x", 26)).alias("a"), F.sum(F.col("x").bitwiseAND(low)).alias("b")).orderBy("i").collect()
        self.sums = [(r.a << 26) + r.b for r in sums]
        self.middle = np.array([round(s / n) for s in self.sums], np.int64)
        self.rest = [s - n * int(m) for s, m in zip(self.sums, self.middle)]  # n times what the mean exceeds the middle by
        self.dim = len(sums)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.middle).astype(float) - np.array(self.rest, float) / self.n

    def product(self, q: np.ndarray) -> np.ndarray:
        """Covariance times q: one pass over the rows, and a sum of one small block a partition."""
        shared = self.rows.sparkSession.sparkContext.broadcast((q, self.middle, np.array(self.rest, float) / self.n))

        def part(batches):
            q, middle, rest = shared.value
            total = np.zeros(q.shape)
            for batch in batches:
                if batch.num_rows:
                    d = (_matrix(batch.column("x")) - middle).astype(float) - rest
                    total += d.T @ (d @ q)
            number = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(GROUPS, dtype=np.int32)), pa.array([number] * GROUPS), pa.array([total[g::GROUPS].tobytes() for g in range(GROUPS)])], names=["g", "part", "sums"])

        def add(rows):
            ordered = rows.sort_by("part")["sums"].to_pylist()  # so that a task that is run again adds up the same
            return pa.table({"g": rows["g"].slice(0, 1), "sums": pa.array([reduce(np.add, (np.frombuffer(x) for x in ordered)).tobytes()])})

        out = np.zeros(q.shape)
        for r in self.rows.select("x").mapInArrow(part, "g int, part long, sums binary").groupBy("g").applyInArrow(add, "g int, sums binary").collect():
            out[r.g :: GROUPS] = np.frombuffer(r.sums).reshape(-1, q.shape[1])
        shared.destroy()
        return out / self.n


def filtered(product, q: np.ndarray, low: float, high: float, top: float, degree: int, against: np.ndarray | None = None) -> np.ndarray:
    """The Chebyshev polynomial of the covariance for [low, high], times q, scaled to stay about 1 at `top`."""
    half, mid = (high - low) / 2, (high + low) / 2
    first = half / (top - mid)
    sigma, before = first, q
    now = (product(q) - mid * q) * (sigma / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - sigma)
        before, now, sigma = now, (product(now) - mid * now) * (2 * after / half) - sigma * after * before, after
        if against is not None:
            now -= against @ (against.T @ now)
    return now


def ritz(product, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values (falling) and vectors in the space of q, and the norms of their residuals."""
    q = np.linalg.qr(q)[0]
    vq = product(q)
    h = q.T @ vq
    values, turn = np.linalg.eigh((h + h.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    q, vq = q @ turn, vq @ turn
    return values, q, np.linalg.norm(vq - q * values, axis=0)


def leading(product, dim: int, count: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues (at most count, none that counts as zero) and their unit eigenvectors."""
    rng, guard = np.random.default_rng(seed), GUARD
    values, q, off = ritz(product, rng.normal(size=(dim, min(dim, count + guard))))
    best, spent = np.inf, 0
    while values[0] > 0:
        wanted = int((values[:count] > RANK * EDGE * values[0]).sum())
        worst = off[:wanted].max() / values[0]
        low = max(0.0, values[-1] - off[-1])
        if q.shape[1] == dim:
            break
        if worst <= CERTIFIED or worst <= STALLED and worst > best / 2:
            mine, last = q[:, :wanted], values[wanted - 1]
            probe = rng.normal(size=(dim, min(PROBES, dim - wanted)))
            probe -= mine @ (mine.T @ probe)
            high = min(last * (1 - 1e-9), max(values[-1], RANK * values[0]))
            probe = filtered(product, probe, min(low, high / 2), high, values[0], DEGREE, mine)
            probe = np.linalg.qr(probe - mine @ (mine.T @ probe))[0]
            if np.linalg.eigvalsh((h := probe.T @ product(probe)) + h.T)[-1] / 2 <= last * (1 + 1e-9):
                break
            q, best = np.hstack([q, probe]), np.inf  # something was missed
        best, spent = min(best, worst), spent + 1
        if spent % PATIENCE == 0:
            guard *= 2
            q = np.hstack([q, rng.normal(size=(dim, max(0, min(dim, count + guard) - q.shape[1])))])
        q = q[:, :dim]
        if q.shape[1] < dim:
            high = max(values[-1], RANK * values[0])
            q = filtered(product, q, low if low < high * (1 - 1e-6) else high / 2, high, values[0], DEGREE)
        values, q, off = ritz(product, q)
    keep = np.flatnonzero(values[:count] > max(RANK * EDGE * values[0], 0))
    q = q[:, keep]
    return values[keep], q * np.sign(q[np.abs(q).argmax(axis=0), np.arange(len(keep))])


def whiten(vectors: DataFrame, count: int = COMPONENTS) -> DataFrame:
    """The rows of KIND for each row (vec_id, x) and each of the leading components."""
    rows = staged(vectors)
    spark, parts = rows.sparkSession, []
    for size in rows.groupBy(F.size("x").alias("d")).count().orderBy("d").collect():  # one row a dimension
        fit = Fit(rows.where(F.size("x") == size["d"]), size["count"])
        values, q = leading(fit.product, fit.dim, count)
        if not len(values):
            continue
        weights = q / np.sqrt(values)
        identity = float(np.abs(weights.T @ fit.product(weights) - np.eye(len(values))).max())
        parts.append(fit.rows.mapInArrow(_projected(fit.n, fit.middle, fit.rest, weights, values / trace(fit), identity), KIND))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], KIND)


def trace(fit: Fit) -> float:
    """Sum of all variances."""
    middle = F.array(*map(F.lit, fit.middle.tolist()))
    off = F.zip_with("x", middle, lambda x, m: (x - m).cast("double"))
    square = F.aggregate(off, F.lit(0.0), lambda a, d: a + d * d)
    return fit.rows.agg(F.sum(square)).first()[0] / fit.n - sum((r / fit.n) ** 2 for r in fit.rest)


def _projected(n: int, middle: np.ndarray, rest: list[int], weights: np.ndarray, explained: np.ndarray, identity: float):
    k = weights.shape[1]

    def deviations(off: np.ndarray) -> pa.Array:
        most = n * (int(np.abs(off).max()) + 1)
        if off.shape[1] * most**2 < 1 << 63:
            return pa.array(((n * off - np.array(rest, np.int64)) ** 2).sum(axis=1))
        exact = [sum((n * x - r) ** 2 for x, r in zip(row, rest)) for row in off.tolist()]
        return pa.array([x if x < 1 << 63 else None for x in exact], pa.int64())

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                off = _matrix(batch.column("x")) - middle
                out = (off.astype(float) - np.array(rest, float) / n) @ weights
                row = pa.array(np.repeat(np.arange(len(out)), k))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(row), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(out))), pa.array(np.full(len(row), n)),
                     deviations(off).take(row), pa.array(out.ravel()), pa.array(np.tile(explained, len(out))), pa.array(np.full(len(row), identity))],
                    names=[x.split()[0] for x in KIND.split(", ")],
                )

    return run


def op13_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(scaled(table(spark, sf_dir, "embeddings")))
