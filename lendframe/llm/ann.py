"""Approximate nearest neighbours by cosine: inverted multi-index over two halves of the unit vectors.

Each half has its own codebook, so two small codebooks cut space into the square of their size in cells. A query ranks the
centroids of either half by distance and walks pairs of them by rising sum of distances with a heap (the multi-sequence algorithm)
until the cells it has met hold enough entries; all entries of those cells are then reranked by exact cosine.

The codebooks are fitted on about `SAMPLE` vectors drawn by hash; every vector is indexed. How many entries a query must
meet is measured, not set: among steps of doubling it is the first at which queries drawn from the sample find `RECALL` of their true
neighbours in the sample, in proportion to all vectors.

Vectors that are null, zero, or hold null or non-finite components take no part. Those of one dimension are a table of their own, with
its own index. Equal vectors are one entry with its 6 smallest ids, which is exact for 5 neighbours, so a vector that a third of all rows
share is one entry. Rows that repeat a vec_id are the query's own row for that id. A null id is no query; as a neighbour it is the last of equals.
Cells are dealt to groups of bounded size.
An empty table, and a query without candidates, give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendframe.llm.common import staged, table

NEAREST = 5
SAMPLE = 20_000
RECALL = 0.97
#: Entries that one group of cells holds at most in a task, and the fewest groups.
CHUNK, GROUPS = 20_000, 16
#: Most centroids of a half; cells are at most its square.
MOST_CENTROIDS = 256
#: Stands for a null id, which comes last.
NO_ID = (1 << 63) - 1


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and v (doubles) of the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    whole = F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    some = F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
    return rows.where(F.col("v").isNotNull() & whole & some)


def lloyd(points: np.ndarray, k: int, rounds: int = 15, seed: int = 7) -> np.ndarray:
    """k centroids of the points; a centroid without points moves to a random one."""
    rng = np.random.default_rng(seed)
    centres = points[rng.choice(len(points), min(k, len(points)), replace=False)].copy()
    for _ in range(rounds):
        near = (points @ centres.T - (centres**2).sum(axis=1) / 2).argmax(axis=1)
        n = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], points[rng.integers(len(points), size=len(centres))])
    return centres


def distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (points**2).sum(axis=1)[:, None] - 2 * points @ centres.T + (centres**2).sum(axis=1)[None, :]


def walk(left: np.ndarray, right: np.ndarray, sizes: np.ndarray, enough: float) -> list[int]:
    """Cells (left number * count of right + right number) by rising summed distance until they hold `enough` entries."""
    a, b = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
    dl, dr, m = left[a], right[b], len(right)
    heap, cells, held = [(dl[0] + dr[0], 0, 0)], [], 0
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        cell = int(a[i]) * m + int(b[j])
        if sizes[cell]:
            cells.append(cell)
            held += int(sizes[cell])
        if j + 1 < m:
            heapq.heappush(heap, (dl[i] + dr[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (dl[i + 1] + dr[0], i + 1, 0))
    return cells


class Index:
    """Two codebooks and the numbers of entries that each cell holds."""

    def __init__(self, sample: np.ndarray, total: int):
        unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
        self.half = unit.shape[1] // 2
        k = int(np.clip(2 ** round(np.log2(max(total, 4) / 32) / 2), 2, MOST_CENTROIDS))
        self.books = [lloyd(unit[:, : self.half], k), lloyd(unit[:, self.half :], k)]
        self.enough = self._calibrate(unit, total)

    def halves(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return distances(unit[:, : self.half], self.books[0]), distances(unit[:, self.half :], self.books[1])

    def cells(self, v: np.ndarray) -> np.ndarray:
        left, right = self.halves(v / np.linalg.norm(v, axis=1, keepdims=True))
        return left.argmin(axis=1) * len(self.books[1]) + right.argmin(axis=1)

    def _calibrate(self, unit: np.ndarray, total: int, queries: int = 200) -> float:
        """Share of all entries that a walk has to meet."""
        cell = self.cells(unit)
        sizes = np.bincount(cell, minlength=len(self.books[0]) * len(self.books[1]))
        asked = unit[:: max(1, len(unit) // queries)]
        own = np.arange(0, len(unit), max(1, len(unit) // queries))
        near = asked @ unit.T
        near[np.arange(len(own)), own] = -2
        want = np.argsort(-near, axis=1)[:, :NEAREST]
        left, right = self.halves(asked)
        share = 1 / 64
        while share < 1:
            found = sum(np.isin(cell[w], walk(x, y, sizes, share * len(unit))).sum() for w, x, y in zip(want, left, right))
            if found >= RECALL * want.size:
                return share
            share *= 1.5
        return 1.0


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = NEAREST) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query (vec_id, v) among vectors of its dimension, its own row left out."""
    written = staged(vectors.withColumn("vec_id", F.coalesce("vec_id", F.lit(NO_ID))))
    dims = [r["d"] for r in written.select(F.size("v").alias("d")).distinct().orderBy("d").collect()] or [0]  # one row a dimension
    parts = [_nearest(written.where(F.size("v") == d), queries.where(F.size("v") == d), k) for d in dims]
    return reduce(DataFrame.unionByName, parts).withColumn("vec_id", F.nullif("vec_id", F.lit(NO_ID)))


def _nearest(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    entries = staged(vectors.distinct().withColumn("nth", nth).where(F.col("nth") <= k + 1))
    firsts = entries.where("nth = 1")
    total = firsts.count()
    u = F.pmod(F.xxhash64("vec_id", F.lit("sample")), F.lit(1 << 30)) / (1 << 30)
    sample = firsts.where(u < min(1.0, SAMPLE / max(total, 1))).select("v").toPandas()
    kind = "query_id long, vec_id long, score double"
    if not len(sample):
        return vectors.sparkSession.createDataFrame([], kind.replace("vec_id", "rank int, vec_id"))
    spark = vectors.sparkSession
    index = spark.sparkContext.broadcast(Index(np.stack(sample["v"]), total))

    def place(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.append_column("cell", pa.array(index.value.cells(_matrix(batch.column("v"))).astype(np.int64)))

    placed = staged(entries.select("vec_id", "v", "nth").mapInArrow(place, "vec_id long, v array<double>, nth int, cell long"))
    n_cells = len(index.value.books[0]) * len(index.value.books[1])
    groups = max(GROUPS, -(-total // CHUNK))  # cells are dealt to groups, and a group that holds more than CHUNK entries is split
    held = placed.groupBy("cell").count().toPandas()  # at most MOST_CENTROIDS squared rows
    sizes = np.zeros(n_cells, np.int64)
    sizes[held["cell"]] = held["count"]
    counts = spark.sparkContext.broadcast(sizes)
    group = F.pmod("cell", F.lit(groups)).cast("int")
    placed = placed.withColumn("group", group)
    chunks = placed.groupBy("group").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))

    def probe(batches):
        need = max(index.value.enough * counts.value.sum(), k + 1)
        for batch in batches:
            ids, v = batch.column("vec_id").to_numpy(), _matrix(batch.column("v"))
            if len(v):
                left, right = index.value.halves(v / np.linalg.norm(v, axis=1, keepdims=True))
                for i in range(len(v)):
                    cells = np.array(walk(left[i], right[i], counts.value, need), np.int64)
                    at = cells % groups
                    names = np.unique(at)
                    n = len(names)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, ids[i])), pa.array([v[i]] * n), pa.array(names.astype(np.int32)), pa.array([cells[at == g] for g in names])], names=["query_id", "q", "group", "cells"]
                    )

    def rerank(left, right):
        e, q = _matrix(left["v"]), _matrix(right["q"])
        if not len(e) or not len(q):
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        ids, cell, own = left["vec_id"].to_numpy(), left["cell"].to_numpy(), right["query_id"].to_numpy()
        length, out, wanted = np.sqrt((e**2).sum(axis=1)), [], np.zeros(n_cells, bool)
        for i, cells in enumerate(right["cells"].to_pylist()):
            wanted[:] = False
            wanted[cells] = True
            near = np.flatnonzero(wanted[cell] & (ids != own[i]))
            size = np.sqrt((q[i] ** 2).sum())
            rough = e[near] @ q[i] / (length[near] * size)
            pick = near[rough >= (np.partition(rough, len(rough) - k)[len(rough) - k] - 1e-9 if len(rough) > k else -1.5)]
            exact = (e[pick] * q[i]).sum(axis=1) / (length[pick] * size)
            order = np.lexsort((ids[pick], -exact))[:k]
            out.append((np.full(len(order), own[i]), ids[pick][order], exact[order]))
        a, b, c = (np.concatenate(x) for x in zip(*out))
        return pa.table({"query_id": pa.array(a), "vec_id": pa.array(b), "score": pa.array(c)})

    chunk = F.pmod(F.xxhash64("vec_id"), "chunks")
    left = placed.join(F.broadcast(chunks), "group").select("vec_id", "v", "cell", "group", chunk.alias("chunk"))
    asked = queries.dropDuplicates(["vec_id"]).select("vec_id", "v").repartition(64).mapInArrow(probe, "query_id long, q array<double>, group int, cells array<long>")
    right = asked.join(F.broadcast(chunks), "group").select("query_id", "q", "cells", "group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"))
    found = left.groupBy("group", "chunk").cogroup(right.groupBy("group", "chunk")).applyInArrow(rerank, kind)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.distinct().withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9_ann(spark, sf_dir: str) -> DataFrame:
    vectors = usable(table(spark, sf_dir, "embeddings"))
    return nearest(vectors, vectors.where("vec_id % 50 = 0"))
