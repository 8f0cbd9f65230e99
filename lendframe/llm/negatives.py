"""Hard negatives by inner product: best-first search of STR-packed R-trees, with score windows.

Rows (vec_id, label, v: whole numbers) are cut into tiles of about TILE by sort-tile-recursive packing: slabs by label and first
coordinate, slabs into tiles by the second, both by Spark's range partitioning; equal values are told apart by a hash of the id, so a
vector that a third of all rows share fills many tiles. Inside a tile the recursion goes on, over its coordinates by falling variance,
down to leaves of LEAF rows; FAN leaves are a node. Tiles, nodes and leaves have minimum bounding boxes, and a box bounds the inner
product with an anchor coordinate by coordinate.

A search has windows of scores, and wants the first k rows of each. It takes boxes from a queue, the largest upper bound first, and leaves out
those outside all windows or strictly below the kth score found. Across tiles it takes two rounds: the tile of the largest bound first
(of each PACK of tiles), which gives a floor for the kth score, then all tiles whose box reaches into a window above its floor. The
first search finds each anchor's positives, the second their windows. Anchors are the stated query set; they meet tiles in blocks.

Rows with a null label, vector or component, or a component that is not finite, take no part. A null id is no anchor; as a candidate it
comes last among ties and is returned as null. Rows equal in all are one row; other rows of one id are separate rows, and an
anchor's other rows are those with another id. Vectors of another dimension than the anchor's have no score with it. Components are
clamped to +-2**26. Anchors without positives, positives below zero (whose window is empty) and empty tables give no rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendframe.llm.blocks import get, put
from lendframe.llm.common import staged, table

TILE, LEAF, FAN = 8192, 256, 8
#: Tiles whose boxes one task holds, and anchors of a block.
PACK, BLOCK = 4096, 1024
LEAST, MOST = -(1 << 63), (1 << 63) - 1
LIMIT = 1 << 26
TILES = "tile long, dim int, low binary, high binary, first long, last long, ids binary, labels binary, rows binary, cuts binary"
ASKED = "tile long, block int, q long, anchor_id long, label long, v array<long>, limits array<struct<w:int,low:long,high:long>>"
FOUND = "q long, w int, vec_id long, score long"


def usable(vectors: DataFrame, label: Column, scale: float = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, label and v, the whole numbers floor(scale * component), of the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    whole = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    number = F.transform("v", lambda c: F.floor(F.greatest(F.least(c * scale, F.lit(float(LIMIT))), F.lit(-float(LIMIT)))))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"), v.alias("v"))
    return rows.where(F.col("label").isNotNull() & F.col("v").isNotNull() & whole).select("vec_id", "label", number.alias("v")).distinct()


def leaves(v: np.ndarray, size: int = LEAF) -> list[np.ndarray]:
    """Rows of each leaf: cut into slabs by one coordinate after another, so many each time that all cuts are alike."""
    by = np.argsort(-v.var(axis=0), kind="stable") if len(v) else np.zeros(0, int)

    def cut(rows: np.ndarray, depth: int) -> list[np.ndarray]:
        pages = -(-len(rows) // size)
        if pages <= 1:
            return [rows]
        left = max(1, min(len(by), int(np.ceil(np.log2(pages)))) - depth % max(1, len(by)))
        slabs = max(2, round(pages ** (1 / left)))
        order = rows[np.argsort(v[rows, by[depth % len(by)]], kind="stable")] if len(by) else rows
        return [x for part in np.array_split(order, min(slabs, pages)) for x in cut(part, depth + 1)]

    return cut(np.arange(len(v)), 0)


def _pack(batches):
    """A tile for each dimension that a partition holds."""
    rows = pa.Table.from_batches(list(batches))
    if not rows.num_rows:
        return
    number = TaskContext.get().partitionId() << 20
    dims = pc.list_value_length(rows["v"])
    for i, dim in enumerate(sorted(pc.unique(dims).to_pylist())):
        part = rows.filter(pc.equal(dims, dim)).combine_chunks()
        v = pc.list_flatten(part["v"]).to_numpy().astype(np.int64).reshape(part.num_rows, dim)
        pages = leaves(v)
        order = np.concatenate(pages)
        v, labels = v[order], part["label"].to_numpy()[order]
        ids = part["vec_id"].fill_null(MOST).to_numpy()[order]
        yield pa.RecordBatch.from_pydict(
            {"tile": [number + i], "dim": pa.array([dim], pa.int32()), "low": [v.min(axis=0).tobytes()], "high": [v.max(axis=0).tobytes()], "first": [int(labels.min())],
             "last": [int(labels.max())], "ids": [put(ids)], "labels": [put(labels)], "rows": [put(v.astype(np.int32))], "cuts": [put(np.cumsum([0, *map(len, pages)]))]}
        )


def tiles(rows: DataFrame) -> DataFrame:
    """The packed tiles of all rows, written."""
    count = max(1, -(-rows.count() // TILE))
    jitter = F.pmod(F.xxhash64("vec_id", "v"), F.lit(1 << 20)) / float(1 << 20)
    slabs = rows.repartitionByRange(int(np.ceil(np.sqrt(count))), "label", F.get("v", F.lit(0)) + jitter).withColumn("slab", F.spark_partition_id())
    dealt = slabs.repartitionByRange(count, "slab", "label", F.get("v", F.lit(1)) + jitter)
    return staged(dealt.select("vec_id", "label", "v").mapInArrow(_pack, TILES))


def bounds(low: np.ndarray, high: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product of an anchor with a point of each box, a hair wider than rounding."""
    up, down = np.maximum(a, 0.0), np.minimum(a, 0.0)
    least, most = low @ up + high @ down, high @ up + low @ down
    slack = 1e-9 * (1 + np.abs(low) @ np.abs(a) + np.abs(high) @ np.abs(a))
    return least - slack, most + slack


class Tree:
    """The R-tree of a tile: rows in packed order, leaves, and nodes of FAN leaves."""

    def __init__(self, v: np.ndarray, ids: np.ndarray, labels: np.ndarray, cuts: np.ndarray):
        self.ids, self.labels, self.cuts = ids, labels, cuts
        self.big = int(np.abs(v).max(initial=0))
        self.whole, self.v = v.astype(np.int64), v.astype(float)
        starts = cuts[:-1]
        self.leaf = [f.reduceat(self.v, starts, axis=0) for f in (np.minimum, np.maximum)]
        self.node = [f.reduceat(x, np.arange(0, len(starts), FAN), axis=0) for f, x in zip((np.minimum, np.maximum), self.leaf)]

    def scores(self, a: np.ndarray, page: slice) -> np.ndarray:
        if len(a) * self.big * int(np.abs(a).max(initial=0)) < 1 << 53:
            return (self.v[page] @ a).astype(np.int64)  # exact: all sums are whole numbers that a double holds
        return self.whole[page] @ a.astype(np.int64)

    def first(self, a: np.ndarray, wanted, limits: list[tuple[int, int]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window (low, high) the ids and scores of its first k rows of the wanted ones: higher scores first, then smaller ids."""
        floor, top = [low for low, _ in limits], max(high for _, high in limits)
        held = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in limits]
        (node_least, node_most), (least, most) = bounds(*self.node, a), bounds(*self.leaf, a)
        queue = [(-x, 0, i) for i, x in enumerate(node_most.tolist()) if node_least[i] <= top]
        heapq.heapify(queue)
        while queue:
            bound, is_leaf, i = heapq.heappop(queue)
            if -bound < min(floor):
                break
            if not is_leaf:
                for j in range(i * FAN, min(i * FAN + FAN, len(least))):
                    if most[j] >= min(floor) and least[j] <= top:
                        heapq.heappush(queue, (-most[j], 1, j))
                continue
            page = slice(self.cuts[i], self.cuts[i + 1])
            use = wanted(self.ids[page], self.labels[page])
            score, ids = self.scores(a, page)[use], self.ids[page][use]
            for w, (_, high) in enumerate(limits):
                inside = np.flatnonzero((score >= floor[w]) & (score <= high))
                if len(inside):
                    all_ids, all_scores = np.append(held[w][0], ids[inside]), np.append(held[w][1], score[inside])
                    keep = np.lexsort((all_ids, -all_scores))[:k]
                    held[w] = all_ids[keep], all_scores[keep]
                    if len(keep) == k:
                        floor[w] = max(floor[w], int(held[w][1][-1]))
        return held


def _meet(same: bool, only_best: bool):
    """Which anchors of a block have to look into which tiles of a pack: those whose box reaches into a window."""

    def run(left, right):
        out, asked = [], right.to_pylist()
        by_dim: dict[int, list[int]] = {}
        dims, firsts, lasts, names = (left[c].to_numpy() for c in ("dim", "first", "last", "tile"))
        boxes = {}
        for dim in np.unique(dims).tolist():
            by_dim[dim] = at = np.flatnonzero(dims == dim)
            lows, highs = left["low"].to_pylist(), left["high"].to_pylist()
            boxes[dim] = [np.stack([np.frombuffer(x[i], np.int64) for i in at]).astype(float) for x in (lows, highs)]
        for i, row in enumerate(asked):
            dim = len(row["v"])
            if dim not in boxes:
                continue
            at = by_dim[dim]
            least, most = bounds(*boxes[dim], np.array(row["v"], float))
            can = (firsts[at] <= row["label"]) & (lasts[at] >= row["label"]) if same else (firsts[at] != row["label"]) | (lasts[at] != row["label"])
            inside = np.zeros(len(at), bool)
            for limit in row["limits"]:
                inside |= (most >= limit["low"]) & (least <= limit["high"])
            hit = np.flatnonzero(can & inside)
            if only_best and len(hit):
                hit = hit[[most[hit].argmax()]]
            out += [(int(names[at[j]]), i) for j in hit]
        tile, i = zip(*out) if out else ((), ())
        rows = right.take(pa.array(i, pa.int64()))
        return pa.table({"tile": pa.array(tile, pa.int64()), "block": rows["block"], **{c: rows[c] for c in ("q", "anchor_id", "label", "v", "limits")}})

    return run


def _look(same: bool, k: int):
    """The first k rows of each window of each anchor of a block in one tile."""

    def run(left, right):
        ids, scores, names, windows = [], [], [], []
        if left.num_rows and right.num_rows:
            t = left.to_pylist()[0]
            tree = Tree(get(t["rows"], np.int32).reshape(-1, t["dim"]) if t["dim"] else np.zeros((len(get(t["ids"], np.int64)), 0), np.int32), get(t["ids"], np.int64), get(t["labels"], np.int64), get(t["cuts"], np.int64))
            for row in right.to_pylist():
                own, label = row["anchor_id"], row["label"]
                wanted = (lambda i, x: (x == label) & (i != own)) if same else (lambda i, x: x != label)
                found = tree.first(np.array(row["v"], float), wanted, [(x["low"], x["high"]) for x in row["limits"]], k)
                for limit, (i, s) in zip(row["limits"], found):
                    ids.append(i)
                    scores.append(s)
                    names.append(np.full(len(i), row["q"]))
                    windows.append(np.full(len(i), limit["w"], np.int32))
        ids, scores, names = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (ids, scores, names))
        windows = np.concatenate([np.zeros(0, np.int32), *windows])
        return pa.table({"q": names, "w": windows, "vec_id": pa.array(ids, mask=ids == MOST), "score": scores})

    return run


def _round(queries: DataFrame, packed: DataFrame, n_tiles: int, n_queries: int, k: int, same: bool, only_best: bool) -> DataFrame:
    packs, blocks = -(-n_tiles // PACK), -(-n_queries // BLOCK)
    pack = F.pmod(F.xxhash64("tile"), F.lit(packs)).cast("int")
    block = F.pmod(F.xxhash64("q"), F.lit(blocks)).cast("int")
    boxes = packed.select("tile", "dim", "low", "high", "first", "last", pack.alias("pack"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    asked = queries.select("q", "anchor_id", "label", "v", "limits", block.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(packs - 1))).alias("pack"))
    pairs = staged(boxes.groupBy("pack", "block").cogroup(asked.groupBy("pack", "block")).applyInArrow(_meet(same, only_best), ASKED))
    needed = pairs.select(F.col("tile").alias("of"), F.col("block").alias("for_block")).distinct()
    bodies = packed.select("tile", "dim", "ids", "labels", "rows", "cuts").join(needed, F.col("tile") == F.col("of"))
    return bodies.groupBy("of", "for_block").cogroup(pairs.groupBy("tile", "block")).applyInArrow(_look(same, k), FOUND)


def first(queries: DataFrame, packed: DataFrame, k: int, same: bool) -> DataFrame:
    """q, w, rank, vec_id, score: the first k rows of each window (limits: w, low, high) of each query, of its label or of all others."""
    n_tiles, n_queries = packed.count(), queries.count()
    if not n_tiles or not n_queries:
        return queries.sparkSession.createDataFrame([], "q long, w int, rank int, vec_id long, score long")
    order = Window.partitionBy("q", "w").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    seen = _round(queries, packed, n_tiles, n_queries, k, same, True)
    floors = seen.withColumn("nth", F.row_number().over(order)).where(F.col("nth") == k).select("q", "w", F.col("score").alias("floor"))
    limits = queries.select("q", F.inline("limits")).join(floors, ["q", "w"], "left")
    raised = limits.select("q", F.struct("w", F.greatest("low", "floor").alias("low"), "high").alias("x")).groupBy("q").agg(F.sort_array(F.collect_list("x")).alias("limits"))
    again = staged(queries.drop("limits").join(raised, "q"))
    found = _round(again, packed, n_tiles, n_queries, k, same, False)
    return staged(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("q", "w", "rank", "vec_id", "score"))


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """Hard negatives of the positives of each anchor: of other labels, at low to high percent of the positive's score.

    rows: vec_id, label, v, of `usable`.
    """
    rows = staged(rows)
    packed = tiles(rows)
    everything = F.array(F.struct(F.lit(0).alias("w"), F.lit(LEAST).alias("low"), F.lit(MOST).alias("high")))
    anchors = staged(rows.where(is_anchor).select(F.xxhash64("vec_id", "label", "v").alias("q"), F.col("vec_id").alias("anchor_id"), "label", "v", everything.alias("limits")))
    near = first(anchors, packed, positives, True).select("q", F.col("rank").alias("w"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")).where("positive_score >= 0")
    score = F.col("positive_score")
    # positives of equal score share a window, that of the first of them
    shared = near.groupBy("q", "positive_score").agg(F.min("w").alias("w"))
    window = F.struct("w", F.expr(f"({low} * positive_score + 99) div 100").alias("low"), F.expr(f"{high} * positive_score div 100").alias("high"))
    wanted = staged(anchors.drop("limits").join(shared.groupBy("q").agg(F.sort_array(F.collect_list(window)).alias("limits")), "q"))
    hard = first(wanted, packed, negatives, False).select("q", "w", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    pairs = near.drop("w").join(shared, ["q", "positive_score"]).join(anchors.select("q", "anchor_id"), "q").join(hard, ["q", "w"])
    return pairs.select("anchor_id", "positive_id", "rank", "negative_id", score, "negative_score")


def op12_negatives(spark, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(usable(table(spark, sf_dir, "embeddings"), label), F.col("vec_id") % 100 == 0)


OP12_SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM (SELECT * FROM e WHERE vec_id % 100 = 0) a, e b),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE label = own AND vec_id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE label <> own AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
