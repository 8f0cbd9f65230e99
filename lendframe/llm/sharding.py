"""Sharding by Karmarkar-Karp differencing: shards of near-equal bytes from groups that must not be split.

Documents with equal texts form a group, and a group goes to one shard. Groups are summed first; in hash buckets of a few
thousand, differencing joins them to units of near-equal bytes, at most some hundreds for each shard in all, and the smallest groups stay
single. Units are joined the same way until there are at most MOST_UNITS, so what is dealt in one place is a bounded table at any input
size. Differencing then deals the units to the shards: of all partial partitions the two with the largest spread are combined, the
fullest part of one with the emptiest of the other, until one is left. Small and large tables take the same path. A group larger than a
shard's share is not split; all others balance around it.

Size: UTF-8 bytes of the text plus 16. Null text has no bytes, checksum 0, and forms a group of its own. Repeated rows are
rows like others. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendframe.llm.common import staged, table

SHARDS = 40
#: Groups of one hash bucket, about, and the most units that are dealt in one place; with very many shards, four times what they need.
BUCKET, MOST_UNITS = 4000, 100_000
#: Units a shard is made of, about, and the smallest groups of a bucket that stay single, to level out the rest.
UNITS, LOOSE = 200, 16


def difference(sizes: np.ndarray, parts: int) -> np.ndarray:
    """Part of each item, by Karmarkar-Karp differencing into `parts` parts.

    A partial partition is the list of its parts that hold items, by rising sum; parts it leaves out are empty. Combining two
    links the part lists of both in opposite order.
    """
    n = len(sizes)
    parent = np.arange(n)  # first item of the part an item has been joined to, followed to the end afterwards
    heap = [(-int(s), i, [(int(s), i)]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, i, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        # rising sums of a meet falling sums of b; empty parts are the lowest of each
        both = max(len(a) + len(b) - parts, 0)
        merged = []
        for x, y in zip(a[:both], reversed(b[:both])):
            parent[y[1]] = x[1]
            merged.append((x[0] + y[0], x[1]))
        merged = sorted(merged + a[both:] + b[both:])
        low = 0
        if len(merged) == parts:  # what all parts have in common matters no more
            low = merged[0][0]
            merged = [(s - low, k) for s, k in merged]
        spread = merged[-1][0] if len(merged) < parts else merged[-1][0] - merged[0][0]
        heapq.heappush(heap, (-spread, i, merged))
    roots = {k: j for j, (_, k) in enumerate(heap[0][2])} if heap else {}
    while True:
        up = parent[parent]
        if (up == parent).all():
            break
        parent = up
    return np.array([roots[k] for k in parent.tolist()], np.int64)


def _bundled(items: DataFrame, total: int, count: int, shards: int, level: int) -> DataFrame:
    """items (g, bytes) with the unit each belongs to."""
    share = max(1, total // (shards * UNITS))
    buckets = max(1, count // BUCKET)

    def bundle(key, group):
        sizes, bucket = group["bytes"].to_numpy(), key[0].as_py()
        unit = np.arange(len(sizes))
        joined = np.lexsort((group["g"].to_numpy(zero_copy_only=False), sizes))[LOOSE:]
        parts = max(1, int(sizes[joined].sum() // share))
        if parts < len(joined):
            unit[joined] = len(sizes) + difference(sizes[joined], parts)
        return pa.table({"g": group["g"], "bytes": group["bytes"], "unit": pa.array([f"{level}-{bucket}-{u}" for u in unit.tolist()], pa.string())})

    by = F.pmod(F.xxhash64("g"), F.lit(buckets)).cast("int")
    return items.withColumn("bucket", by).groupBy("bucket").applyInArrow(bundle, "g string, bytes long, unit string")


def _units(groups: DataFrame, total: int, count: int, shards: int) -> tuple[DataFrame, DataFrame]:
    """groups (g, bytes) with the unit each belongs to, and the units with their bytes (about MOST_UNITS at most)."""
    members, level = staged(_bundled(groups, total, count, shards, 1)), 1
    while True:
        units = staged(members.groupBy("unit").agg(F.sum("bytes").alias("bytes")))
        many = units.count()
        if many <= max(MOST_UNITS, 4 * shards * UNITS):
            return members.select("g", "unit"), units
        level += 1
        again = _bundled(units.withColumnRenamed("unit", "g"), total, many, shards, level).select(F.col("g").alias("unit"), F.col("unit").alias("next"))
        members = staged(members.join(again, "unit").select("g", "bytes", F.col("next").alias("unit")))


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Every row with size, text_crc32, shard and slot (gapless from 0 within the shard)."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 16
    crc = F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0).cast("long"))
    rows = staged(docs.select("doc_id", size.alias("size"), crc.alias("text_crc32"), F.coalesce(F.sha2(F.col("text").cast("binary"), 256), F.lit("")).alias("g")))
    groups = staged(rows.groupBy("g").agg(F.sum("size").alias("bytes")))
    total, count = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.count("*")).first()
    members, units = _units(groups, total, count, shards)

    def deal(units):
        units = units.sort_by([("bytes", "descending"), ("unit", "ascending")])
        return pa.table({"unit": units["unit"], "shard": pa.array(difference(units["bytes"].to_numpy(), shards).astype(np.int32))})

    dealt = units.groupBy().applyInArrow(deal, "unit string, shard int")
    placed = staged(rows.join(members.join(dealt, "unit").select("g", "shard"), "g").drop("g"))
    # slots: rows are numbered within hash parts of a shard, after all rows of the parts before
    parts = max(1, placed.count() // 1_000_000) * 8
    placed = placed.withColumn("part", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(parts)))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    firsts = placed.groupBy("shard", "part").agg(F.count("*").alias("n")).select("shard", "part", F.coalesce(before, F.lit(0)).alias("first"))
    nth = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size"))
    return placed.withColumn("nth", nth).join(firsts, ["shard", "part"]).select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("nth") - 1).alias("slot"))


def op10_sharding(spark, sf_dir: str) -> DataFrame:
    out = assign(table(spark, sf_dir, "documents"))
    return out.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))
