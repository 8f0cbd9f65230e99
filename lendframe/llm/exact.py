"""Exact deduplication of a new batch against immutable snapshots, screened by static binary-fuse filters.

A snapshot is a table of digests that never changes, so each of its digest buckets gets one binary-fuse filter of 9 bits a
key, built once and stored. Of an incoming batch only the rows that a filter lets through, all true members and one in 256 of the
others, join the exact buckets, where whole texts are compared as bytes. Rows that no filter lets through cannot be in the
snapshot and are grouped among themselves. Texts are equal when identical after lower-casing A to Z; of equal texts the row with
the largest id stays.

Null text counts as empty. A null id is smaller than any other. Rows that repeat an id within a group are each returned; one of
them stays. An empty table, snapshot or batch gives an empty side. Extra columns are ignored.
Groups are summed before they are shuffled, so a group of any size is a few rows. The semi-join that picks the texts let through
shuffles every text once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendframe.llm.common import ascii_lower, mix, staged, table

#: Keys of one filter, about.
KEYS = 200_000


def _slots(keys: np.ndarray, seed: int, segment: int, count: int) -> np.ndarray:
    """Three slots of each key, one in each of three neighbouring segments."""
    h = mix(keys ^ np.uint64(seed))
    first = (h >> np.uint64(40)) % np.uint64(count)
    steps = [np.uint64(segment) * (first + np.uint64(i)) + ((h >> np.uint64(13 * i)) & np.uint64(segment - 1)) for i in range(3)]
    return np.stack(steps).astype(np.int64)


def _prints(keys: np.ndarray, seed: int) -> np.ndarray:
    return (mix(keys + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(56)).astype(np.uint8)


def build_filter(keys: np.ndarray) -> bytes:
    """Binary-fuse filter of 64-bit keys: 16 bytes of seed, segment length and segment count, then one byte a slot.

    Slots that a single key uses are peeled off in rounds; going back, each peeled key sets its own slot so that its three
    slots add up (xor) to its fingerprint. A seed with which peeling gets stuck is replaced by the next.
    """
    keys = np.unique(keys)
    n = len(keys)
    segment = 1 << max(2, min(18, int(np.log(max(n, 2)) / np.log(3.33) + 2.25)))
    room = int(n * max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 4)))) + 3 * segment
    count = max(1, -(-room // segment) - 2)
    for seed in range(1, 200):
        slots = _slots(keys, seed, segment, count)
        size = segment * (count + 2)
        degree = np.bincount(slots.ravel(), minlength=size)
        owner = np.zeros(size, np.int64)  # xor of the numbers of the keys that use a slot
        for row in slots:
            np.bitwise_xor.at(owner, row, np.arange(n))
        rounds, open_ = [], np.flatnonzero(degree == 1)
        while len(open_):
            key, first = np.unique(owner[open_], return_index=True)
            rounds.append((key, open_[first]))
            touched = slots[:, key]
            np.subtract.at(degree, touched.ravel(), 1)
            for row in touched:
                np.bitwise_xor.at(owner, row, key)
            open_ = np.unique(touched)
            open_ = open_[degree[open_] == 1]
        if sum(len(k) for k, _ in rounds) == n:
            break
    else:
        raise ValueError("no seed lets these keys be peeled")
    cells, prints = np.zeros(size, np.uint8), _prints(keys, seed)
    for key, slot in reversed(rounds):
        a, b, c = cells[slots[:, key]]
        cells[slot] = prints[key] ^ a ^ b ^ c ^ cells[slot]
    return np.array([seed, segment, count, n], "<u4").tobytes() + cells.tobytes()


def in_filter(filter_: bytes, keys: np.ndarray) -> np.ndarray:
    """True for every key of the filter, and for about one in 256 of the others."""
    seed, segment, count, n = np.frombuffer(filter_[:16], "<u4").tolist()
    if not n:
        return np.zeros(len(keys), bool)
    cells = np.frombuffer(filter_, np.uint8, offset=16)
    a, b, c = cells[_slots(keys, seed, segment, count)]
    return (a ^ b ^ c) == _prints(keys, seed)


def digest(text: Column) -> Column:
    return F.sha2(ascii_lower(F.coalesce(text, F.lit(""))).cast("binary"), 256)


def _key(sha: Column) -> Column:
    """The first 64 bits of the digest as a signed number."""
    return F.conv(F.substring(sha, 1, 16), 16, -10).cast("long")


def _shard(sha: Column, shards: int) -> Column:
    """Bucket from the next bits, so that it is independent of the filter's."""
    return (F.conv(F.substring(sha, 17, 8), 16, 10).cast("long") % shards).cast("int")


def snapshot_filters(snapshot: DataFrame, shards: int) -> DataFrame:
    """One filter for each bucket of a snapshot's digests (text_sha256): shard, filter."""
    keys = snapshot.select("text_sha256").distinct().select(_shard(F.col("text_sha256"), shards).alias("shard"), _key(F.col("text_sha256")).alias("key"))

    def build(group):
        return pa.table({"shard": group["shard"].slice(0, 1), "filter": pa.array([build_filter(group["key"].to_numpy().view(np.uint64))], pa.binary())})

    return staged(keys.groupBy("shard").applyInArrow(build, "shard int, filter binary"))


def screen(incoming: DataFrame, filters: DataFrame, shards: int) -> DataFrame:
    """Distinct digests of a batch with `possible`: whether the snapshot's filter lets them through."""
    keys = incoming.select("text_sha256").distinct().withColumn("shard", _shard(F.col("text_sha256"), shards)).withColumn("key", _key(F.col("text_sha256")))

    def ask(left, right):
        known = right["filter"][0].as_py() if right.num_rows else None
        hit = in_filter(known, left["key"].to_numpy().view(np.uint64)) if known and left.num_rows else np.zeros(left.num_rows, bool)
        return pa.table({"text_sha256": left["text_sha256"], "possible": pa.array(hit)})

    return keys.groupBy("shard").cogroup(filters.groupBy("shard")).applyInArrow(ask, "text_sha256 string, possible boolean")


def _newest(rows: DataFrame, by: list[str]) -> DataFrame:
    """Per group: rows (group_size), largest id (keep_id) and how many rows have that id (n_keep)."""
    ids = rows.groupBy(*by, "doc_id").agg(F.sum("n").alias("n"))
    top = F.max(F.col("doc_id"))
    return ids.groupBy(*by).agg(F.sum("n").alias("group_size"), top.alias("keep_id"), F.coalesce(F.max_by("n", "doc_id"), F.max("n")).alias("n_keep"))


def groups(docs: DataFrame, digests: DataFrame, is_new: Column) -> DataFrame:
    """Groups of equal texts over a snapshot and a batch: text_sha256, keep_id, group_size, n_keep.

    digests: doc_id, text_sha256, new (false: of the snapshot). docs: the same rows with their texts; is_new tells them apart.
    """
    shards = digests.agg(F.count("*")).first()[0] // KEYS + 1
    old, new = digests.where(~F.col("new")), digests.where("new")
    screened = staged(screen(new, snapshot_filters(old, shards), shards))
    possible = screened.where("possible").select("text_sha256")
    # exact buckets: all rows of a digest that the filters let through, equal only if their bytes are
    texts = docs.select("doc_id", digest(F.col("text")).alias("text_sha256"), ascii_lower(F.coalesce("text", F.lit(""))).alias("bytes"))
    bucket = texts.join(possible, "text_sha256", "left_semi").groupBy("text_sha256", "bytes", "doc_id").agg(F.count("*").alias("n"))
    exact = _newest(bucket, ["text_sha256", "bytes"]).drop("bytes")
    rest = digests.join(possible, "text_sha256", "left_anti").groupBy("text_sha256", "doc_id", "new").agg(F.count("*").alias("n"))
    alone = _newest(rest, ["text_sha256", "new"]).drop("new")
    return exact.unionByName(alone)


def batch_of(doc_id: Column) -> Column:
    """Which rows count as the new batch: one id in two, by hash. All rows take part on one side or the other."""
    return F.pmod(F.xxhash64(doc_id), F.lit(2)) == 1


def _marked(docs: DataFrame, is_new: Column | None) -> DataFrame:
    is_new = batch_of(F.col("doc_id")) if is_new is None else is_new
    digests = staged(docs.select("doc_id", digest(F.col("text")).alias("text_sha256"), is_new.alias("new")))
    out = digests.join(groups(docs, digests, is_new), "text_sha256")
    is_keep = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    once = out.where(~is_keep | (F.col("n_keep") == 1)).withColumn("kept", is_keep)
    nth = F.row_number().over(Window.partitionBy("text_sha256").orderBy("new"))
    again = out.where(is_keep & (F.col("n_keep") > 1)).withColumn("kept", nth == 1)
    return once.unionByName(again)


def mark(docs: DataFrame, is_new: Column | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row."""
    return _marked(docs, is_new).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with all their columns: of equal texts the one with the largest id."""
    kept = staged(_marked(docs, None).where("kept").select(F.col("doc_id").alias("id"), F.col("text_sha256").alias("sha"), F.col("n_keep").alias("copies")))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), digest(docs["text"]).alias("digest"))
    both = rows.join(kept, F.col("row.doc_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("sha")))
    if not kept.where("copies > 1").isEmpty():  # rows that repeat both id and text
        both = both.withColumn("nth", F.row_number().over(Window.partitionBy("sha", "id").orderBy(F.lit(0)))).where("nth = 1")
    return both.select("row.*")


def op8_exact(spark, sf_dir: str) -> DataFrame:
    return mark(table(spark, sf_dir, "documents"))


OP8_SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""
