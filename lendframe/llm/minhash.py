"""Near-duplicate documents by weighted MinHash with darts (DartMinHash), banded joins and exact verification.

A document is a weighted set: its shingles of five words (`[^\\x20\\x09-\\x0D]+`, lower-cased in A to Z), each weighted by how often it
occurs; a text of fewer words is one shingle. Every unit of weight of every shingle is a region into which darts are thrown at
hashed times. A document collects the darts of its regions up to a time that shrinks with its weight, so that a long text keeps
few darts a region and about k * (ln k + 2) in all; of those for one coordinate the earliest is the signature there. Two
documents agree on a coordinate with the probability of their weighted Jaccard similarity. Where a coordinate got no dart,
the time is doubled for that document.

Texts that are equal (lower-cased in A to Z) are one node. Nodes that share a band of the signature form a bucket. The centre of
a bucket is the node that shares bands with most others: of an original and its copies, the original. Each node is compared once, with
the centre it shares most bands with, and buckets whose nodes are then one component are done. What is still apart in a bucket
is compared pair by pair across components, but for pairs that cannot be alike (`across`). Two exact bounds say so. Of a node's units of
weight only those that also occur in another component can be in common, and that bounds its similarity to any text of a given size;
nodes that no partner is left for go, the units are counted anew among the others, and so on. And a bit of a hashed bitmap of units that one
node sets and the other does not is a unit that they don't share. Both tests are part of the join that makes pairs, as is the test that
components differ, so a pair that is known to be linked or known to be below 0.8 is never a row. All other pairs that share a band are
compared, exactly, on whole texts. A class is a component of links of similarity 0.8 or more, named by its smallest doc_id.

Null text counts as empty. Texts without words are only ever in a class with equal ones. Repeated rows are in one class.
Null ids: the class has a null id only if it has no other. Extra columns are ignored. An empty table gives an empty result.
With 32 bands of 4, a pair of similarity 0.8 is missed with probability 5e-8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendframe.llm.common import BASE, ascii_lower, give_back, mix, slices, staged, table, utf8, word_hashes

SHINGLE = 5
BANDS, ROWS = 32, 4
SIMILARITY = 0.8
#: Comparisons with one node that a single task makes.
FAN = 256
#: The bound is tightened while a round leaves at most this share of the rows.
FEWER = 0.9
#: Words of 64 bits in the bitmap of a text's units.
BITS = 32
SLICE = 1 << 19


def elements(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each unit of weight (shingle and number of its repeat) and the text it belongs to, in order of the texts."""
    h, n = word_hashes(data, offsets)
    ends = np.cumsum(n)
    starts = ends - n
    base = np.uint64(BASE)
    found = np.zeros(len(h), np.uint64)
    use = np.zeros(len(h), bool)
    if len(h) >= shingle:
        s = h[: len(h) - shingle + 1].copy()
        for i in range(1, shingle):
            s = s * base + h[i : len(h) - shingle + 1 + i]
        found[: len(s)] = s
    owner = np.repeat(np.arange(len(n)), n)
    use[:] = np.arange(len(h)) + shingle <= ends[owner]
    short = np.flatnonzero((n > 0) & (n < shingle))
    s = n[short].astype(np.uint64)
    for i in range(shingle - 1):
        more = i < n[short]
        s[more] = s[more] * base + h[starts[short][more] + i]
    found[starts[short]], use[starts[short]] = s, True
    found, owner = mix(found[use]), owner[use]
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(len(found)), 0))
    return mix(found + (np.arange(len(found)) - first).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)), owner


def dart_signatures(element: np.ndarray, owner: np.ndarray, count: int, k: int = BANDS * ROWS) -> np.ndarray:
    """Signature (count, k) of each weighted set; rows of sets without elements are zero."""
    out = np.zeros((count, k), np.uint64)
    weight = np.bincount(owner, minlength=count)
    limit = (np.log(k) + 2) / np.maximum(weight, 1)
    todo = weight > 0
    while todo.any():
        pick = todo[owner]
        e, doc = element[pick], owner[pick]
        time, i, darts = np.zeros(len(e)), 0, []
        while len(e):
            h = mix(e + np.uint64((i * BASE + 1) % (1 << 64)))
            time = time - np.log(((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / k
            on = time <= limit[doc]
            e, doc, time, h, i = e[on], doc[on], time[on], h[on], i + 1
            darts.append((doc, time, h))
        doc, time, h = (np.concatenate(x) for x in zip(*darts))
        h = mix(h ^ np.uint64(0xA24BAED4963EE407))
        cell = doc * k + (h % np.uint64(k)).astype(np.int64)
        late_first = np.argsort(-time)
        flat = out.reshape(-1)
        hit = np.zeros(count * k, bool)
        flat[cell[late_first]] = h[late_first]  # the earliest is written last
        hit[cell] = True
        todo &= ~hit.reshape(count, k).all(axis=1)
        limit = limit * 2
    return out


def bands(signatures: np.ndarray, n_bands: int = BANDS) -> np.ndarray:
    """One 64-bit key per band, which names the band too."""
    parts = signatures.reshape(len(signatures), n_bands, -1)
    key = np.arange(n_bands, dtype=np.uint64)[None, :] * np.uint64(0x9FB21C651E98DF25)
    for i in range(parts.shape[2]):
        key = mix(key * np.uint64(BASE) + parts[:, :, i])
    return key.view(np.int64)


def node_of(text: Column) -> Column:
    """128 bits of the SHA-256 of the lower-cased text."""
    return F.substring(F.unhex(F.sha2(ascii_lower(F.coalesce(text, F.lit(""))).cast("binary"), 256)), 1, 16)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        for low, high in slices(offsets, SLICE):
            e, owner = elements(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
            keys = bands(dart_signatures(e, owner, high - low))
            full = np.bincount(owner, minlength=high - low) > 0
            at = np.concatenate([[0], np.cumsum(full * BANDS)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(at), pa.array(keys[full].ravel()))
            cut = batch.slice(low, high - low)
            yield pa.RecordBatch.from_arrays([cut.column("doc_id"), cut.column("node"), lists], names=["doc_id", "node", "bands"])
    give_back()


def bitmaps(element: np.ndarray, owner: np.ndarray, count: int) -> np.ndarray:
    """A bitmap of BITS * 64 bits for each text: a bit is set if a unit of weight hashes to it."""
    place = (mix(element) >> np.uint64(20)) % np.uint64(BITS * 64)
    out = np.zeros((count, BITS), np.uint64)
    np.bitwise_or.at(out, (owner, (place >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (place & np.uint64(63)))
    return out


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        for low, high in slices(offsets, SLICE):
            e, owner = elements(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
            at = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=high - low))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(at), pa.array(e.view(np.int64)))
            bits = pa.ListArray.from_arrays(pa.array(np.arange(high - low + 1, dtype=np.int32) * BITS), pa.array(bitmaps(e, owner, high - low).view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("node").slice(low, high - low), lists, bits], names=["node", "elements", "bits"])
    give_back()


def _compare(left, right):
    """Similarity of the one text of `right` (a) to each text of `left` (b)."""
    if not left.num_rows or not right.num_rows:
        return pa.table({"a": pa.array([], pa.binary()), "b": pa.array([], pa.binary()), "similarity": pa.array([], pa.float64())})
    mine, _ = elements(*utf8(right.column("whole").slice(0, 1)))
    data, offsets = utf8(left.column("text"))
    found = np.zeros(left.num_rows)
    mine = np.sort(mine)
    for low, high in slices(offsets, SLICE):
        e, owner = elements(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
        at = np.minimum(np.searchsorted(mine, e), max(len(mine) - 1, 0))
        same = np.bincount(owner[mine[at] == e] if len(mine) else owner[:0], minlength=high - low)
        found[low:high] = same / np.maximum(np.bincount(owner, minlength=high - low) + len(mine) - same, 1)
    return pa.table({"a": left["a"], "b": left["b"], "similarity": pa.array(found)})


def verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Exact similarity of pairs (a, b) of nodes; a node in many pairs meets its partners in groups of about FAN."""
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / FAN).alias("groups"))
    dealt = pairs.join(many, "a").select("a", "b", F.pmod(F.xxhash64("b"), "groups").alias("part"))
    left = dealt.join(texts.select(F.col("node").alias("b"), "text"), "b").select("a", "b", "part", "text")
    asked = dealt.select(F.col("a").alias("of"), F.col("part").alias("in_part")).distinct()
    right = asked.join(texts.select(F.col("node").alias("of"), F.col("text").alias("whole")), "of")
    return left.groupBy("a", "part").cogroup(right.groupBy("of", "in_part")).applyInArrow(_compare, "a binary, b binary, similarity double")


def components(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Labels (node, root) after joining the components that edges (a, b) connect; the root is the smallest node.

    Each root hooks onto its smallest neighbour, chains of hooks are shortened to their ends, and so on until no edge crosses.
    """
    while True:
        ends = edges.join(labels.select(F.col("node").alias("a"), F.col("root").alias("x")), "a").join(labels.select(F.col("node").alias("b"), F.col("root").alias("y")), "b")
        cross = staged(ends.where("x <> y").select("x", "y").distinct())
        if cross.isEmpty():
            return labels
        both = cross.unionByName(cross.select(F.col("y").alias("x"), F.col("x").alias("y")))
        hooks = staged(both.groupBy("x").agg(F.min("y").alias("y")).where("y < x"))
        while True:
            on = hooks.select(F.col("x").alias("y"), F.col("y").alias("z"))
            longer = hooks.join(on, "y", "left").select("x", F.coalesce("z", "y").alias("y"), F.col("z").isNotNull().alias("moved"))
            hooks = staged(longer)
            if hooks.where("moved").isEmpty():
                break
            hooks = hooks.drop("moved")
        labels = staged(labels.join(hooks.select(F.col("x").alias("root"), F.col("y").alias("to")), "root", "left").select("node", F.coalesce("to", "root").alias("root")))


def across(rooted: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a < b) of nodes that share a bucket but no component, without those that are surely below SIMILARITY.

    rooted: key, node, root, of buckets with several roots. Texts of sizes x and y with n units in common are alike if n * (1 + 1 / SIMILARITY) >= x + y, and n is
    at most the units of either that occur in other components too. So the size and that count give a node's reach: the largest
    partner it can have. Rows whose bucket has no partner in reach of another component go, and the units of the others are counted anew.
    """
    rest = rooted
    sets = staged(texts.join(rest.select("node").distinct(), "node", "left_semi").mapInArrow(_sets, "node binary, elements array<long>, bits array<long>"))
    left = rest.count()
    while True:
        nodes = sets.join(rest.select("node", F.xxhash64("root").alias("r")).distinct(), "node").withColumn("id", F.xxhash64("node"))
        units = nodes.select("id", "r", F.explode("elements").alias("e"))
        common = units.groupBy("e").agg(F.min("r").alias("r"), F.max("r").alias("s")).where("r <> s").select("e")
        counted = units.select("id", "e").join(common, "e", "left_semi").groupBy("id").agg(F.count("*").alias("n"))
        size = F.size("elements")
        bounds = nodes.select("node", "id", size.alias("size")).join(counted, "id").select("node", "size", (F.col("n") * (1 + 1 / SIMILARITY) - F.col("size")).alias("reach"))
        near = staged(rest.select("key", "node", "root").join(bounds, "node"))
        # the smallest text and the furthest reach of each bucket, and the next ones of another component
        per = near.groupBy("key", "root").agg(F.min("size").alias("size"), F.max("reach").alias("reach"))
        small, far = (F.row_number().over(Window.partitionBy("key").orderBy(c, "root")) for c in (F.col("size"), F.desc("reach")))
        ends = per.withColumn("i", small).withColumn("j", far).where("i <= 2 or j <= 2").groupBy("key").agg(
            *(F.max(F.when(F.col(i) == k, F.col(c))).alias(f"{c}_{i}{k}") for i, c in (("i", "size"), ("j", "reach")) for k in (1, 2)),
            *(F.max(F.when(F.col(i) == 1, F.col("root"))).alias(f"root_{i}") for i in "ij"),
        )
        least = F.when(F.col("root") == F.col("root_i"), F.col("size_i2")).otherwise(F.col("size_i1"))
        most = F.when(F.col("root") == F.col("root_j"), F.col("reach_j2")).otherwise(F.col("reach_j1"))
        rest = staged(near.join(ends, "key").where((least <= F.col("reach")) & (most >= F.col("size"))).select("key", "node", "root", "size", "reach"))
        before, left = left, rest.count()
        if left > FEWER * before or not left:
            break
    # each pair once, in the lowest of the buckets both are in; large buckets are dealt to groups of FAN
    groups = rest.groupBy("key").agg(F.ceil(F.count("*") / FAN).cast("int").alias("groups"))
    per_node = rest.groupBy("node").agg(F.collect_list("key").alias("keys")).join(sets.select("node", "bits"), "node")
    rows = rest.join(groups, "key").join(per_node, "node")
    a, b = (rows.select("key", "groups", *(F.col(c).alias(f"{c}_{x}") for c in ("node", "root", "size", "reach", "keys", "bits"))) for x in "ab")
    a = a.withColumn("part", F.pmod(F.xxhash64("node_a"), "groups").cast("int")).drop("groups")
    b = b.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))).drop("groups")
    fits = F.expr("node_a < node_b and root_a <> root_b and size_a <= reach_b and size_b <= reach_a")

    def alone(x: str, y: str) -> Column:
        """Units of x that y lacks, at least."""
        return F.aggregate(F.zip_with(f"bits_{x}", f"bits_{y}", lambda p, q: F.bit_count(p.bitwiseAND(F.bitwise_not(q)))), F.lit(0), lambda n, i: n + i)

    common = F.least(F.col("size_a") - alone("a", "b"), F.col("size_b") - alone("b", "a"))
    alike = common * (1 + 1 / SIMILARITY) >= F.col("size_a") + F.col("size_b") - 1e-6
    once = F.array_min(F.array_intersect("keys_a", "keys_b")) == F.col("key")
    return a.join(b, ["key", "part"]).where(fits & alike & once).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))


def classes(docs: DataFrame) -> DataFrame:
    """Every row with its node, class_id, class_size, and kept: whether it is the one that stays of its class."""
    signed = staged(docs.select("doc_id", node_of(F.col("text")).alias("node"), "text").mapInArrow(_sign, "doc_id long, node binary, bands array<long>"))
    one = signed.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.any_value("bands").alias("bands"), F.count("*").alias("copies"))
    keys = one.select("doc_id", "node", "copies", F.explode("bands").alias("key"))
    buckets = keys.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("z"), F.count("*").alias("nodes")).where("a <> z").select("key", "nodes")
    shared = staged(keys.join(buckets, "key"))
    known = shared.groupBy("node").agg(F.sum("nodes").alias("met"))
    centres = shared.select("key", "node").join(known, "node").groupBy("key").agg(F.max_by("node", F.struct("met", "node")).alias("a"))
    met = shared.select("key", F.col("node").alias("b")).join(centres, "key").where("a <> b").groupBy("a", "b").agg(F.count("*").alias("bands"))
    best = met.groupBy("b").agg(F.max_by("a", F.struct("bands", "a")).alias("a")).select("a", "b")
    labels = staged(shared.select("node").distinct().select("node", F.col("node").alias("root")))
    wanted = shared.select("node", "doc_id", "copies").distinct()
    full = docs.select(F.col("doc_id").alias("id"), node_of(F.col("text")).alias("n"), "text")
    found = staged(full.join(wanted, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("n") == F.col("node"))).select("node", "text", "copies"))
    again = found.where("copies > 1").groupBy("node").agg(F.any_value("text").alias("text"))  # rows may repeat both id and text
    texts = found.where("copies = 1").select("node", "text").unionByName(again)

    def link(pairs: DataFrame, labels: DataFrame) -> DataFrame:
        return components(staged(verify(pairs, texts)).where(F.col("similarity") >= SIMILARITY).select("a", "b"), labels)

    labels = link(staged(best), labels)
    rooted = staged(shared.select("key", "node").join(labels, "node"))
    apart = rooted.groupBy("key").agg(F.min("root").alias("r"), F.max("root").alias("s")).where("r <> s").select("key")
    labels = link(staged(across(staged(rooted.join(apart, "key")), texts)), labels)

    rows = signed.select("doc_id", "node").join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    per = staged(rows.groupBy("root", "node", "doc_id").agg(F.count("*").alias("n")))
    named = per.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.sum("n").alias("class_size"))
    firsts = per.join(named, "root").where(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy("root").agg(F.min(F.struct("node", "n")).alias("f")).select("root", F.col("f.node").alias("first"), F.col("f.n").alias("n"))
    out = rows.join(named.join(firsts, "root"), "root")
    is_first = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("node") == F.col("first"))
    nth = F.row_number().over(Window.partitionBy("root").orderBy("node"))
    stays = out.where(is_first).withColumn("kept", nth == 1)
    return out.where(~is_first).withColumn("kept", F.lit(False)).unionByName(stays).select("doc_id", "node", "class_id", "class_size", "kept", "n")


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with all their columns: of each class the document with the smallest id."""
    kept = staged(classes(docs).where("kept").select(F.col("doc_id").alias("id"), F.col("node").alias("kept"), F.col("n").alias("copies")))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), node_of(docs["text"]).alias("node"))
    both = rows.join(kept, F.col("row.doc_id").eqNullSafe(F.col("id")) & (F.col("node") == F.col("kept")))
    if not kept.where("copies > 1").isEmpty():  # rows that repeat both id and text
        both = both.withColumn("nth", F.row_number().over(Window.partitionBy("kept", "id").orderBy(F.lit(0)))).where("nth = 1")
    return both.select("row.*")


def op7_minhash(spark, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents")).drop("node", "n")
