"""Quality classifier: perplexity under an interpolated modified Kneser-Ney n-gram model of trusted text.

The tokens are bytes, all 256 of them as they are, and n-grams have `LOW` to `TOP` of them: exact 54-bit keys. Below them lies a model of
4-grams of 64 byte classes, bounded and therefore broadcast, with the share of each byte in its class: it answers where no exact n-gram does.
The n-gram counts of trusted texts are hash-sharded tables that grow with the corpus; the discounts, continuation counts, back-off
weights and probabilities of each order come from grouping and joining them on their keys.

The log probability of a text is a sum over its places and orders (`values`), one number for each n-gram of the model that occurs. The most
frequent n-grams, `HEAVY` at most, are looked up in a broadcast table while the texts are scanned; all others are counted for
each document and joined with the sharded model. No n-gram is left out, wherever the line between the two is drawn.

Trusted: labelled quality 1 and not toxic; all of them count, whole texts. They are dealt to two halves by id, with a model each: a trusted
document is scored by the model that did not count it, any other by the mean of both, so that scores of labelled and of other documents compare.
The classes below are counted over both halves. All documents are scored. A histogram of all scores per language gives its quantiles; the threshold is the one that best separates the labelled
documents of the language, where a good one lost weighs `GOOD` times a bad one kept. Languages with fewer than `LABELS` good or bad labels take the quantile that is best for all.

Short texts: the score that is thresholded shrinks towards the trusted mean by `PRIOR` symbols, so that a few letters do not
condemn a document. Null text counts as empty: the end symbol alone. Null lang is a language of its own. Repeated rows are scored alike.
Without trusted text nothing is rejected. Labels that name a document twice count by the lowest quality and the highest toxic mark.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendframe.llm.common import BASE, mix, slices, staged, table, utf8

ORDER, BITS = 4, 6
CLASSES = 1 << BITS
PRIOR = 100
#: Orders of exact n-grams, bits of a symbol (0: before the text, 1 to 256: bytes, 257: the end), and where a key has its order.
LOW, TOP, SIGN, END, TAG = 4, 6, 9, 257, 56
#: Most n-grams of the exact model that are broadcast.
HEAVY = 1 << 21
#: A good document rejected counts as this many bad ones kept, both as shares of their labels.
GOOD = 2
LABELS = 20
#: Width of a histogram bin in bits a symbol, and the number of bins.
WIDTH, BINS = 0.01, 3000
#: Bytes of text that are counted at once, and that are scored at once.
SLICE, PART = 1 << 20, 1 << 18
#: The bit map of trusted ids has 2**19 words of 64 bits, however many ids there are.
WORD_BITS = 19


def _symbols() -> np.ndarray:
    """Class of each byte; 0 is the edge of a text."""
    s = np.zeros(256, np.uint8)
    s[97:123] = np.arange(1, 27)
    s[65:91] = 27
    s[48:58] = 28
    s[[32, 10]] = 29, 30
    s[[b for b in range(32) if b != 10] + [127]] = 31
    for i, c in enumerate(b".,;:!?'\"-()/"):
        s[c] = 32 + i
    for i, group in enumerate((b"*#$%&", b"+=<>", b"@[\\]^_`{|}~")):
        s[list(group)] = 44 + i
    s[192:] = 47
    s[128:192] = 48 + (np.arange(64) >> 2)
    return s


SYMBOL = _symbols()


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The n-gram ending at each symbol, edges included, and for each text the first and last such place (the end symbol)."""
    n, pad = len(offsets) - 1, ORDER - 1
    lengths = np.diff(offsets)
    line = np.zeros(len(data) + pad * (n + 1), np.int32)
    first = offsets[:-1] + pad * np.arange(1, n + 1)
    line[np.arange(len(data)) + np.repeat(pad * np.arange(1, n + 1), lengths)] = SYMBOL[data]
    key = line.copy()
    for i in range(1, ORDER):
        key[i:] |= line[:-i] << np.int32(BITS * i)
    return key, first, first + lengths


def _add_up(found: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    seen, at = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
    return [(seen, np.bincount(at, np.concatenate([n for _, n in found]), len(seen)).astype(np.int64))]


def places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts as symbols, each with edges before and the end behind; then, text after text, the places from the last edge to the end, and where each text's begin."""
    lengths, pad = np.diff(offsets), TOP
    line = np.zeros(len(data) + (pad + 1) * len(lengths), np.int64)
    first = offsets[:-1] + pad + (pad + 1) * np.arange(len(lengths))
    line[np.arange(len(data)) + np.repeat(first - offsets[:-1], lengths)] = data.astype(np.int64) + 1
    line[first + lengths] = END
    starts = np.cumsum(lengths + 2) - (lengths + 2)
    return line, np.arange(len(data) + 2 * len(lengths)) + np.repeat(first - 1 - starts, lengths + 2), starts


def exact(line: np.ndarray, order: int) -> np.ndarray:
    """The n-gram of bytes ending at each place."""
    key = line.copy()
    for i in range(1, order):
        key[i:] |= line[:-i] << np.int64(SIGN * i)
    return key


def _count(batches):
    """Counts of the exact n-grams of a task's texts, by half; only those seen are held, and handed on when they are many."""
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def rows():
        ((seen, n),) = _add_up(found)
        found.clear()
        return pa.RecordBatch.from_arrays([pa.array(seen >> 1), pa.array((seen & 1).astype(np.int32)), pa.array(n)], names=["gram", "half", "n"])

    for batch in batches:
        data, offsets = utf8(batch.column(0))
        half = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        for low, high in slices(offsets, SLICE):
            line, at, starts = places(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
            halves = np.repeat(half[low:high], np.diff(np.append(starts, len(at))))
            inner = np.ones(len(at), bool)
            inner[starts] = False
            found.append(np.unique(exact(line, TOP)[at[inner]] << 1 | halves[inner], return_counts=True))
            if len(found) >= 8:
                found[:] = _add_up(found)
                if len(found[0][0]) > 1 << 22:
                    yield rows()
    if found:
        yield rows()


def _classes(grams: np.ndarray) -> np.ndarray:
    """The n-gram of classes that an exact one of at least as many bytes ends in."""
    symbol = np.concatenate([[0], SYMBOL, [0]]).astype(np.int32)
    key = np.zeros(len(grams), np.int32)
    for i in range(ORDER):
        key |= symbol[grams >> (SIGN * i) & ((1 << SIGN) - 1)] << np.int32(BITS * i)
    return key


def _to_classes(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(_classes(batch.column(0).to_numpy())), batch.column(1)], names=["gram", "n"])


def kneser_ney(counts: DataFrame, top: int = ORDER, low: int = 1, bits: int = BITS) -> list[tuple[DataFrame, DataFrame]]:
    """For each order from `low`: (gram, share) after discounting, and (context, rest) for the next lower order."""
    out = []
    for order in range(top, low - 1, -1):
        if order < top:  # continuation counts: how many different symbols come before
            counts = counts.select(F.col("gram").bitwiseAND((1 << bits * order) - 1).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))
        counts = staged(counts)
        of = counts.agg(*(F.count(F.when(F.col("n") == i, 1)).alias(f"n{i}") for i in range(1, 5))).first()
        y = of.n1 / (of.n1 + 2 * of.n2) if of.n1 and of.n2 else 0.5
        d = [min(max(i - (i + 1) * y * of[i] / of[i - 1], 0.0), i) if of[i - 1] else 0.5 * i for i in (1, 2, 3)]
        discount = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        context = F.shiftright("gram", bits)
        totals = counts.groupBy(context.alias("context")).agg(F.sum("n").alias("total"), F.sum(discount).alias("held"))
        shares = counts.withColumn("context", context).join(totals, "context").select("gram", ((F.col("n") - discount) / F.col("total")).alias("share"))
        out.append((shares, totals.select("context", (F.col("held") / F.col("total")).alias("rest"))))
    return out[::-1]


def dense(model: list[tuple[np.ndarray, ...]]) -> np.ndarray:
    """log2 probability of the last symbol of every n-gram given the others, made in place a part at a time."""
    p = np.full((1, CLASSES), 1.0 / CLASSES, np.float32)
    for order, (gram, share, context, rest) in enumerate(model, 1):
        contexts = CLASSES ** (order - 1)
        keep = np.ones(contexts, np.float32)
        keep[context] = rest
        q = np.empty((contexts, CLASSES), np.float32)
        for low in range(0, contexts, len(p)):  # contexts that share all but their first symbol back off to the same row
            np.multiply(keep[low : low + len(p), None], p, out=q[low : low + len(p)])
        np.add.at(q.reshape(-1), gram, share.astype(np.float32))
        p = q
    out = p.reshape(-1)
    np.maximum(out, 1e-12, out=out)
    return np.log2(out, out=out)


def likely(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """All rows of docs with a doc_id of ids, and those others whose id has the same bit in a map of hashed ids. The map is broadcast: its size is bounded."""
    h = "xxhash64(cast(doc_id as string))"
    word, bit = F.expr(f"shiftrightunsigned({h}, {64 - WORD_BITS})"), F.expr(f"shiftleft(1L, cast({h} & 63 as int))")
    bits = ids.select(word.alias("_word"), bit.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    return docs.join(F.broadcast(bits), (F.col("_word") == word) & (F.col("_bits").bitwiseAND(bit) != 0), "left_semi")


def trusted_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts of trusted documents and the half that they are dealt to. Their ids grow with the corpus and are not broadcast; the texts that are shuffled to them are the likely ones only."""
    ids = labels.where("quality = 1 and coalesce(toxic, 0) = 0").select("doc_id")
    return likely(docs.select("doc_id", "text"), ids).join(ids.hint("shuffle_hash"), "doc_id", "left_semi").select("text", half_of(F.col("doc_id")).alias("half"))


def half_of(doc_id):
    return F.pmod(F.xxhash64(doc_id.cast("string")), F.lit(2)).cast("int")


def counted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """gram, half, n: how often each n-gram of `TOP` bytes, edges and the end included, occurs in all trusted texts."""
    texts = trusted_texts(docs, labels)
    return staged(texts.mapInArrow(_count, "gram long, half int, n long").groupBy("gram", "half").agg(F.sum("n").alias("n")))


def train(docs: DataFrame, labels: DataFrame, found: DataFrame | None = None):
    """The model of classes as broadcast arrays and its mean log2 probability a symbol on the trusted text; None without trusted text."""
    found = counted(docs, labels) if found is None else found
    counts = staged(found.select("gram", "n").mapInArrow(_to_classes, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")))
    if counts.isEmpty():
        return None
    model = []
    for shares, rests in kneser_ney(counts):
        a, b = shares.toPandas(), rests.toPandas()
        model.append((a["gram"].to_numpy(), a["share"].to_numpy(), b["context"].to_numpy(), b["rest"].to_numpy()))
    c = counts.toPandas()
    mean = float((dense(model)[c["gram"]].astype(float) * c["n"]).sum() / c["n"].sum())
    return docs.sparkSession.sparkContext.broadcast(model), mean


def shares_in_class(found: DataFrame) -> np.ndarray:
    """log2 of the share of each symbol among the symbols of its class in the trusted texts, each counted once more than it occurs."""
    n = np.ones(END + 1)
    for r in found.groupBy(F.col("gram").bitwiseAND((1 << SIGN) - 1).alias("symbol")).agg(F.sum("n").alias("n")).collect():
        n[r["symbol"]] += r["n"]
    n[0] = 0  # the edge is never foretold, so the end is alone in its class
    group = np.concatenate([[0], SYMBOL, [0]])
    n /= np.bincount(group, n)[group]
    return np.log2(np.maximum(n, 1e-300))


def values(found: DataFrame, model, within: np.ndarray) -> DataFrame:
    """key, v0, v1: what each n-gram adds to the log2 probability of a text under the model of either half.

    p(s | c) = share(c s) + rest(c) p(s | c without its first), and at the lowest order the classes' p. An n-gram c s adds log2 of p(s | c) over what backing
    off would give it, and the log2 of its own rest as the context of the next symbol. So a sum over orders and places is the text's.
    """
    held, _ = model
    tables: dict[str, np.ndarray] = {}

    @F.arrow_udf("double")
    def below(column: pa.Array) -> pa.Array:
        if not tables:
            tables["logs"] = dense(held.value)
        gram = column.to_numpy(zero_copy_only=False)
        return pa.array(np.exp2(tables["logs"][_classes(gram)] + within[gram & ((1 << SIGN) - 1)]))

    parts = []
    for half in (0, 1):
        lower = None
        for order, (shares, rests) in enumerate(kneser_ney(found.where(F.col("half") == half).select("gram", "n"), TOP, LOW, SIGN), LOW):
            rests = rests.withColumn("rest", F.greatest("rest", F.lit(1e-9)))
            known = shares.withColumn("context", F.shiftright("gram", SIGN)).join(rests, "context")
            if lower is None:
                known = known.withColumn("q", below("gram"))
            else:
                known = known.withColumn("suffix", F.col("gram").bitwiseAND((1 << SIGN * (order - 1)) - 1)).join(lower, "suffix")
            p = F.col("share") + F.col("rest") * F.col("q")
            known = staged(known.select("gram", p.alias("p"), F.log2(p / (F.col("rest") * F.col("q"))).alias("v")))
            lower = known.select(F.col("gram").alias("suffix"), F.col("p").alias("q"))
            parts.append(known.select(_tagged(F.col("gram"), order).alias("key"), F.lit(half).alias("half"), "v"))
            parts.append(rests.select(_tagged(F.col("context"), order - 1).alias("key"), F.lit(half).alias("half"), F.log2("rest").alias("v")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.groupBy("key").agg(*(F.coalesce(F.sum(F.when(F.col("half") == h, F.col("v"))), F.lit(0.0)).alias(f"v{h}") for h in (0, 1)))


def _tagged(gram, order: int):
    return gram.bitwiseOR(F.lit(order << TAG))


def parted(found: DataFrame, model: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The n-grams of the model that are looked up in the scan, at most `HEAVY` or little more (those of contexts before any text), and those that are joined.

    The line is drawn by frequency in the trusted texts: a histogram of it, 8 steps for each factor of two, tells where.
    """
    ends = [_tagged(F.col("gram").bitwiseAND((1 << SIGN * k) - 1), k) for k in range(LOW - 1, TOP + 1)]
    often = found.select(F.explode(F.array(*ends)).alias("key"), "n").groupBy("key").agg(F.sum("n").alias("n"))
    rank = F.coalesce(F.floor(F.log2("n") * 8).cast("int"), F.lit(1 << 20))  # a context of edges alone ends no n-gram
    ranked = staged(model.join(often, "key", "left").withColumn("rank", rank).drop("n"))
    left, least = HEAVY, 1 << 20
    for r in ranked.groupBy("rank").count().orderBy(F.desc("rank")).collect():
        left -= r["count"]
        if left < 0 and r["rank"] < 1 << 20:
            break
        least = r["rank"]
    return ranked.where(F.col("rank") >= least).drop("rank"), ranked.where(F.col("rank") < least).drop("rank")


def lookup(keys: np.ndarray, v0: np.ndarray, v1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An open table of keys, at most half full, and their values; 0 is an empty slot."""
    size = 1 << max(4, (2 * len(keys)).bit_length())
    slots, held = np.zeros(size, np.int64), np.zeros((size, 2), np.float32)
    at, left = _slot(keys, size), np.arange(len(keys))
    while len(left):
        free = left[slots[at[left]] == 0]
        slots[at[free]] = keys[free]  # of several at one slot the last stays
        placed = slots[at[left]] == keys[left]
        left = left[~placed]
        at[left] = (at[left] + 1) & (size - 1)
    held[at, 0], held[at, 1] = v0, v1
    return slots, held


def _slot(keys: np.ndarray, size: int) -> np.ndarray:
    return (mix(keys.astype(np.uint64)) & np.uint64(size - 1)).astype(np.int64)


def _slots_of(keys: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Slot of each key, an empty one if it is not in the table."""
    at = _slot(keys, len(slots))
    there = slots[at]
    left = np.flatnonzero((there != keys) & (there != 0))
    while len(left):
        at[left] = (at[left] + 1) & (len(slots) - 1)
        there = slots[at[left]]
        left = left[(there != keys[left]) & (there != 0)]
    return at


SCORE = "struct<bits0: double, bits1: double, symbols: long, tail: array<struct<key: long, n: int>>>"


def score(text, model, within: np.ndarray, table, others):
    """Column of structs: minus the log2 probability of each whole text by either half's model, but for what its tail adds; its symbols with the end; and the tail:
    n-grams not in the broadcast table `table` that the bit map `others` lets through, with their counts."""
    held, _ = model
    tables: dict[str, np.ndarray] = {}  # a task's own: the dense model, 64 MB, goes when the task does

    @F.arrow_udf(SCORE)
    def run(column: pa.Array) -> pa.Array:
        if not tables:
            tables["logs"] = dense(held.value)
        logs, (slots, known), bits = tables["logs"], table.value, others.value
        data, offsets = utf8(column)
        out, tails, n = np.zeros((len(column), 2)), [], np.diff(offsets) + 1
        for low, high in slices(offsets, PART):
            part, cuts = data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
            key, first, last = grams(part, cuts)
            sums = np.concatenate([[0.0], np.cumsum(logs[key], dtype=np.float64)])
            line, at, starts = places(part, cuts)
            rows = np.repeat(np.arange(low, high), n[low:high] + 1)
            sums = sums[last + 1] - sums[first] + np.add.reduceat(within[line[at]] * (line[at] > 0), starts)
            found = np.zeros((len(at), 2), np.float32)
            for order in range(LOW - 1, TOP + 1):
                keys = exact(line, order)[at] | np.int64(order << TAG)
                slot = _slots_of(keys, slots)
                found += known[slot]
                if len(bits):
                    misses = np.flatnonzero(slots[slot] == 0)
                    misses = misses[_maybe(keys[misses], bits)]
                    if len(misses):
                        tails.append(np.stack([rows[misses], keys[misses]]))
            out[low:high] = -(sums[:, None] + np.add.reduceat(found.astype(np.float64), starts, axis=0))
        row, keys = np.concatenate(tails, axis=1) if tails else np.zeros((2, 0), np.int64)
        order = np.lexsort((keys, row))
        row, keys = row[order], keys[order]
        begins = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (keys[1:] != keys[:-1]))[: len(row)])
        many = np.diff(np.append(begins, len(row))).astype(np.int32)
        tail = pa.StructArray.from_arrays([pa.array(keys[begins]), pa.array(many)], names=["key", "n"])
        ends = np.searchsorted(row[begins], np.arange(len(column) + 1)).astype(np.int32)
        return pa.StructArray.from_arrays(
            [pa.array(out[:, 0].copy()), pa.array(out[:, 1].copy()), pa.array(n), pa.ListArray.from_arrays(pa.array(ends), tail)], names=["bits0", "bits1", "symbols", "tail"]
        )

    return run(text)


def _hash_bits(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = mix(keys.astype(np.uint64) + np.uint64(BASE))
    return (h >> np.uint64(64 - WORD_BITS)).astype(np.int64), (h & np.uint64(63)).astype(np.int64)


def _maybe(keys: np.ndarray, bits: np.ndarray) -> np.ndarray:
    word, bit = _hash_bits(keys)
    return (bits[word] >> bit & 1).astype(bool)


def _bits(batches):
    for batch in batches:
        word, bit = _hash_bits(batch.column(0).to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(np.int64(1) << bit)], names=["word", "bits"])


def bit_map(keys: DataFrame) -> np.ndarray:
    """Bits of the hashes of keys in 2**WORD_BITS words, however many keys there are; no words without keys."""
    found = keys.select("key").mapInArrow(_bits, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << WORD_BITS if len(found) else 0, np.int64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy()
    return out


def thresholds(found: pd.DataFrame) -> dict:
    """Highest bin that stays, by language. found: lang, bin, docs, good, bad."""
    if not len(found):
        return {}

    def best(part: pd.DataFrame, least: int) -> float | None:
        """The bin after which shares of good documents kept, GOOD times, and of bad ones rejected add up to most; the middle of several."""
        hist = part.groupby("bin")[["docs", "good", "bad"]].sum().reindex(range(BINS + 1), fill_value=0)
        good, bad = hist["good"].sum(), hist["bad"].sum()
        if good < least or bad < least:
            return None
        right = (GOOD * hist["good"].cumsum() / good + 1 - hist["bad"].cumsum() / bad).to_numpy()
        top = np.flatnonzero(right >= right.max() - 1e-12)
        run = top[: int(np.argmax(np.append(np.diff(top) > 1, True))) + 1]
        return float(run[len(run) // 2])

    pooled, out = best(found, 1), {}
    level = 1.0 if pooled is None else found.loc[found["bin"] <= pooled, "docs"].sum() / found["docs"].sum()
    for lang, part in found.groupby("lang", dropna=False):
        own = best(part, LABELS)
        if own is None:
            hist = part.groupby("bin")["docs"].sum().reindex(range(BINS + 1), fill_value=0).cumsum() / part["docs"].sum()
            own = BINS if level >= 1 else float(np.argmax(hist.to_numpy() >= level))
        out[None if pd.isna(lang) else lang] = own
    return out


def classify(docs: DataFrame, labels: DataFrame, keep: tuple | list = ("doc_id", "lang")) -> DataFrame:
    """Columns `keep` of docs (doc_id and lang among them) with perplexity, threshold and kept."""
    labels = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    found = counted(docs, labels)
    model = train(docs, labels, found)
    if model is None:
        return docs.select(*keep, F.lit(None).cast("double").alias("perplexity"), F.lit(None).cast("double").alias("threshold"), F.lit(True).alias("kept"))
    context, within = docs.sparkSession.sparkContext, shares_in_class(found)
    often, others = parted(found, values(found, model, within))
    top, bits = often.select("key", *(F.col(f"v{h}").cast("float").alias(f"v{h}") for h in (0, 1))).toArrow(), bit_map(others)
    table_ = context.broadcast(lookup(*(top[c].to_numpy() for c in ("key", "v0", "v1"))))
    scored = staged(docs.select(*keep, F.monotonically_increasing_id().alias("_row"), score(docs["text"], model, within, table_, context.broadcast(bits)).alias("_s")))

    each = scored.select("_row", "doc_id", "lang", "_s.symbols", "_s.bits0", "_s.bits1")
    if len(bits):  # the sharded part of the model, joined with the n-grams of each document that need it
        tail = scored.select("_row", F.explode("_s.tail").alias("_t")).select("_row", "_t.key", "_t.n")
        sums = tail.join(others, "key").groupBy("_row").agg(*(F.sum(F.col("n") * F.col(f"v{h}")).alias(f"_more{h}") for h in (0, 1)))
        more = [(F.col(f"bits{h}") - F.coalesce(f"_more{h}", F.lit(0.0))).alias(f"bits{h}") for h in (0, 1)]
        each = each.join(sums, "_row", "left").select("_row", "doc_id", "lang", "symbols", *more)
    trusted = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    unseen = F.when(trusted & (half_of(F.col("doc_id")) == 0), F.col("bits1")).when(trusted, F.col("bits0")).otherwise((F.col("bits0") + F.col("bits1")) / 2)
    marked = staged(each.join(labels, "doc_id", "left").select("_row", "lang", "quality", trusted.alias("trusted"), "symbols", unseen.alias("bits")))
    mean = marked.where("trusted").agg(-F.sum("bits") / F.sum("symbols")).first()[0]

    rate = (F.col("bits") - PRIOR * mean) / (F.col("symbols") + PRIOR)
    binned = marked.withColumn("_bin", F.greatest(F.least(F.floor(rate / WIDTH), F.lit(BINS)), F.lit(0)).cast("int"))
    histogram = binned.groupBy("lang", F.col("_bin").alias("bin")).agg(
        F.count("*").alias("docs"), F.count(F.when(F.col("quality") == 1, 1)).alias("good"), F.count(F.when(F.col("quality") == 0, 1)).alias("bad")
    )
    limits = thresholds(histogram.toPandas())
    limit = docs.sparkSession.createDataFrame([(k, float(v)) for k, v in limits.items()], "_l string, _limit double")
    out = binned.join(F.broadcast(limit), F.col("lang").eqNullSafe(F.col("_l")), "left")
    stays = F.coalesce(F.col("_bin") <= F.col("_limit"), F.lit(True))
    verdict = out.select(
        "_row", F.pow(F.lit(2.0), F.col("bits") / F.col("symbols")).alias("perplexity"), F.pow(F.lit(2.0), (F.col("_limit") + 1) * WIDTH).alias("threshold"), stays.alias("kept")
    )
    return scored.select("_row", *keep).join(verdict, "_row").select(*keep, "perplexity", "threshold", "kept")


def op2_quality(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return classify(docs, labels)


def stage(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that stay, with their own columns."""
    inner = docs.select("doc_id", "lang", "text", F.struct("*").alias("__row"))
    return classify(inner, labels, keep=["doc_id", "lang", "__row"]).where("kept").select("__row.*")
