"""Language identification by error-correcting output codes over binary n-gram classifiers.

Each learned language has a codeword of +1 and -1. For each bit a binary classifier, log-odds of hashed byte trigrams between the
languages of either sign, says how far a whole text lies on the +1 side. Decoding picks the language whose codeword has the smallest
loss, the sum over bits of the logistic loss of the margins, each bit weighted by how well it did on documents held back
from training. The score is the share of the best language in the exponentials of the losses; a text is flagged as ambiguous where it
is below `AMBIGUOUS`. Up to 6 languages the code is exhaustive; beyond, the best of some random codes.

Trained on whole texts of a sample, by hash, of about `docs_per_lang` documents of each language; a fifth of it is held back.
Predictions use the text alone. `und` with score 0: null texts, texts without a letter, and all texts if nothing could be learned.
If one language is learned, it is predicted with score 1. Repeated rows are predicted alike. Extra columns are ignored.
Counts are bounded by languages times `HASHES`, so they are collected and broadcast at any corpus size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendframe.llm.common import crc_of, slices, table, utf8

HASHES = 1 << 16
DOCS_PER_LANG = 10_000
SMOOTH = 0.5
AMBIGUOUS = 0.6
SLICE = 1 << 21
#: Letters as they are (A to Z lower-cased, all non-ASCII bytes), anything else a space.
FOLD = np.full(256, 32, np.uint32)
FOLD[97:123] = np.arange(97, 123)
FOLD[65:91] = np.arange(97, 123)
FOLD[128:] = np.arange(128, 256)


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigram around each byte, with a space on either side of each text, and where the trigrams of each text begin.

    Texts are a space apart; the trigram around that space belongs to none.
    """
    n = len(offsets) - 1
    line = np.full(len(data) + n + 1, 32, np.uint32)
    line[np.arange(len(data)) + np.repeat(np.arange(1, n + 1), np.diff(offsets))] = FOLD[data]
    h = np.zeros(len(line), np.uint32)
    h[1:-1] = (line[:-2] * np.uint32(0x9E3779B1) + line[1:-1] * np.uint32(0x85EBCA77) + line[2:] * np.uint32(0xC2B2AE3D)) >> np.uint32(16)
    return h, offsets[:-1] + np.arange(1, n + 1)


def codebook(k: int) -> np.ndarray:
    """Codeword of each of k languages, one row each, of +1 and -1; no bit is the same for all."""
    if k <= 6:
        bits = np.arange(2 ** (k - 1) - 1, dtype=np.int64)
        return np.array([np.ones(len(bits))] + [np.where(bits >> i & 1, 1.0, -1.0) for i in range(k - 1)])
    length, best, apart = 10 * int(np.ceil(np.log2(k))), None, -1.0
    for seed in range(50):
        code = np.where(np.random.default_rng(seed).random((k, length)) < 0.5, -1.0, 1.0)
        code = code[:, np.abs(code.sum(axis=0)) < k]
        far = np.abs(code @ code.T - np.diag(np.full(k, 2.0 * code.shape[1]))).max()
        if best is None or code.shape[1] - far > apart:
            best, apart = code, code.shape[1] - far
    return best


def _count(batches):
    """Trigram counts by language number (column 1), once for each task."""
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        data, offsets = utf8(batch.column(0))
        lang = batch.column(1).to_numpy()
        for low, high in slices(offsets, SLICE):
            h, first = trigrams(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
            lengths = np.diff(offsets[low : high + 1])
            inner = h[np.repeat(first - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())]
            owner = np.repeat(lang[low:high], lengths)
            for k in np.unique(lang[low:high]).tolist():
                n = np.bincount(inner[owner == k], minlength=HASHES)
                totals[k] = totals[k] + n if k in totals else n
    for k, n in totals.items():
        seen = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(seen), k, np.int32)), pa.array(seen.astype(np.int32)), pa.array(n[seen])], names=["k", "h", "n"])


def margins_of(weights: np.ndarray, column: pa.Array) -> np.ndarray:
    """Mean log-odds of each text for each bit."""
    data, offsets = utf8(column)
    out = np.zeros((len(column), weights.shape[1]))
    for low, high in slices(offsets, SLICE // 4):
        h, first = trigrams(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
        lengths = np.diff(offsets[low : high + 1])
        sums = np.add.reduceat(weights[h], np.stack([first, first + lengths], axis=1).ravel(), axis=0)[::2]
        out[low:high] = np.where(lengths[:, None] > 0, sums / np.maximum(lengths, 1)[:, None], 0)
    return out


class Model:
    """Languages, their code, trigram log-odds of each bit (HASHES, bits), and scale and weight of each bit."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs, self.code = langs, codebook(len(langs))
        share = (counts + SMOOTH) / (counts.sum(axis=1, keepdims=True) + SMOOTH * HASHES)
        sides = [(np.stack([share[c == s].mean(axis=0) for s in (1, -1)])) for c in self.code.T]
        self.weights = np.stack([np.log(a / b) for a, b in sides], axis=1).astype(np.float32)
        self.scale = np.ones(self.code.shape[1])
        self.bit = np.ones(self.code.shape[1])

    def calibrate(self, sums: list[tuple]) -> None:
        """sums: for each bit the documents held back, their absolute margins summed, and how many the bit got right."""
        for b, (n, size, right) in enumerate(sums):
            if n:
                error = (n - right + 0.5) / (n + 1)
                self.scale[b] = max(size / n, 1e-9) / 3
                self.bit[b] = max(0.5 * np.log((1 - error) / error), 1e-3)
        self.bit = self.bit / self.bit.mean()

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        t = margins / self.scale
        loss = np.stack([(np.logaddexp(0, -t * c) * self.bit).sum(axis=1) for c in self.code], axis=1)
        like = np.exp(loss.min(axis=1, keepdims=True) - loss)
        return loss.argmin(axis=1), like.max(axis=1) / like.sum(axis=1)


def train(learn: DataFrame, docs_per_lang: int = DOCS_PER_LANG) -> Model | list[str]:
    """Model from rows (doc_id, text, lang); with fewer than two languages just their names."""
    learn = learn.where("text is not null and lang is not null")
    sizes = {r["lang"]: r["count"] for r in learn.groupBy("lang").count().collect()}
    langs = sorted(sizes)
    if len(langs) < 2:
        return langs
    spark = learn.sparkSession
    numbers = spark.createDataFrame([(x, i, min(1.0, docs_per_lang / sizes[x])) for i, x in enumerate(langs)], "lang string, k int, rate double")
    u = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / (1 << 30)
    sample = learn.join(F.broadcast(numbers), "lang").where(u < F.col("rate")).withColumn("back", F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0)
    found = sample.where("not back").select("text", "k").mapInArrow(_count, "k int, h int, n long").groupBy("k", "h").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((len(langs), HASHES))
    counts[found["k"], found["h"]] = found["n"]
    model = Model(langs, counts)
    held = spark.sparkContext.broadcast((model.weights, model.code))
    bits = model.code.shape[1]

    def check(batches):
        n, size, right = np.zeros(bits), np.zeros(bits), np.zeros(bits)
        weights, code = held.value
        for batch in batches:
            m, want = margins_of(weights, batch.column(0)), code[batch.column(1).to_numpy()]
            n, size, right = n + len(m), size + np.abs(m).sum(axis=0), right + (m * want > 0).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(bits, dtype=np.int32)), pa.array(n), pa.array(size), pa.array(right)], names=["b", "n", "size", "right"])

    checked = sample.where("back").select("text", "k").mapInArrow(check, "b int, n double, size double, right double").groupBy("b").agg(*(F.sum(c).alias(c) for c in ("n", "size", "right"))).collect()
    model.calibrate([(r["n"], r["size"], r["right"]) for r in sorted(checked, key=lambda r: r["b"])])
    return model


def predict(docs: DataFrame, model: Model | list[str], text: Column) -> Column:
    """Column of structs (lang_pred, score, ambiguous)."""
    nothing = F.struct(F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("ambiguous"))
    if not isinstance(model, Model):
        if not model:
            return nothing
        found = F.struct(F.lit(model[0]).alias("lang_pred"), F.lit(1.0).alias("score"), F.lit(False).alias("ambiguous"))
    else:
        held = docs.sparkSession.sparkContext.broadcast(model)

        @F.arrow_udf("struct<lang_pred: string, score: double, ambiguous: boolean>")
        def run(column: pa.Array) -> pa.Array:
            m = held.value
            best, score = m.decode(margins_of(m.weights, column))
            return pa.StructArray.from_arrays([pa.array([m.langs[i] for i in best], pa.string()), pa.array(score), pa.array(score < AMBIGUOUS)], names=["lang_pred", "score", "ambiguous"])

        found = run(text)
    return F.when(F.coalesce(text.rlike(r"\p{L}"), F.lit(False)), found).otherwise(nothing)


def op6_langid(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = crc_of(F.col("doc_id")) % 4
    model = train(docs.where(fold != 2).select("doc_id", "text", "lang"))
    out = docs.select("doc_id", (fold == 2).alias("held_out"), predict(docs, model, F.col("text")).alias("p"))
    return out.select("doc_id", "held_out", "p.*")
