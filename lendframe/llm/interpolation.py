"""Language-model scores by deleted interpolation of bigram, unigram and uniform estimates.

p(w | h) = a(b) c(h w) / c(h) + b(b) c(w) / N + u(b) / (V + 1), where b is the bucket of the context's frequency, floor(log2 c(h)) + 1,
and the three weights of each bucket add up to one; unknown words share the last of V + 1 classes. A context never seen has no bigram
part. The weights are learned by expectation-maximisation on the tokens of a deleted fold of the training documents, against the
counts without that fold; the final estimates use the counts of all training documents. The documents' starts are the end
token as context.

Counts cover the whole corpus and are never broadcast: blocks of documents send their distinct unigrams and bigrams (64-bit hashes, with counts
in all training documents and in the deleted fold) to shards of the key space, which add them up and answer each block. The
EM data are a histogram of the deleted tokens by bucket and by the two estimates in steps of 2**(1/16), bounded at any corpus size.

Null text counts as empty: one end token. A null id counts as the empty text in the choice of folds. Repeated rows count and are
scored one by one. Without training documents all scores are 0. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendframe.llm.blocks import blocks, get, opened, put, shard_of, shards_for
from lendframe.llm.common import BASE, crc_of, mix, staged, table, word_hashes

#: Learned from unless 0; 1 is the deleted fold.
FOLDS, HELD_OUT, DELETED = 10, 0, 1
END = np.uint64(0x1F83D9ABFB41BD6B)
#: Steps per factor of two in the histogram of estimates.
STEPS = 16
BUCKETS = 64
ROUNDS = 40
DEFAULT = (0.3, 0.6, 0.1)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each token with the end tokens, hash of each bigram (context first), and tokens of each document."""
    h, n = word_hashes(data, offsets)
    ends = np.cumsum(n + 1) - 1
    line = np.full(len(h) + len(n), END, np.uint64)
    inner = np.ones(len(line), bool)
    inner[ends] = False
    line[inner] = h
    before = np.empty_like(line)
    before[:1], before[1:] = END, line[:-1]
    return line, mix(before * np.uint64(BASE) + line), n + 1


def _keys(row: dict):
    """For orders 1 and 2: distinct keys, rising, and for each token the number of its key; then tokens a document and fold of each token."""
    line, pairs, n = tokens(*opened(row))
    fold = np.repeat(np.array(row["marks"], np.int64), n)
    return [np.unique(x, return_inverse=True) for x in (line, pairs)], n, fold


def ask(shards: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                found, _, fold = _keys(row)
                for order, (keys, at) in enumerate(found, 1):
                    counts = [np.bincount(at[m], minlength=len(keys)).astype(np.uint32) for m in (fold != HELD_OUT, fold == DELETED)]
                    cuts = np.searchsorted(shard_of(keys, shards), np.arange(shards + 1))
                    filled = np.flatnonzero(np.diff(cuts))
                    parts = [slice(cuts[s], cuts[s + 1]) for s in filled]
                    for i in range(0, len(filled), 64):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(filled[i : i + 64]), order, np.int32)), pa.array(filled[i : i + 64].astype(np.int32)), pa.array(np.full(len(filled[i : i + 64]), row["block"])),
                             *(pa.array([x[p].tobytes() if x.dtype == np.uint64 else put(x[p]) for p in parts[i : i + 64]], pa.binary()) for x in (keys, *counts))],
                            names=["n", "shard", "block", "keys", "learned", "deleted"],
                        )

    return run


def add_up(asked):
    """Total counts of the keys of one shard, for each block in the order of its keys; block -1: sums over the distinct keys."""
    order, shard = asked["n"][0].as_py(), asked["shard"][0].as_py()
    keys = [np.frombuffer(x, np.uint64) for x in asked["keys"].to_pylist()]
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    totals = [np.bincount(at, weights=np.concatenate([get(x, np.uint32) for x in asked[c].to_pylist()]), minlength=len(distinct)).astype(np.int64) for c in ("learned", "deleted")]
    cuts = np.cumsum([0, *map(len, keys)])
    rows = [[put(t[at[a:b]]) for a, b in zip(cuts[:-1], cuts[1:])] for t in totals]
    n = len(keys)
    return pa.table(
        {"n": pa.array(np.full(n + 1, order, np.int32)), "shard": pa.array(np.full(n + 1, shard, np.int32)), "block": pa.array([*asked["block"].to_pylist(), -1], pa.int64()),
         "learned": pa.array([*rows[0], None], pa.binary()), "deleted": pa.array([*rows[1], None], pa.binary()),
         "tokens": pa.array([None] * n + [int(totals[0].sum())], pa.int64()), "less": pa.array([None] * n + [int(totals[1].sum())], pa.int64()), "types": pa.array([None] * n + [int((totals[0] > 0).sum())], pa.int64())}
    )


def bucket(count: np.ndarray) -> np.ndarray:
    return np.where(count > 0, np.floor(np.log2(np.maximum(count, 1))).astype(np.int64) + 1, 0)


def _step(p: np.ndarray) -> np.ndarray:
    """0 for an estimate of 0, else 1 + steps below 1."""
    return np.where(p > 0, 1 + np.rint(-STEPS * np.log2(np.where(p > 0, p, 1))).astype(np.int64), 0)


def _previous(counts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Count of the context of each token: that of the token before, and of the end token for the first."""
    out = np.empty_like(counts)
    out[1:] = counts[:-1]
    out[:1] = counts[np.cumsum(n)[:1] - 1]
    return out


def answer(retained: int):
    """Counts of every token of a block, and its part of the EM histogram."""

    def run(left, right):
        row, back = left.to_pylist()[0], right.sort_by([("n", "ascending"), ("shard", "ascending")])
        found, n, fold = _keys(row)
        order = back["n"].to_numpy()
        all_, gone = ([np.concatenate([get(x, np.int64) for x in back[c].filter(pa.array(order == k)).to_pylist()])[found[k - 1][1]] for k in (1, 2)] for c in ("learned", "deleted"))
        pick = fold == DELETED
        c1, c2, ch = all_[0] - gone[0], all_[1] - gone[1], _previous(all_[0], n) - _previous(gone[0], n)
        c1, c2, ch = c1[pick], c2[pick], ch[pick]
        cell = (bucket(ch) << 40) | (_step(np.where(ch > 0, c2 / np.maximum(ch, 1), 0)) << 20) | _step(c1 / max(retained, 1))
        cells, many = np.unique(cell, return_counts=True)
        return pa.table(
            {"ids": pa.array([row["ids"]], pa.list_(pa.int64())), "marks": pa.array([row["marks"]], pa.list_(pa.int64())), "n": pa.array([put(n.astype(np.int64))], pa.binary()),
             "c1": pa.array([put(all_[0])], pa.binary()), "c2": pa.array([put(all_[1])], pa.binary()), "cells": pa.array([cells.tolist()], pa.list_(pa.int64())), "many": pa.array([many.tolist()], pa.list_(pa.int64()))}
        )

    return run


def learn(cells: np.ndarray, many: np.ndarray, types: int) -> np.ndarray:
    """Weights (BUCKETS, 3) of the bigram, unigram and uniform parts, by expectation-maximisation."""
    weights = np.tile(DEFAULT, (BUCKETS, 1))
    weights[0] = 0, DEFAULT[1] / (DEFAULT[1] + DEFAULT[2]), DEFAULT[2] / (DEFAULT[1] + DEFAULT[2])
    b = cells >> 40
    steps = np.stack([cells >> 20 & 0xFFFFF, cells & 0xFFFFF])
    p = np.where(steps > 0, 2.0 ** (-(steps - 1) / STEPS), 0)
    p = np.vstack([p, np.full(len(cells), 1 / (types + 1))]).T
    for _ in range(ROUNDS):
        share = weights[b] * p
        share *= (many / np.maximum(share.sum(axis=1), 1e-300))[:, None]
        sums = np.stack([np.bincount(b, share[:, i], BUCKETS) for i in range(3)], axis=1)
        seen = sums.sum(axis=1) > 0
        weights[seen] = (sums[seen] + 1e-3 * np.array([0, 1, 1])) / (sums[seen].sum(axis=1) + 2e-3)[:, None]
    known = np.flatnonzero(np.bincount(b, many, BUCKETS)[1:] > 0) + 1
    for i in range(1, BUCKETS):  # a bucket without deleted tokens takes the weights of the nearest
        if len(known) and i not in known:
            weights[i] = weights[known[np.abs(known - i).argmin()]]
    return weights


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    fold = (crc_of(F.col("doc_id")) % FOLDS).alias("mark")
    written = blocks(docs.select("doc_id", fold, "text"))
    shards = shards_for(written)
    asked = written.mapInArrow(ask(shards), "n int, shard int, block long, keys binary, learned binary, deleted binary")
    answers = staged(asked.groupBy("n", "shard").applyInArrow(add_up, "n int, shard int, block long, learned binary, deleted binary, tokens long, less long, types long"))
    total, less, types = (x or 0 for x in answers.where("block = -1 and n = 1").agg(F.sum("tokens"), F.sum("less"), F.sum("types")).first())
    back = answers.where("block >= 0").select("n", "shard", "block", "learned", "deleted")
    counted = staged(
        written.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(answer(total - less), "ids array<long>, marks array<long>, n binary, c1 binary, c2 binary, cells array<long>, many array<long>")
    )
    histogram = counted.select(F.explode(F.arrays_zip("cells", "many")).alias("x")).groupBy("x.cells").agg(F.sum("x.many").alias("many")).toPandas()
    weights = learn(histogram["cells"].to_numpy(np.int64), histogram["many"].to_numpy(np.float64), types)

    def finish(batches):
        for batch in batches:
            for row in batch.to_pylist():
                n, c1, c2 = (get(row[c], np.int64) for c in ("n", "c1", "c2"))
                ch = _previous(c1, n)
                w = weights[bucket(ch)]
                p = w[:, 0] * c2 / np.maximum(ch, 1) + w[:, 1] * c1 / max(total, 1) + w[:, 2] / (types + 1) if total else np.ones(len(c1))
                at = np.cumsum(n) - n
                logs = [np.add.reduceat(np.log10(x), at) for x in (p, (c1 + 0.1) / (total + 0.1 * (types + 1)))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"], pa.int64()), pa.array(np.array(row["marks"]) == HELD_OUT), pa.array(n), pa.array(np.add.reduceat((c1 > 0).astype(np.int64), at)),
                     pa.array(np.full(len(n), total, np.int64)), pa.array(logs[1]), pa.array(logs[0])],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return counted.select("ids", "marks", "n", "c1", "c2").mapInArrow(finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op5_interpolation(spark, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
