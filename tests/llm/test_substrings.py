import hashlib

import numpy as np
from pyspark.sql import functions as F

from lendframe.llm import substrings as S


def brute(rows):
    """rows (doc_id, text) in order: removed masks of each."""
    first, out = set(), []
    for _, text in rows:
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 99):
            w = b[i : i + 100]
            if w in first:
                gone[i : i + 100] = True
            first.add(w)
        out.append((len(b), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), np.frombuffer(b, np.uint8)[~gone].tobytes()))
    return out


def test_documents(spark, sf_dir, docs):
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.op3_substrings(spark, sf_dir).collect()}
    assert got == {i: (*b[:3], hashlib.sha256(b[3]).hexdigest()) for (i, _), b in zip(rows, brute(rows))}
    assert sum(x[1] for x in got.values()) > 0


def test_messy(messy, messy_rows, empty):
    # rows of one id are in the order of the input: tell them apart first
    rows = sorted({(r[0] if r[0] is not None else 10**9, r[1]) for r in messy_rows if (r[0], r[1]) != (9, "same id, other text")}, key=lambda r: r[0])
    one = messy.where("doc_id <> 9 or text not like 'same id%'or doc_id is null").dropDuplicates(["doc_id", "text"])
    got = {r.doc_id if r.doc_id is not None else 10**9: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in S.remove_repeats(one.repartition(5)).collect()}
    assert got == {i: b for (i, _), b in zip(rows, brute(rows))}
    assert S.remove_repeats(empty).count() == 0
    repeated = S.remove_repeats(messy.where("doc_id = 9 and text not like 'same%'")).collect()
    assert sorted(r.n_removed == r.n_bytes for r in repeated) == [False, True, True]


def test_hot_anchor_in_many_blocks(spark, monkeypatch):
    """One line in every document with different surroundings, over many blocks and more chunks than HOT."""
    rng = np.random.default_rng(3)
    line = "this very line of eighty letters and some more is found in each of the documents of this test "
    texts = ["".join(chr(97 + c) for c in rng.integers(0, 26, 60)) + line * (1 + i % 2) + "".join(chr(97 + c) for c in rng.integers(0, 26, 60)) for i in range(120)]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6, F.col("doc_id"))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in S.remove_repeats(df).collect()}
    assert got == {i: b for (i, _), b in zip(rows, brute(rows))}
