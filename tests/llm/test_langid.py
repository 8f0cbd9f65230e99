import numpy as np
import pytest
from pyspark.sql import functions as F

from lendframe.llm import langid as L


def test_held_out_accuracy(spark, sf_dir, docs):
    got = {r.doc_id: r for r in L.op6_langid(spark, sf_dir).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    held = [r for r in rows if got[r.doc_id].held_out]
    assert held and np.mean([got[r.doc_id].lang_pred == r.lang for r in held]) >= 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


@pytest.mark.parametrize("k", [2, 3, 4, 5, 6, 7, 20, 60])
def test_codewords_are_apart(k):
    code = L.codebook(k)
    assert code.shape[0] == k and (np.abs(code.sum(axis=0)) < k).all()
    apart = [(code[i] != code[j]).sum() for i in range(k) for j in range(i)]
    assert min(apart) >= max(1, code.shape[1] // 5)


def test_decoding_survives_a_wrong_bit():
    counts = np.ones((4, L.HASHES))
    model = L.Model(["a", "b", "c", "d"], counts)
    for i, word in enumerate(model.code):
        for bit in range(len(word)):
            sent = word.copy()
            sent[bit] = -sent[bit]
            best, score = model.decode(sent[None, :])
            assert best[0] == i and 0 < score[0] < 1


def test_messy(spark, messy, empty, docs):
    model = L.train(docs.select("doc_id", "text", "lang"))
    out = {r.doc_id: r.p for r in messy.select("doc_id", L.predict(messy, model, F.col("text")).alias("p")).collect()}
    for i in (0, 1, 2, -5):
        assert (out[i].lang_pred, out[i].score) == ("und", 0.0)
    assert out[3].lang_pred in model.langs
    assert empty.select(L.predict(empty, model, F.col("text"))).count() == 0
    assert L.train(empty) == []
    nothing = messy.select(L.predict(messy, [], F.col("text")).alias("p")).select("p.*").distinct().collect()
    assert [tuple(r) for r in nothing] == [("und", 0.0, True)]
    single = L.train(docs.where("lang = 'fr'"))
    assert {r.lang_pred for r in messy.select(L.predict(messy, single, F.col("text")).alias("p")).select("p.*").collect()} == {"fr", "und"}


def test_words_after_other_texts_do_not_matter(docs):
    import pyarrow as pa

    weights = np.random.default_rng(0).normal(size=(L.HASHES, 3)).astype(np.float32)
    texts = ["", "Abc", None, "déjà vu", "x" * 5000]
    together = L.margins_of(weights, pa.array(texts))
    for i, t in enumerate(texts):
        assert np.allclose(together[i], L.margins_of(weights, pa.array([t]))[0], atol=1e-4)
