import numpy as np
import pandas as pd

from lendframe.llm import quality as Q


def test_labelled_documents(spark, sf_dir, docs, labels):
    marks = {r.doc_id: r for r in labels.collect()}
    got = Q.op2_quality(spark, sf_dir).collect()
    assert len(got) == docs.count()
    good = [r.kept for r in got if r.doc_id in marks and marks[r.doc_id].quality == 1 and not marks[r.doc_id].toxic]
    bad = [r.kept for r in got if r.doc_id in marks and marks[r.doc_id].quality == 0]
    assert np.mean(good) >= 0.98 and np.mean(bad) <= 0.2


def brute_model(texts):
    """Interpolated modified Kneser-Ney over symbol tuples: a function of (context, symbol)."""
    from collections import Counter

    counts = Counter()
    for t in texts:
        s = [0] * (Q.ORDER - 1) + [int(Q.SYMBOL[b]) for b in t.encode()] + [0]
        counts.update(tuple(s[i - Q.ORDER + 1 : i + 1]) for i in range(Q.ORDER - 1, len(s)))
    levels = []
    for order in range(Q.ORDER, 0, -1):
        if order < Q.ORDER:
            counts = Counter(k[1:] for k in counts)
        n = [sum(v == i for v in counts.values()) for i in range(1, 5)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else 0.5
        d = [min(max(i - (i + 1) * y * n[i] / n[i - 1], 0), i) if n[i - 1] else 0.5 * i for i in (1, 2, 3)]
        total, held = Counter(), Counter()
        for k, v in counts.items():
            total[k[:-1]] += v
            held[k[:-1]] += d[min(v, 3) - 1]
        levels.append((counts, d, total, held))

    def p(context, symbol):
        q = 1 / Q.CLASSES
        for counts, d, total, held in levels[::-1]:
            order = len(next(iter(counts)))
            h = tuple(context[len(context) - order + 1 :]) if order > 1 else ()
            if total[h]:
                c = counts[h + (symbol,)]
                q = (c - d[min(c, 3) - 1] if c else 0) / total[h] + held[h] / total[h] * q
        return q

    return p


def test_model_is_kneser_ney(spark):
    texts = ["abra cadabra", "abracadabra!", "a bad cab", "Dad, a cad.", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(len(texts))], "doc_id long, quality int, toxic int")
    held, _ = Q.train(docs, labels)
    table, p = Q.dense(held.value), brute_model(texts)
    rng = np.random.default_rng(0)
    sums = (2.0 ** table.astype(float)).reshape(-1, Q.CLASSES).sum(axis=1)
    assert np.allclose(sums[rng.integers(0, len(sums), 2000)], 1, atol=1e-3)
    for _ in range(500):
        key = rng.choice([0, 1, 2, 3, 4, 18, 27, 29, 32, 36], 4)
        assert np.isclose(2.0 ** table[int(sum(int(s) << 6 * (3 - i) for i, s in enumerate(key)))], p(tuple(key[:3]), key[3]), rtol=1e-3)


def test_messy(spark, messy, messy_rows, empty, no_labels, labels):
    assert Q.classify(messy, no_labels).where("kept").count() == len(messy_rows)
    some = spark.createDataFrame([(i, 1, 0) for i in range(22)] + [(3, 1, 1), (None, 1, None), (4, None, None)], "doc_id long, quality int, toxic int")
    out = Q.stage(messy, some)
    assert out.columns == messy.columns and out.count() == len(messy_rows)  # no bad label, no threshold
    assert Q.classify(messy, some).where("perplexity is null").count() == 0
    assert Q.stage(empty, some).count() == 0


def test_thresholds_by_language():
    def part(lang, good, bad):
        return [(lang, b, 10, 10, 0) for b in range(100, 100 + good)] + [(lang, b, 5, 0, 5) for b in range(300, 300 + bad)]

    found = pd.DataFrame(part("a", 20, 20) + part("b", 10, 30) + [("c", 100 + i, 1, 0, 0) for i in range(100)], columns=["lang", "bin", "docs", "good", "bad"])
    limits = Q.thresholds(found)
    assert 119 <= limits["a"] < 300 and 109 <= limits["b"] < 300
    share = found.loc[(found["lang"] != "c") & (found["bin"] < 300), "docs"].sum() + 100
    assert abs((limits["c"] - 99) / 100 - share / found["docs"].sum()) < 0.02


def test_all_trusted_texts_count(spark):
    """24,000 trusted documents, each with a 4-gram of its own: the model knows every one of them."""
    n = 24_000
    words = ["".join(chr(97 + i // 26**k % 26) for k in range(4)) for i in range(n)]
    docs = spark.createDataFrame(list(enumerate(words)), "doc_id long, text string")
    labels = spark.range(n).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    held, _ = Q.train(docs, labels)
    grams = {sum(int(Q.SYMBOL[ord(c)]) << Q.BITS * (3 - k) for k, c in enumerate(w)) for w in words}
    assert len(grams) == n and grams <= set(held.value[-1][0].tolist())


def test_trusted_texts_whatever_the_size(spark, monkeypatch):
    """The ids are not broadcast, however few; texts that the bit map rules out are not shuffled; a full map changes no result."""
    rows = [(i, f"text {i}") for i in range(4000)] + [(7, "again"), (7, "again"), (None, "no id"), (8, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 20 == 7), 0) for i in range(5000)] + [(8, 1, None), (None, 1, 0)], "doc_id int, quality int, toxic int")
    want = sorted(str(t) for i, t in rows if i is not None and (i % 20 == 7 or i == 8))

    plans = []
    monkeypatch.setattr(Q, "staged", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or df)
    Q.train(docs, labels)
    text_join = next(line for line in plans[0].splitlines() if "doc_id" in line and "Join" in line)
    assert "ShuffledHashJoin" in text_join

    ids = labels.where("quality = 1").select("doc_id")
    through = Q.likely(docs, ids)
    assert len(want) <= through.count() <= len(want) + 20
    for bits in (Q.WORD_BITS, 1):
        monkeypatch.setattr(Q, "WORD_BITS", bits)
        assert sorted(str(r.text) for r in Q.trusted_texts(docs, labels).collect()) == want
