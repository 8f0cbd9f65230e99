"""The model of exact n-grams of bytes against a plain one in Python, with and without the sharded part."""

from collections import Counter

import numpy as np
import pytest

from lendframe.llm import quality as Q

TEXTS = ["abra cadabra", "abracadabra!", "a bad cab", "Dad, a cad.", "", "1234 1235", "1999, 2000", "été à Éze", None, "ABRA CADABRA", "the abbot", "a cab, a cad"]


def discounted(counts, top, low):
    """For each order from the highest: counts, discounts, totals and masses held back of each context."""
    levels = []
    for order in range(top, low - 1, -1):
        if order < top:
            counts = Counter(k[1:] for k in counts)
        n = [sum(v == i for v in counts.values()) for i in range(1, 5)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else 0.5
        d = [min(max(i - (i + 1) * y * n[i] / n[i - 1], 0), i) if n[i - 1] else 0.5 * i for i in (1, 2, 3)]
        total, held = Counter(), Counter()
        for k, v in counts.items():
            total[k[:-1]] += v
            held[k[:-1]] += d[min(v, 3) - 1]
        levels.append((order, counts, d, total, held))
    return levels[::-1]


def line(text):
    return [0] * (Q.TOP - 1) + [b + 1 for b in (text or "").encode()] + [Q.END]


def places(text):
    s = line(text)
    return [tuple(s[i - Q.TOP + 1 : i + 1]) for i in range(Q.TOP - 1, len(s))]


def classed(gram):
    return tuple(int(Q.SYMBOL[s - 1]) if 0 < s < Q.END else 0 for s in gram)


def step(levels, gram, p):
    """Interpolates p, the probability below the lowest level, upwards."""
    for order, counts, d, total, held in levels:
        h = gram[len(gram) - order : -1]
        if total[h]:
            c = counts[gram[len(gram) - order :]]
            p = (c - d[min(c, 3) - 1] if c else 0) / total[h] + max(held[h] / total[h], 1e-9) * p
    return p


def perplexities(texts, halves, trusted):
    learned = [g for t, ok in zip(texts, trusted) if ok for g in places(t)]
    classes = discounted(Counter(classed(g[-Q.ORDER :]) for g in learned), Q.ORDER, 1)
    seen = Counter(g[-1] for g in learned)
    group = Counter()
    for s in range(1, Q.END + 1):
        group[classed((s,))] += seen[s] + 1
    exact = [discounted(Counter(g for t, h, ok in zip(texts, halves, trusted) if ok and h == half for g in places(t)), Q.TOP, Q.LOW) for half in (0, 1)]

    def bits(text, half):
        out = 0.0
        for g in places(text):
            p = step(classes, classed(g[-Q.ORDER :]), 1 / Q.CLASSES) * (seen[g[-1]] + 1) / group[classed(g[-1:])]
            out -= np.log2(step(exact[half], g, p))
        return out

    out = []
    for text, half, ok in zip(texts, halves, trusted):
        use = (1 - half,) if ok else (0, 1)
        out.append(2 ** (np.mean([bits(text, h) for h in use]) / len(line(text)[Q.TOP - 1 :])))
    return out


@pytest.mark.parametrize("heavy", [Q.HEAVY, 60])
def test_perplexity_is_that_of_all_exact_ngrams(spark, monkeypatch, heavy):
    """Each document's, however little of the model is broadcast."""
    monkeypatch.setattr(Q, "HEAVY", heavy)
    texts = TEXTS * 2
    trusted = [i % 3 != 1 for i in range(len(texts))]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i, ok in enumerate(trusted) if ok], "doc_id int, quality int, toxic int")
    halves = [r[0] for r in docs.select(Q.half_of(docs["doc_id"])).collect()]
    assert set(halves) == {0, 1}
    got = {r["doc_id"]: r["perplexity"] for r in Q.classify(docs, labels).collect()}
    assert np.allclose([got[i] for i in range(len(texts))], perplexities(texts, halves, trusted), rtol=1e-4)


def test_bytes_of_one_class_differ(spark):
    """All digits are one class of the model below; which digits follow each other counts all the same."""
    rows = [(i, "call 555-0100 now", "en") for i in range(40)] + [(100, "call 555-0100 now", "en"), (101, "call 050-1505 now", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["perplexity"] for r in Q.classify(docs, labels).where("doc_id >= 100").collect()}
    assert got[101] > 1.5 * got[100]


def test_no_ngram_is_lost_between_table_and_join(spark, monkeypatch):
    monkeypatch.setattr(Q, "HEAVY", 100)
    docs = spark.createDataFrame([(i, f"text {i} of {i * 7}", "en") for i in range(50)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(50)], "doc_id long, quality int, toxic int")
    found = Q.counted(docs, labels)
    model = Q.train(docs, labels, found)
    whole = Q.values(found, model, Q.shares_in_class(found))
    often, others = Q.parted(found, whole)
    a, b = ({tuple(r) for r in x.collect()} for x in (often, others))
    assert 0 < len(a) <= 104 and b and not a & b and {r[0] for r in a | b} == {r["key"] for r in whole.collect()}


def test_pipeline_classifies_by_exact_bytes(spark, tmp_path):
    """The first stage tells digits apart that are one class of bytes."""
    import corpus_pipeline

    good, bad = "the number is 5550100 and 5550123", "the number is 0915733 and 8642097"
    rows = [(i, good if i < 50 else bad, "en", "s", len(good)) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, int(i < 50), 0) for i in range(100) if i % 50 < 40], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    stage = dict(corpus_pipeline.STAGES)["quality_classifier"]
    out = stage(spark, docs, str(tmp_path))
    assert out.columns == docs.columns and sorted(map(tuple, out.collect())) == rows[:50]
