from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from lendframe.llm import minhash as M

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = (text or "").translate(LOWER).encode().split()
    return Counter(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1 if w else 0)))


def brute(rows):
    """Root number of each row, by links of similarity 0.8 between all rows that share a shingle, and equal texts."""
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets, by, equal = [shingles(t) for _, t in rows], {}, {}
    pairs = set()
    for i, s in enumerate(sets):
        for k in s:
            pairs.update((j, i) for j in by.setdefault(k, []))
            by[k].append(i)
        t = (rows[i][1] or "").translate(LOWER)
        if t in equal:
            root[find(i)] = find(equal[t])
        equal.setdefault(t, i)
    for a, b in pairs:
        if sum((sets[a] & sets[b]).values()) >= 0.8 * sum((sets[a] | sets[b]).values()):
            root[find(b)] = find(a)
    return [find(i) for i in range(len(rows))]


def check(rows, found):
    roots, ids, sizes = brute(rows), {}, Counter()
    for (i, _), r in zip(rows, roots):
        ids.setdefault(r, []).append(i)
    want = Counter()
    for (i, _), r in zip(rows, roots):
        known = [x for x in ids[r] if x is not None]
        want[i, min(known) if known else None, len(ids[r])] += 1
    assert Counter((r.doc_id, r.class_id, r.class_size) for r in found) == want
    assert sum(r.kept for r in found) == len(ids)
    assert all(r.doc_id == r.class_id for r in found if r.kept)


def test_documents(docs):
    check([(r.doc_id, r.text) for r in docs.collect()], M.classes(docs).collect())


def test_messy(messy, messy_rows, empty):
    check([r[:2] for r in messy_rows], M.classes(messy).collect())
    out = M.deduplicate(messy)
    assert out.columns == messy.columns
    assert out.count() == len(set(brute([r[:2] for r in messy_rows])))
    assert M.deduplicate(empty).count() == 0


def test_group_around_a_centre(spark):
    """Members that resemble only some others: links beyond the bucket's first must be found too."""
    rng = np.random.default_rng(5)
    centre = [f"w{i}" for i in rng.integers(0, 5000, 300)]
    rows = []
    for n in range(150):
        words = list(centre)
        for at in rng.integers(0, 300, 1 + n % 14):
            words[at] = f"v{n}x{at}"
        rows.append((n, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    check(rows, M.classes(df).collect())


def test_agreement_is_weighted_jaccard():
    k, rng = 4096, np.random.default_rng(2)
    a, b = rng.integers(0, 1 << 62, 900).astype(np.uint64), rng.integers(0, 1 << 62, 100).astype(np.uint64)
    both = np.concatenate([a[:800], a[:900], b])  # 800 of 1000 in common
    owner = np.repeat([0, 1], [800, 1000])
    s = M.dart_signatures(both, owner, 3, k)
    assert abs((s[0] == s[1]).mean() - 0.8) < 0.03
    assert (s[2] == 0).all() and (s[:2] != 0).all()


def test_repeated_rows_are_one_node(spark, monkeypatch):
    """A text in ten equal rows, with an id and without, beside two near copies: each node has one text and is counted once."""
    words = [f"w{i}" for i in range(300)]
    x, y = " ".join(words), " ".join(w if i % 40 else f"y{i}" for i, w in enumerate(words))
    z = y.replace("w299", "z299")
    rows = [(1, x)] * 10 + [(None, x + " null")] * 10 + [(2, y), (3, z)]
    seen, verify = [], M.verify

    def spy(pairs, texts):
        seen.append((texts.groupBy("node").count().agg({"count": "max"}).first()[0], pairs.groupBy("a", "b").count().agg({"count": "max"}).first()[0]))
        return verify(pairs, texts)

    monkeypatch.setattr(M, "verify", spy)
    check(rows, M.classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect())
    assert seen and {n for both in seen for n in both} <= {None, 1}


def test_partners_that_are_no_centres(spark):
    """In large buckets, where all share a frame and a few pairs chose nearly the same words, each such pair is a link."""
    rng = np.random.default_rng(3)
    rows = []
    for n in range(150):
        words = [f"w{i}" for i in range(300)]
        for i, side in enumerate(rng.integers(0, 2, 22)):
            words[13 * i + 6] = f"{'lr'[side]}{i}"
        rows.append((n, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    check(rows, M.classes(df).collect())


def test_pairs_grow_with_the_family(spark, monkeypatch):
    """A family of near copies of one text is one comparison a member, whatever its size: no pair within a component is a row."""
    counts, verify = [], M.verify

    def spy(pairs, texts):
        counts[-1].append(pairs.count())
        return verify(pairs, texts)

    monkeypatch.setattr(M, "verify", spy)
    words = [f"w{i}" for i in range(400)]
    for n in (150, 300):
        counts.append([])
        rows = [(0, " ".join(words))] + [(i, " ".join(w if j not in (7 * i % 400, 11 * i % 400, 13 * i % 400) else f"v{i}x{j}" for j, w in enumerate(words))) for i in range(1, n)]
        found = M.classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
        assert {r.class_id for r in found} == {0}
        assert sum(counts[-1]) < 1.2 * n
    assert sum(counts[1]) < 2.5 * sum(counts[0])


def test_bitmaps_bound_what_two_texts_share():
    rng = np.random.default_rng(8)
    common, mine, other = (rng.integers(0, 1 << 62, n).astype(np.uint64) for n in (500, 120, 90))
    both = np.concatenate([common, mine, common, other])
    bits = M.bitmaps(both, np.repeat([0, 1], [620, 590]), 3)
    alone = [int(np.bitwise_count(bits[a] & ~bits[1 - a]).sum()) for a in (0, 1)]
    assert alone[0] <= 120 and alone[1] <= 90 and alone[0] > 60 and not bits[2].any()


def test_clashing_columns_are_kept(messy):
    named = messy.withColumns({"__node": F.lit("mine"), "row": F.lit("r"), "id": F.lit("i"), "node": F.lit("n"), "copies": F.lit("c")})
    out = M.deduplicate(named)
    assert out.columns == named.columns and {(r["__node"], r["row"], r["id"], r["node"], r["copies"]) for r in out.collect()} == {("mine", "r", "i", "n", "c")}
