import math
import zlib
from collections import Counter

import numpy as np
import pytest

from lendframe.llm import interpolation as I


def words(text):
    return (text or "").encode().lower().split() + [None]


def brute(rows):
    c1, c2, d1, d2 = Counter(), Counter(), Counter(), Counter()
    fold = {}
    for n, (doc_id, text) in enumerate(rows):
        fold[n] = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10
        w = words(text)
        pairs = list(zip([None] + w[:-1], w))
        if fold[n]:
            c1.update(w), c2.update(pairs)
        if fold[n] == 1:
            d1.update(w), d2.update(pairs)
    total, types = sum(c1.values()), len(c1)
    retained = total - sum(d1.values())
    data = []
    for n, (_, text) in enumerate(rows):
        if fold[n] == 1:
            w = words(text)
            for h, x in zip([None] + w[:-1], w):
                ch = c1[h] - d1[h]
                b = int(math.floor(math.log2(ch))) + 1 if ch else 0
                data.append((b, (c2[h, x] - d2[h, x]) / ch if ch else 0, (c1[x] - d1[x]) / retained, 1 / (types + 1)))
    weights = np.tile(I.DEFAULT, (I.BUCKETS, 1))
    weights[0] = 0, 6 / 7, 1 / 7
    for b in {x[0] for x in data}:
        p = np.array([x[1:] for x in data if x[0] == b])
        for _ in range(I.ROUNDS):
            s = weights[b] * p
            s /= s.sum(axis=1, keepdims=True)
            weights[b] = s.mean(axis=0)
    known = sorted({x[0] for x in data} - {0})
    for b in range(1, I.BUCKETS):
        if b not in known:
            weights[b] = weights[known[int(np.abs(np.array(known) - b).argmin())]]
    out = []
    for n, (doc_id, text) in enumerate(rows):
        w = words(text)
        base = sum(math.log10((c1[x] + 0.1) / (total + 0.1 * (types + 1))) for x in w)
        score = 0.0
        for h, x in zip([None] + w[:-1], w):
            a = weights[int(math.floor(math.log2(c1[h]))) + 1 if c1[h] else 0]
            score += math.log10(a[0] * (c2[h, x] / c1[h] if c1[h] else 0) + a[1] * c1[x] / total + a[2] / (types + 1))
        out.append((doc_id, fold[n] == 0, len(w), sum(c1[x] > 0 for x in w), total, base, score))
    return out


def test_documents(docs):
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    got = sorted((tuple(r) for r in I.score(docs).collect()), key=lambda r: r[0])
    for a, b in zip(got, brute(rows), strict=True):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], rel=1e-9)
        assert a[6] == pytest.approx(b[6], rel=0.01)
    held = [a for a in got if a[1]]
    assert sum(a[6] for a in held) > sum(a[5] for a in held)


def test_messy(messy, messy_rows, empty):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[3])
    got = sorted((tuple(r) for r in I.score(messy).collect()), key=key)
    want = sorted(brute([r[:2] for r in messy_rows]), key=key)
    for a, b in zip(got, want, strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9, abs=1e-9) and a[6] <= 1e-9
    assert I.score(empty).count() == 0


def test_weights_add_up():
    rng = np.random.default_rng(1)
    cells = (rng.integers(0, 9, 500) << 40) | (rng.integers(0, 300, 500) << 20) | rng.integers(0, 300, 500)
    w = I.learn(cells, rng.integers(1, 50, 500).astype(float), 1000)
    assert np.allclose(w.sum(axis=1), 1) and (w >= 0).all() and (w[:, 2] > 0).all()
    assert np.allclose(I.learn(np.zeros(0, np.int64), np.zeros(0), 0).sum(axis=1), 1)
