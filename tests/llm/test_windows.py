import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendframe.llm import windows as W


def brute(rows, width):
    """(doc_id, n_words, n_removed, kept text) of each row, from all windows in one dictionary."""
    split = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text in rows]
    windows = Counter(tuple(w[i : i + width]) for w in split for i in range(len(w) - width + 1))
    out = []
    for (doc_id, _), w in zip(rows, split):
        gone = {j for i in range(len(w) - width + 1) if windows[tuple(w[i : i + width])] > 1 for j in range(i, i + width)}
        out.append((doc_id, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept.decode()) for r in df.collect()), key=str)


@pytest.mark.parametrize("width", [1, 3, 35])
def test_messy_matches_brute_force(messy, messy_rows, width):
    assert got(W.remove_repeats(messy, width)) == brute([r[:2] for r in messy_rows], width)


def test_whole_table_matches_brute_force(spark, sf_dir, docs):
    want = [(i, n, m, hashlib.sha256(t.encode()).hexdigest()) for i, n, m, t in brute([(r.doc_id, r.text) for r in docs.collect()], 35)]
    rows = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in W.op11_windows(spark, sf_dir).collect()), key=str)
    assert rows == want and any(m for _, _, m, _ in rows)


def test_many_blocks(docs, monkeypatch):
    """With small blocks windows of different blocks and shards have to meet, and sketches are crowded."""
    from lendframe.llm import blocks

    monkeypatch.setattr(blocks, "BLOCK", 20_000)
    monkeypatch.setattr(W, "LOAD", 1)
    some = docs.where(F.length("text") < 5000)
    assert got(W.remove_repeats(some, 35)) == brute([(r.doc_id, r.text) for r in some.collect()], 35)


def test_empty(empty):
    assert W.remove_repeats(empty).collect() == []


def test_estimates_are_never_too_low():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 1 << 63, 5000).astype(np.uint64)
    keys = np.concatenate([keys, keys[:500]])
    for row in range(W.ROWS):
        cells, twice, place = W._distinct(W._cells(keys, row, 7, 4096))
        assert twice[place][:500].all() and twice[place][-500:].all()
        assert (W._unstep(W._steps(cells)) == cells).all()
        assert cells.max() < 7 * 4096
