import itertools
import zlib
from collections import defaultdict

import numpy as np
import pytest

from lendframe.llm import sharding as S


def check(rows, out, shards):
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in out) == sorted((str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    slots = defaultdict(list)
    for r in out:
        assert 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
    for x in slots.values():
        assert sorted(x) == list(range(len(x)))


def test_documents(spark, sf_dir, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    out = S.op10_sharding(spark, sf_dir).collect()
    check(rows, out, 40)
    texts, of, sums = dict(rows), defaultdict(set), defaultdict(int)
    for r in out:
        of[texts[r.doc_id]].add(r.shard)
        sums[r.shard] += r["size"]
    assert all(len(x) == 1 for x in of.values())
    largest = max(sum(len(t.encode()) + 16 for _, t in rows if t == x) for x in set(texts.values()))
    assert max(sums.values()) <= max(largest, 1.1 * sum(sums.values()) / 40)


@pytest.mark.parametrize("most,units,loose", [(100_000, 20, 16), (100, 5, 40)])
def test_units_of_many_groups(spark, monkeypatch, most, units, loose):
    """Units are joined again while there are too many to deal in one place."""
    monkeypatch.setattr(S, "BUCKET", 300)
    monkeypatch.setattr(S, "MOST_UNITS", most)
    monkeypatch.setattr(S, "LOOSE", loose)
    monkeypatch.setattr(S, "UNITS", units)
    rng = np.random.default_rng(0)
    rows = [(i, "x" * int(n) + str(i % 2500)) for i, n in enumerate(rng.pareto(1.5, 3000) * 30)]
    out = S.assign(spark.createDataFrame(rows, "doc_id long, text string"), 10).collect()
    check(rows, out, 10)
    sums = np.zeros(10)
    for r in out:
        sums[r.shard] += r["size"]
    assert sums.max() <= (1.01 if most > 1000 else 1.1) * sums.mean()


def test_messy(messy, messy_rows, empty):
    check([r[:2] for r in messy_rows], S.assign(messy, 4).collect(), 4)
    assert S.assign(empty).count() == 0


@pytest.mark.parametrize("seed", range(8))
def test_differencing_is_near_the_best_split(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, 100, 9)
    part = S.difference(sizes, 3)
    assert set(part) <= {0, 1, 2}
    top = np.bincount(part, sizes, 3).max()
    best = min(np.bincount(p, sizes, 3).max() for p in itertools.product(range(3), repeat=9))
    assert top <= 1.1 * best
    assert len(S.difference(np.zeros(0, int), 3)) == 0 and S.difference(np.array([5]), 3).tolist() == [0]


def test_differencing_of_equal_items_is_even():
    assert np.bincount(S.difference(np.ones(1000, int), 40)).tolist() == [25] * 40
