import numpy as np
import pytest
from pyspark.sql import functions as F

from lendframe.llm import negatives as N
from verification.compare import connect


def brute(rows, step=100):
    """All scores of all anchors, sorted; rows: (vec_id, label, vector)."""
    use = {(i, label, tuple(int(np.floor(256 * float(c))) for c in v)) for i, label, v in rows if label is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)}
    last = 1 << 70
    out = []
    for i, label, v in use:
        if i is None or i % step:
            continue
        others = [(-sum(a * b for a, b in zip(v, w)), last if j is None else j, other) for j, other, w in use if len(w) == len(v)]
        near = sorted((s, j) for s, j, other in others if other == label and j != i)[:5]
        for s, p in near:
            hard = sorted((t, j) for t, j, other in others if other != label and 30 * -s <= 100 * -t <= 90 * -s)[:10]
            out += [(i, None if p == last else p, n, None if j == last else j, -s, -t) for n, (t, j) in enumerate(hard, 1)]
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect()), key=repr)


def test_whole_table_matches_brute_force_and_sql(spark, sf_dir):
    rows = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    mine = got(N.op12_negatives(spark, sf_dir))
    assert mine == brute(rows) and mine
    con = connect(sf_dir)
    rel = con.execute(N.OP12_SQL)
    assert sorted(rel.fetchall(), key=repr) == mine


@pytest.fixture
def small_boxes(monkeypatch):
    for name, size in (("TILE", 40), ("LEAF", 4), ("FAN", 3), ("PACK", 3), ("BLOCK", 2)):
        monkeypatch.setattr(N, name, size)


def test_messy(spark, small_boxes):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(3, 5))
    rows = [(i, int(rng.integers(3)), (centre[i % 3] + rng.normal(size=5) * 0.4).tolist()) for i in range(300)]
    hot = [1.0, 0.5, -0.25, 2.0, 0.0]
    rows += [(1000 + i, i % 2, hot) for i in range(150)]  # one vector held by a third of all rows: ties by id
    rows += [rows[0], rows[0], (0, 2, hot), (None, 1, hot), (None, 1, hot), (None, 0, rows[3][2])]
    rows += [(2000, None, hot), (2100, 1, None), (2200, 1, [1.0, None, 0.0, 0.0, 0.0]), (2300, 1, [float("nan")] * 5), (2400, 1, [float("-inf")] + [1.0] * 4)]
    rows += [(2500, 1, [1.0, 2.0]), (2501, 1, [1.0, 1.0]), (2502, 0, [0.5, 0.5]), (2600, 1, []), (2601, 1, []), (2602, 0, []), (2700, 77, hot), (-100, 0, [-x for x in hot])]
    df = spark.createDataFrame([(i, label, v, 1, "x") for i, label, v in rows], "vec_id long, label int, embedding array<double>, q int, tile string").repartition(4)
    mine = got(N.mine(N.usable(df, F.col("label")), F.col("vec_id") % 100 == 0))
    assert mine == brute(rows)
    none = N.usable(df.where("false"), F.col("label"))
    assert N.mine(none, F.col("vec_id") % 100 == 0).count() == 0
    alone = N.usable(df.where("vec_id = 2700"), F.col("label"))
    assert N.mine(alone, F.col("vec_id") % 100 == 0).count() == 0


def test_large_components(spark):
    rows = [(100, 1, [9e4, -9e4]), (101, 1, [8e4, -9e4]), (102, 0, [4e4, -4e4]), (103, 0, [1e300, 1e300])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    assert got(N.mine(N.usable(df, F.col("label")), F.col("vec_id") % 100 == 0)) == brute(rows[:3])


def test_tree_matches_a_scan_and_prunes():
    rng = np.random.default_rng(5)
    v = rng.integers(-50, 50, (3000, 3)) + np.repeat(rng.integers(-500, 500, (30, 3)), 100, axis=0)
    pages = N.leaves(v, 64)
    assert sorted(np.concatenate(pages)) == list(range(3000)) and max(map(len, pages)) <= 64
    order = np.concatenate(pages)
    tree = N.Tree(v[order], order, np.zeros(3000, np.int64), np.cumsum([0, *map(len, pages)]))
    seen = []
    score = tree.scores
    tree.scores = lambda a, page: seen.append(page) or score(a, page)
    for a in rng.integers(-50, 50, (20, 3)).astype(float):
        s = (v @ a).astype(int)
        limits = [(N.LEAST, N.MOST), (int(np.quantile(s, 0.3)), int(np.quantile(s, 0.5)))]
        for (low, high), (ids, scores) in zip(limits, tree.first(a, lambda i, x: i >= 0, limits, 7)):
            want = sorted((-x, i) for i, x in enumerate(s.tolist()) if low <= x <= high)[:7]
            assert list(zip(ids.tolist(), scores.tolist())) == [(i, -x) for x, i in want]
        low, high = N.bounds(*tree.leaf, a)
        for j, page in enumerate(pages):
            assert low[j] <= s[page].min() and s[page].max() <= high[j]
        tree.first(a, lambda i, x: i >= 0, [limits[0]], 7)
    assert len(seen) < 0.9 * 40 * len(pages)
