import hashlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lendframe.llm import exact as E

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def groups(rows):
    out = defaultdict(list)
    for r in rows:
        out[(r[1] or "").translate(LOWER)].append(r[0])
    return out


def check(rows, marked):
    kept, seen = Counter(), Counter()
    found = groups(rows)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in found.items()}
    assert len(marked) == len(rows)
    for m in marked:
        ids = by_sha[m.text_sha256]
        top = max((i for i in ids if i is not None), default=None)
        assert m.keep_id == top and m.group_size == len(ids) and m.doc_id in ids
        assert not m.kept or m.doc_id == top
        kept[m.text_sha256] += m.kept
    assert set(kept.values()) == {1} and len(kept) == len(found)


@pytest.mark.parametrize("new", [None, True, False])
def test_messy(messy, messy_rows, new):
    check(messy_rows, E.mark(messy, None if new is None else F.lit(new)).collect())


def test_oracle(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = sorted(con.execute(E.OP8_SQL).fetchall())
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in E.op8_exact(spark, sf_dir).collect()) == want


def test_deduplicate_keeps_one_of_each(messy, messy_rows, empty):
    out = E.deduplicate(messy)
    assert out.columns == messy.columns
    assert Counter((r.text or "").translate(LOWER) for r in out.collect()) == Counter(dict.fromkeys(groups(messy_rows), 1))
    assert E.deduplicate(empty).count() == 0 and E.mark(empty).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 1000, 100_000])
def test_filter_knows_its_keys(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 1 << 63, n, dtype=np.int64).view(np.uint64)
    built = E.build_filter(np.concatenate([keys, keys[:3]]))
    assert E.in_filter(built, keys).all()
    others = rng.integers(0, 1 << 63, 20_000, dtype=np.int64).view(np.uint64) + np.uint64(1 << 63)
    assert E.in_filter(built, others).mean() < 0.01
    if n == 100_000:
        assert len(built) < 1.3 * n


def test_clashing_columns_are_kept(messy):
    named = messy.withColumns({"__digest": F.lit("mine"), "row": F.lit("r"), "id": F.lit("i"), "digest": F.lit("d"), "sha": F.lit("s")})
    out = E.deduplicate(named)
    assert out.columns == named.columns and {(r["__digest"], r["row"], r["id"], r["digest"], r["sha"]) for r in out.collect()} == {("mine", "r", "i", "d", "s")}
