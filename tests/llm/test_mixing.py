import re
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from lendframe.llm import mixing as M


def brute_targets(sizes):
    """sizes: list of (source, size) in order; resharing until none is above."""
    weights = [1.0 + i % 3 for i in range(len(sizes))]
    total, target, open_ = sum(s for _, s in sizes), {}, set(range(len(sizes)))
    left = float(total)
    while open_:
        w = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / w > 3 * sizes[i][1] + 1e-9]
        if not full:
            for i in open_:
                target[sizes[i][0]] = left * weights[i] / w
            break
        for i in full:
            target[sizes[i][0]] = 3.0 * sizes[i][1]
        left -= sum(3.0 * sizes[i][1] for i in full)
        open_ -= set(full)
    return target


def check(rows, mixed):
    size = defaultdict(int)
    for r in rows:
        size[r[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    target, taken, most = brute_targets([(s, size[s]) for s in order]), defaultdict(int), defaultdict(int)
    for r in mixed:
        assert r.source_size == size[r.source] and r.target == pytest.approx(target[r.source])
        assert r.taken in (0, r.size, 2 * r.size, 3 * r.size)
        taken[r.source] += r.taken
        most[r.source] = max(most[r.source], r.size)
    for s in order:
        assert abs(taken[s] - target[s]) <= most[s]


def test_targets_and_reruns(docs):
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
    first, second = M.mix(docs).collect(), M.mix(docs.repartition(7)).collect()
    check(rows, first)
    assert sorted(map(str, first)) == sorted(map(str, second))


def test_oracle(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = {r[0]: r[1:] for r in con.execute(M.OP4_SQL).fetchall()}
    assert {r.doc_id: (r["size"], r.source_size, r.target, r.taken) for r in M.op4_mixing(spark, sf_dir).collect()} == want


def test_messy_and_empty(messy, messy_rows, empty):
    mixed = M.mix(messy).collect()
    assert len(mixed) == len(messy_rows)
    assert [r["size"] for r in mixed if r.doc_id == 18] == [40_000]
    out = M.stage(messy)
    assert out.columns == messy.columns
    assert out.count() == sum(r.copies for r in mixed)
    assert M.mix(empty).count() == 0 and M.stage(empty).count() == 0


def test_equal_rows_are_taken_in_the_number_that_fits(spark):
    """A source of one row a hundred times, without ids, comes as near its target as any other; the SQL takes as many."""
    rows = [(None, "one two three four five six seven eight nine ten", None, "a")] * 100 + [(i, f"w{i} " * 20, None, "b") for i in range(40)]
    rows += [(7, "same row " * 5, None, "c")] * 33 + [(None, f"other {i}", None, "c") for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(7)
    mixed = M.mix(df).collect()
    check(rows, mixed)
    assert len({r.copies for r in mixed if r.source == "a"}) == 2
    out = M.stage(df.withColumns({"row": F.lit("r"), "__place": F.lit("p"), "n": F.lit(5)}))
    assert out.count() == sum(r.copies for r in mixed) and {(r["row"], r["__place"], r["n"]) for r in out.collect()} == {("r", "p", 5)}
    con = duckdb.connect()
    con.register("documents", df.toPandas().astype({"doc_id": "Int64"}))
    assert sorted(con.execute(M.OP4_SQL).fetchall(), key=repr) == sorted(((r.doc_id, r["size"], r.source_size, r.target, r.taken) for r in mixed), key=repr)


def test_no_python_in_the_plan(docs):
    plan = M.mix(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
