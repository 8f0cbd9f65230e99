from collections import Counter

import corpus_pipeline as C
from lendframe.llm.common import staged


def test_stages(spark, sf_dir, docs, labels):
    before, marks = docs, {r.doc_id: r for r in labels.collect()}
    columns = docs.columns
    for n, (name, stage) in enumerate(C.STAGES):
        after = staged(stage(spark, before, sf_dir))
        if n == len(C.STAGES) - 1:
            rows = Counter(r.doc_id for r in before.collect())
            whole = Counter()
            for r in after.collect():
                whole[r.doc_id, r.doc_tokens] += r.length
            assert {d: sum(v for (i, _), v in whole.items() if i == d) for d in rows} == {d: sum(t * rows[d] for (i, t) in whole if i == d) for d in rows}
            break
        assert after.columns == columns, name
        old, new = Counter(map(tuple, before.collect())), Counter(map(tuple, after.collect()))
        assert set(new) <= set(old) and new
        if name != "mixing":
            assert not new - old
        else:
            assert max(new.values()) <= 3
        if name == "quality_classifier":
            clean = [r for r in old if r[0] in marks and marks[r[0]].quality == 1 and not marks[r[0]].toxic]
            assert sum(r in new for r in clean) >= 0.98 * len(clean)
        before = after


def test_names_and_run(spark, sf_dir):
    from __spark_entry__ import queries

    assert len(C.STAGES) == 5 and queries()["pipeline"] is C.run and C.ORACLE_SQL is None
    assert C.run(spark, sf_dir).count() > 0


def test_stages_on_messy_and_empty_tables(spark, sf_dir, messy, empty):
    """Nulls, empty and very long texts, repeated rows, clashing columns: every stage passes on rows with the columns of its input."""
    for docs, some in ((messy, True), (empty, False)):
        out = docs
        for name, stage in C.STAGES[:-1]:
            out = staged(stage(spark, out, sf_dir))
            assert out.columns == messy.columns, name
        pieces = C.STAGES[-1][1](spark, out, sf_dir)
        assert (pieces.count() > 0) is some
