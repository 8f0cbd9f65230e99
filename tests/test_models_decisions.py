"""Binning, training, decisions, explanations; plans; streams."""

import itertools
import random
import re
import threading

import pytest
from pyspark.sql import functions as F

from lendframe.operators import binning as B
from lendframe.operators import decide as Q
from lendframe.operators import explain as Z
from lendframe.operators import metrics as M
from lendframe.operators import models as X
from lendframe.operators import splits as S


@pytest.fixture(scope="module")
def loans(spark):
    """Risk rises with a, falls with b, depends on c; e copies a; k is constant."""
    r = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000
    a = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) / 1000
    b = F.pmod(F.xxhash64("id", F.lit(2)), F.lit(1000)) / 1000
    c = F.element_at(F.array(F.lit("u"), F.lit("v"), F.lit("w")), (F.col("id") % 3 + 1).cast("int"))
    risk = 0.05 + 0.3 * a - 0.1 * b + F.when(c == "w", 0.15).otherwise(0.0)
    df = spark.range(6000).select(
        F.col("id").alias("SK_ID_CURR"), a.alias("a"), F.when(F.col("id") % 10 > 0, b).alias("b"), c.alias("c"), (2 * a).alias("e"), F.lit(1).alias("k"),
        (r < risk).cast("int").alias("TARGET"),
    )
    return df.persist()


def test_merge_rules():
    counts = [(100, 2), (100, 9), (100, 7), (100, 20), (3, 1), (97, 30), (100, 30), (100, 50)]
    cells, cuts = B.merge_bins(counts, [1, 2, 3, 4, 5, 6, 7], 700, 1, 4, 0.05, 5)
    rates = [e / n for n, e in cells]
    assert rates == sorted(rates) and len(set(rates)) == len(rates) and len(cells) <= 4 and len(cuts) == len(cells) - 1
    assert sum(n for n, _ in cells) == 700 and sum(e for _, e in cells) == 149 and all(n >= 35 and e >= 5 for n, e in cells)


@pytest.mark.parametrize("seed", range(30))
def test_merge_equals_exhaustive_search(seed):
    """The division found has the information of the best of all divisions that keep the rules."""
    rng = random.Random(seed)
    counts = [(n := rng.choice([0, 3, 40, 100]), rng.randint(0, n) if rng.random() < 0.5 else n // (i + 2)) for i in range(rng.randint(2, 9))]
    total, direction, max_bins, share, events = sum(n for n, _ in counts) or 1, rng.choice([-1, 0, 1]), rng.randint(1, 4), 0.1, 5
    cuts = list(range(1, len(counts)))

    def allowed(cells, d):
        rates = [e / n if n else None for n, e in cells]
        return len(cells) <= max_bins and all(n >= share * total and events <= e < n for n, e in cells) and all((b - a) * d > 0 for a, b in zip(rates, rates[1:]))

    best = None
    for picked in itertools.chain.from_iterable(itertools.combinations(cuts, k) for k in range(len(cuts) + 1)):
        ends = [0, *picked, len(counts)]
        cells = [(sum(n for n, _ in counts[a:b]), sum(e for _, e in counts[a:b])) for a, b in zip(ends, ends[1:])]
        if any(allowed(cells, d) for d in ([direction] if direction else [1, -1])):
            best = max(best or 0.0, B._information(cells))
    cells, found = B.merge_bins(counts, cuts, total, direction, max_bins, share, events)
    assert len(cells) == len(found) + 1 and [sum(x) for x in zip(*cells)] == [sum(x) for x in zip(*counts)]
    assert B._information(cells) == pytest.approx(best or 0.0, abs=1e-12)
    if best is None:
        assert found == []


def test_binning_invariants(spark, loans):
    fit = B.fit_binning(loans, directions={"a": 1, "b": 1})
    assert fit.skipped == ["k"] and set(fit.bins) == {"a", "b", "c", "e"}
    table = fit.table(spark)
    for f, rows in {f: [r for r in table.collect() if r["feature"] == f] for f in fit.bins}.items():
        regular = [r for r in rows if not r["is_special"]]
        assert sum(r["count"] for r in rows) == 6000 and len(regular) <= B.MAX_BINS
        if len(regular) > 1:
            assert all(r["count"] >= 300 and r["event"] >= B.MIN_BIN_EVENTS for r in regular)
    up = [r["event_rate"] for r in table.where("feature = 'a'").collect()]
    assert up == sorted(up)
    # the required direction contradicts the data: everything merges
    assert len(fit.bins["b"].counts) == 1 and fit.bins["b"].null_count[0] == 600
    assert all(r["iv"] >= 0 for r in fit.values(spark).collect())


def test_woe_transform_and_selection(spark, loans):
    fit = B.fit_binning(loans)
    out = fit.transform(loans, ["SK_ID_CURR", "TARGET"])
    assert out.where(" OR ".join(f"{f} IS NULL" for f in fit.bins)).count() == 0
    unseen = loans.limit(1).withColumn("c", F.lit("zzz"))
    assert fit.transform(unseen, [], ["c"]).first()["c"] == 0.0
    decisions = B.prune_correlated(B.iv_selection(fit.values(spark), high=9.0), out)
    by = {r["feature"]: r for r in decisions.collect()}
    assert by["e"]["correlated_with"] == "a" and not by["e"]["kept"] and by["a"]["kept"]
    matrix = B.encoded_matrix(fit, loans, decisions)
    assert matrix.columns[0] == "SK_ID_CURR" and matrix.columns[-1] == "TARGET" and "e" not in matrix.columns
    status = {r["feature"]: r["status"] for r in fit.status(spark).collect()}
    assert status["k"] == "skipped" and status["a"] == "binned"
    assert {r["reason"] for r in B.selection_report(decisions).collect()} >= {"kept", "correlated"}
    assert B.top_by_iv(decisions, 1).count() == 1


def test_champion_and_challenger(spark, loans):
    parts = S.split_frames(loans.drop("c", "k"), S.stratified_split(loans))
    enc = B.fit_binning(parts["dev"])
    woe = {n: enc.transform(p, ["SK_ID_CURR", "TARGET"]) for n, p in parts.items()}
    champ = X.champion_search(woe["dev"], woe["val"], c_grid=(0.0001, 1.0), l1_grid=(0.0,), max_iter=20)
    aucs = [r["val_auc"] for r in champ.trials.collect()]
    assert max(aucs) > 0.6 and champ.params["C"] in (0.0001, 1.0)
    # more weight of evidence means less risk
    assert X.coefficient_importance(champ).first()["coefficient"] < 0
    space = lambda seed, t: {"maxDepth": 2, "stepSize": 0.3}
    chall = X.challenger_search(parts["dev"], parts["val"], trials=1, max_rounds=3, space=space)
    assert X.tree_importance(chall).first()["feature"] in ("a", "e")
    scored = X.score(chall.model, parts["test"].withColumn("split", F.lit("test")), chall.features, "challenger")
    assert scored.columns == ["model", "split", "SK_ID_CURR", "TARGET", "raw_pd"] and scored.where("raw_pd NOT BETWEEN 0 AND 1").count() == 0
    row = M.discrimination(scored, ["model", "split"], "raw_pd", "TARGET").first()
    assert row["auc"] > 0.6
    smoke = X.smoke_model(loans.select("SK_ID_CURR", "a", "TARGET"), trees=2, max_depth=2).first()
    assert smoke["verdict"] == "below_expected"


def test_fits_send_the_driver_results_of_a_fixed_number_of_partitions(spark):
    most = 2 * spark.sparkContext.defaultParallelism
    for rows in (spark.range(0, 1000, 1, 3), spark.range(0, 1000, 1, 200)):
        kept = X.held(rows)
        assert X.few(kept).count() == 1000 and X.few(kept).rdd.getNumPartitions() == min(most, rows.rdd.getNumPartitions())
        kept.unpersist()


def test_search_space_is_seeded():
    draws = [X.sample_params(42, t) for t in range(50)]
    assert draws[3] == X.sample_params(42, 3) and all(0.01 <= d["stepSize"] <= 0.1 and 3 <= d["maxDepth"] <= 12 for d in draws)


def applicants(spark, rows):
    return spark.createDataFrame(rows, "applicant_id string, pd double, segment string, policy_flags map<string,boolean>")


def test_decisions(spark):
    rows = [
        ("edge", 0.04, None, None), ("low", 0.0399, "default", {}), ("top", 0.2, "x", None), ("new", 0.055, "new_customer", None),
        ("both", 0.01, None, {"vip_customer": True, "sanctions_list": True}), ("vip", 0.9, None, {"vip_customer": True, "fraud_flag": False}),
    ]
    out = {r["applicant_id"]: r for r in Q.decide(applicants(spark, rows), segment="segment", flags="policy_flags").collect()}
    assert [out[k]["decision"] for k in ("edge", "low", "top", "new", "both", "vip")] == ["REFER", "APPROVE", "DECLINE", "APPROVE", "DECLINE", "APPROVE"]
    assert out["edge"]["threshold_used"] == 0.2 and out["edge"]["expected_cost"] == pytest.approx(0.1)
    assert out["both"]["override_applied"] == "sanctions_list" and out["both"]["threshold_used"] == 0 and out["both"]["expected_cost"] == 0
    assert out["low"]["expected_cost"] == pytest.approx(20 * 0.0399) and re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", out["low"]["decided_at"])


def test_invalid_probability(spark):
    df = applicants(spark, [("a", 1.2, None, None), ("b", 0.5, None, None), ("c", None, None, None)])
    with pytest.raises(Exception, match="pd must be in"):
        Q.decide(df).collect()
    ok, bad = Q.reject_invalid(df)
    assert ok.count() == 1 and bad.count() == 2
    with pytest.raises(KeyError):
        Q.decide(df.drop("pd"))


@pytest.mark.parametrize("bad", [{"cost_fn": 0.0}, {"default_limits": (0.3, 0.2)}, {"segments": {"s": (0.1, 1.2)}}, {"overrides": (("x", "MAYBE", ""),)}])
def test_policy_bounds(bad):
    with pytest.raises(Q.PolicyError):
        Q.Policy(**bad)


def test_reasons_split_four_and_six(spark):
    names = [r[0] for r in Z.REASONS if r[3] == "positive"][:12]
    wide = spark.createDataFrame([tuple(["1", *[float(i + 1) for i in range(12)], 99.0])], ", ".join(["applicant_id string", *[f"`{n}` double" for n in names], "EXT_SOURCE_1 double"]))
    decisions = spark.createDataFrame([("1", 0.5, "DECLINE")], "applicant_id string, pd double, decision string")
    features = [*names, "EXT_SOURCE_1"]
    row = Z.reason_codes(decisions, wide, features).first()
    assert [r["contribution"] for r in row["primary_reasons"]] == [12.0, 11.0, 10.0, 9.0] and len(row["additional_reasons"]) == 6
    loose = Z.reason_codes(decisions, wide, features, respect_direction=False).first()
    assert loose["primary_reasons"][0]["feature"] == "EXT_SOURCE_1"
    approved = Z.reason_codes(decisions.withColumn("decision", F.lit("APPROVE")), wide, features).first()
    assert approved["primary_reasons"] == [] and approved["additional_reasons"] == []


def test_contribution_guards(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0)], "SK_ID_CURR int, a double, b double")
    assert Z.linear_contributions(df, {"a": 2.0, "b": -1.0}).first()[1:] == (4.0, -3.0)
    with pytest.raises(ValueError):
        Z.linear_contributions(df, {"a": 2.0})
    with pytest.raises(ValueError):
        Z.top_contributions(df, ["a"], 51)


def test_requests_and_stream(spark, tmp_path):
    """Scoring is stateless per row, so a stream gives what a batch gives."""
    rows = spark.range(20).select(
        F.col("id").cast("string").alias("applicant_id"), F.create_map(F.lit("x"), F.col("id") / 10.0, F.lit("zzz"), F.lit(1.0)).alias("features")
    )
    rows.write.parquet(str(tmp_path / "in"))
    model = lambda df: df.withColumn("raw_pd", M.sigmoid(F.col("x") - 2) + F.coalesce("y", F.lit(0.0)))
    score = lambda df: Z.score_requests(df, ["x", "y"], model, decided_at="t")
    batch = score(rows)
    stream = score(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")))
    q = stream.writeStream.format("memory").queryName("scored").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("scored").exceptAll(batch).count() == 0 and spark.table("scored").count() == 20
    full = Z.explain_requests(rows, ["x"], lambda df: df.withColumn("raw_pd", M.sigmoid(F.col("x"))), {"x": 2.0}, top_k=1).collect()
    assert all(r["top_contributions"][0]["contribution"] == pytest.approx(2 * int(r["applicant_id"]) / 10) for r in full)


LAZY = [
    "rollup_installments", "rollup_bureau", "rollup_previous", "rollup_pos_cash", "rollup_credit_card", "assemble_matrix", "auc_gini", "reliability",
    "cost_sweep", "feature_drift", "stratified_split", "woe_table", "decide_batch", "topk_contributions", "reason_codes", "join_stats",
]


@pytest.mark.parametrize("name", LAZY)
def test_plans(spark, sf_dir, name):
    """No Python worker, no Cartesian product, no window over ungrouped rows of a table."""
    from verification.queries import QUERIES

    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas|CartesianProduct|BroadcastNestedLoopJoin", plan)
    lines = plan.split("\n")
    for i, line in enumerate(lines):
        if re.search(r"[- ]Window \[", line):
            assert "SinglePartition" not in "".join(lines[i : i + 3])


def test_patience():
    assert X.best_round([5, 4, 3, 3.5, 3.2, 3.1, 2.9, 4], 4) == (7, False)
    assert X.best_round([5, 4, 3, 3.5, 3.2, 3.1, 2.9, 4], 3) == (3, True)
    assert X.best_round([1.0], 1) == (1, False)


def test_boosting_is_cut_at_its_best_round(spark, loans, tmp_path):
    """The model is the prefix of a longer fit that has the lowest held-out loss, and a longer fit repeats a shorter one."""
    rows = X.vectors(loans.select("SK_ID_CURR", "a", "b", "TARGET"), ["a", "b"])
    train, held = rows.where("SK_ID_CURR % 4 > 0").persist(), rows.where("SK_ID_CURR % 4 = 0").persist()
    params = {"maxDepth": 3, "stepSize": 0.4, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.5"}
    long = X.fit_trees(train, params, 12)
    losses = long.evaluateEachIteration(held)
    model = X.boosted(train, held, params, 12, 3, first=4)
    want, _ = X.best_round(losses, 3)
    assert model.getNumTrees == want and model.evaluateEachIteration(held) == pytest.approx(losses[:want], rel=1e-9)
    assert model.getMaxDepth() == 3 and model.numFeatures == 2
    model.save(str(tmp_path / "m"))
    assert type(model).load(str(tmp_path / "m")).getNumTrees == want
    walked = {}

    def walk(node):
        if node.subtreeDepth():
            i = node.split().featureIndex()
            walked[i] = walked.get(i, 0) + 1
            walk(node.leftChild())
            walk(node.rightChild())

    for tree in model.trees:
        walk(tree._java_obj.rootNode())
    assert X.split_counts(model) == walked


def test_challenger_fit_runs_the_whole_search(spark, tmp_path, monkeypatch):
    """30 trials, each allowed 2,000 rounds and a patience of 50, on all rows of the split; the fit itself is one tree here."""
    from verification.queries import challenger_fit

    spark.range(400).selectExpr(
        "id AS o_orderkey", "id % 37 AS o_custkey", "element_at(array('O', 'F', 'P'), int(id % 3) + 1) AS o_orderstatus", "double(id * 997 % 400000) AS o_totalprice",
        "date_add(date'1995-01-01', int(id % 900)) AS o_orderdate", "element_at(array('1-URGENT', '5-LOW'), int(id % 2) + 1) AS o_orderpriority",
    ).write.parquet(str(tmp_path / "orders.parquet"))
    asked, fitted, lock = [], [], threading.Lock()

    def one_tree(train, held, params, max_rounds, patience, seed):
        with lock:
            asked.append((max_rounds, patience, train.count() + held.count()))
            if not fitted:
                fitted.append(X.fit_trees(train, {"maxDepth": 1}, 1, seed))
            return fitted[0]

    monkeypatch.setattr(X, "boosted", one_tree)
    trials = challenger_fit(spark, str(tmp_path)).collect()
    assert sorted(r["trial"] for r in trials) == list(range(30))
    assert len(asked) == 30 and {a[:2] for a in asked} == {(2000, 50)} and len({a[2] for a in asked}) == 1 and asked[0][2] > 300
