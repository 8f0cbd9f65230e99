"""Order statistics, metrics and drift against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendframe.functions import ordered as O
from lendframe.functions import sizing
from lendframe.operators import calibrate as G
from lendframe.operators import drift as D
from lendframe.operators import encode as E
from lendframe.operators import metrics as M


def frame(spark, **cols):
    names = list(cols)
    rows = list(zip(*[[None if isinstance(x, float) and np.isnan(x) else x for x in np.asarray(v).tolist()] for v in cols.values()]))
    return spark.createDataFrame(rows, ", ".join(f"{n} {'double' if np.asarray(cols[n]).dtype.kind == 'f' else 'int'}" for n in names))


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(7)
    p = np.round(rng.beta(1, 6, 4000), 3)
    p[:1300] = 0.1  # one value holds a third of the rows
    y = (rng.random(4000) < p).astype(int)
    return p, y, frame(spark, pd=p, y=y)


def brute_auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    return ((pos[:, None] > neg).sum() + (pos[:, None] == neg).sum() / 2) / (len(pos) * len(neg))


def test_quantiles_match_numpy_bit_for_bit(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=3001), np.full(1500, 0.25)])
    g = np.arange(len(x)) % 2
    df = frame(spark, g=g, x=x)
    probs = O.quantile_probs(10)
    for ranges in (None,):
        got = {r["g"]: r["edges"] for r in O.quantiles(df, ["g"], "x", probs).collect()}
        for k in (0, 1):
            assert got[k] == np.quantile(x[g == k], np.linspace(0, 1, 11)).tolist()


def test_running_sums_with_few_and_many_ranges(spark):
    x = np.array([3.0, 1.0, 1.0, 2.0, 9.0, -4.0, np.nan, 9.0, 9.0])
    df = frame(spark, x=x)
    for ranges in (1, 3, 50):
        rows = O.running(df, [], "x", {"n": F.count(F.lit(1))}, ranges).orderBy("x").collect()
        assert [(r["x"], r["n"], r["n_before"], r["n_total"]) for r in rows] == [(-4, 1, 0, 8), (1, 2, 1, 8), (2, 1, 3, 8), (3, 1, 4, 8), (9, 3, 5, 8)]


def test_discrimination(spark, scored):
    p, y, df = scored
    row = M.discrimination(df, [], "pd", "y").first()
    assert row["auc"] == pytest.approx(brute_auc(y, p), abs=1e-12)
    cuts = np.unique(p)
    gap = max(abs((p[y == 1] <= c).mean() - (p[y == 0] <= c).mean()) for c in cuts)
    assert row["ks"] == pytest.approx(gap, abs=1e-12)


def test_tied_scores_and_single_class(spark):
    assert M.discrimination(frame(spark, pd=[0.5, 0.5], y=[1, 0]), [], "pd", "y").first()["auc"] == 0.5
    row = M.discrimination(frame(spark, pd=[0.5, 0.6], y=[0, 0]), [], "pd", "y").first()
    assert row["auc"] is None and row["ks"] == 0.0


def test_calibration_fit_solves_the_score_equations(spark, scored):
    p, y, df = scored
    row = M.calibration_fit(df, [], "pd", "y").first()
    q = np.clip(p, 1e-9, 1 - 1e-9)
    x = np.log(q / (1 - q))
    fit = 1 / (1 + np.exp(-(row["intercept"] + row["slope"] * x)))
    assert abs((y - fit).sum()) < 1e-6 and abs(((y - fit) * x).sum()) < 1e-5


def test_reliability_of_a_constant_score(spark):
    rows = M.reliability(frame(spark, pd=[0.3, 0.3, 0.3], y=[1, 0, 0]), [], "pd", "y").collect()
    assert len(rows) == 1 and rows[0]["n"] == 3 and rows[0]["bin"] == 1


def test_first_of_equal_costs(spark):
    row = M.cost_optimal(frame(spark, pd=[0.2, 0.1], y=[1, 0]), [], "pd", "y", [5.0]).first()
    assert row["threshold"] == 0.11 and row["expected_cost"] == 0.0


def test_cost_thresholds_by_brute_force(spark, scored):
    p, y, df = scored
    got = {round(r["threshold"], 2): r for r in M.threshold_costs(df, [], "pd", "y").collect()}
    for i in range(1, 100):
        t = i / 100
        assert got[t]["false_negatives"] == int(((p < t) & (y == 1)).sum())
        assert got[t]["false_positives"] == int(((p >= t) & (y == 0)).sum())


def brute_psi(ref, mon, bins=10):
    ref, mon = ref[~np.isnan(ref)], mon[~np.isnan(mon)]
    if not len(ref) or not len(mon):
        return 0.0
    edges = np.unique(np.quantile(ref, np.linspace(0, 1, bins + 1)))
    if len(edges) < 2:
        return 0.0
    a = np.maximum(np.histogram(ref, edges)[0] / len(ref), 1e-6)
    b = np.maximum(np.histogram(mon, edges)[0] / len(mon), 1e-6)
    return float(((a - b) * np.log(a / b)).sum())


def test_drift_by_brute_force(spark):
    rng = np.random.default_rng(3)
    ref = {"a": rng.normal(size=500), "b": np.where(rng.random(500) < 0.3, np.nan, rng.integers(0, 5, 500).astype(float)), "c": np.ones(500)}
    mon = {"a": rng.normal(0.6, 2.0, size=400), "b": rng.integers(0, 9, 400).astype(float), "c": rng.random(400)}
    out = {r["feature"]: r for r in D.feature_drift(frame(spark, **ref), frame(spark, **mon), ["a", "b", "c", "absent"]).collect()}
    assert set(out) == {"a", "b", "c"}
    for f in "abc":
        assert out[f]["psi"] == pytest.approx(brute_psi(ref[f], mon[f]), abs=1e-9)
        r, m = ref[f][~np.isnan(ref[f])], mon[f]
        both = np.concatenate([r, m])
        gap = max(abs((r <= v).mean() - (m <= v).mean()) for v in both)
        assert out[f]["ks"] == pytest.approx(gap, abs=1e-12)
        assert out[f]["reference_null_rate"] == pytest.approx(np.isnan(ref[f]).mean())
    assert out["a"]["severity"] == "material" and out["c"]["severity"] == "stable"


def test_prediction_and_calibration_drift(spark, scored):
    p, y, df = scored
    pred = D.prediction_drift(df, df, "pd").first()
    assert pred["psi"] == pytest.approx(0.0) and pred["ks"] == 0.0
    assert pred["reference_positive_rate"] == pytest.approx((p > 0.5).mean())
    cal = D.calibration_drift(df, df, "pd", "y").first()
    assert cal["reference_auc"] == pytest.approx(brute_auc(y, p)) and cal["reference_brier"] == pytest.approx(((p - y) ** 2).mean())
    drift = D.feature_drift(df, df, ["pd"])
    notes = D.alert_notes(drift, D.prediction_drift(df, df, "pd"), D.calibration_drift(df, df, "pd", "y")).collect()
    assert [n["alert"] for n in notes] == (["all_stable"] if cal["calibration_ok"] else ["calibration"])


def test_isotonic_is_the_best_monotone_fit(spark, scored):
    p, y, df = scored
    iso = G.fit_isotonic(df, "pd", "y")
    assert all(a <= b + 1e-12 for a, b in zip(iso.levels, iso.levels[1:]))
    got = df.select("pd", iso.apply(F.col("pd")).alias("c"), "y").toPandas()
    # pool adjacent violators by hand
    xs = np.unique(p)
    blocks = [[float(y[p == x].sum()), int((p == x).sum()), 1] for x in xs]
    out: list[list[float]] = []
    for b in blocks:
        out.append(b)
        while len(out) > 1 and out[-2][0] / out[-2][1] >= out[-1][0] / out[-1][1]:
            last = out.pop()
            out[-1] = [out[-1][0] + last[0], out[-1][1] + last[1], out[-1][2] + last[2]]
    want = dict(zip(xs, np.concatenate([np.full(k, s / n) for s, n, k in out])))
    assert np.allclose(got["c"], [want[v] for v in got["pd"]], atol=1e-9)
    outside = spark.createDataFrame([(-1.0,), (2.0,)], "pd double").select(iso.apply(F.col("pd")).alias("c")).collect()
    assert [r["c"] for r in outside] == [iso.levels[0], iso.levels[-1]]


def test_calibrator_selection(spark, scored):
    _, _, df = scored
    skewed = df.withColumn("pd", F.col("pd") * F.col("pd"))
    best, report = G.select_calibrator(skewed, skewed, "pd", "y")
    row = report.first()
    assert min(row["platt_brier"], row["isotonic_brier"]) <= row["raw_brier"] and best.method == row["selected_method"]
    both = G.combine_predictions(df.withColumnRenamed("pd", "raw_pd"), df.withColumnRenamed("pd", "raw_pd"), best)
    assert both.count() == 2 * df.count()


def test_recommendation_rules(spark):
    def metrics(auc, slope):
        return spark.createDataFrame(
            [("champion", 0.77, 0.54, 0.067, 1.0, 0.0), ("challenger", auc, 2 * auc - 1, 0.066, slope, 0.0)],
            "model string, auc double, gini double, brier double, slope double, intercept double",
        )

    def sweep(pct):
        return spark.createDataFrame([(20.0, pct)], "cost_ratio double, challenger_cost_savings_pct double")

    cases = [
        ((0.785, 1.0), 1.9, "challenger_superior", "challenger"),
        ((0.785, 1.0), 0.2, "challenger_superior", "challenger_marginal_cost"),
        ((0.785, 1.4), 1.9, "recalibrate_challenger", "champion"),
        ((0.772, 1.0), 1.9, "equivalent_prefer_champion", "champion"),
        ((0.70, 1.0), 1.9, "keep_champion", "champion"),
    ]
    for m, pct, statistical, operational in cases:
        row = M.recommendation(metrics(*m), sweep(pct)).first()
        assert (row["statistical"], row["operational"]) == (statistical, operational)


@pytest.mark.parametrize("limit", [10**6, 0])
def test_hot_categories(spark, monkeypatch, limit):
    """Half of the rows in one category, a third null: the same codes either way, and no partition with the hot rows."""
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", limit)
    kind = F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 3 > 0, F.concat(F.lit("c"), (F.col("id") % 701).cast("string")))
    df = spark.range(12_000, numPartitions=4).select(F.col("id").alias("SK_ID_CURR"), kind.alias("c"), F.lit(1).alias("x"))
    codes = E.category_codes(df.where("SK_ID_CURR % 701 <> 5"), ["c"])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = E.encode_categories(df, codes, ["c"])
        plan = out._jdf.queryExecution().executedPlan().toString()
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert ("BroadcastHashJoin" in plan) is (limit > 0) and ("SortMergeJoin" in plan) is (limit == 0)
    assert max(sizes) < 1.3 * sum(sizes) / len(sizes) and len(sizes) == 4
    rank = {r["category"]: r["code"] for r in codes.collect()}
    want = {r["SK_ID_CURR"]: rank.get(r["c"], -1) for r in df.collect()}
    assert {r["SK_ID_CURR"]: r["c"] for r in out.collect()} == want and out.columns == df.columns
    heavy = sizing.heavy_values(df.select("c"), ["c"])["c"]
    assert "hot" in heavy and len(heavy) <= 1 / sizing.SUPPORT


@pytest.mark.parametrize("knots", [1, 2, 3, 10, 100_000])
def test_isotonic_map_of_any_size(spark, knots):
    """The looked-up map equals a plain interpolation, on knots, between them and outside."""
    rng = np.random.default_rng(knots)
    x = np.sort(rng.choice(10**7, knots, replace=False)) / 1e7 * 0.8 + 0.1
    y = np.sort(rng.random(knots))
    scores = np.concatenate([rng.random(3000), x[:: max(1, knots // 500)], [0.0, 1.0]])
    df = frame(spark, s=scores)
    fit = G.Isotonic(tuple(x.tolist()), tuple(y.tolist()))
    got = fit.add(df.unionByName(spark.createDataFrame([(None,)], "s double")), "s", "p")
    assert got.columns == ["s", "p"] and got.where("s IS NULL").first()["p"] is None
    rows = got.where("s IS NOT NULL").collect()
    assert len(rows) == len(scores)
    for r in rows:
        assert r["p"] == pytest.approx(np.interp(r["s"], x, y), abs=1e-12)
    if knots <= 10:
        assert [r["p"] for r in df.select(fit.apply(F.col("s")).alias("p")).collect()] == [r["p"] for r in fit.add(df, "s", "p").collect()]
