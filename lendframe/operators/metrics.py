"""Discrimination, calibration, reliability and cost measures.

Every function takes a long prediction table and a list of group columns
(model, split, ...), so one job measures all models and splits together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendframe.functions import ordered as O

COST_RATIOS = (5.0, 10.0, 20.0, 30.0, 50.0)
THRESHOLDS = 99
CHECK_TOLERANCE = 0.001
AUC_MARGIN = 0.005
CALIBRATION_TOLERANCE = 0.10
SAVINGS_MARGIN_PCT = 0.5


def logit(p: Column, floor: float = 1e-9) -> Column:
    clipped = F.greatest(F.lit(floor), F.least(F.lit(1 - floor), p))
    return F.ln(clipped / (1 - clipped))


def sigmoid(z: Column) -> Column:
    return 1 / (1 + F.exp(-z))


def discrimination(df: DataFrame, by: Sequence[str], score: str, label: str) -> DataFrame:
    """AUC with ties counted half, Gini, and KS between the classes."""
    counts = {"pos": F.sum(F.col(label).cast("bigint")), "neg": F.sum(1 - F.col(label).cast("bigint"))}
    rows = O.running(df, by, score, counts)
    p, n = F.col("pos_total").cast("double"), F.col("neg_total").cast("double")
    gap = F.abs((F.col("pos_before") + F.col("pos")) / F.nullif(p, F.lit(0.0)) - (F.col("neg_before") + F.col("neg")) / F.nullif(n, F.lit(0.0)))
    won = F.col("pos").cast("double") * (F.col("neg_before") + F.col("neg") / 2)
    out = rows.groupBy(*by).agg(
        F.max("pos_total").alias("positives"),
        F.max("neg_total").alias("negatives"),
        F.sum(won).alias("_won"),
        F.coalesce(F.max(gap), F.lit(0.0)).alias("ks"),
    )
    pairs = F.col("positives").cast("double") * F.col("negatives")
    auc = F.col("_won") / F.nullif(pairs, F.lit(0.0))
    return out.select(*by, "positives", "negatives", auc.alias("auc"), (2 * auc - 1).alias("gini"), "ks")


def brier(df: DataFrame, by: Sequence[str], score: str, label: str) -> DataFrame:
    """Rows, positive rate, mean prediction and mean squared error."""
    miss = F.col(score) - F.col(label)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col(label).cast("bigint")).alias("n_positive"),
        F.avg(F.col(label)).alias("positive_rate"),
        F.avg(score).alias("mean_predicted"),
        F.avg(miss * miss).alias("brier"),
    )


def calibration_fit(
    df: DataFrame, by: Sequence[str], score: str, label: str, rounds: int = 25, tolerance: float = 1e-10
) -> DataFrame:
    """Slope and intercept of the label on logit(score) by Newton steps (E4), all groups at once.

    Rows shrink to distinct scores first; each step is one aggregate that
    returns five numbers per group. Only those reach the driver.
    """
    spark, by = df.sparkSession, list(by)
    df = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    cells = df.groupBy(*by, score).agg(F.count(F.lit(1)).alias("_n"), F.sum(F.col(label).cast("double")).alias("_y"))
    cells = cells.select(*by, logit(F.col(score)).alias("_x"), "_n", "_y").persist()
    try:
        groups = [tuple(r) for r in cells.select(*by).distinct().collect()] if by else [()]
        state = {g: (1.0, 0.0) for g in groups}
        # groups are models and splits: a handful of literals
        for _ in range(rounds):
            slope, intercept = (_per_group(by, {g: s[i] for g, s in state.items()}) for i in (0, 1))
            p = sigmoid(slope * F.col("_x") + intercept)
            w, miss = F.col("_n") * p * (1 - p), F.col("_y") - F.col("_n") * p
            sums = cells.groupBy(*by).agg(
                F.sum(miss).alias("g0"),
                F.sum(miss * F.col("_x")).alias("g1"),
                F.sum(w).alias("h00"),
                F.sum(w * F.col("_x")).alias("h01"),
                F.sum(w * F.col("_x") * F.col("_x")).alias("h11"),
            )
            moved = 0.0
            for r in sums.collect():
                key = tuple(r[c] for c in by)
                det = r["h00"] * r["h11"] - r["h01"] ** 2
                if not det > 0:
                    continue
                step = (
                    (r["h00"] * r["g1"] - r["h01"] * r["g0"]) / det,
                    (r["h11"] * r["g0"] - r["h01"] * r["g1"]) / det,
                )
                size = max(abs(step[0]), abs(step[1]))
                scale = min(1.0, 2.0 / size) if size else 1.0
                state[key] = tuple(s + scale * d for s, d in zip(state[key], step))
                moved = max(moved, size)
            if moved < tolerance:
                break
    finally:
        cells.unpersist()
    fields = [f for f in df.select(*by).schema.fields] if by else []
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "slope double", "intercept double"])
    return spark.createDataFrame([(*g, *s) for g, s in state.items()], schema)


def _per_group(by: list[str], values: dict[tuple, float]) -> Column:
    out = F.lit(None).cast("double")
    for group, value in values.items():
        match = F.lit(True)
        for name, part in zip(by, group):
            match = match & F.col(name).eqNullSafe(F.lit(part))
        out = F.when(match, F.lit(value)).otherwise(out)
    return out


def reliability(df: DataFrame, by: Sequence[str], score: str, label: str, bins: int = 10) -> DataFrame:
    """Equal-count bins of the score with mean prediction and observed rate.

    A value on an inner edge belongs to the upper bin; empty bins disappear.
    """
    by = list(by)
    cells = O.counted(df, by, score, {"_n": F.count(F.lit(1)), "_y": F.sum(F.col(label).cast("bigint"))})
    edges = O.quantiles_rows(cells, by, score, O.quantile_probs(bins), "_n")
    edges = edges.select(*by, O.distinct_edges(F.col("edges")).alias("edges"))
    first = F.get("edges", F.lit(0))
    edges = edges.withColumn(
        "edges", F.when(F.size("edges") > 1, F.col("edges")).otherwise(F.array(first - 1e-9, first + 1e-9))
    )
    inner = F.slice("edges", F.lit(2), F.greatest(F.lit(0), F.size("edges") - 2))
    rows = O.attach_groups(cells, edges, by).withColumn("_bin", O.position(F.col(score), inner, bins))
    out = rows.groupBy(*by, "_bin").agg(
        F.sum("_n").alias("n"),
        (F.sum(F.col(score) * F.col("_n")) / F.sum("_n")).alias("mean_predicted"),
        (F.sum("_y") / F.sum("_n")).alias("observed_rate"),
        F.first("edges").alias("edges"),
    )
    return out.select(
        *by,
        (F.col("_bin") + 1).alias("bin"),
        "n",
        F.get("edges", F.col("_bin")).alias("lower_edge"),
        F.get("edges", F.col("_bin") + 1).alias("upper_edge"),
        "mean_predicted",
        "observed_rate",
    )


def metrics_cube(df: DataFrame, by: Sequence[str], score: str, label: str) -> DataFrame:
    """All measures per group: size, rate, AUC, Gini, KS, Brier, slope, intercept."""
    by = list(by)
    base = brier(df, by, score, label)
    ranked = discrimination(df, by, score, label).drop("positives", "negatives")
    return O.null_safe_join(O.null_safe_join(base, ranked, by, "left"), calibration_fit(df, by, score, label), by, "left", small=True)


def threshold_costs(df: DataFrame, by: Sequence[str], score: str, label: str) -> DataFrame:
    """False negatives and positives at each threshold 0.01 ... 0.99 (E12), one pass over the rows.

    A row is approved when its score is below the threshold. Rows without a score are left out, as in AUC.
    """
    df, by = df.where(F.col(score).isNotNull()), list(by)
    step = F.floor(F.col(score) * 100).cast("int")
    passed = step + (F.col(score) >= (step + 1) / 100).cast("int") - (F.col(score) < step / 100).cast("int")
    cell = F.greatest(F.lit(0), F.least(F.lit(THRESHOLDS), passed))
    counts = df.groupBy(*by, cell.alias("_cell")).agg(
        F.sum(F.col(label).cast("bigint")).alias("_pos"), F.sum(1 - F.col(label).cast("bigint")).alias("_neg")
    )
    grid = counts.select(*by).distinct() if by else df.sparkSession.range(1).select()
    grid = grid.select(*by, F.explode(F.sequence(F.lit(0), F.lit(THRESHOLDS))).alias("_cell"))
    rows = O.null_safe_join(grid, counts, [*by, "_cell"], "left").na.fill(0, ["_pos", "_neg"])
    w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = w.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    out = rows.select(
        *by,
        "_cell",
        (F.col("_cell") / 100).alias("threshold"),
        F.sum("_pos").over(before).alias("false_negatives"),
        (F.sum("_neg").over(w) - F.coalesce(F.sum("_neg").over(before), F.lit(0))).alias("false_positives"),
        (F.sum("_pos").over(w) + F.sum("_neg").over(w)).alias("n"),
    )
    return out.where("_cell > 0").drop("_cell")


def cost_optimal(
    df: DataFrame, by: Sequence[str], score: str, label: str, ratios: Sequence[float] = COST_RATIOS, cost_fp: float = 1.0
) -> DataFrame:
    """Cheapest threshold per group and cost ratio; the first one wins a tie."""
    costs = threshold_costs(df, by, score, label).withColumn("cost_ratio", F.explode(F.array(*map(F.lit, ratios))))
    cost = (F.col("cost_ratio") * cost_fp * F.col("false_negatives") + F.lit(cost_fp) * F.col("false_positives")) / F.col("n")
    best = costs.groupBy(*by, "cost_ratio").agg(F.min(F.struct(cost.alias("cost"), F.col("threshold").alias("t"))).alias("b"))
    return best.select(*by, "cost_ratio", F.col("b.t").alias("threshold"), F.col("b.cost").alias("expected_cost"))


def cost_sweep(
    df: DataFrame,
    model: str,
    score: str,
    label: str,
    champion: str = "champion",
    challenger: str = "challenger",
    ratios: Sequence[float] = COST_RATIOS,
) -> DataFrame:
    """Both models at their own cheapest threshold, savings and savings in percent."""
    both = cost_optimal(df.where(F.col(model).isin(champion, challenger)), [model], score, label, ratios)

    def of(name: str, column: str) -> Column:
        return F.max(F.when(F.col(model) == name, F.col(column)))

    wide = both.groupBy("cost_ratio").agg(
        of(champion, "threshold").alias("champion_threshold"),
        of(challenger, "threshold").alias("challenger_threshold"),
        of(champion, "expected_cost").alias("champion_expected_cost"),
        of(challenger, "expected_cost").alias("challenger_expected_cost"),
    )
    saved = F.col("champion_expected_cost") - F.col("challenger_expected_cost")
    share = F.when(F.col("champion_expected_cost") > 0, saved / F.col("champion_expected_cost") * 100).otherwise(0.0)
    return wide.withColumns({"challenger_cost_savings": saved, "challenger_cost_savings_pct": share})


def cross_checks(stored: DataFrame, recomputed: DataFrame, keys: Sequence[str], tolerance: float = CHECK_TOLERANCE) -> DataFrame:
    """Stored against recomputed values of the same checks (E14); both sides hold one row per key."""
    joined = stored.withColumnRenamed("value", "stored_value").join(
        recomputed.withColumnRenamed("value", "recomputed_value"), list(keys)
    )
    delta = F.abs(F.col("stored_value") - F.col("recomputed_value"))
    return joined.withColumn("delta", delta).withColumn("passed", F.col("delta") <= tolerance)


def recommendation(metrics: DataFrame, sweep: DataFrame, failed_checks: Column | int = 0, ratio: float = 20.0) -> DataFrame:
    """Promotion advice from two rows of metrics and the cost sweep."""

    def of(name: str, column: str) -> Column:
        return F.max(F.when(F.col("model") == name, F.col(column))).alias(f"{name}_{column}")

    row = metrics.agg(*[of(m, c) for m in ("champion", "challenger") for c in ("auc", "gini", "brier", "slope", "intercept")])
    middle = sweep.where(F.col("cost_ratio") == ratio).agg(F.max("challenger_cost_savings_pct").alias("challenger_cost_savings_pct"))
    row = O.attach_groups(row, middle, [])

    def in_tolerance(name: str) -> Column:
        return (F.abs(F.col(f"{name}_slope") - 1) <= CALIBRATION_TOLERANCE) & (
            F.abs(F.col(f"{name}_intercept")) <= CALIBRATION_TOLERANCE
        )

    auc_gain = F.col("challenger_auc") - F.col("champion_auc")
    verdict = (
        F.when((auc_gain > AUC_MARGIN) & in_tolerance("challenger") & in_tolerance("champion"), "challenger_superior")
        .when((auc_gain > AUC_MARGIN) & ~in_tolerance("challenger"), "recalibrate_challenger")
        .when(F.abs(auc_gain) <= AUC_MARGIN, "equivalent_prefer_champion")
        .otherwise("keep_champion")
    )
    production = (
        F.when(F.col("statistical") != "challenger_superior", "champion")
        .when(F.col("challenger_cost_savings_pct") > SAVINGS_MARGIN_PCT, "challenger")
        .otherwise("challenger_marginal_cost")
    )
    failed = F.lit(failed_checks) if isinstance(failed_checks, int) else failed_checks
    return (
        row.withColumns(
            {
                "auc_delta": auc_gain,
                "gini_delta": F.col("challenger_gini") - F.col("champion_gini"),
                "brier_delta": F.col("champion_brier") - F.col("challenger_brier"),
                "statistical": verdict,
                "failed_checks": failed,
            }
        )
        .withColumn("operational", production)
        .select(
            "auc_delta", "gini_delta", "brier_delta", "challenger_cost_savings_pct", "failed_checks", "statistical", "operational"
        )
    )
