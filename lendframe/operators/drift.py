"""Population drift between a reference and a monitoring table."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendframe.functions import ordered as O
from lendframe.functions.radix import Distributions
from lendframe.operators import metrics as M

# Alert levels.
PSI_STABLE = 0.10
PSI_MODERATE = 0.25
SLOPE_RANGE = (0.90, 1.10)
INTERCEPT_LIMIT = 0.15
AUC_DROP_LIMIT = 0.03
TOP_DRIFTED = 20
SHARE_FLOOR = 1e-6
DECILES = 10
#: Columns that count a row for the reference or the monitoring side.
REF, MON = "_ref", "_mon"


class Sides:
    """Two populations of the same columns side by side: exact distributions of both from one set of counted value ranges.

    Columns that one side lacks are left out; NaN counts as null.
    """

    def __init__(self, reference: DataFrame, monitoring: DataFrame, features: Sequence[str]):
        self.features = [f for f in features if f in reference.columns and f in monitoring.columns]
        self.spark = reference.sparkSession

        def side(df: DataFrame, is_ref: int) -> DataFrame:
            values = [F.nanvl(F.col(f"`{f}`").cast("double"), F.lit(None)).alias(f) for f in self.features]
            return df.select(*values, F.lit(is_ref).alias(REF), F.lit(1 - is_ref).alias(MON))

        self.rows = side(reference, 1).unionByName(side(monitoring, 0))

        self.distributions = Distributions(self.rows, self.features, [REF, MON])

    @cached_property
    def decided(self) -> tuple[dict[str, list[float]], dict[str, float]]:
        """Reference deciles and largest gaps, from the same scans."""
        return self.distributions.decide((REF, O.quantile_probs(DECILES)), (REF, MON))

    def table(self, values: Mapping[str, Sequence], names: str) -> DataFrame:
        return self.spark.createDataFrame([(f, *values[f]) for f in self.features if f in values], f"feature string, {names}")


def severity(psi: Column) -> Column:
    return F.when(psi < PSI_STABLE, "stable").when(psi < PSI_MODERATE, "moderate").otherwise("material")


def psi_values(sides: Sides) -> dict[str, float]:
    """PSI of each feature over the distinct reference deciles; 0 where a side is empty or all values are equal.

    Bins are closed on the left, the last one on both sides. Monitoring values outside the edges fall into no bin but stay in the
    denominator.
    """
    facts = sides.distributions.facts
    edges = {f: sorted(set(e)) for f, e in sides.decided[0].items() if facts[f][MON]}
    edges = {f: e for f, e in edges.items() if len(e) > 1}
    out = dict.fromkeys(sides.features, 0.0)
    for f, counts in sides.distributions.below({f: [(x, x == e[-1]) for x in e] for f, e in edges.items()}).items():
        for low, high in zip(counts, counts[1:]):
            r, m = (max(SHARE_FLOOR, (high[i] - low[i]) / facts[f][side]) for i, side in enumerate((REF, MON)))
            out[f] += (r - m) * math.log(r / m)
    return out


def psi(sides: Sides) -> DataFrame:
    """Population stability index per feature (G1)."""
    return sides.table({f: (v,) for f, v in psi_values(sides).items()}, "psi double")


def ks_values(sides: Sides) -> dict[str, float]:
    return dict.fromkeys(sides.features, 0.0) | sides.decided[1]


def ks_two_sample(sides: Sides) -> DataFrame:
    """Largest gap between the two empirical distributions per feature."""
    return sides.table({f: (v,) for f, v in ks_values(sides).items()}, "ks double")


def moments(sides: Sides) -> dict[str, tuple]:
    """Mean and null rate per feature and side (G3), from the scan that counts the value ranges."""

    def of(r, m: str) -> tuple:
        return r[f"{m}_sum"] / r[m] if r[m] else None, (r[f"{m}_rows"] - r[m]) / r[f"{m}_rows"] if r[f"{m}_rows"] else None

    out = {}
    for f, r in sides.distributions.facts.items():
        (mean_ref, null_ref), (mean_mon, null_mon) = of(r, REF), of(r, MON)
        out[f] = (mean_ref, mean_mon, null_ref, null_mon)
    return out


def feature_drift(reference: DataFrame, monitoring: DataFrame, features: Sequence[str]) -> DataFrame:
    """Drift table, one row per feature (G5). Every pass is a scan of the wide tables; what is shuffled are counts."""
    sides = Sides(reference, monitoring, features)
    means, stability, gaps = moments(sides), psi_values(sides), ks_values(sides)
    names = "reference_mean double, monitoring_mean double, reference_null_rate double, monitoring_null_rate double, psi double, ks double"
    return sides.table({f: (*means[f], stability[f], gaps[f]) for f in sides.features}, names).withColumn("severity", severity(F.col("psi")))


def severity_counts(drift: DataFrame) -> DataFrame:
    return drift.groupBy("severity").agg(F.count(F.lit(1)).alias("features"))


def top_drifted(drift: DataFrame, n: int = TOP_DRIFTED, ranked_by: str = "psi") -> DataFrame:
    """The n most drifted features (G8); equal values rank by name."""
    return drift.orderBy(F.col(ranked_by).desc(), "feature").limit(n)


def prediction_drift(reference: DataFrame, monitoring: DataFrame, score: str) -> DataFrame:
    """PSI, KS, means and share above one half of a score."""
    base = feature_drift(reference, monitoring, [score])

    def high(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.avg((F.col(score) > 0.5).cast("int")).alias(name))

    row = O.attach_groups(base, high(reference, "reference_positive_rate"), [])
    row = O.attach_groups(row, high(monitoring, "monitoring_positive_rate"), [])
    names = "reference_mean monitoring_mean reference_positive_rate monitoring_positive_rate psi ks severity"
    return row.select(*names.split())


def calibration_drift(reference: DataFrame, monitoring: DataFrame, score: str, label: str) -> DataFrame:
    """AUC and Brier on both sides, slope and intercept on the monitoring side."""
    marked = reference.select(F.lit("reference").alias("side"), score, label).unionByName(
        monitoring.select(F.lit("monitoring").alias("side"), score, label)
    )
    auc = M.discrimination(marked, ["side"], score, label).select("side", "auc")
    err = M.brier(marked, ["side"], score, label).select("side", "brier")
    joined = auc.join(err, "side")

    def of(name: str, column: str) -> Column:
        return F.max(F.when(F.col("side") == name, F.col(column))).alias(f"{name}_{column}")

    row = joined.agg(*[of(s, c) for c in ("auc", "brier") for s in ("reference", "monitoring")])
    fit = M.calibration_fit(monitoring, [], score, label).select(
        F.col("slope").alias("monitoring_slope"), F.col("intercept").alias("monitoring_intercept")
    )
    ok = F.col("monitoring_slope").between(*SLOPE_RANGE) & (F.abs("monitoring_intercept") <= INTERCEPT_LIMIT)
    return O.attach_groups(row, fit, []).withColumn("calibration_ok", ok)


def alert_notes(drift: DataFrame, prediction: DataFrame, calibration: DataFrame) -> DataFrame:
    """One row per raised alert, or a single all-stable row."""
    found = drift.agg(
        F.count_if(F.col("severity") == "material").alias("material"),
        F.count_if(F.col("severity") == "moderate").alias("moderate"),
    )
    level = prediction.select(F.col("severity").alias("prediction_severity"), F.col("psi").alias("prediction_psi"))
    row = O.attach_groups(O.attach_groups(found, level, []), calibration, [])
    drop = F.col("reference_auc") - F.col("monitoring_auc")
    alerts = {
        "feature_material": (F.col("material") > 0, F.col("material").cast("double")),
        "feature_moderate": (F.col("moderate") > 0, F.col("moderate").cast("double")),
        "prediction_material": (F.col("prediction_severity") == "material", F.col("prediction_psi")),
        "calibration": (~F.col("calibration_ok"), F.col("monitoring_slope")),
        "auc_drop": (drop > AUC_DROP_LIMIT, drop),
    }
    raised = F.filter(
        F.array(*[F.when(test, F.struct(F.lit(n).alias("alert"), v.alias("amount"))) for n, (test, v) in alerts.items()]),
        lambda a: a.isNotNull(),
    )
    calm = F.array(F.struct(F.lit("all_stable").alias("alert"), F.lit(0.0).alias("amount")))
    return row.select(F.explode(F.when(F.size(raised) > 0, raised).otherwise(calm)).alias("a")).select("a.alert", "a.amount")
