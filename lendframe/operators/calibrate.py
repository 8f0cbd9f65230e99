"""Probability calibration and its selection."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendframe.functions.ordered import position
from lendframe.operators import metrics as M
from lendframe.session import staged


@dataclass(frozen=True)
class Platt:
    """Logistic map of the log odds (E5)."""

    slope: float
    intercept: float
    method: str = "platt"

    def apply(self, raw: Column) -> Column:
        return M.sigmoid(F.lit(self.intercept) + F.lit(self.slope) * M.logit(raw))

    def add(self, df: DataFrame, raw: str, out: str) -> DataFrame:
        return df.withColumn(out, self.apply(F.col(raw)))


@dataclass(frozen=True)
class Isotonic:
    """Monotone step map, linear between knots, constant outside."""

    knots: tuple[float, ...]
    levels: tuple[float, ...]
    method: str = "isotonic"

    def apply(self, raw: Column) -> Column:
        """The map as an expression that holds all knots: for maps of a few knots, written by hand or on a stream; `add` takes any number."""
        return _between(raw, F.array(*map(F.lit, self.knots)), F.array(*map(F.lit, self.levels)), len(self.knots))

    def table(self, spark: SparkSession) -> DataFrame:
        """Written knots in blocks of about the square root of their number: block, first, xs, ys.

        A block ends with the first knot of the next one, so two neighbours always lie in one row.
        """
        size = max(1, math.isqrt(len(self.knots)))
        cuts = [(i, slice(i * size, (i + 1) * size + 1)) for i in range(-(-len(self.knots) // size))]
        rows = [(i, self.knots[c.start], list(self.knots[c]), list(self.levels[c])) for i, c in cuts]
        return staged(spark.createDataFrame(rows, "_block int, _first double, _xs array<double>, _ys array<double>"))

    def add(self, df: DataFrame, raw: str, out: str) -> DataFrame:
        """df with the mapped score: the last block that starts at or below a score is looked up first, then the knots in it.

        Neither list is longer than the root of the number of knots, and only the first travels with every row.
        """
        table = self.table(df.sparkSession)
        most = math.isqrt(len(self.knots)) + 3
        firsts = table.agg(F.sort_array(F.collect_list("_first")).alias("_firsts")).scalar()
        block = F.greatest(F.lit(0), position(F.col(raw), F.col("_firsts"), most) - 1)
        found = df.withColumn("_firsts", firsts).withColumn("_at", block).join(F.broadcast(table), F.col("_at") == F.col("_block"), "left")
        return found.withColumn(out, _between(F.col(raw), F.col("_xs"), F.col("_ys"), most)).drop("_firsts", "_at", "_block", "_first", "_xs", "_ys")


def _between(raw: Column, x: Column, y: Column, most: int) -> Column:
    """Linear between the knots x (at most `most`) with levels y, constant outside, within [0, 1]; null stays null."""
    at = position(raw, x, most)
    x0, x1, y0, y1 = F.get(x, at - 1), F.get(x, at), F.get(y, at - 1), F.get(y, at)
    inside = F.coalesce(y0 + (y1 - y0) * (raw - x0) / F.nullif(x1 - x0, F.lit(0.0)), y0)
    value = F.when(at < 1, F.get(y, F.lit(0))).when(at >= F.size(x), F.get(y, F.size(y) - 1)).otherwise(inside)
    return F.when(raw.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)))


def fit_platt(df: DataFrame, raw: str, label: str) -> Platt:
    row = M.calibration_fit(df, [], raw, label).first()
    return Platt(row["slope"], row["intercept"])


def fit_isotonic(df: DataFrame, raw: str, label: str) -> Isotonic:
    """Isotonic fit on distinct scores with their weights, which gives the same map as the raw rows."""
    cells = df.groupBy(raw).agg(F.count(F.lit(1)).cast("double").alias("w"), F.avg(F.col(label).cast("double")).alias("y"))
    model = isotonic_model(cells.select(F.col(raw).alias("x"), "y", "w"))
    return Isotonic(tuple(model.boundaries.toArray().tolist()), tuple(model.predictions.toArray().tolist()))


def isotonic_model(cells: DataFrame) -> IsotonicRegressionModel:
    rows = VectorAssembler(inputCols=["x"], outputCol="v").transform(cells)
    return IsotonicRegression(featuresCol="v", labelCol="y", weightCol="w").fit(rows)


def saved(spark: SparkSession, calibrator: Platt | Isotonic) -> DataFrame:
    """The calibrator as rows (S14): method, and slope and intercept, or one row for each knot."""
    kind = "method string, place int, x double, y double"
    if isinstance(calibrator, Platt):
        return spark.createDataFrame([(calibrator.method, 0, calibrator.slope, calibrator.intercept)], kind)
    return spark.createDataFrame([(calibrator.method, i, x, y) for i, (x, y) in enumerate(zip(calibrator.knots, calibrator.levels))], kind)


def restored(rows: DataFrame) -> Platt | Isotonic:
    """The calibrator that `saved` wrote."""
    found = rows.orderBy("place").collect()
    if found[0]["method"] == Platt.method:
        return Platt(found[0]["x"], found[0]["y"])
    return Isotonic(tuple(r["x"] for r in found), tuple(r["y"] for r in found))


def select_calibrator(fit_on: DataFrame, select_on: DataFrame, raw: str, label: str) -> tuple[Platt | Isotonic, DataFrame]:
    """Fit both on one population, keep the one with the lower Brier on the other; a tie goes to Platt."""
    platt, isotonic = fit_platt(fit_on, raw, label), fit_isotonic(fit_on, raw, label)

    def error(p: str) -> Column:
        return F.avg((F.col(p) - F.col(label)) * (F.col(p) - F.col(label)))

    both = isotonic.add(platt.add(select_on.select(F.col(raw).alias("raw"), label), "raw", "platt"), "raw", "isotonic")
    row = both.agg(*[error(p).alias(p) for p in ("raw", "platt", "isotonic")]).first()
    best = isotonic if row["isotonic"] < row["platt"] else platt
    gain = (row["raw"] - min(row["platt"], row["isotonic"])) * 100
    report = select_on.sparkSession.createDataFrame(
        [(best.method, row["raw"], row["platt"], row["isotonic"], gain)],
        "selected_method string, raw_brier double, platt_brier double, isotonic_brier double, improvement_pp double",
    )
    return best, report


def combine_predictions(champion: DataFrame, challenger: DataFrame, calibrator: Platt | Isotonic) -> DataFrame:
    """Long union of both models (E10); the champion's calibrated score is its raw score."""
    return champion.withColumn("calibrated_pd", F.col("raw_pd")).unionByName(calibrator.add(challenger, "raw_pd", "calibrated_pd"))
