"""Supervised binning, weight of evidence and feature selection.

Rows are only ever aggregated: quantile pre-bins, then one long-form count per
(feature, pre-bin). What reaches the driver is at most 21 counts per feature;
the merge under the size, event and trend constraints runs on those.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lendframe.functions.radix import Distributions
from lendframe.functions.sizing import Lookup, attach_lookups, lookups, step
from lendframe.operators.encode import feature_types

KEY, TARGET = "SK_ID_CURR", "TARGET"
MAX_BINS = 6
MIN_BIN_SHARE = 0.05
MIN_BIN_EVENTS = 100
PRE_BINS = 20
IV_MIN, IV_MAX = 0.01, 0.50
CORRELATION_MAX = 0.90
UNSEEN = -1.0

# Required direction of the event rate, +1 rising, -1 falling with the feature.
DIRECTIONS = {
    "DAYS_BIRTH": -1,
    "AMT_INCOME_TOTAL": -1,
    "AMT_CREDIT": 1,
    "AMT_ANNUITY": 1,
    "EXT_SOURCE_1": -1,
    "EXT_SOURCE_2": -1,
    "EXT_SOURCE_3": -1,
    "bureau_count_credits": 1,
    "bureau_count_active": 1,
    "bureau_count_bad_debt": 1,
    "bureau_credit_sum_overdue_max": 1,
    "bureau_credit_max_overdue_max": 1,
    "inst_delay_positive_rate": 1,
    "inst_delay_max": 1,
    "inst_underpaid_rate": 1,
    "pos_sk_dpd_max": 1,
    "pos_sk_dpd_positive_months_total": 1,
    "cc_sk_dpd_max": 1,
    "cc_utilization_last": 1,
    "bb_max_status_max": 1,
    "bb_months_at_3_plus_total": 1,
}

TABLE_SCHEMA = (
    "feature string, bin string, count bigint, count_rate double, non_event bigint, event bigint, event_rate double,"
    " woe double, iv double, is_special boolean"
)


# --- the table for given bins -----------------------------------------------


def woe_columns(counts: DataFrame, by: str = "feature") -> DataFrame:
    """Rates, WoE and IV from (feature, bin, n, event) counts (W3); an empty class counts as one half."""
    w = Window.partitionBy(by)
    good = F.col("n") - F.col("event")
    bad_all, good_all = F.sum("event").over(w), F.sum(good).over(w)
    empty = (F.col("event") == 0) | (good == 0)
    bad_share = F.when(empty, F.col("event") + 0.5).otherwise(F.col("event").cast("double")) / bad_all
    good_share = F.when(empty, good + 0.5).otherwise(good.cast("double")) / good_all
    woe = F.ln(good_share / bad_share)
    return counts.select(
        by,
        "bin",
        F.col("n").alias("count"),
        (F.col("n") / F.sum("n").over(w)).alias("count_rate"),
        good.alias("non_event"),
        F.col("event"),
        (F.col("event") / F.col("n")).alias("event_rate"),
        woe.alias("woe"),
        ((good_share - bad_share) * woe).alias("iv"),
    )


def bin_index(value: Column, cuts: Sequence[float]) -> Column:
    """Bins closed on the left; null is its own bin, numbered -1."""
    return F.when(value.isNull(), F.lit(-1)).otherwise(step(value, list(cuts), [F.lit(i) for i in range(len(cuts) + 1)]))


def bin_counts(df: DataFrame, cuts: Mapping[str, Sequence[float]], target: str = TARGET, batch: int = 100) -> DataFrame:
    """(feature, bin, n, event) of all features in one long-form count; tiny after map-side combine."""
    names, parts = list(cuts), []
    for start in range(0, len(names), batch):
        chunk = names[start : start + batch]
        wide = df.select(F.col(target).alias("_y"), *[bin_index(F.col(f"`{n}`"), cuts[n]).alias(n) for n in chunk])
        parts.append(wide.unpivot(["_y"], chunk, "feature", "bin"))
    long = parts[0]
    for part in parts[1:]:
        long = long.unionByName(part)
    return long.groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("_y").cast("bigint")).alias("event"))


def woe_table(df: DataFrame, cuts: Mapping[str, Sequence[float]], target: str = TARGET) -> DataFrame:
    """Binning table for given cut points."""
    return woe_columns(bin_counts(df, cuts, target))


def information_values(table: DataFrame) -> DataFrame:
    """IV per feature."""
    return table.groupBy("feature").agg(F.sum("iv").alias("iv"))


def woe_transform(df: DataFrame, table: DataFrame, cuts: Mapping[str, Sequence[float]], keep: Sequence[str]) -> DataFrame:
    """Replace each feature by the WoE of its bin (W4) given a binning table with numbered bins.

    The table has a handful of rows per feature; it is read once and becomes a
    tree of comparisons inside one projection.
    """
    weights: dict[str, dict[int, float]] = {}
    for r in table.select("feature", "bin", "woe").collect():
        weights.setdefault(r["feature"], {})[r["bin"]] = r["woe"]
    return df.select(*keep, *[_woe(F.col(f"`{n}`"), list(cuts[n]), weights.get(n, {})).alias(n) for n in cuts])


def _woe(value: Column, cuts: list[float], weights: Mapping[int, float]) -> Column:
    known = step(value, cuts, [F.lit(float(weights.get(i, 0.0))) for i in range(len(cuts) + 1)])
    return F.when(value.isNull(), F.lit(float(weights.get(-1, 0.0)))).otherwise(known)


# --- fitting ----------------------------------------------------------------


@dataclass(frozen=True)
class Bins:
    """Fitted bins of one feature: counts per bin in cut order, null bin apart."""

    feature: str
    kind: str
    direction: int
    cuts: tuple[float, ...]
    counts: tuple[tuple[int, int], ...]
    null_count: tuple[int, int]
    totals: tuple[int, int]

    def weight(self, n: int, event: int) -> tuple[float, float]:
        good, bad_all, good_all = n - event, self.totals[1], self.totals[0] - self.totals[1]
        half = 0.5 if 0 in (event, good) else 0.0
        g, b = (good + half) / good_all, (event + half) / bad_all
        return math.log(g / b), (g - b) * math.log(g / b)

    @property
    def weights(self) -> dict[int, float]:
        out = {i: self.weight(*c)[0] for i, c in enumerate(self.counts)}
        if self.null_count[0]:
            out[-1] = self.weight(*self.null_count)[0]
        return out

    @property
    def iv(self) -> float:
        cells = [*self.counts, *([self.null_count] if self.null_count[0] else [])]
        return sum(self.weight(*c)[1] for c in cells)

    def rows(self) -> list[tuple]:
        ends = ["-inf", *[f"{c:g}" for c in self.cuts], "inf"]
        out = []
        cells = [(f"[{a}, {b})", c, False) for a, b, c in zip(ends, ends[1:], self.counts)]
        if self.null_count[0]:
            cells.append(("Missing", self.null_count, True))
        for label, (n, event), special in cells:
            woe, iv = self.weight(n, event)
            out.append((self.feature, label, n, n / self.totals[0], n - event, event, event / n, woe, iv, special))
        return out


@dataclass
class Binning:
    """All fitted bins, category scores, and what was left out."""

    bins: dict[str, Bins]
    scores: Mapping[str, Lookup]
    categorical: list[str]
    skipped: list[str] = field(default_factory=list)
    failed: dict[str, str] = field(default_factory=dict)

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([r for b in self.bins.values() for r in b.rows()], TABLE_SCHEMA)

    def values(self, spark: SparkSession) -> DataFrame:
        rows = [(b.feature, b.kind, b.direction, float(b.iv), len(b.counts), b.null_count[0] > 0) for b in self.bins.values()]
        return spark.createDataFrame(rows, "feature string, kind string, direction int, iv double, n_bins int, has_null_bin boolean")

    def status(self, spark: SparkSession) -> DataFrame:
        """(feature, status, note): binned, skipped as constant, or failed."""
        rows = [(f, "binned", "") for f in self.bins] + [(f, "skipped", "constant") for f in self.skipped]
        return spark.createDataFrame(rows + [(f, "failed", why) for f, why in self.failed.items()], "feature string, status string, note string")

    def transform(self, df: DataFrame, keep: Sequence[str], features: Sequence[str] | None = None) -> DataFrame:
        """WoE of every row (W4); a category never seen in fitting gets 0."""
        names = list(features or self.bins)
        ready = score_categories(df, self.scores, [n for n in names if n in self.categorical])
        out = []
        for n in names:
            x = F.col(f"`{n}`")
            woe = _woe(x, list(self.bins[n].cuts), self.bins[n].weights)
            out.append((F.when(x == UNSEEN, F.lit(0.0)).otherwise(woe) if n in self.categorical else woe).alias(n))
        return ready.select(*keep, *out)


def category_scores(dev: DataFrame, columns: Sequence[str], target: str = TARGET) -> DataFrame:
    """(feature, category, score): event rate per category, the order that suits a binary target."""
    text = dev.select(F.col(target).alias("_y"), *[F.col(f"`{c}`").cast("string").alias(c) for c in columns])
    long = text.unpivot(["_y"], list(columns), "feature", "category").where("category IS NOT NULL")
    return long.groupBy("feature", "category").agg(F.avg(F.col("_y").cast("double")).alias("score"))


def score_categories(df: DataFrame, scores: Mapping[str, Lookup], columns: Sequence[str]) -> DataFrame:
    """Replace categories by their score; null stays null, unseen becomes UNSEEN."""
    found = attach_lookups(df, {c: scores[c] for c in columns}, "category", "score")

    def value(c: str) -> Column:
        return F.when(F.col(f"`{c}`").isNotNull(), F.coalesce(F.col(f"`_found_{c}`"), F.lit(UNSEEN))).alias(c)

    return found.select(*[value(c) if c in columns else F.col(f"`{c}`") for c in df.columns])


def merge_bins(
    counts: Sequence[tuple[int, int]],
    cuts: Sequence[float],
    total: int,
    direction: int = 0,
    max_bins: int = MAX_BINS,
    min_share: float = MIN_BIN_SHARE,
    min_events: int = MIN_BIN_EVENTS,
) -> tuple[list[tuple[int, int]], list[float]]:
    """The division of the pre-bins into neighbouring bins with the most information (W1 step 3, W2).

    Every bin has its share of all rows, its events and at least one other row; there are at most max_bins, and event rates rise or
    fall strictly (direction 0: whichever tells more). Information adds up over bins, so the best division that ends with a given bin is
    that bin after the best one that ends with a smaller (or larger) rate before it: dynamic programming over (bins, last bin). With
    equal information the fewer bins win, then the earlier cuts. Where no division keeps the rules, all rows are one bin.
    """
    if direction == 0:
        tries = [merge_bins(counts, cuts, total, d, max_bins, min_share, min_events) for d in (1, -1)]
        return max(tries, key=lambda t: _information(t[0]))
    size = len(counts)
    sums = [(0, 0)]
    for n, e in counts:
        sums.append((sums[-1][0] + n, sums[-1][1] + e))
    bad_all, good_all = sums[-1][1], sums[-1][0] - sums[-1][1]
    whole = [sums[-1]], []
    if not bad_all or not good_all:
        return whole

    def cell(i: int, j: int) -> tuple[int, int]:
        return sums[j][0] - sums[i][0], sums[j][1] - sums[i][1]

    def fits(n: int, e: int) -> bool:
        return n > 0 and n >= min_share * total and e >= min_events and e < n

    bins = {(i, j): cell(i, j) for j in range(1, size + 1) for i in range(j) if fits(*cell(i, j))}
    gain = {b: _cell_information(*c, bad_all, good_all) for b, c in bins.items()}
    ending: dict[int, list[int]] = {}
    for i, j in bins:
        ending.setdefault(j, []).append(i)
    best = {b: (gain[b], None) for b in bins if b[0] == 0}  # last bin: information, bin before
    layers = [best]
    for _ in range(1, max_bins):
        longer = {}
        for (i, j), (n, e) in bins.items():
            options = []
            for h in ending.get(i, ()):
                if (h, i) in layers[-1]:
                    m, f = bins[h, i]
                    if (e * m - f * n) * direction > 0:  # the rates, compared in whole numbers
                        options.append((layers[-1][h, i][0] + gain[i, j], (h, i)))
            if options:
                longer[i, j] = max(options, key=lambda o: (o[0], [-x for x in o[1]]))
        layers.append(longer)
    ends = [(layer[b][0], -k, -b[0], b) for k, layer in enumerate(layers) for b in layer if b[1] == size]
    if not ends:
        return whole
    _, k, _, last = max(ends)
    chain, k = [last], -k
    while k:
        last, k = layers[k][last][1], k - 1
        chain.insert(0, last)
    return [bins[b] for b in chain], [cuts[i - 1] for i, _ in chain[1:]]


def _cell_information(n: int, e: int, bad_all: int, good_all: int) -> float:
    g, b = max(n - e, 0.5) / good_all, max(e, 0.5) / bad_all
    return (g - b) * math.log(g / b)


def _information(cells: Sequence[Sequence[int]]) -> float:
    bad_all = sum(e for _, e in cells)
    good_all = sum(n - e for n, e in cells)
    if not bad_all or not good_all:
        return 0.0
    return sum(_cell_information(n, e, bad_all, good_all) for n, e in cells)


def fit_binning(
    dev: DataFrame,
    target: str = TARGET,
    key: str = KEY,
    features: Sequence[str] | None = None,
    directions: Mapping[str, int] = DIRECTIONS,
    pre_bins: int = PRE_BINS,
    max_bins: int = MAX_BINS,
    min_share: float = MIN_BIN_SHARE,
    min_events: int = MIN_BIN_EVENTS,
) -> Binning:
    """Fit bins of all features on the development rows (W1). Runs a fixed number of jobs, not one per feature."""
    names = list(features or [c for c in dev.columns if c not in (key, target)])
    kinds = {r["feature"]: r["kind"] for r in feature_types(dev.select(*names), exclude=()).collect()}
    skipped = [n for n in names if kinds[n] == "constant"]
    categorical = [n for n in names if kinds[n] == "categorical"]
    used = [n for n in names if n not in skipped]
    scores: dict[str, Lookup] = {}
    ready = dev
    if categorical:
        scores = lookups(category_scores(dev, categorical, target), "feature", categorical)
        ready = score_categories(dev, scores, categorical)
    probs = [i / pre_bins for i in range(1, pre_bins)]
    # exact quantiles: the same cut points whatever the order in which partitions arrive
    edges = Distributions(ready.select("*", F.lit(1).alias("_row")), used, ["_row"]).quantiles("_row", probs) if used else {}
    cuts = dict.fromkeys(used, []) | {n: sorted(set(e)) for n, e in edges.items()}
    found: dict[str, dict[int, tuple[int, int]]] = {}
    for r in bin_counts(ready, cuts, target).collect():
        found.setdefault(r["feature"], {})[r["bin"]] = (r["n"], r["event"])
    bins, failed = {}, {}
    for n in used:
        cells = found[n]
        totals = (sum(c[0] for c in cells.values()), sum(c[1] for c in cells.values()))
        if totals[1] in (0, totals[0]):
            failed[n] = "one class only"
            continue
        ordered = [cells.get(i, (0, 0)) for i in range(len(cuts[n]) + 1)]
        trend = directions.get(n, 0)
        merged, edges = merge_bins(ordered, cuts[n], totals[0], trend, max_bins, min_share, min_events)
        bins[n] = Bins(n, kinds[n], trend, tuple(edges), tuple(merged), cells.get(-1, (0, 0)), totals)
    return Binning(bins, scores, categorical, skipped, failed)


# --- selection --------------------------------------------------------------


def iv_selection(values: DataFrame, low: float = IV_MIN, high: float = IV_MAX) -> DataFrame:
    """Keep or drop by information value, with the reason."""
    reason = F.when(F.col("iv") < low, "low_iv").when(F.col("iv") > high, "suspicious_iv").otherwise("kept")
    return values.select("feature", "iv", reason.alias("reason"), (reason == "kept").alias("kept"))


def correlation_matrix(df: DataFrame, features: Sequence[str]) -> list[list[float]]:
    """Pearson matrix of the columns in one pass (features x features on the driver)."""
    vectors = VectorAssembler(inputCols=list(features), outputCol="_v").transform(df).select("_v")
    return Correlation.corr(vectors, "_v").head()[0].toArray().tolist()


def corr_pairs(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(a, b, r) for every pair of columns, a before b (W8), from the matrix that pruning walks over."""
    matrix = correlation_matrix(df, features)
    rows = [(a, b, matrix[i][j]) for i, a in enumerate(features) for j, b in enumerate(features) if i < j]
    return df.sparkSession.createDataFrame(rows, "a string, b string, r double")


def prune_correlated(decisions: DataFrame, encoded: DataFrame, limit: float = CORRELATION_MAX) -> DataFrame:
    """Walk kept features by falling IV and drop later ones too close to a kept one.

    The walk needs the features x features matrix only.
    """
    rows = decisions.collect()
    kept = sorted((r for r in rows if r["kept"]), key=lambda r: (-r["iv"], r["feature"]))
    names = [r["feature"] for r in kept]
    winner: dict[str, tuple[str, float]] = {}
    if len(names) > 1:
        matrix = correlation_matrix(encoded, names)
        for i, a in enumerate(names):
            if a in winner:
                continue
            for j in range(i + 1, len(names)):
                if names[j] not in winner and abs(matrix[i][j]) > limit:
                    winner[names[j]] = (a, abs(matrix[i][j]))
    out = []
    for r in rows:
        hit = winner.get(r["feature"])
        out.append((r["feature"], r["iv"], "correlated" if hit else r["reason"], r["kept"] and not hit, hit[0] if hit else None, float(hit[1]) if hit else None))
    return decisions.sparkSession.createDataFrame(out, "feature string, iv double, reason string, kept boolean, correlated_with string, r double")


def selection_report(decisions: DataFrame) -> DataFrame:
    """Features per reason."""
    return decisions.groupBy("reason").agg(F.count(F.lit(1)).alias("features"))


def selection_lists(decisions: DataFrame) -> DataFrame:
    """Per reason the number of features and their names in order."""
    names = F.sort_array(F.collect_list("feature"))
    return decisions.groupBy("reason").agg(F.count(F.lit(1)).alias("features"), names.alias("names"))


def top_by_iv(decisions: DataFrame, n: int = 15) -> DataFrame:
    return decisions.where("kept").orderBy(F.col("iv").desc(), "feature").limit(n)


def encoded_matrix(binning: Binning, df: DataFrame, decisions: DataFrame, key: str = KEY, target: str = TARGET) -> DataFrame:
    """Key, kept WoE features by name, target."""
    kept = sorted(r["feature"] for r in decisions.where("kept").select("feature").collect())
    out = binning.transform(df, [key, target], kept)
    return out.select(key, *kept, target)
