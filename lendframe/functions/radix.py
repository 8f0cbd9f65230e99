"""Exact order statistics of many columns from counts of value ranges.

One wide scan counts, for every column at once, how many rows fall into each range of a first digit, an order-preserving function of
the value; some thousand counts per column and task are all that is shuffled, whatever the number of rows. Counts over the lower ranges
give the exact rank at each range's ends, hence the one range that holds a wanted rank. Only such ranges are looked into by another
scan: cut into PARTS while they hold more than OPEN rows of different values, and read value by value at the end. So no cell of the
table becomes a shuffled row unless it lies in a range that decides a result.

The first digit is logarithmic in the distance from zero, so it tells magnitudes apart without knowing the column; later digits are
linear between the smallest and the largest value of their range. Both ends of a range fall into different parts of it, so every
cut makes progress, and equal values are never cut: a value that half of all rows share is one count.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from lendframe.session import staged

#: Values of the first digit for each sign; neighbours differ by 0.3 % beyond NEAR, below it the ranges are of equal width.
DIGITS, REACH, NEAR = 1 << 18, 740.0, 1e-9
PARTS = 2048
OPEN = 4096
INF = float("inf")


@dataclass(frozen=True)
class Range:
    """Rows of a column from `low` to `high`, both included, all of one first digit: counts per measure, and those of all smaller values."""

    digit: int
    low: float
    high: float
    counts: tuple[int, ...]
    before: tuple[int, ...]

    @property
    def divisible(self) -> bool:
        return self.high / 2 - self.low / 2 > 0 and abs(self.low) < INF and abs(self.high) < INF

    @property
    def single(self) -> bool:
        return self.low == self.high or math.isnan(self.low)


def per_column(df: DataFrame, names: Sequence[str], stats: Mapping[str, Callable[[Column], Column]], batch: int = 150) -> DataFrame:
    """The same aggregates for many columns: one pass, one row per column.

    Wide tables go in batches so that no generated class grows too large.
    """
    parts = []
    for start in range(0, len(names), batch):
        chunk = list(names[start : start + batch])
        row = df.agg(
            *[
                F.struct(F.lit(n).alias("feature"), *[fn(F.col(f"`{n}`")).alias(s) for s, fn in stats.items()]).alias(f"c{i}")
                for i, n in enumerate(chunk)
            ]
        )
        parts.append(row.select(F.inline(F.array(*[f"c{i}" for i in range(len(chunk))]))))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def interpolated(low: float, high: float, part: float) -> float:
    """Value at `part` of the way between two neighbours in order."""
    if part == 0:
        return low
    gap = high - low
    return high - gap * (1 - part) if part >= 0.5 else low + gap * part


def first_digit(x: Column) -> Column:
    """Whole number that never falls as the value rises; infinities and NaN have digits of their own, null has none."""
    scaled = F.signum(x) * F.log1p(F.abs(x) / NEAR) * (DIGITS / REACH)
    finite = F.floor(F.greatest(F.lit(-float(DIGITS)), F.least(F.lit(float(DIGITS)), scaled))).cast("int")
    return F.when(F.isnan(x), DIGITS + 2).when(x == INF, DIGITS + 1).when(x == -INF, -DIGITS - 1).when(x.isNotNull(), finite)


def unpivoted(df: DataFrame, names: Sequence[str], measures: Sequence[str], batch: int = 100) -> DataFrame:
    """(measures..., feature, value), for aggregation within the scan; wide tables go in column batches."""
    parts = []
    for start in range(0, len(names), batch):
        chunk = names[start : start + batch]
        wide = df.select(*measures, *[F.col(f"`{n}`").cast("double").alias(n) for n in chunk])
        parts.append(wide.unpivot(list(measures), chunk, "feature", "value"))
    long = parts[0]
    for part in parts[1:]:
        long = long.unionByName(part)
    return long.withColumn("value", F.when(F.col("value") == 0, F.lit(0.0)).otherwise(F.col("value")))  # one zero


class Distributions:
    """Counts of value ranges of numeric columns. `measures` are columns of df that count a row: 1 or 0, for a side of a comparison.

    The first scan also takes, for each column and measure, the rows with a value, all rows, and the sum: see `facts`.
    """

    def __init__(self, df: DataFrame, names: Iterable[str], measures: Sequence[str]):
        self.names, self.measures, self.spark = list(names), list(measures), df.sparkSession
        self.cells = unpivoted(df, self.names, self.measures).withColumn("digit", first_digit(F.col("value")))
        sums = [F.sum(F.col("value") * F.col(m)).alias(f"{m}_sum") for m in self.measures]
        counts = self.cells.groupBy("feature", "digit").agg(*[F.sum(m).alias(m) for m in self.measures], *sums, F.min("value").alias("low"), F.max("value").alias("high"))
        self.first = staged(counts)

    @cached_property
    def facts(self) -> dict[str, Row]:
        """Per column and measure m: m (rows with a value), m_rows (all rows), m_sum."""
        known = F.col("digit").isNotNull()
        per = [x for m in self.measures for x in (F.coalesce(F.sum(F.when(known, F.col(m))), F.lit(0)).alias(m), F.sum(m).alias(f"{m}_rows"), F.sum(f"{m}_sum").alias(f"{m}_sum"))]
        return {r["feature"]: r for r in self.first.groupBy("feature").agg(*per).collect()}

    def _with_before(self, counts: DataFrame, by: Sequence[str], order: str) -> DataFrame:
        """Adds the counts of all smaller ranges: `<measure>_before`."""
        w = Window.partitionBy(*by).orderBy(order, "low").rowsBetween(Window.unboundedPreceding, -1)
        return counts.withColumns({f"{m}_before": F.coalesce(F.sum(m).over(w), F.lit(0)) for m in self.measures})

    def _looked_into(self, known: Mapping[str, Sequence[Range]], parts: int) -> DataFrame:
        """Counts of the parts (one part: of the values) of given ranges, with the counts below each.

        The ranges are as few as the results that they decide, so they are sent to the scan.
        """
        rows = [(n, i, r.digit, r.low, r.high, *map(int, r.before)) for n, ranges in known.items() for i, r in enumerate(ranges)]
        starts = [f"{m}_start" for m in self.measures]
        wanted = self.spark.createDataFrame(rows, "feature string, number int, digit int, _low double, _high double, " + ", ".join(f"{s} bigint" for s in starts))
        inside = self.cells.join(F.broadcast(wanted), ["feature", "digit"]).where("value BETWEEN _low AND _high")
        share = (F.col("value") / 2 - F.col("_low") / 2) / (F.col("_high") / 2 - F.col("_low") / 2)
        part = F.least(F.lit(parts - 1), F.floor(share * float(parts))).cast("int") if parts > 1 else F.col("value")
        by = ["feature", "digit", "number", *starts]
        counts = inside.groupBy(*by, part.alias("part")).agg(*[F.sum(m).alias(m) for m in self.measures], F.min("value").alias("low"), F.max("value").alias("high"))
        inner = self._with_before(counts, ["feature", "number"], "part")
        return inner.withColumns({f"{m}_before": F.col(f"{m}_before") + F.col(f"{m}_start") for m in self.measures})

    def _ranges(self, counts: DataFrame, keep: Callable[[Row], bool]) -> dict[str, list[Range]]:
        out: dict[str, list[Range]] = {}
        for r in filter(keep, counts.collect()):
            made = Range(r["digit"], r["low"], r["high"], tuple(r[m] for m in self.measures), tuple(r[f"{m}_before"] for m in self.measures))
            out.setdefault(r["feature"], []).append(made)
        return out

    def _narrowed(self, pick: Callable[[DataFrame], DataFrame], keep: Callable[[Row], bool]) -> dict[str, list[Range]]:
        """Ranges that `pick` keeps, cut until they hold one value each or at most OPEN rows, then value by value."""
        current = self._ranges(pick(self._with_before(self.first.where("digit IS NOT NULL"), ["feature"], "digit")), keep)
        done: dict[str, list[Range]] = {n: [] for n in current}
        values: dict[str, list[Range]] = {}
        while current:
            again: dict[str, list[Range]] = {}
            for n, ranges in current.items():
                for r in ranges:
                    where = done if r.single else again if sum(r.counts) > OPEN and r.divisible else values
                    where.setdefault(n, []).append(r)
            current = self._ranges(pick(self._looked_into(again, PARTS)), keep) if again else {}
        if values:
            for n, ranges in self._ranges(pick(self._looked_into(values, 1)), keep).items():
                done.setdefault(n, []).extend(ranges)
        return done

    def decide(self, quantiles: tuple[str, Sequence[float]] | None = None, gap: tuple[str, str] | None = None) -> tuple[dict[str, list[float]], dict[str, float]]:
        """Both in the same scans: exact quantiles (measure, probs) with linear interpolation, for columns with rows of that measure;
        and the largest gap between the empirical distributions of two measures (two-sample KS), for columns with rows of either.

        For the gap a range is looked into only if the gap inside it could exceed the largest one at the end of any range so far.
        """
        measure, probs = quantiles or (self.measures[0], [])
        a, b = gap or (self.measures[0], self.measures[0])
        totals = {n: r[measure] for n, r in self.facts.items() if r[measure] and probs}
        spots = {n: [(total - 1) * p for p in probs] for n, total in totals.items()}
        best = {n: 0.0 for n, r in self.facts.items() if gap and r[a] and r[b]}
        ranks = {n: sorted({min(math.floor(s) + side, totals[n] - 1) for s in at for side in (0, 1)}) for n, at in spots.items()}

        start, size = F.col(f"{measure}_before"), F.col(measure)
        holds = F.exists("_ranks", lambda r: (r >= start) & (r < start + size))
        ends = [(F.col(f"{m}_before") / F.col(f"_n_{s}"), (F.col(f"{m}_before") + F.col(m)) / F.col(f"_n_{s}")) for s, m in (("a", a), ("b", b))]
        (low_a, high_a), (low_b, high_b) = ends
        bound = F.greatest(F.abs(high_a - low_b), F.abs(low_a - high_b))
        w = Window.partitionBy("feature")

        def pick(counts: DataFrame) -> DataFrame:
            wanted = [(n, ranks.get(n, []), *((r[a], r[b], best[n]) if n in best else (None, None, None))) for n, r in self.facts.items()]
            known = self.spark.createDataFrame(wanted, "feature string, _ranks array<bigint>, _n_a bigint, _n_b bigint, _known double")
            rows = counts.join(F.broadcast(known), "feature").withColumn("_best", F.greatest("_known", F.max(F.abs(high_a - high_b)).over(w)))
            exceeds = F.coalesce((bound > F.col("_best")) & (F.col("low") < F.col("high")), F.lit(False))
            first = F.row_number().over(w.orderBy("digit", "low")) == 1  # tells the gap of a column none of whose ranges stays
            return rows.withColumns({"_open": holds | exceeds, "_first": first}).where("_open OR _first")

        def keep(row: Row) -> bool:
            if row["_best"] is not None:
                best[row["feature"]] = max(best[row["feature"]], row["_best"])
            return row["_open"]

        i = self.measures.index(measure)
        found = self._narrowed(pick, keep) if totals or best else {}
        out = {}
        for n, at in spots.items():
            held = [r for r in found[n] if r.counts[i]]

            def value(rank: int) -> float:
                return next(r.low for r in held if r.before[i] <= rank < r.before[i] + r.counts[i])

            out[n] = [interpolated(value(math.floor(s)), value(min(math.floor(s) + 1, totals[n] - 1)), s - math.floor(s)) for s in at]
        return out, best

    def below(self, points: Mapping[str, Sequence[tuple[float, bool]]]) -> dict[str, list[tuple[int, ...]]]:
        """Rows per measure below each point (value, closed) of a column, equal ones included where closed.

        Ranges of smaller first digits are added up; only cells of a point's own digit are compared with it.
        """
        rows = [(n, i, float(x), closed) for n, at in points.items() for i, (x, closed) in enumerate(at)]
        if not rows:
            return {}
        wanted = F.broadcast(self.spark.createDataFrame(rows, "feature string, _i int, _x double, _closed boolean").withColumn("_digit", first_digit(F.col("_x"))))
        under = self.first.join(wanted, "feature").where("digit < _digit").select("feature", "_i", *self.measures)
        same = self.cells.join(wanted.withColumnRenamed("_digit", "digit"), ["feature", "digit"]).where("value < _x OR _closed AND value = _x").select("feature", "_i", *self.measures)
        counts = [x.groupBy("feature", "_i").agg(*[F.sum(m).alias(m) for m in self.measures]) for x in (under, same)]
        out = {n: [(0,) * len(self.measures)] * len(at) for n, at in points.items()}
        for r in counts[0].unionByName(counts[1]).collect():
            out[r["feature"]][r["_i"]] = tuple(x + r[m] for x, m in zip(out[r["feature"]][r["_i"]], self.measures))
        return out

    def quantiles(self, measure: str, probs: Sequence[float]) -> dict[str, list[float]]:
        return self.decide(quantiles=(measure, probs))[0]

    def largest_gaps(self, a: str, b: str) -> dict[str, float]:
        return self.decide(gap=(a, b))[1]
