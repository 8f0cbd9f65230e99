"""Exact order statistics without a single-task sort.

A window over a whole population would put it into one task. Here equal values
are first counted together (map-side) and staged, so the input is scanned once; then
each group is cut into value ranges at a hash-chosen sample of its own values. Only the per-range totals, a bounded
table, are accumulated per group; the rows are accumulated inside their range.
The cut points depend on the values alone, so re-running a lost task gives the
same ranges.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendframe.session import staged

RANGE = "_range"


def position(value: Column, cuts: Column, capacity: int) -> Column:
    """How many sorted `cuts` are <= value, by binary search (log2(capacity) steps)."""
    steps = [1 << i for i in reversed(range(max(1, math.ceil(math.log2(capacity + 1)))))]
    return F.reduce(
        F.array(*map(F.lit, steps)),
        F.lit(0),
        lambda at, step: F.when(F.get(cuts, at + step - 1) <= value, at + step).otherwise(at),
    )


def default_ranges(df: DataFrame) -> int:
    """Ranges per group: as many as shuffle partitions, so that a range is no larger than a partition of the session."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), 16)


def null_safe_join(left: DataFrame, right: DataFrame, by: Sequence[str], how: str = "inner", small: bool = False) -> DataFrame:
    """Join on `by`, where null equals null: a group named null is a group. `small`: the right side has one row per group."""
    keys = {c: f"_right_{c}" for c in by}
    right = right.withColumnsRenamed(keys)
    on = F.lit(True)
    for c, r in keys.items():
        on = on & F.col(f"`{c}`").eqNullSafe(F.col(f"`{r}`"))
    return left.join(F.broadcast(right) if small else right, on, how).drop(*keys.values())


def counted(df: DataFrame, by: Sequence[str], value: str, measures: Mapping[str, Column]) -> DataFrame:
    """Measures per distinct (by, value), null values left out, staged for the passes that follow."""
    return staged(df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(*[m.alias(n) for n, m in measures.items()]))


def ranged(
    rows: DataFrame, by: Sequence[str], value: str, names: Sequence[str], ranges: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows unique on (by, value), each tagged with its range, and the running range table.

    `by` must have few groups (features, models, splits). The range table holds,
    per group and range, `<name>_in`, `<name>_before` and `<name>_total`.
    """
    by = list(by)
    ranges = ranges or default_ranges(rows)
    sizes = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_values"))
    stride = F.greatest(F.lit(1), F.ceil(F.col("_values") / F.lit(ranges)))
    sample = attach_groups(rows.select(*by, value), sizes, by).where(F.pmod(F.xxhash64(value), stride) == 0)
    cuts = sample.groupBy(*by).agg(F.sort_array(F.collect_list(value)).alias("_cuts"))
    tagged = (
        attach_groups(rows.select(*by, value, *names), cuts, by, "left")
        .withColumn(RANGE, F.coalesce(position(F.col(value), F.col("_cuts"), 2 * ranges), F.lit(0)))
        .drop("_cuts")
    )
    w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    up_to = w.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    table = tagged.groupBy(*by, RANGE).agg(*[F.sum(n).alias(f"{n}_in") for n in names])
    table = table.select(
        "*",
        *[F.coalesce(F.sum(f"{n}_in").over(up_to), F.lit(0)).alias(f"{n}_before") for n in names],
        *[F.sum(f"{n}_in").over(w).alias(f"{n}_total") for n in names],
    )
    return tagged, table


def attach_groups(df: DataFrame, groups: DataFrame, by: list[str], how: str = "inner") -> DataFrame:
    """Attach a per-group table. It has one row per group, so it is always broadcast; without groups it is a scalar."""
    if by:
        return null_safe_join(df, groups, by, how, small=True)
    row = groups.select(F.struct(*groups.columns).alias("_whole")).scalar()
    return df.select("*", row.alias("_whole")).select(*df.columns, "_whole.*")


def running_rows(rows: DataFrame, by: Sequence[str], value: str, names: Sequence[str], ranges: int | None = None) -> DataFrame:
    """Rows unique on (by, value) with, per name, the sum over smaller values and the group total."""
    by = list(by)
    tagged, table = ranged(rows, by, value, names, ranges)
    offsets = table.drop(*[f"{n}_in" for n in names])
    inside = Window.partitionBy(*by, RANGE).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    joined = null_safe_join(tagged, offsets, [*by, RANGE], small=True)
    return joined.select(
        *by,
        value,
        *names,
        *[(F.col(f"{n}_before") + F.coalesce(F.sum(n).over(inside), F.lit(0))).alias(f"{n}_before") for n in names],
        *[f"{n}_total" for n in names],
    )


def running(
    df: DataFrame, by: Sequence[str], value: str, measures: Mapping[str, Column], ranges: int | None = None
) -> DataFrame:
    """Running sums over any rows: equal values are counted together first."""
    return running_rows(counted(df, by, value, measures), by, value, list(measures), ranges)


def quantile_probs(bins: int) -> list[float]:
    """Equally spaced probabilities from 0 to 1."""
    return [i * (1.0 / bins) for i in range(bins)] + [1.0]


def quantiles(df: DataFrame, by: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per group: `by`, `edges` (array in probs order)."""
    return quantiles_rows(counted(df, by, value, {"n": F.count(F.lit(1))}), by, value, probs, "n")


def quantiles_rows(rows: DataFrame, by: Sequence[str], value: str, probs: Sequence[float], weight: str) -> DataFrame:
    """Quantiles of rows unique on (by, value), each counting `weight` times (not at all when 0)."""
    by = list(by)
    counts = rows.where(F.col(value).isNotNull() & (F.col(weight) > 0)).select(*by, value, F.col(weight).alias("n"))
    tagged, table = ranged(counts, by, value, ["n"])

    def targets(total: Column) -> Column:
        out = []
        for i, p in enumerate(probs):
            spot = (total - 1) * F.lit(float(p))
            low = F.floor(spot)
            for side in (0, 1):
                at = F.least(low + side, total - 1)
                out.append(F.struct(F.lit(i).alias("i"), F.lit(side).alias("side"), at.alias("at"), (spot - low).alias("part")))
        return F.array(*out)

    def covering(wanted: Column, start: Column, size: Column) -> Column:
        return F.filter(wanted, lambda t: (t["at"] >= start) & (t["at"] < start + size))

    wanted = covering(targets(F.col("n_total")), F.col("n_before"), F.col("n_in"))
    # ranges without a wanted rank are dropped before anything is sorted
    spots = table.select(*by, RANGE, "n_before", wanted.alias("wanted")).where(F.size("wanted") > 0)
    inside = Window.partitionBy(*by, RANGE).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    near = null_safe_join(tagged, spots, [*by, RANGE], small=True).withColumn(
        "start", F.col("n_before") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    )
    hits = near.select(*by, F.col(value).alias("v"), F.explode(covering(F.col("wanted"), F.col("start"), F.col("n"))).alias("t"))
    pairs = hits.groupBy(*by, F.col("t.i").alias("i")).agg(
        F.max(F.when(F.col("t.side") == 0, F.col("v"))).alias("a"),
        F.max(F.when(F.col("t.side") == 1, F.col("v"))).alias("b"),
        F.max("t.part").alias("part"),
    )
    gap = F.col("b") - F.col("a")
    value_at = F.when(F.col("part") >= 0.5, F.col("b") - gap * (1 - F.col("part"))).otherwise(F.col("a") + gap * F.col("part"))
    ordered = F.sort_array(F.collect_list(F.struct("i", value_at.alias("edge"))))
    return pairs.groupBy(*by).agg(F.transform(ordered, lambda x: x["edge"]).alias("edges"))


def distinct_edges(edges: Column) -> Column:
    return F.array_sort(F.array_distinct(edges))


def long_form(df: DataFrame, keep: Sequence[str], features: Sequence[str], batch: int = 100) -> DataFrame:
    """(keep..., feature, value) with one row per feature; wide inputs go in column batches."""
    parts = []
    for start in range(0, len(features), batch):
        names = list(features[start : start + batch])
        cast = [F.col(f"`{n}`").cast("double").alias(n) for n in names]
        parts.append(df.select(*keep, *cast).unpivot(list(keep), names, "feature", "value"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
