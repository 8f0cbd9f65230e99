"""Stratified split by key hash, its checks, and its application."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendframe.functions.ordered import attach_groups

KEY, TARGET = "SK_ID_CURR", "TARGET"
SEED = 42
FRACTIONS = {"dev": 0.70, "val": 0.15, "test": 0.15}
RATE_TOLERANCE = 0.005
RATE_NOTE = 0.002
BUCKET_DIGITS = 4
#: Class of the rows without a target.
NO_TARGET = -(2**31)


def check_fractions(fractions: dict[str, float]) -> None:
    if abs(sum(fractions.values()) - 1.0) > 1e-9:
        raise ValueError(f"split fractions must sum to 1, got {fractions}")


def target_preconditions(df: DataFrame, key: str = KEY, target: str = TARGET) -> DataFrame:
    """One row: rows, distinct keys, null targets, targets outside {0, 1}, and whether all is well."""
    for name in (key, target):
        if name not in df.columns:
            raise KeyError(f"column {name!r} not found")
    # counts per key first: a plain aggregate over unique keys, never one set in one task
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col(target).isNull().cast("int")).alias("nulls"),
        F.sum((~F.col(target).isin(0, 1)).cast("int")).alias("odd"),
        F.sum(F.when(F.col(target) == 1, 1).otherwise(0)).alias("pos"),
    )
    out = per_key.agg(
        F.sum("n").alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.sum("nulls").alias("null_targets"),
        F.coalesce(F.sum("odd"), F.lit(0)).alias("odd_targets"),
        F.sum("pos").alias("positives"),
    )
    return out.withColumn("ok", (F.col("n_rows") == F.col("n_keys")) & (F.col("null_targets") == 0) & (F.col("odd_targets") == 0))


def require_target(df: DataFrame, key: str = KEY, target: str = TARGET) -> DataFrame:
    """Raise unless the preconditions hold. This is an action."""
    row = target_preconditions(df, key, target).first()
    if not row["ok"]:
        raise ValueError(f"target preconditions failed: {row.asDict()}")
    return df


def _rounded(share: float, count: Column) -> Column:
    return F.floor(F.lit(share) * count + 0.5).cast("bigint")


def stratified_split(
    df: DataFrame, key: str = KEY, target: str = TARGET, fractions: dict[str, float] = FRACTIONS, seed: int = SEED
) -> DataFrame:
    """(key, split) with exact per-class quotas, decided by the order of md5(seed, key).

    Sizes of test and val are rounded for the whole table and for the positives;
    the negatives take the rest. The hash is uniform, so its leading hex digits
    cut every class into equal ranges, and the range totals tell the split of
    every range but those a quota ends in. Only the keys of those few ranges are
    ranked; all others get their split without a shuffle. Rows without a target
    are a class of their own with its own quotas.
    """
    check_fractions(fractions)
    hashed = df.select(key, F.coalesce(F.col(target).cast("int"), F.lit(NO_TARGET)).alias("_y"), F.md5(F.concat(F.lit(f"{seed}-"), F.col(key).cast("string"))).alias("_h"))
    hashed = hashed.withColumn("_b", F.substring("_h", 1, BUCKET_DIGITS))
    sizes = hashed.groupBy("_y", "_b").agg(F.count(F.lit(1)).alias("_n"))
    known = F.when(F.col("_y") != NO_TARGET, F.col("_n")).otherwise(0)
    counts = sizes.agg(F.sum(known).alias("all"), *(F.sum(F.when(F.col("_y") == y, F.col("_n")).otherwise(0)).alias(n) for y, n in ((1, "pos"), (NO_TARGET, "open"))))
    before = Window.partitionBy("_y").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    # at most 16^4 ranges per class
    ranges = attach_groups(sizes.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))), counts, [])

    def quota(name: str) -> Column:
        pos = _rounded(fractions[name], F.col("pos"))
        open_ = _rounded(fractions[name], F.col("open"))
        return F.when(F.col("_y") == 1, pos).when(F.col("_y") == NO_TARGET, open_).otherwise(_rounded(fractions[name], F.col("all")) - pos)

    def named(rank: Column) -> Column:
        return F.when(rank <= F.col("_test"), "test").when(rank <= F.col("_val"), "val").otherwise("dev")

    ranges = ranges.withColumns({"_test": quota("test"), "_val": quota("test") + quota("val")})
    first, last = named(F.col("_start") + 1), named(F.col("_start") + F.col("_n"))
    ranges = ranges.select("_y", "_b", "_start", "_test", "_val", first.alias("_first"), (first == last).alias("_whole_range"))
    whole = F.broadcast(ranges.where("_whole_range").select("_y", "_b", F.col("_first").alias("split")))
    broken = F.broadcast(ranges.where("NOT _whole_range"))
    inside = Window.partitionBy("_y", "_b").orderBy("_h", key)
    ranked = hashed.join(broken, ["_y", "_b"]).withColumn("_rank", F.col("_start") + F.row_number().over(inside))
    decided = hashed.join(whole, ["_y", "_b"]).select(key, "split")
    return decided.unionByName(ranked.select(key, named(F.col("_rank")).alias("split")))


def split_checks(
    df: DataFrame, splits: DataFrame, key: str = KEY, target: str = TARGET, fractions: dict[str, float] = FRACTIONS
) -> DataFrame:
    """One row per split: size against plan, class rate against the whole, overlap and coverage."""
    joined = df.select(key, target).join(splits, key, "full")
    per_key = joined.groupBy(key).agg(
        F.count_distinct("split").alias("names"), F.max("split").alias("split"), F.max(target).alias("y"), F.count(target).alias("hits")
    )
    per_split = per_key.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("y").alias("positives"),
        F.sum((F.col("names") > 1).cast("int")).alias("overlaps"),
        F.sum((F.col("hits") == 0).cast("int")).alias("extra"),
    )
    whole = per_split.agg(
        F.sum("n").alias("_n"),
        F.sum("positives").alias("_p"),
        F.sum("overlaps").alias("overlapping_keys"),
        F.sum("extra").alias("extra_keys"),
        F.sum(F.when(F.col("split").isNull(), F.col("n")).otherwise(0)).alias("missing_keys"),
    )
    share = F.lit(None).cast("double")
    for name, fraction in fractions.items():
        share = F.when(F.col("split") == name, F.lit(fraction)).otherwise(share)
    rate, overall = F.col("positives") / F.col("n"), F.col("_p") / F.col("_n")
    out = attach_groups(per_split.where(F.col("split").isNotNull()).drop("overlaps", "extra"), whole, [])
    planned = F.floor(share * F.col("_n") + 0.5).cast("bigint")
    return out.select(
        "split",
        "n",
        planned.alias("planned"),
        (F.abs(F.col("n") - planned) <= 1).alias("size_ok"),
        rate.alias("positive_rate"),
        (F.abs(rate - overall) <= RATE_TOLERANCE).alias("rate_ok"),
        (F.abs(rate - overall) > RATE_NOTE).alias("rate_note"),
        "overlapping_keys",
        "extra_keys",
        "missing_keys",
    )


def require_splits(df: DataFrame, splits: DataFrame, key: str = KEY, target: str = TARGET) -> DataFrame:
    """Raise unless every split has its planned size and class rate and each key lies in exactly one (B5). This is an action.

    In tables so small that a whole row moves the rate by more than the tolerance, the rate is not held against them.
    """
    for row in split_checks(df, splits, key, target).collect():
        odd = row["overlapping_keys"] or row["extra_keys"] or row["missing_keys"] or not row["size_ok"]
        if odd or (not row["rate_ok"] and row["n"] * RATE_TOLERANCE >= 1):
            raise ValueError(f"split check failed: {row.asDict()}")
    return splits


def apply_splits(df: DataFrame, splits: DataFrame, key: str = KEY) -> DataFrame:
    """Rows with their split, by key."""
    return df.join(splits, key, "inner")


def split_frames(df: DataFrame, splits: DataFrame, key: str = KEY) -> dict[str, DataFrame]:
    tagged = apply_splits(df, splits, key)
    return {name: tagged.where(F.col("split") == name).drop("split") for name in FRACTIONS}


def split_parts(laid_out: DataFrame) -> dict[str, DataFrame]:
    """The splits of a matrix whose files are laid out by split: each reads its own folders."""
    return {name: laid_out.where(F.col("split") == name).drop("split") for name in FRACTIONS}


def check_split_total(df: DataFrame, splits: DataFrame, key: str = KEY) -> None:
    """Raise unless the split table covers the input exactly. This is an action."""
    left, right = df.count(), apply_splits(df, splits, key).count()
    if left != right:
        raise ValueError(f"splits hold {right} rows, input has {left}")
