"""Key maps, checked joins and join diagnostics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class CardinalityError(ValueError):
    """A join side that had to be unique on its key is not."""


def key_map(df: DataFrame, child: str, parent: str) -> DataFrame:
    """One parent per child key (A20); deterministic if a child key repeats."""
    return df.groupBy(child).agg(F.min(parent).alias(parent))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(key).count().where("count > 1")


def assert_unique(df: DataFrame, key: str, what: str = "join side") -> DataFrame:
    """Raise when `key` repeats (A23). This is an action; pass checked tables to the lazy joins."""
    bad = duplicate_keys(df, key).take(1)
    if bad:
        raise CardinalityError(f"{what}: {key}={bad[0][0]!r} occurs {bad[0]['count']} times")
    return df


def through_parent(per_child: DataFrame, parent: DataFrame, child: str, owner: str) -> DataFrame:
    """Attach the owner of each child key and drop orphans."""
    return per_child.join(key_map(parent.select(child, owner), child, owner), child, "inner")


def join_diagnostics(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """One row: keys on the child side, matched keys, orphan keys.

    Both sides are reduced to distinct keys first, so a hot key costs one row.
    """
    left = child.select(key).where(F.col(key).isNotNull()).distinct()
    right = parent.select(key).distinct().withColumn("hit", F.lit(1))
    return left.join(right, key, "left").agg(
        F.count(F.lit(1)).alias("child_keys"),
        F.count("hit").alias("matched_keys"),
        (F.count(F.lit(1)) - F.count("hit")).alias("orphan_keys"),
    )
