"""Lookup tables and decision trees of comparisons."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendframe.session import staged

#: Rows of a lookup that are sent to every executor; larger ones are joined by a shuffle.
BROADCAST_ROWS = 500_000
#: Values that may hold this share of a column's rows are mapped before such a shuffle, 1 / SUPPORT of them at most.
SUPPORT = 0.02
SPREAD = 4096


@dataclass(frozen=True)
class Lookup:
    """Part of a written table that belongs to one name, with its number of rows."""

    table: DataFrame
    rows: int


def lookups(table: DataFrame, by: str, names: list[str]) -> dict[str, Lookup]:
    """One lookup per name, read from one written table: its plan runs once, and the sizes are known when joins are planned."""
    written = staged(table)
    sizes = {r[by]: r["count"] for r in written.groupBy(by).count().collect()}
    return {n: Lookup(written.where(F.col(by) == n), sizes.get(n, 0)) for n in names}


def heavy_values(df: DataFrame, columns: Sequence[str]) -> dict[str, list]:
    """Values of each column among which are all with more than SUPPORT of its rows: one bounded pass."""
    row = df.select(*columns).freqItems(list(columns), SUPPORT).first() if columns else []
    return {c: [v for v in values if v is not None] for c, values in zip(columns, row)}


def attach_lookups(df: DataFrame, tables: dict[str, Lookup], key: str, value: str, out: str = "_found_{}") -> DataFrame:
    """df with a column for each name: the value whose key equals that column's text, null where there is none.

    A lookup within BROADCAST_ROWS is sent to the rows. For a larger one the rows go to the lookup: null and heavy values are mapped in place
    and get keys of their own, spread by the row's hash, so that no partition holds more of them than of others.
    """
    wide = [n for n, t in tables.items() if t.rows > BROADCAST_ROWS]
    heavy = heavy_values(df.select(*[F.col(f"`{n}`").cast("string").alias(n) for n in wide]), wide)
    names = list(df.columns)
    for n, lookup in tables.items():
        x = F.col(f"`{n}`").cast("string")
        table = lookup.table.select(F.col(key).cast("string").alias("_key"), F.col(value).alias(out.format(n)))
        if n not in heavy:
            df = df.join(F.broadcast(table), x == F.col("_key"), "left").drop("_key")
            continue
        known = {r[0]: r[1] for r in table.where(F.col("_key").isin(heavy[n])).collect()}  # 1 / SUPPORT rows at most
        settled = x.isNull() | x.isin(heavy[n])
        spread = F.concat(F.lit("\0"), F.pmod(F.xxhash64(*[f"`{c}`" for c in names]), F.lit(SPREAD)).cast("string"))
        tail = df.withColumn("_of", F.when(settled, spread).otherwise(x)).join(table, F.col("_of") == F.col("_key"), "left")
        found = F.col(out.format(n))
        for v, code in known.items():
            found = F.when(x == v, F.lit(code)).otherwise(found)
        df = tail.withColumn(out.format(n), found).drop("_key", "_of")
    return df


def step(value: Column, cuts: list[float], results: list[Column]) -> Column:
    """results[i] for the number i of sorted cuts <= value, as a balanced tree of comparisons."""
    if not cuts:
        return results[0]
    mid = len(cuts) // 2
    low = step(value, cuts[:mid], results[: mid + 1])
    high = step(value, cuts[mid + 1 :], results[mid + 1 :])
    return F.when(value < F.lit(cuts[mid]), low).otherwise(high)
