"""Missing indicators, category codes and feature typing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendframe.functions import columns as C
from lendframe.functions import ordered as O
from lendframe.functions.sizing import attach_lookups, lookups
from lendframe.functions.radix import per_column
from lendframe.operators.profile import distinct_values, low_cardinality

KEY, TARGET = "SK_ID_CURR", "TARGET"
# The five features that get a missing indicator.
MISSING_INDICATOR_FEATURES = (
    "cc_utilization_last",
    "cc_balance_last",
    "bb_max_status_max",
    "bb_months_at_3_plus_total",
    "bureau_credit_sum_overdue_max",
)
CATEGORICAL_LIMIT = 20


def missing_indicators(df: DataFrame, features: Sequence[str] = MISSING_INDICATOR_FEATURES) -> DataFrame:
    """`<feature>_is_null` as 0/1; absent features are skipped."""
    have = [f for f in features if f in df.columns]
    return df.select("*", *[F.col(f).isNull().cast("int").alias(f"{f}_is_null") for f in have])


def string_columns(df: DataFrame, exclude: Sequence[str] = (KEY, TARGET)) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def category_codes(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, category, code): rank of each training category in sorted order, from 0."""
    long = train.select(*columns).unpivot([], list(columns), "feature", "category")
    ranked = O.running(long, ["feature"], "category", {"one": F.max(F.lit(1))})
    return ranked.select("feature", "category", F.col("one_before").cast("int").alias("code"))


def encode_categories(df: DataFrame, codes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace categories by their codes; null and unseen become -1 (B8). How a category's code table is joined depends on its size."""
    found = attach_lookups(df, lookups(codes, "feature", list(columns)), "category", "code")
    ready = [F.coalesce(F.col(f"`_found_{c}`"), F.lit(-1)).alias(c) if c in columns else F.col(f"`{c}`") for c in df.columns]
    return found.select(*ready)


def encode_splits(train: DataFrame, *others: DataFrame) -> list[DataFrame]:
    """Indicators, codes fitted on train, and column order for all splits."""
    columns = string_columns(train)
    codes = category_codes(train, columns) if columns else None
    out = []
    for df in (train, *others):
        ready = missing_indicators(df)
        if codes is not None:
            ready = encode_categories(ready, codes, columns)
        out.append(C.ordered_columns(ready, KEY, last=[TARGET] if TARGET in df.columns else []))
    return out


def feature_types(df: DataFrame, exclude: Sequence[str] = (KEY, TARGET)) -> DataFrame:
    """(feature, distinct_capped, nulls, kind): constant, categorical or numerical.

    Integers count as categorical only when they have no null and at most 20
    values: a nullable integer is a float in the lending tables. Exact distinct
    counts are taken only where a sketch says the column is narrow; the others
    report 21.
    """
    fields = [f for f in df.schema.fields if f.name not in exclude]
    names = [f.name for f in fields]
    over = CATEGORICAL_LIMIT + 1
    narrow = low_cardinality(df, names, CATEGORICAL_LIMIT)
    nulls = per_column(df, names, {"nulls": lambda c: F.count_if(c.isNull())})
    counts = distinct_values(df, narrow).groupBy("feature").agg(F.count("value").alias("distinct"))
    out = nulls.join(F.broadcast(counts), "feature", "left")
    capped = F.when(F.col("feature").isin(*narrow), F.least(F.lit(over), F.coalesce("distinct", F.lit(0)))).otherwise(over)
    whole = F.col("feature").isin(*[f.name for f in fields if isinstance(f.dataType, T.IntegralType)])
    number = F.col("feature").isin(*[f.name for f in fields if isinstance(f.dataType, T.NumericType)])
    kind = (
        F.when(F.col("distinct_capped") <= 1, "constant")
        .when(whole & (F.col("nulls") == 0) & (F.col("distinct_capped") <= CATEGORICAL_LIMIT), "categorical")
        .when(number, "numerical")
        .otherwise("categorical")
    )
    out = out.select("feature", capped.cast("bigint").alias("distinct_capped"), "nulls")
    return out.withColumn("kind", kind)
