"""Full-data profiling (P1-P15). Every statistic is an aggregate over the whole table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendframe.functions import ordered as O
from lendframe.functions.radix import Distributions, per_column
from lendframe.session import staged

DISTINCT_LIMIT = 50
PREVIEW = 5
SAMPLE_PROBS = {"p01": 0.01, "p50": 0.5, "p99": 0.99}
SENTINEL = "XNA"


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def low_cardinality(df: DataFrame, names: Sequence[str], limit: int = DISTINCT_LIMIT) -> list[str]:
    """Columns that may have at most `limit` distinct values, by sketch with a wide margin.

    This is an action; it returns column names only.
    """
    names = list(names)
    if not names:
        return []
    row = per_column(df, names, {"n": lambda c: F.approx_count_distinct(c)}).where(F.col("n") <= 2 * limit + 10)
    hit = {r["feature"] for r in row.collect()}
    return [n for n in names if n in hit]


def distinct_values(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(feature, value as text) over the distinct values of narrow columns, null included."""
    names = list(names)
    if not names:
        return df.sparkSession.createDataFrame([], "feature string, value string")
    text = df.select(*[F.col(f"`{n}`").cast("string").alias(n) for n in names])
    return text.unpivot([], names, "feature", "value").distinct()


def value_sets(df: DataFrame, names: Sequence[str] | None = None, limit: int = DISTINCT_LIMIT) -> DataFrame:
    """(feature, n_unique, unique_values, sample_values) for columns with at most `limit` values.

    Numbers sort as numbers. The set is collected only for columns the sketch
    calls narrow, so it is bounded.
    """
    narrow = low_cardinality(df, list(names or df.columns), limit)
    keyed = F.struct(F.expr("try_cast(value AS DOUBLE)").alias("number"), F.col("value").alias("text"))
    sets = distinct_values(df, narrow).where("value IS NOT NULL").groupBy("feature").agg(F.sort_array(F.collect_set(keyed)).alias("s"))
    values = F.transform("s", lambda x: x["text"])
    return sets.where(F.size("s") <= limit).select(
        "feature", F.size("s").cast("bigint").alias("n_unique"), values.alias("unique_values"), F.slice(values, 1, PREVIEW).alias("sample_values")
    )


def value_preview(df: DataFrame, names: Sequence[str] | None = None, n: int = PREVIEW) -> DataFrame:
    """(feature, sample_values): the n smallest different values of every column, numbers by size.

    The rule is over the whole table, so it does not depend on the order of rows or files. Each of n passes takes the next larger value of
    all columns at once; nothing is shuffled but one row a task.
    """
    names = list(names if names is not None else df.columns)
    numeric, found = set(numeric_columns(df)), {c: [] for c in names}

    def key(c: str) -> Column:
        text = F.col(f"`{c}`").cast("string")
        number = F.col(f"`{c}`").cast("double") if c in numeric else text.try_cast("double")
        return F.when(text.isNotNull(), F.struct(number.alias("number"), text.alias("text")))

    for _ in range(n):
        left = [c for c in names if not found[c] or found[c][-1]]

        def following(c: str) -> Column:
            last = found[c][-1] if found[c] else None
            beyond = F.struct(F.lit(last["number"]).cast("double").alias("number"), F.lit(last["text"]).alias("text")) if last else None
            return F.min(key(c) if last is None else F.when(key(c) > beyond, key(c))).alias(f"c{names.index(c)}")

        for start in range(0, len(left), 150):
            chunk = left[start : start + 150]
            row = df.agg(*[following(c) for c in chunk]).first()
            for c in chunk:
                found[c].append(row[f"c{names.index(c)}"])
    rows = [(c, [v["text"] for v in values if v]) for c, values in found.items()]
    return df.sparkSession.createDataFrame([r for r in rows if r[1]], "feature string, sample_values array<string>")


def column_stats(df: DataFrame) -> DataFrame:
    """Rows, nulls, null rate, min and max per column (P1-P3); min and max only for numbers."""
    numeric = set(numeric_columns(df))
    base = {
        "rows": lambda c: F.count(F.lit(1)),
        "nulls": lambda c: F.count_if(c.isNull()),
    }
    number = {**base, "min": lambda c: F.min(c).cast("double"), "max": lambda c: F.max(c).cast("double")}
    number |= {"mean": lambda c: F.avg(c), "std": lambda c: F.stddev_samp(c)}
    none = {s: (lambda c: F.lit(None).cast("double")) for s in ("min", "max", "mean", "std")}
    groups = ([n for n in df.columns if n in numeric], number), ([n for n in df.columns if n not in numeric], {**base, **none})
    parts = [per_column(df, names, stats) for names, stats in groups if names]
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    rate = F.round(F.col("nulls") / F.nullif(F.col("rows"), F.lit(0)), 6)
    types = F.create_map(*[F.lit(x) for n, t in df.dtypes for x in (n, t)])
    return out.withColumns({"null_rate": F.coalesce(rate, F.lit(0.0)), "dtype": F.element_at(types, F.col("feature"))})


def quantile_table(df: DataFrame, names: Sequence[str], exact: bool = True, accuracy: int = 10000) -> DataFrame:
    """p01, p50, p99 per numeric column (P5), exact with interpolation or by bounded sketch."""
    probs = list(SAMPLE_PROBS.values())
    if exact:
        found = Distributions(df.select("*", F.lit(1).alias("_row")), names, ["_row"]).quantiles("_row", probs)
        return df.sparkSession.createDataFrame([(n, *edges) for n, edges in found.items()], "feature string, " + ", ".join(f"{n} double" for n in SAMPLE_PROBS))
    edges = per_column(df, names, {"edges": lambda c: F.percentile_approx(c.cast("double"), probs, accuracy)})
    return edges.select("feature", *[F.get("edges", F.lit(i)).alias(n) for i, n in enumerate(SAMPLE_PROBS)])


def profile(df: DataFrame, exact_quantiles: bool | None = True, previews: bool = True) -> DataFrame:
    """One row per column: counts, range, moments, quantiles, small value sets and previews.

    Quantiles: exact, by sketch, or (None) left out. Columns without a value set have their smallest values as preview.
    """
    numeric = numeric_columns(df)
    out = column_stats(df)
    if numeric and exact_quantiles is not None:
        out = out.join(quantile_table(df, numeric, exact_quantiles), "feature", "left")
    sets = staged(value_sets(df))
    wide = sorted(set(df.columns) - {r["feature"] for r in sets.select("feature").collect()})
    preview = value_preview(df, wide).withColumnRenamed("sample_values", "_preview") if previews and wide else None
    out = out.join(sets, "feature", "left")
    if preview is None:
        return out
    return out.join(preview, "feature", "left").withColumn("sample_values", F.coalesce("sample_values", "_preview")).drop("_preview")


def key_uniqueness(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys (null counts as one), nulls, duplicates per key column."""
    parts = []
    for k in keys:
        counts = df.groupBy(F.col(k).alias("k")).agg(F.count(F.lit(1)).alias("n"))
        parts.append(
            counts.agg(
                F.lit(k).alias("key"),
                F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
                F.count(F.lit(1)).alias("n_unique"),
                F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("n"))), F.lit(0)).alias("n_null"),
                F.max("n").alias("largest_group"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    duplicates = F.col("n_rows") - F.col("n_unique")
    return out.withColumns({"duplicates": duplicates, "is_unique": duplicates == 0})


def join_stats(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows and keys, orphan keys and rate, covered share of the parent (P10).

    Both sides shrink to one row per key before they meet.
    """
    left = child.groupBy(F.col(child_key).alias("k")).agg(F.count(F.lit(1)).alias("child_rows"))
    right = parent.select(F.col(parent_key).alias("k")).where("k IS NOT NULL").distinct().withColumn("hit", F.lit(1))
    both = left.join(right, "k", "full")
    keyed = F.col("k").isNotNull()
    is_child, is_parent = F.col("child_rows").isNotNull() & keyed, F.col("hit").isNotNull()
    row = both.agg(
        F.coalesce(F.sum("child_rows"), F.lit(0)).alias("child_rows"),
        F.count_if(is_child).alias("child_unique_keys"),
        F.count_if(is_parent).alias("parent_unique_keys"),
        F.count_if(is_child & ~is_parent).alias("orphan_keys"),
        F.count_if(is_child & is_parent).alias("matched_keys"),
    )
    return row.withColumns(
        {
            "orphan_rate": F.round(F.col("orphan_keys") / F.greatest(F.lit(1), F.col("child_unique_keys")), 6),
            "coverage_of_parent": F.round(F.col("matched_keys") / F.greatest(F.lit(1), F.col("parent_unique_keys")), 6),
        }
    )


def target_profile(df: DataFrame, target: str) -> DataFrame:
    """Rows per target value, null included, with the share of all rows and the positive rate."""
    counts = df.groupBy(F.col(target).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    whole = counts.agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
        (F.sum(F.when(F.col("value").isNotNull(), F.col("value") * F.col("n"))) / F.sum(F.when(F.col("value").isNotNull(), F.col("n")))).alias(
            "positive_rate"
        ),
    )
    return O.attach_groups(counts, whole, [])


def sentinel_profile(df: DataFrame, columns: Sequence[str], sentinel: str = SENTINEL) -> DataFrame:
    """Sentinel count, null count and distinct values (null included) per text column."""
    long = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns]).unpivot([], list(columns), "feature", "value")
    cells = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))

    def total(test: Column) -> Column:
        return F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0))

    return cells.groupBy("feature").agg(
        total(F.col("value") == sentinel).alias("sentinel_count"),
        total(F.col("value").isNull()).alias("null_count"),
        F.count(F.lit(1)).alias("n_distinct"),
    )


def cooccurrence(df: DataFrame, a: Column, b: Column) -> DataFrame:
    """Counts of A, B, both, A only, B only."""
    a, b = F.coalesce(a, F.lit(False)), F.coalesce(b, F.lit(False))
    return df.agg(
        F.count_if(a).alias("a"),
        F.count_if(b).alias("b"),
        F.count_if(a & b).alias("both"),
        F.count_if(a & ~b).alias("a_only"),
        F.count_if(~a & b).alias("b_only"),
    )


def cooccurrence_rows(df: DataFrame, a: Column, b: Column, n: int = 10) -> DataFrame:
    """A few rows where either condition holds."""
    return df.where(a | b).limit(n)


def sum_checks(df: DataFrame, parts: Sequence[str], total: str, rates: Sequence[str] = ()) -> DataFrame:
    """Rows whose parts add up to the total, rows where not, and rates outside [0, 1]."""
    whole = sum((F.col(p) for p in parts[1:]), F.col(parts[0]))
    return df.agg(
        F.count_if(whole == F.col(total)).alias("matches"),
        F.count_if(~(whole.eqNullSafe(F.col(total)))).alias("mismatches"),
        *[F.count_if((F.col(r) < 0) | (F.col(r) > 1)).alias(f"{r}_out_of_range") for r in rates],
    )


def coded_distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows per code, null included."""
    return df.groupBy(F.col(column).alias("code")).agg(F.count(F.lit(1)).alias("n"))


def encoded_checks(df: DataFrame, target: str, indicators: Mapping[str, str], codes: Sequence[str]) -> DataFrame:
    """Per encoded matrix: rows, target mean, indicator mismatches, unseen codes.

    `indicators` maps an indicator column to the feature it describes.
    """
    wrong = [F.count_if(F.col(i) != F.col(f).isNull().cast("int")).alias(f"{i}_mismatches") for i, f in indicators.items()]
    unseen = [F.count_if(F.col(c) == -1).alias(f"{c}_unseen") for c in codes]
    return df.agg(F.count(F.lit(1)).alias("rows"), F.avg(target).alias("target_mean"), *wrong, *unseen)


def same_columns(*frames: DataFrame) -> bool:
    """Whether all matrices share one column list."""
    return all(f.columns == frames[0].columns for f in frames)
