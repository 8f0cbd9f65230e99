"""Data contracts: derivation from a profile and validation against one.

Contracts and results are DataFrames. A broken rule becomes a row; nothing is
raised, so one run reports every problem of every table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lendframe.operators import profile as P

ROW_TOLERANCE = NULL_TOLERANCE = ORPHAN_TOLERANCE = 0.02
# Primary keys and the tables kept out of the contract.
PRIMARY_KEYS = {
    "application_train": "SK_ID_CURR",
    "application_test": "SK_ID_CURR",
    "bureau": "SK_ID_BUREAU",
    "previous_application": "SK_ID_PREV",
}
# Child table, its key, parent table, its key.
JOINS = (
    ("bureau", "SK_ID_CURR", "application_train", "SK_ID_CURR"),
    ("bureau_balance", "SK_ID_BUREAU", "bureau", "SK_ID_BUREAU"),
    ("previous_application", "SK_ID_CURR", "application_train", "SK_ID_CURR"),
    ("pos_cash_balance", "SK_ID_PREV", "previous_application", "SK_ID_PREV"),
    ("installments_payments", "SK_ID_PREV", "previous_application", "SK_ID_PREV"),
    ("credit_card_balance", "SK_ID_PREV", "previous_application", "SK_ID_PREV"),
)
REFERENCE_TABLES = ("sample_submission", "columns_description")

VIOLATION = "`table` string, `check` string, `column` string, expected string, observed string, severity string"
COLUMN_CONTRACT = (
    "`table` string, feature string, dtype string, nullable boolean, null_rate_reference double, null_rate_tolerance double,"
    " is_unique boolean, allowed_values array<string>, min_value double, max_value double"
)
TABLE_CONTRACT = "`table` string, primary_key string, row_count_reference bigint, row_count_tolerance double"
JOIN_CONTRACT = (
    "child string, child_key string, parent string, parent_key string, orphan_rate_reference double, orphan_rate_tolerance double"
)


def _all(parts: list[DataFrame], spark: SparkSession, schema: str) -> DataFrame:
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


# --- derivation -------------------------------------------------------------


def column_contract(profile: DataFrame, table: str, primary_key: str | None) -> DataFrame:
    """Contract rows of one table from its profile (V1): nullable when a null was seen, small sets frozen."""
    is_key = F.col("feature").eqNullSafe(F.lit(primary_key))
    return profile.select(
        F.lit(table).alias("table"),
        "feature",
        "dtype",
        (F.col("null_rate") > 0).alias("nullable"),
        F.col("null_rate").alias("null_rate_reference"),
        F.lit(NULL_TOLERANCE).alias("null_rate_tolerance"),
        is_key.alias("is_unique"),
        F.when(~is_key, F.col("unique_values")).alias("allowed_values"),
        F.col("min").alias("min_value"),
        F.col("max").alias("max_value"),
    )


def derive_contracts(tables: Mapping[str, DataFrame], primary_keys: Mapping[str, str] = PRIMARY_KEYS) -> tuple[DataFrame, DataFrame]:
    """(column contracts, table contracts) of all modelling tables (V1).

    The result is frozen: one local row per column, so later changes of the
    data cannot move the contract they are checked against.
    """
    columns, sizes = [], []
    for name, df in tables.items():
        if name in REFERENCE_TABLES:
            continue
        key = primary_keys.get(name)
        columns.append(column_contract(P.profile(df, None, False), name, key))
        sizes.append(
            df.agg(
                F.lit(name).alias("table"),
                F.lit(key).cast("string").alias("primary_key"),
                F.count(F.lit(1)).alias("row_count_reference"),
                F.lit(ROW_TOLERANCE).alias("row_count_tolerance"),
            )
        )
    spark = next(iter(tables.values())).sparkSession
    frozen = []
    for parts, schema in ((columns, COLUMN_CONTRACT), (sizes, TABLE_CONTRACT)):
        frozen.append(spark.createDataFrame(_all(parts, spark, schema).collect(), schema))
    return frozen[0], frozen[1]


def join_contract(child: str, child_key: str, parent: str, parent_key: str, stats: DataFrame) -> DataFrame:
    """Contract row of one join from its statistics (V1)."""
    return stats.select(
        F.lit(child).alias("child"),
        F.lit(child_key).alias("child_key"),
        F.lit(parent).alias("parent"),
        F.lit(parent_key).alias("parent_key"),
        F.col("orphan_rate").alias("orphan_rate_reference"),
        F.lit(ORPHAN_TOLERANCE).alias("orphan_rate_tolerance"),
    )


def derive_joins(tables: Mapping[str, DataFrame], joins: Sequence[tuple[str, str, str, str]] = JOINS) -> DataFrame:
    """Join contracts between the tables that are there (V1), frozen like the others."""
    parts = [
        join_contract(c, ck, p, pk, P.join_stats(tables[c], tables[p], ck, pk)) for c, ck, p, pk in joins if c in tables and p in tables
    ]
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(_all(parts, spark, JOIN_CONTRACT).collect(), JOIN_CONTRACT)


# --- validation -------------------------------------------------------------


def _text(number: Column, places: int = 4) -> Column:
    return F.round(number, places).cast("string")


def _violation(table: Column, check: str, column: Column, expected: Column, observed: Column, severity: str = "error") -> Column:
    return F.struct(
        table.alias("table"),
        F.lit(check).alias("check"),
        column.cast("string").alias("column"),
        expected.cast("string").alias("expected"),
        observed.cast("string").alias("observed"),
        F.lit(severity).alias("severity"),
    )


def row_count_check(df: DataFrame, name: str, sizes: DataFrame) -> DataFrame:
    """Row count outside reference x (1 +- tolerance) (V3)."""
    counted = df.agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("n")).join(F.broadcast(sizes), "table")
    ref, tol = F.col("row_count_reference"), F.col("row_count_tolerance")
    low, high = ref * (1 - tol), ref * (1 + tol)
    bounds = F.concat_ws(" to ", F.floor(low).cast("string"), F.floor(high).cast("string"))
    row = _violation(F.col("table"), "row_count", F.lit(None), bounds, F.col("n"))
    return counted.where(~F.col("n").between(low, high)).select(row.alias("v")).select("v.*")


def schema_check(df: DataFrame, name: str, columns: DataFrame) -> DataFrame:
    """Contracted columns that are absent (error), present columns without contract (warning) (V4)."""
    here = df.sparkSession.createDataFrame([(c,) for c in df.columns], "feature string").withColumn("present", F.lit(1))
    wanted = columns.where(F.col("table") == name).select("feature", F.lit(1).alias("wanted"))
    gaps = wanted.join(here, "feature", "full").where("present IS NULL OR wanted IS NULL")
    absent = _violation(F.lit(name), "column_present", F.col("feature"), F.lit("present"), F.lit("missing"))
    extra = _violation(F.lit(name), "column_unexpected", F.col("feature"), F.lit("not present"), F.lit("present"), "warning")
    return gaps.select(F.when(F.col("present").isNull(), absent).otherwise(extra).alias("v")).select("v.*")


def column_checks(df: DataFrame, name: str, columns: DataFrame) -> DataFrame:
    """Nullability or null-rate drift (one or the other), and value range (V5, V8): one pass over the table."""
    stats = P.column_stats(df).drop("dtype")
    rows = stats.join(F.broadcast(columns.where(F.col("table") == name)), "feature")
    rate = F.when(F.col("rows") > 0, F.col("nulls") / F.col("rows")).otherwise(0.0)
    ref, tol = F.col("null_rate_reference"), F.col("null_rate_tolerance")
    lo, hi = F.col("min_value"), F.col("max_value")
    width = F.abs(hi - lo)
    slack = 0.02 * F.when(width == 0, 1.0).otherwise(width)
    outside = (F.col("min") < lo - slack) | (F.col("max") > hi + slack)
    where, what = F.col("table"), F.col("feature")
    broken = F.array(
        F.when(
            ~F.col("nullable") & (F.col("nulls") > 0),
            _violation(where, "nullability", what, F.lit("no nulls"), _text(rate)),
        ).when(
            F.abs(rate - ref) > tol,
            _violation(where, "null_rate", what, F.concat_ws(" +- ", _text(ref), _text(tol)), _text(rate)),
        ),
        F.when(
            outside,
            _violation(
                where,
                "value_range",
                what,
                F.concat_ws(" to ", lo.cast("string"), hi.cast("string")),
                F.concat_ws(" to ", F.col("min").cast("string"), F.col("max").cast("string")),
            ),
        ),
    )
    return rows.select(F.explode(broken).alias("v")).where("v IS NOT NULL").select("v.*")


def uniqueness_checks(df: DataFrame, name: str, columns: DataFrame, keys: list[str]) -> list[DataFrame]:
    """Unique columns whose distinct count (null included) differs from the row count (V6)."""
    have = [k for k in keys if k in df.columns]
    if not have:
        return []
    row = _violation(F.lit(name), "uniqueness", F.col("key"), F.col("n_rows"), F.col("n_unique"))
    return [P.key_uniqueness(df, have).where(~F.col("is_unique")).select(row.alias("v")).select("v.*")]


def allowed_value_checks(df: DataFrame, name: str, columns: DataFrame, fixed: list[str]) -> list[DataFrame]:
    """Values outside the contracted set, reported with the first five (V7). Numbers are compared as numbers, whatever type either side has.

    A broken column may have any number of such values: they stay rows, and the
    rank that keeps five is cut before the shuffle.
    """
    have = [c for c in fixed if c in df.columns]
    if not have:
        return []
    allowed = columns.where((F.col("table") == name) & F.col("feature").isin(*have))
    numeric = [c for c in have if c in P.numeric_columns(df)]
    number = F.when(F.col("feature").isin(*numeric), F.expr("try_cast(value AS DOUBLE)").cast("string"))
    pairs = allowed.select("feature", F.explode("allowed_values").alias("value")).select("feature", F.coalesce(number, "value").alias("same"))
    seen = P.distinct_values(df, have).where("value IS NOT NULL").withColumn("same", F.coalesce(number, "value"))
    odd = seen.join(pairs, ["feature", "same"], "left_anti")
    ranked = odd.withColumn("r", F.row_number().over(Window.partitionBy("feature").orderBy("value"))).where("r <= 5")
    shown = ranked.groupBy("feature").agg(F.sort_array(F.collect_list("value")).alias("odd"))
    rows = shown.join(F.broadcast(allowed), "feature")
    row = _violation(
        F.lit(name), "allowed_values", F.col("feature"), F.array_join("allowed_values", ","), F.array_join("odd", ",")
    )
    return [rows.select(row.alias("v")).select("v.*")]


def orphan_check(child: DataFrame, parent: DataFrame, contract: Mapping[str, object]) -> DataFrame:
    """Orphan rate away from its reference by more than the tolerance (V9)."""
    stats = P.join_stats(child, parent, contract["child_key"], contract["parent_key"])
    rate = F.col("orphan_keys") / F.greatest(F.lit(1), F.col("child_unique_keys"))
    ref, tol = contract["orphan_rate_reference"], contract["orphan_rate_tolerance"]
    row = _violation(
        F.lit(contract["child"]),
        "orphan_rate",
        F.lit(contract["child_key"]),
        F.lit(f"{round(ref, 4)} +- {tol}"),
        _text(rate),
    )
    return stats.where(F.abs(rate - ref) > tol).select(row.alias("v")).select("v.*")


def validate(
    tables: Mapping[str, DataFrame], columns: DataFrame, sizes: DataFrame, joins: DataFrame | None = None
) -> tuple[DataFrame, int]:
    """(violations, number of checks) over all contracted tables and joins.

    Contract rows are read on the driver once: they decide which checks exist.
    """
    spark = sizes.sparkSession
    parts: list[DataFrame] = []
    checks = 0
    by_table: dict[str, list] = {}
    for r in columns.select("table", "feature", "is_unique", F.col("allowed_values").isNotNull().alias("fixed"), "min_value", "max_value").collect():
        by_table.setdefault(r["table"], []).append(r)
    known = [r["table"] for r in sizes.select("table").collect()]
    plain: list[tuple] = []
    for name in known:
        if name not in tables:
            plain.append((name, "file_exists", None, name, "missing", "error"))
            continue
        df, rules = tables[name], by_table.get(name, [])
        present = [r for r in rules if r["feature"] in df.columns]
        unique = [r["feature"] for r in present if r["is_unique"]]
        fixed = [r["feature"] for r in present if r["fixed"]]
        checks += 1 + (len(rules) - len(present)) + len(set(df.columns) - {r["feature"] for r in rules})
        checks += len(present) + len(unique) + len(fixed) + sum(r["min_value"] is not None and r["max_value"] is not None for r in present)
        parts += [row_count_check(df, name, sizes), schema_check(df, name, columns), column_checks(df, name, columns)]
        parts += uniqueness_checks(df, name, columns, unique) + allowed_value_checks(df, name, columns, fixed)
    for c in joins.collect() if joins is not None else []:
        if c["child"] not in known or c["parent"] not in known:
            plain.append((c["child"], "join_tables_resolvable", None, f"{c['child']} to {c['parent']}", "contract missing", "error"))
        elif c["child"] in tables and c["parent"] in tables:
            checks += 1
            parts.append(orphan_check(tables[c["child"]], tables[c["parent"]], c.asDict()))
    if plain:
        parts.append(spark.createDataFrame(plain, VIOLATION))
    return _all(parts, spark, VIOLATION), checks


def verdict(violations: DataFrame, checks: int) -> DataFrame:
    """Error and warning counts and whether the run passed."""
    out = violations.agg(
        F.lit(checks).cast("bigint").alias("checks_run"),
        F.count_if(F.col("severity") == "error").alias("errors"),
        F.count_if(F.col("severity") == "warning").alias("warnings"),
    )
    return out.withColumn("passed", F.col("errors") == 0)
