"""Null, tie and empty-group edges of the roll-up primitives."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendframe.functions import columns as C
from lendframe.operators import assemble as A
from lendframe.operators import joins as J
from lendframe.operators import rollups as R
from verification import roles
from verification.queries import QUERIES


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_last_non_null_skips_nulls_but_argmax_keeps_them(spark):
    df = spark.createDataFrame([(1, 10, None), (1, 5, 7.0)], "k int, o int, v double")
    r = one(df.groupBy("k").agg(C.last_non_null(F.col("v"), F.col("o")).alias("last"), C.row_at_max(["v"], "o").alias("best")))
    assert r["last"] == 7.0 and r["best"]["v"] is None


def test_last_non_null_puts_null_order_last_and_breaks_ties_by_value(spark):
    df = spark.createDataFrame([(1, None, 3.0), (1, 9, 8.0), (2, 4, 1.0), (2, 4, 2.0)], "k int, o int, v double")
    rows = {r["k"]: r["v"] for r in df.groupBy("k").agg(C.last_non_null(F.col("v"), F.col("o")).alias("v")).collect()}
    assert rows == {1: 3.0, 2: 2.0}


def test_null_group_sums_and_counts(spark):
    df = spark.createDataFrame([(1, None), (1, None)], "k int, v double")
    r = one(df.groupBy("k").agg(F.sum("v").alias("s"), C.count_where(F.col("v") > 0).alias("c"), F.stddev_samp("v").alias("sd")))
    assert (r["s"], r["c"], r["sd"]) == (None, 0, None)


def test_known_and_residual_counts(spark):
    df = spark.createDataFrame([(1, "Active"), (1, None), (1, "odd"), (1, "Amortized debt")], "k int, s string")
    r = one(df.groupBy("k").agg(*C.known_counts(F.col("s"), R.POS_STATUS, "n_"), C.residual_count(F.col("s"), R.POS_STATUS).alias("n_other")))
    assert r["n_active"] == 1 and r["n_amortized_debt"] == 1 and r["n_other"] == 2 and r["n_demand"] == 0


def test_ratio_without_due_amount(spark):
    rows = [(1, 1, 1.0, 1, 0.0, 3.0, 0.0, 5.0)]
    df = spark.createDataFrame(
        rows,
        "SK_ID_PREV int, SK_ID_CURR int, NUM_INSTALMENT_VERSION double, NUM_INSTALMENT_NUMBER int, DAYS_INSTALMENT double,"
        " DAYS_ENTRY_PAYMENT double, AMT_INSTALMENT double, AMT_PAYMENT double",
    )
    r = one(R.installments_per_loan(df))
    assert r["inst_prev_payment_ratio_mean"] is None and r["inst_prev_underpaid_count"] == 0
    assert r["inst_prev_delay_positive_count"] == 1 and r["inst_prev_delay_std"] is None
    assert r["inst_prev_count_distinct_versions"] == 1


def test_bureau_months_without_numeric_status(spark):
    df = spark.createDataFrame([(1, -1, " c "), (1, -2, "X")], "SK_ID_BUREAU int, MONTHS_BALANCE int, STATUS string")
    r = one(R.bureau_months(df))
    assert (r["bb_max_status"], r["bb_mean_status"], r["bb_count_months"]) == (None, None, 2)
    assert (r["bb_ever_closed"], r["bb_ever_unknown"]) == (1, 1)


def test_previous_skips_absent_columns(spark):
    df = spark.createDataFrame([(1, 9, "Approved", -5), (2, 9, "Refused", -5)], "SK_ID_PREV int, SK_ID_CURR int, NAME_CONTRACT_STATUS string, DAYS_DECISION int")
    r = one(R.rollup_previous(df))
    assert r["prev_approval_rate"] == 0.5 and "prev_amt_credit_sum" not in r.asDict()
    # equal days: the larger loan key decides
    assert r["prev_last_name_contract_status"] == 1


def test_feature_counts_per_family(spark, sf_dir):
    from verification.queries import _families

    sizes = {name: len(df.columns) - 1 for name, df in _families(spark, sf_dir).items()}
    assert sizes == {"bureau": 38, "previous_application": 76, "pos_cash": 35, "installments": 30, "credit_card": 58}


def test_assembly_keeps_rows_and_fills_flags(spark):
    base = spark.createDataFrame([(1, 0, 5.0), (2, 1, None)], "SK_ID_CURR int, TARGET int, b double")
    fam = spark.createDataFrame([(1, 3.0, 9.0, 1)], "SK_ID_CURR int, inst_x double, b double, has_installment_history int")
    out = A.assemble(base, {"installments": fam})
    assert out.columns == ["SK_ID_CURR", "TARGET", "b", "b_installments", "has_installment_history", "inst_x"]
    rows = {r["SK_ID_CURR"]: r for r in out.collect()}
    assert rows[2]["has_installment_history"] == 0 and rows[2]["inst_x"] is None and rows[1]["b_installments"] == 9.0


def test_checked_join_raises_on_duplicates(spark):
    import pytest

    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    with pytest.raises(J.CardinalityError):
        J.assert_unique(df, "k")
    J.assert_unique(df.distinct(), "k")


def test_catalogue_names_aggregations(spark, sf_dir, tmp_path):
    df = R.rollup_previous(roles.previous_application(spark, sf_dir))
    df.write.parquet(str(tmp_path / "rolled"))
    for rolled in (df, spark.read.parquet(str(tmp_path / "rolled"))):  # the marks survive a file
        kinds = {r[0]: r[2] for r in A.family_catalogue(rolled, "previous_application")}
        want = {"prev_last_amt_credit": "last", "prev_refusal_rate": "rate", "prev_count_total": "count", "prev_amt_credit_mean": "mean", "prev_amt_credit_sum": "sum", "has_previous_application": "presence"}
        assert {k: kinds[k] for k in want} == want and "derived" not in kinds.values()


@pytest.mark.parametrize("family", ["installments", "bureau", "previous", "pos_cash", "credit_card"])
def test_rollups_use_the_hash_aggregate(spark, sf_dir, family):
    plan = QUERIES[f"rollup_{family}"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_last_non_null_ties(spark):
    rows = [(1, 5, 2.5), (1, 5, 2.25), (1, 4, 9.0), (2, 3, None), (2, 1, -1.5), (2, 1, -1.25), (3, None, 0.1), (3, 7, 8.0), (4, 1, None), (5, -3, float("nan")), (5, -4, 1.0)]
    df = spark.createDataFrame(rows, "k int, o int, v double")
    got = {r.k: r.v for r in df.groupBy("k").agg(C.last_non_null(F.col("v"), F.col("o")).alias("v")).collect()}
    assert got.pop(5) != got[1] and got == {1: 2.5, 2: -1.25, 3: 0.1, 4: None}


@pytest.mark.parametrize(
    "rows,want",
    [
        ([(20250131, 1.0), (20250201, 2.0), (20241231, 9.0)], 2.0),
        ([(1, 2e13), (1, 3e13), (1, 2.5e13)], 3e13),
        ([(1, 1e-17), (1, 3e-17), (1, 2e-17)], 3e-17),
        ([(9_999_999, 5.0), (None, 1.0)], 1.0),
        ([(2**62 - 2, 5.0), (2**61, 9.0), (-(2**62) + 1, 9.0)], 5.0),
        ([(1, -5e-324), (1, -1e-323), (1, -0.0)], 0.0),
        ([(1, 1.7e308), (1, float("inf")), (0, float("nan"))], float("inf")),
    ],
)
def test_last_non_null_over_the_whole_range(spark, rows, want):
    df = spark.createDataFrame(rows, "o bigint, v double")
    assert df.agg(C.last_non_null(F.col("v"), F.col("o")).alias("v")).first()["v"] == want


def test_versions_are_parts_only_where_they_must(spark):
    """Any double may be a version; a loan with usual versions is one row of the first aggregate."""
    versions = [0.0, -0.0, 1.0, 1.0, 61.0, 62.0, 185.0, 186.0, 1.5, -1.0, float("nan"), float("nan"), float("inf"), 1e300, None]
    rows = [(1, v, i) for i, v in enumerate(versions)] + [(2, float(v % 3), v) for v in range(9)] + [(3, None, 0)]
    df = spark.createDataFrame(rows, "SK_ID_PREV bigint, NUM_INSTALMENT_VERSION double, NUM_INSTALMENT_NUMBER bigint").select(
        "*", *[F.col("NUM_INSTALMENT_NUMBER").cast("double").alias(c) for c in ("DAYS_INSTALMENT", "DAYS_ENTRY_PAYMENT", "AMT_INSTALMENT", "AMT_PAYMENT")]
    )
    out = R.installments_per_loan(df)
    found = {r["SK_ID_PREV"]: (r["inst_prev_count_distinct_versions"], r["inst_prev_count_installments"]) for r in out.collect()}
    assert found == {1: (11, 15), 2: (3, 9), 3: (0, 1)}
    assert "_odd" in out._jdf.queryExecution().optimizedPlan().toString() and dict(out.dtypes)["inst_prev_count_distinct_versions"] == "bigint"


def test_rank_is_made_once(spark):
    """The logarithm of a value stands outside every conditional expression, where Spark makes it once for a row."""
    plan = spark.range(9).select(C.last_order(F.col("id").cast("double"), F.col("id")).alias("k"))._jdf.queryExecution().optimizedPlan().toString()
    assert "LOG2" in plan.upper() and "CASE WHEN" not in plan.split("LOG2")[-1]


def test_whole_rank_counts_doubles(spark):
    rng = np.random.default_rng(0)
    bits = np.concatenate([rng.integers(0, 0x7FF0000000000001, 20_000), np.arange(2047) << 52, (np.arange(1, 2047) << 52) - 1, np.arange(50)]).astype(np.int64)
    rows = [(float(v), int(b)) for v, b in zip(bits.view(np.float64), bits)]
    df = spark.createDataFrame(rows + [(-v, -b) for v, b in rows], "v double, b bigint")
    assert df.where(C.whole_rank(F.col("v")) != F.col("b")).count() == 0


def test_repeated_rollup_key_is_refused(spark):
    base = spark.createDataFrame([(1, 0), (2, 1)], "SK_ID_CURR int, TARGET int")
    rolled = spark.createDataFrame([(1, 5, 1), (1, 6, 1)], "SK_ID_CURR int, x int, has_bureau_history int")
    with pytest.raises(J.CardinalityError):
        A.assemble(base, {"bureau": rolled}, check=True)


def test_hot_applicant(spark):
    """One applicant owns a third of all rows: the result stays whole."""
    n = 3000
    df = spark.range(n).select(
        F.col("id").alias("SK_ID_BUREAU"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") + 10).alias("SK_ID_CURR"),
        F.lit("Active").alias("CREDIT_ACTIVE"),
        *[F.lit(-1).alias(c) for c in ("DAYS_CREDIT", "CNT_CREDIT_PROLONG", "DAYS_CREDIT_UPDATE")],
        *[
            F.lit(2.0).alias(c)
            for c in (
                "DAYS_CREDIT_ENDDATE DAYS_ENDDATE_FACT AMT_CREDIT_MAX_OVERDUE AMT_CREDIT_SUM AMT_CREDIT_SUM_DEBT AMT_CREDIT_SUM_LIMIT AMT_CREDIT_SUM_OVERDUE"
            ).split()
        ],
    )
    bb = spark.createDataFrame([], "SK_ID_BUREAU bigint, MONTHS_BALANCE bigint, STATUS string")
    hot = one(R.rollup_bureau(df, bb).where("SK_ID_CURR = 1"))
    assert hot["bureau_count_credits"] == n // 3 and hot["bureau_credit_sum_total"] == 2.0 * (n // 3)
