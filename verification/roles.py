"""The driver's tables in the roles of the lending tables.

Amounts become whole numbers so that sums are exact in any order, and rates
become multiples of a power of two. Nulls are made where the lending tables
have them; orphans come from orders in status P and one market segment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EPOCH = "2002-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(column: Column) -> Column:
    return F.floor(column).cast("double")


def days(column: str) -> Column:
    return F.datediff(F.col(column), F.lit(EPOCH)).cast("bigint")


def pick(column: Column, values: dict[str, str], default: str | None = None) -> Column:
    out = F.lit(default)
    for value, result in reversed(values.items()):
        out = F.when(column == value, result).otherwise(out)
    return out


def application(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("SK_ID_CURR"),
        (F.col("c_acctbal") < 0).cast("int").alias("TARGET"),
        F.col("c_mktsegment").alias("NAME_SEGMENT"),
        F.col("c_nationkey").cast("bigint").alias("REGION_CODE"),
        F.nullif(F.col("c_nationkey") % 7, F.lit(0)).cast("double").alias("EXT_SOURCE_1"),
    )


def previous_application(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    price, key = F.col("o_totalprice"), F.col("o_orderkey")
    decided = days("o_orderdate")
    status = pick(F.col("o_orderstatus"), {"F": "Approved", "O": "Refused", "P": "Canceled"})
    return o.select(
        key.alias("SK_ID_PREV"),
        F.col("o_custkey").alias("SK_ID_CURR"),
        status.alias("NAME_CONTRACT_STATUS"),
        pick(
            F.col("o_orderpriority"),
            {"1-URGENT": "Cash loans", "2-HIGH": "Consumer loans", "3-MEDIUM": "Revolving loans"},
            "XNA",
        ).alias("NAME_CONTRACT_TYPE"),
        F.element_at(F.array(*map(F.lit, ("New", "Repeater", "Refreshed", "XNA"))), (key % 4 + 1).cast("int")).alias("NAME_CLIENT_TYPE"),
        whole(price).alias("AMT_APPLICATION"),
        F.when(F.col("o_orderstatus") != "P", whole(price * 0.9)).alias("AMT_CREDIT"),
        whole(price / 12).alias("AMT_ANNUITY"),
        F.when(F.col("o_orderpriority") != "5-LOW", whole(price * 0.8)).alias("AMT_GOODS_PRICE"),
        F.when(key % 3 > 0, whole(price * 0.1)).alias("AMT_DOWN_PAYMENT"),
        (key % 24).cast("double").alias("CNT_PAYMENT"),
        F.when(key % 3 > 0, (key % 100) / 128.0).alias("RATE_DOWN_PAYMENT"),
        F.when(key % 10 == 0, (key % 64) / 64.0).alias("RATE_INTEREST_PRIMARY"),
        F.when(key % 11 == 0, (key % 32) / 64.0).alias("RATE_INTEREST_PRIVILEGED"),
        decided.alias("DAYS_DECISION"),
        F.when(F.col("o_orderstatus") == "F", (decided + key % 30).cast("double")).alias("DAYS_FIRST_DRAWING"),
        (decided + key % 17).cast("double").alias("DAYS_FIRST_DUE"),
        (decided + key % 90).cast("double").alias("DAYS_LAST_DUE_1ST_VERSION"),
        F.when(F.col("o_orderstatus") != "P", (decided + key % 120).cast("double")).alias("DAYS_LAST_DUE"),
        F.when(F.col("o_orderpriority") != "1-URGENT", (decided + key % 150).cast("double")).alias("DAYS_TERMINATION"),
    )


def booked_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that became loans: children of the others are orphans."""
    o = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") != "P")
    return o.select(F.col("o_orderkey").alias("SK_ID_PREV"), F.col("o_custkey").alias("SK_ID_CURR"))


def installments(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    due = F.col("l_extendedprice")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("l_orderkey").alias("SK_ID_PREV"),
        (F.col("l_suppkey") % 3).cast("double").alias("NUM_INSTALMENT_VERSION"),
        F.col("l_linenumber").cast("bigint").alias("NUM_INSTALMENT_NUMBER"),
        days("o_orderdate").cast("double").alias("DAYS_INSTALMENT"),
        F.when(F.col("l_returnflag") != "R", days("l_shipdate").cast("double")).alias("DAYS_ENTRY_PAYMENT"),
        F.when(F.col("l_quantity") > 2, whole(due / 100)).otherwise(0.0).alias("AMT_INSTALMENT"),
        F.when(F.col("l_tax") > 0.005, whole(due * (1 - F.col("l_discount") + F.col("l_tax")) / 100)).alias("AMT_PAYMENT"),
    )


def bureau(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    price, key = F.col("o_totalprice"), F.col("o_orderkey")
    opened = days("o_orderdate")
    state = pick(F.col("o_orderstatus"), {"F": "Closed", "O": "Active", "P": "Bad debt"})
    return o.select(
        F.col("o_custkey").alias("SK_ID_CURR"),
        key.alias("SK_ID_BUREAU"),
        F.when(F.col("o_orderpriority") == "5-LOW", "Sold").otherwise(state).alias("CREDIT_ACTIVE"),
        opened.alias("DAYS_CREDIT"),
        F.when(F.col("o_orderstatus") != "F", (opened + key % 365).cast("double")).alias("DAYS_CREDIT_ENDDATE"),
        F.when(F.col("o_orderstatus") == "F", (opened + key % 200).cast("double")).alias("DAYS_ENDDATE_FACT"),
        F.when(key % 5 > 0, (key % 1000).cast("double")).alias("AMT_CREDIT_MAX_OVERDUE"),
        (key % 4).alias("CNT_CREDIT_PROLONG"),
        F.when(key % 13 > 0, whole(price)).alias("AMT_CREDIT_SUM"),
        F.when(F.col("o_orderstatus") != "F", whole(price * 0.5)).alias("AMT_CREDIT_SUM_DEBT"),
        F.when(F.col("o_orderstatus") == "P", whole(price * 0.25)).alias("AMT_CREDIT_SUM_LIMIT"),
        (key % 50).cast("double").alias("AMT_CREDIT_SUM_OVERDUE"),
        (opened + key % 20).alias("DAYS_CREDIT_UPDATE"),
    )


def bureau_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    late = F.concat(F.lit(" "), (F.col("l_linenumber") % 6).cast("string"))
    done = F.when(F.col("l_linestatus") == "F", "c ").otherwise("X")
    return li.select(
        F.col("l_orderkey").alias("SK_ID_BUREAU"),
        (-F.col("l_linenumber")).cast("bigint").alias("MONTHS_BALANCE"),
        F.when(F.col("l_returnflag") == "N", done).when(F.col("l_returnflag") == "A", late).otherwise("0").alias("STATUS"),
    )


def pos_cash(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    status = ("Active", "Completed", "Signed", "Demand", "Returned to the store", "Approved", "Amortized debt", "XNA")
    return li.select(
        F.col("l_orderkey").alias("SK_ID_PREV"),
        days("l_shipdate").alias("MONTHS_BALANCE"),
        F.when(F.col("l_returnflag") != "R", F.col("l_quantity")).alias("CNT_INSTALMENT"),
        F.when(F.col("l_returnflag") != "A", whole(F.col("l_quantity") / 2)).alias("CNT_INSTALMENT_FUTURE"),
        F.when(
            F.col("l_linestatus") == "F",
            F.concat(F.element_at(F.array(*map(F.lit, status)), (F.col("l_partkey") % 8 + 1).cast("int")), F.lit(" ")),
        ).otherwise(F.when(F.col("l_returnflag") != "R", "Active")).alias("NAME_CONTRACT_STATUS"),
        F.greatest(F.lit(0), F.col("l_suppkey") % 20 - 10).cast("bigint").alias("SK_DPD"),
        F.greatest(F.lit(0), F.col("l_suppkey") % 20 - 15).cast("bigint").alias("SK_DPD_DEF"),
    )


def card_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two cards per customer outside one segment, whose cards stay orphans."""
    c = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") != "MACHINERY")
    both = F.array(F.col("c_custkey") * 2, F.col("c_custkey") * 2 + 1)
    return c.select(F.explode(both).alias("SK_ID_PREV"), F.col("c_custkey").alias("SK_ID_CURR"))


def credit_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    kind, value, key = F.col("event_type"), F.col("value"), F.col("event_id")
    status = pick(kind, {"click": "Active", "error": "Demand", "purchase": "Sent proposal ", "signup": "Signed"}, "odd")
    return e.select(
        (F.col("user_id") * 2 + key % 2).alias("SK_ID_PREV"),
        F.datediff(F.col("ts"), F.lit(EPOCH)).cast("bigint").alias("MONTHS_BALANCE"),
        whole(value * 10).alias("AMT_BALANCE"),
        F.when(kind == "signup", 0).otherwise(1024).cast("bigint").alias("AMT_CREDIT_LIMIT_ACTUAL"),
        F.when(kind != "view", whole(value * 2)).alias("AMT_DRAWINGS_ATM_CURRENT"),
        whole(value * 5).alias("AMT_DRAWINGS_CURRENT"),
        F.when(kind == "error", whole(value)).alias("AMT_DRAWINGS_OTHER_CURRENT"),
        F.when(kind != "error", whole(value * 3)).alias("AMT_DRAWINGS_POS_CURRENT"),
        F.when(kind != "click", (key % 5 * 64).cast("double")).alias("AMT_INST_MIN_REGULARITY"),
        F.when(kind != "purchase", whole(value * 7)).alias("AMT_PAYMENT_CURRENT"),
        whole(value * 7).alias("AMT_PAYMENT_TOTAL_CURRENT"),
        whole(value * 4).alias("AMT_RECEIVABLE_PRINCIPAL"),
        whole(value * 6).alias("AMT_TOTAL_RECEIVABLE"),
        F.when(kind != "view", (key % 3).cast("double")).alias("CNT_DRAWINGS_ATM_CURRENT"),
        (key % 6).alias("CNT_DRAWINGS_CURRENT"),
        F.when(kind != "error", (key % 4).cast("double")).alias("CNT_DRAWINGS_POS_CURRENT"),
        F.when(kind != "signup", (key % 40).cast("double")).alias("CNT_INSTALMENT_MATURE_CUM"),
        F.when(kind == "view", F.lit(None)).otherwise(status).alias("NAME_CONTRACT_STATUS"),
        (key % 9 - 4).alias("SK_DPD"),
        (key % 7 - 4).alias("SK_DPD_DEF"),
    )
