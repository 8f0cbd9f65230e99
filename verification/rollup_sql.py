"""SQL twins of the roll-ups, written for DuckDB over the driver tables."""

from __future__ import annotations

EPOCH = "DATE '2002-01-01'"


def days(column: str) -> str:
    return f"date_diff('day', {EPOCH}, CAST({column} AS DATE))"


APPLICATION = """
  SELECT c_custkey AS "SK_ID_CURR", CAST(c_acctbal < 0 AS INT) AS "TARGET", c_mktsegment AS "NAME_SEGMENT",
    CAST(c_nationkey AS BIGINT) AS "REGION_CODE", CAST(nullif(c_nationkey % 7, 0) AS DOUBLE) AS "EXT_SOURCE_1"
  FROM customer"""

PREVIOUS = f"""
  SELECT o_orderkey AS SK_ID_PREV, o_custkey AS SK_ID_CURR,
    CASE o_orderstatus WHEN 'F' THEN 'Approved' WHEN 'O' THEN 'Refused' WHEN 'P' THEN 'Canceled' END AS NAME_CONTRACT_STATUS,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Cash loans' WHEN '2-HIGH' THEN 'Consumer loans'
      WHEN '3-MEDIUM' THEN 'Revolving loans' ELSE 'XNA' END AS NAME_CONTRACT_TYPE,
    CASE o_orderkey % 4 WHEN 0 THEN 'New' WHEN 1 THEN 'Repeater' WHEN 2 THEN 'Refreshed' ELSE 'XNA' END AS NAME_CLIENT_TYPE,
    floor(o_totalprice) AS AMT_APPLICATION,
    CASE WHEN o_orderstatus <> 'P' THEN floor(o_totalprice * 0.9) END AS AMT_CREDIT,
    floor(o_totalprice / 12) AS AMT_ANNUITY,
    CASE WHEN o_orderpriority <> '5-LOW' THEN floor(o_totalprice * 0.8) END AS AMT_GOODS_PRICE,
    CASE WHEN o_orderkey % 3 > 0 THEN floor(o_totalprice * 0.1) END AS AMT_DOWN_PAYMENT,
    CAST(o_orderkey % 24 AS DOUBLE) AS CNT_PAYMENT,
    CASE WHEN o_orderkey % 3 > 0 THEN (o_orderkey % 100) / 128.0 END AS RATE_DOWN_PAYMENT,
    CASE WHEN o_orderkey % 10 = 0 THEN (o_orderkey % 64) / 64.0 END AS RATE_INTEREST_PRIMARY,
    CASE WHEN o_orderkey % 11 = 0 THEN (o_orderkey % 32) / 64.0 END AS RATE_INTEREST_PRIVILEGED,
    {days('o_orderdate')} AS DAYS_DECISION,
    CASE WHEN o_orderstatus = 'F' THEN CAST({days('o_orderdate')} + o_orderkey % 30 AS DOUBLE) END AS DAYS_FIRST_DRAWING,
    CAST({days('o_orderdate')} + o_orderkey % 17 AS DOUBLE) AS DAYS_FIRST_DUE,
    CAST({days('o_orderdate')} + o_orderkey % 90 AS DOUBLE) AS DAYS_LAST_DUE_1ST_VERSION,
    CASE WHEN o_orderstatus <> 'P' THEN CAST({days('o_orderdate')} + o_orderkey % 120 AS DOUBLE) END AS DAYS_LAST_DUE,
    CASE WHEN o_orderpriority <> '1-URGENT' THEN CAST({days('o_orderdate')} + o_orderkey % 150 AS DOUBLE) END AS DAYS_TERMINATION
  FROM orders"""

BOOKED = "SELECT o_orderkey AS SK_ID_PREV, o_custkey AS SK_ID_CURR FROM orders WHERE o_orderstatus <> 'P'"

INSTALLMENTS = f"""
  SELECT l_orderkey AS SK_ID_PREV, CAST(l_suppkey % 3 AS DOUBLE) AS NUM_INSTALMENT_VERSION,
    CAST(l_linenumber AS BIGINT) AS NUM_INSTALMENT_NUMBER,
    CAST({days('o_orderdate')} AS DOUBLE) AS DAYS_INSTALMENT,
    CASE WHEN l_returnflag <> 'R' THEN CAST({days('l_shipdate')} AS DOUBLE) END AS DAYS_ENTRY_PAYMENT,
    CASE WHEN l_quantity > 2 THEN floor(l_extendedprice / 100) ELSE 0.0::DOUBLE END AS AMT_INSTALMENT,
    CASE WHEN l_tax > 0.005 THEN floor(l_extendedprice * (1 - l_discount + l_tax) / 100) END AS AMT_PAYMENT
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

BUREAU = f"""
  SELECT o_custkey AS SK_ID_CURR, o_orderkey AS SK_ID_BUREAU,
    CASE WHEN o_orderpriority = '5-LOW' THEN 'Sold' WHEN o_orderstatus = 'F' THEN 'Closed'
      WHEN o_orderstatus = 'O' THEN 'Active' WHEN o_orderstatus = 'P' THEN 'Bad debt' END AS CREDIT_ACTIVE,
    {days('o_orderdate')} AS DAYS_CREDIT,
    CASE WHEN o_orderstatus <> 'F' THEN CAST({days('o_orderdate')} + o_orderkey % 365 AS DOUBLE) END AS DAYS_CREDIT_ENDDATE,
    CASE WHEN o_orderstatus = 'F' THEN CAST({days('o_orderdate')} + o_orderkey % 200 AS DOUBLE) END AS DAYS_ENDDATE_FACT,
    CASE WHEN o_orderkey % 5 > 0 THEN CAST(o_orderkey % 1000 AS DOUBLE) END AS AMT_CREDIT_MAX_OVERDUE,
    o_orderkey % 4 AS CNT_CREDIT_PROLONG,
    CASE WHEN o_orderkey % 13 > 0 THEN floor(o_totalprice) END AS AMT_CREDIT_SUM,
    CASE WHEN o_orderstatus <> 'F' THEN floor(o_totalprice * 0.5) END AS AMT_CREDIT_SUM_DEBT,
    CASE WHEN o_orderstatus = 'P' THEN floor(o_totalprice * 0.25) END AS AMT_CREDIT_SUM_LIMIT,
    CAST(o_orderkey % 50 AS DOUBLE) AS AMT_CREDIT_SUM_OVERDUE,
    {days('o_orderdate')} + o_orderkey % 20 AS DAYS_CREDIT_UPDATE
  FROM orders"""

BUREAU_BALANCE = """
  SELECT l_orderkey AS SK_ID_BUREAU,
    CASE WHEN l_returnflag = 'N' THEN CASE WHEN l_linestatus = 'F' THEN 'C' ELSE 'X' END
      WHEN l_returnflag = 'A' THEN CAST(l_linenumber % 6 AS VARCHAR) ELSE '0' END AS STATUS
  FROM lineitem"""

POS_CASH = f"""
  SELECT l_orderkey AS SK_ID_PREV, {days('l_shipdate')} AS MONTHS_BALANCE,
    CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS CNT_INSTALMENT,
    CASE WHEN l_returnflag <> 'A' THEN floor(l_quantity / 2) END AS CNT_INSTALMENT_FUTURE,
    CASE WHEN l_linestatus = 'F' THEN
      CASE l_partkey % 8 WHEN 0 THEN 'active' WHEN 1 THEN 'completed' WHEN 2 THEN 'signed' WHEN 3 THEN 'demand'
        WHEN 4 THEN 'returned_to_the_store' WHEN 5 THEN 'approved' WHEN 6 THEN 'amortized_debt' ELSE 'other' END
      WHEN l_returnflag <> 'R' THEN 'active' ELSE 'other' END AS status,
    greatest(0, l_suppkey % 20 - 10) AS SK_DPD, greatest(0, l_suppkey % 20 - 15) AS SK_DPD_DEF
  FROM lineitem"""

CARD_LOANS = """
  SELECT c_custkey * 2 + side AS SK_ID_PREV, c_custkey AS SK_ID_CURR
  FROM customer, (VALUES (0), (1)) AS sides(side) WHERE c_mktsegment <> 'MACHINERY'"""

CREDIT_CARD = f"""
  SELECT user_id * 2 + event_id % 2 AS SK_ID_PREV, {days('ts')} AS MONTHS_BALANCE, floor("value" * 10) AS balance,
    CASE WHEN event_type = 'signup' THEN 0 ELSE 1024 END AS credit_limit,
    CASE WHEN event_type <> 'signup' THEN floor("value" * 10) / 1024 END AS utilization,
    CASE WHEN event_type <> 'view' THEN floor("value" * 2) END AS drawings_atm, floor("value" * 5) AS drawings_total,
    CASE WHEN event_type = 'error' THEN floor("value") END AS drawings_other,
    CASE WHEN event_type <> 'error' THEN floor("value" * 3) END AS drawings_pos,
    CASE WHEN event_type <> 'click' THEN CAST(event_id % 5 * 64 AS DOUBLE) END AS inst_min_regularity,
    CASE WHEN event_type <> 'purchase' THEN floor("value" * 7) END AS payment_current,
    floor("value" * 7) AS payment_total,
    CASE WHEN event_type NOT IN ('purchase', 'click') AND event_id % 5 > 0
      THEN floor("value" * 7) / (event_id % 5 * 64) END AS payment_to_min_ratio,
    CASE WHEN event_type <> 'purchase' THEN floor("value" * 5) - floor("value" * 7) END AS net_drawing,
    floor("value" * 4) AS receivable_principal, floor("value" * 6) AS receivable_total,
    CASE WHEN event_type <> 'view' THEN CAST(event_id % 3 AS DOUBLE) END AS cnt_drawings_atm,
    event_id % 6 AS cnt_drawings_total,
    CASE WHEN event_type <> 'error' THEN CAST(event_id % 4 AS DOUBLE) END AS cnt_drawings_pos,
    CASE WHEN event_type <> 'signup' THEN CAST(event_id % 40 AS DOUBLE) END AS cnt_instalment_mature,
    CASE event_type WHEN 'click' THEN 'active' WHEN 'error' THEN 'demand' WHEN 'purchase' THEN 'sent_proposal'
      WHEN 'signup' THEN 'signed' ELSE 'other' END AS status,
    event_id % 9 - 4 AS sk_dpd, event_id % 7 - 4 AS sk_dpd_def
  FROM events"""

FN = {"sum": "sum", "mean": "avg", "max": "max", "min": "min", "std": "stddev_samp"}


def stat(source: str, name: str, kind: str) -> str:
    return f"{FN[kind]}({source}) AS {name}_{kind}"


def last(value: str, order: str, name: str) -> str:
    return f"last({value} ORDER BY {order} NULLS LAST, {value}) FILTER (WHERE {value} IS NOT NULL) AS {name}"


def count_of(condition: str, name: str) -> str:
    return f"CAST(sum(CASE WHEN {condition} THEN 1 ELSE 0 END) AS BIGINT) AS {name}"


def rounded(names: dict[str, int]) -> str:
    """Columns as they are, but the listed ones rounded (non-dyadic averages, deviations)."""
    return ", ".join(f"round({n}, {d}) AS {n}" for n, d in names.items())


def final(body: str, digits: dict[str, int]) -> str:
    return f"{body[0]} SELECT * REPLACE ({rounded(digits)}) FROM ({body[1]})" if digits else " ".join(body)


# Columns whose last bits depend on summation order, with the digits both engines agree on.
ROUND = {
    "bureau": {"bureau_credit_sum_std": 2, "bb_mean_status_mean": 8},
    "previous": {},
    "pos_cash": {
        "pos_sk_dpd_mean": 8,
        "pos_sk_dpd_def_mean": 8,
        "pos_cnt_instalment_mean": 8,
        "pos_cnt_instalment_future_mean": 8,
    },
    "installments": {
        "inst_delay_mean": 6,
        "inst_underpayment_mean": 7,
        "inst_payment_ratio_mean": 8,
        "inst_amt_instalment_mean": 7,
        "inst_amt_payment_mean": 7,
    },
    "credit_card": {
        "cc_balance_mean": 6,
        "cc_credit_limit_mean": 6,
        "cc_utilization_mean": 8,
        "cc_payment_total_mean": 6,
        "cc_inst_min_regularity_mean": 6,
        "cc_payment_to_min_ratio_mean": 8,
        "cc_net_drawing_mean": 6,
        "cc_receivable_principal_mean": 6,
        "cc_receivable_total_mean": 6,
        "cc_sk_dpd_mean": 8,
        "cc_sk_dpd_def_mean": 8,
    },
}


def bureau_sql() -> str:
    per_credit = f"""
    SELECT SK_ID_BUREAU, max(try_cast(STATUS AS INT)) AS mx, avg(try_cast(STATUS AS INT)) AS mean, count(*) AS n,
      sum(CASE WHEN STATUS IN ('1','2','3','4','5') THEN 1 ELSE 0 END) AS late1,
      sum(CASE WHEN STATUS IN ('3','4','5') THEN 1 ELSE 0 END) AS late3,
      max(CASE WHEN STATUS = 'C' THEN 1 ELSE 0 END) AS closed, max(CASE WHEN STATUS = 'X' THEN 1 ELSE 0 END) AS unknown
    FROM months GROUP BY 1"""
    a = [
        "count(*) AS bureau_count_credits",
        *[
            count_of(f"CREDIT_ACTIVE = '{v}'", f"bureau_count_{n}")
            for n, v in (("active", "Active"), ("closed", "Closed"), ("bad_debt", "Bad debt"), ("sold", "Sold"))
        ],
        "sum(AMT_CREDIT_SUM) AS bureau_credit_sum_total",
        *[stat("AMT_CREDIT_SUM", "bureau_credit_sum", k) for k in ("mean", "max", "min", "std")],
        "sum(AMT_CREDIT_SUM_DEBT) AS bureau_credit_sum_debt_total",
        *[stat("AMT_CREDIT_SUM_DEBT", "bureau_credit_sum_debt", k) for k in ("mean", "max")],
        "sum(AMT_CREDIT_SUM_LIMIT) AS bureau_credit_sum_limit_total",
        stat("AMT_CREDIT_SUM_LIMIT", "bureau_credit_sum_limit", "mean"),
        "sum(AMT_CREDIT_SUM_OVERDUE) AS bureau_credit_sum_overdue_total",
        stat("AMT_CREDIT_SUM_OVERDUE", "bureau_credit_sum_overdue", "max"),
        stat("AMT_CREDIT_MAX_OVERDUE", "bureau_credit_max_overdue", "max"),
        "CAST(sum(CNT_CREDIT_PROLONG) AS BIGINT) AS bureau_cnt_prolong_sum",
        stat("CNT_CREDIT_PROLONG", "bureau_cnt_prolong", "max"),
        *[stat("DAYS_CREDIT", "bureau_days_credit", k) for k in ("min", "max", "mean")],
        *[stat("DAYS_CREDIT_ENDDATE", "bureau_days_credit_enddate", k) for k in ("min", "max")],
        *[stat("DAYS_ENDDATE_FACT", "bureau_days_enddate", k) for k in ("min", "max")],
        *[stat("DAYS_CREDIT_UPDATE", "bureau_days_credit_update", k) for k in ("min", "max")],
        "max(mx) AS bb_max_status_max, avg(mx) AS bb_max_status_mean, avg(mean) AS bb_mean_status_mean",
        "CAST(sum(n) AS BIGINT) AS bb_count_months_total",
        "CAST(sum(late1) AS BIGINT) AS bb_months_at_1_plus_total, CAST(sum(late3) AS BIGINT) AS bb_months_at_3_plus_total",
        "CAST(sum(closed) AS BIGINT) AS bb_ever_closed_sum, CAST(sum(unknown) AS BIGINT) AS bb_ever_unknown_sum",
        "1 AS has_bureau_history",
    ]
    return final(
        (
            f"WITH credits AS ({BUREAU}), months AS ({BUREAU_BALANCE}), per_credit AS ({per_credit})",
            f"SELECT SK_ID_CURR, {', '.join(a)} FROM credits LEFT JOIN per_credit USING (SK_ID_BUREAU) GROUP BY SK_ID_CURR",
        ),
        ROUND["bureau"],
    )


def previous_sql() -> str:
    amounts = ("AMT_CREDIT", "AMT_APPLICATION", "AMT_ANNUITY", "AMT_GOODS_PRICE", "AMT_DOWN_PAYMENT", "CNT_PAYMENT", "RATE_DOWN_PAYMENT")
    day_columns = {c: c.lower() for c in ("DAYS_DECISION", "DAYS_FIRST_DRAWING", "DAYS_FIRST_DUE", "DAYS_LAST_DUE", "DAYS_TERMINATION")}
    day_columns["DAYS_LAST_DUE_1ST_VERSION"] = "days_last_due_1st"
    a = ["count(*) AS prev_count_total"]
    for column, values in (
        ("NAME_CONTRACT_STATUS", ("Approved", "Refused", "Canceled", "Unused offer")),
        ("NAME_CONTRACT_TYPE", ("Cash loans", "Consumer loans", "Revolving loans")),
    ):
        a += [count_of(f"{column} = '{v}'", "prev_count_" + v.lower().replace(" ", "_")) for v in values]
    a += [count_of(f"NAME_CLIENT_TYPE = '{v}'", "prev_count_client_" + v.lower()) for v in ("New", "Repeater", "Refreshed")]
    a += [count_of("NAME_CONTRACT_TYPE = 'XNA'", "prev_count_other_contract_type")]
    a += ["avg(CASE WHEN NAME_CONTRACT_STATUS = 'Approved' THEN 1 ELSE 0 END) AS prev_approval_rate"]
    a += ["avg(CASE WHEN NAME_CONTRACT_STATUS = 'Refused' THEN 1 ELSE 0 END) AS prev_refusal_rate"]
    a += [stat(c, f"prev_{c.lower()}", k) for c in amounts for k in ("sum", "mean", "max", "min")]
    a += [stat(f"RATE_INTEREST_{c}", f"prev_rate_interest_{c.lower()}", k) for c in ("PRIMARY", "PRIVILEGED") for k in ("mean", "max")]
    a += [stat(c, f"prev_{n}", k) for c, n in day_columns.items() for k in ("min", "max", "mean")]
    last_fields = [
        "AMT_CREDIT", "AMT_ANNUITY", "AMT_APPLICATION", "DAYS_DECISION", "DAYS_FIRST_DRAWING", "DAYS_LAST_DUE",
        "CNT_PAYMENT", "RATE_DOWN_PAYMENT",
    ]
    b = [f"{c} AS prev_last_{c.lower()}" for c in last_fields]
    b += [
        "CASE NAME_CONTRACT_STATUS WHEN 'Approved' THEN 0 WHEN 'Refused' THEN 1 WHEN 'Canceled' THEN 2 END AS prev_last_name_contract_status",
        "CASE NAME_CLIENT_TYPE WHEN 'New' THEN 0 WHEN 'Repeater' THEN 1 WHEN 'Refreshed' THEN 2 END AS prev_last_name_client_type",
        "CASE NAME_CONTRACT_TYPE WHEN 'Cash loans' THEN 0 WHEN 'Consumer loans' THEN 1 WHEN 'Revolving loans' THEN 2 END"
        " AS prev_last_name_contract_type",
    ]
    return f"""
    WITH prev AS ({PREVIOUS}), totals AS (SELECT SK_ID_CURR, {', '.join(a)} FROM prev GROUP BY 1),
    recent AS (SELECT SK_ID_CURR, {', '.join(b)} FROM prev
      QUALIFY row_number() OVER (PARTITION BY SK_ID_CURR ORDER BY DAYS_DECISION DESC, SK_ID_PREV DESC) = 1)
    SELECT *, 1 AS has_previous_application FROM totals JOIN recent USING (SK_ID_CURR)"""


def pos_cash_sql() -> str:
    names = ("active", "completed", "signed", "demand", "returned_to_the_store", "approved", "amortized_debt")
    p = ["count(*) AS months"]
    for d in ("SK_DPD", "SK_DPD_DEF"):
        p += [f"max({d}) AS {d}_max, avg({d}) AS {d}_mean, sum({d}) AS {d}_sum, sum(CASE WHEN {d} > 0 THEN 1 ELSE 0 END) AS {d}_pos"]
    p += ["max(CNT_INSTALMENT) AS ci_max, avg(CNT_INSTALMENT) AS ci_mean"]
    p += ["max(CNT_INSTALMENT_FUTURE) AS cf_max, avg(CNT_INSTALMENT_FUTURE) AS cf_mean"]
    p += [last("CNT_INSTALMENT_FUTURE", "MONTHS_BALANCE", "cf_last"), "min(MONTHS_BALANCE) AS mb_min, max(MONTHS_BALANCE) AS mb_max"]
    p += [f"sum(CASE WHEN status = '{s}' THEN 1 ELSE 0 END) AS st_{s}" for s in (*names, "other")]
    a = ["count(*) AS pos_count_prev_loans, CAST(sum(months) AS BIGINT) AS pos_count_total_months"]
    for d in ("sk_dpd", "sk_dpd_def"):
        a += [
            f"max({d}_max) AS pos_{d}_max, avg({d}_mean) AS pos_{d}_mean, CAST(sum({d}_sum) AS BIGINT) AS pos_{d}_sum",
            f"CAST(sum({d}_pos) AS BIGINT) AS pos_{d}_positive_months_total",
        ]
    a += ["sum(SK_DPD_pos) / sum(months) AS pos_rate_dpd_positive, sum(SK_DPD_DEF_pos) / sum(months) AS pos_rate_dpd_def_positive"]
    a += ["max(ci_max) AS pos_cnt_instalment_max, avg(ci_mean) AS pos_cnt_instalment_mean"]
    a += ["max(cf_max) AS pos_cnt_instalment_future_max, avg(cf_mean) AS pos_cnt_instalment_future_mean"]
    a += ["sum(cf_last) AS pos_cnt_instalment_future_current"]
    a += ["min(mb_min) AS pos_months_balance_min, max(mb_max) AS pos_months_balance_max"]
    a += [f"CAST(sum(st_{s}) AS BIGINT) AS pos_count_status_{s}" for s in (*names, "other")]
    a += [count_of(f"st_{s} > 0", f"pos_count_ever_{s}") for s in names]
    a += ["1 AS has_pos_cash_history"]
    return final(
        (
            f"WITH pos AS ({POS_CASH}), prev AS ({BOOKED}), loans AS (SELECT SK_ID_PREV, {', '.join(p)} FROM pos GROUP BY 1)",
            f"SELECT SK_ID_CURR, {', '.join(a)} FROM loans JOIN prev USING (SK_ID_PREV) GROUP BY 1",
        ),
        ROUND["pos_cash"],
    )


def installments_sql() -> str:
    p = [
        "count(*) AS n, count(DISTINCT NUM_INSTALMENT_VERSION) AS versions, max(NUM_INSTALMENT_NUMBER) AS num_max",
        "max(delay) AS delay_max, avg(delay) AS delay_mean, sum(delay) AS delay_sum",
        "sum(CASE WHEN delay > 0 THEN 1 ELSE 0 END) AS late, sum(CASE WHEN short > 0 THEN 1 ELSE 0 END) AS shorts",
        "max(short) AS short_max, avg(short) AS short_mean, sum(short) AS short_sum",
        "avg(ratio) AS ratio_mean, min(ratio) AS ratio_min, sum(CASE WHEN ratio < 1 THEN 1 ELSE 0 END) AS under",
        "sum(AMT_INSTALMENT) AS due_sum, avg(AMT_INSTALMENT) AS due_mean",
        "sum(AMT_PAYMENT) AS paid_sum, avg(AMT_PAYMENT) AS paid_mean, max(AMT_PAYMENT) AS paid_max",
        "min(DAYS_INSTALMENT) AS di_min, max(DAYS_INSTALMENT) AS di_max",
        "min(DAYS_ENTRY_PAYMENT) AS de_min, max(DAYS_ENTRY_PAYMENT) AS de_max",
        *[last(v, "DAYS_ENTRY_PAYMENT", f"{n}_last") for v, n in (("delay", "delay"), ("ratio", "ratio"), ("AMT_PAYMENT", "paid"))],
    ]
    a = [
        "count(*) AS inst_count_prev_loans, CAST(sum(n) AS BIGINT) AS inst_count_installments_total",
        "CAST(sum(versions) AS BIGINT) AS inst_count_distinct_versions_total, max(num_max) AS inst_num_instalment_max",
        "max(delay_max) AS inst_delay_max, avg(delay_mean) AS inst_delay_mean, sum(delay_sum) AS inst_delay_sum",
        "CAST(sum(late) AS BIGINT) AS inst_delay_positive_count, sum(late) / sum(n) AS inst_delay_positive_rate",
        "max(short_max) AS inst_underpayment_max, avg(short_mean) AS inst_underpayment_mean",
        "sum(short_sum) AS inst_underpayment_sum, CAST(sum(shorts) AS BIGINT) AS inst_underpayment_positive_count",
        "avg(ratio_mean) AS inst_payment_ratio_mean, min(ratio_min) AS inst_payment_ratio_min",
        "CAST(sum(under) AS BIGINT) AS inst_underpaid_count, sum(under) / sum(n) AS inst_underpaid_rate",
        "sum(due_sum) AS inst_amt_instalment_sum, avg(due_mean) AS inst_amt_instalment_mean",
        "sum(paid_sum) AS inst_amt_payment_sum, avg(paid_mean) AS inst_amt_payment_mean, max(paid_max) AS inst_amt_payment_max",
        "min(di_min) AS inst_days_instalment_min, max(di_max) AS inst_days_instalment_max",
        "min(de_min) AS inst_days_entry_min, max(de_max) AS inst_days_entry_max",
        *[last(f"{v}_last", "de_max", f"inst_{n}_last") for v, n in (("delay", "delay"), ("ratio", "payment_ratio"), ("paid", "amt_payment"))],
        "1 AS has_installment_history",
    ]
    return final(
        (
            f"""WITH base AS ({INSTALLMENTS}), prev AS ({BOOKED}),
            enriched AS (SELECT *, DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT AS delay, AMT_INSTALMENT - AMT_PAYMENT AS short,
              CASE WHEN AMT_INSTALMENT > 0 THEN AMT_PAYMENT / AMT_INSTALMENT END AS ratio FROM base),
            loans AS (SELECT SK_ID_PREV, {', '.join(p)} FROM enriched GROUP BY 1)""",
            f"SELECT SK_ID_CURR, {', '.join(a)} FROM loans JOIN prev USING (SK_ID_PREV) GROUP BY 1",
        ),
        ROUND["installments"],
    )


def credit_card_sql() -> str:
    names = ("active", "completed", "demand", "sent_proposal", "signed", "approved", "refused", "other")
    both = {
        "max": "balance credit_limit utilization drawings_total inst_min_regularity receivable_principal receivable_total"
        " cnt_instalment_mature sk_dpd sk_dpd_def",
        "mean": "balance credit_limit utilization payment_total inst_min_regularity payment_to_min_ratio net_drawing"
        " receivable_principal receivable_total sk_dpd sk_dpd_def",
        "min": "balance credit_limit utilization payment_to_min_ratio",
        "sum": "drawings_total drawings_atm drawings_pos drawings_other payment_total payment_current net_drawing",
    }
    pairs = [(k, n) for k, ns in both.items() for n in ns.split()]
    lasts = ("balance", "credit_limit", "utilization", "sk_dpd", "payment_current", "cnt_instalment_mature")
    p = ["count(*) AS months, min(MONTHS_BALANCE) AS mb_min, max(MONTHS_BALANCE) AS mb_max"]
    p += [stat(n, n, k) for k, n in pairs]
    p += [f"sum(cnt_drawings_{c}) AS cd_{c}" for c in ("total", "atm", "pos")]
    p += [f"sum(CASE WHEN {d} > 0 THEN 1 ELSE 0 END) AS {d}_pos" for d in ("sk_dpd", "sk_dpd_def")]
    p += [f"sum(CASE WHEN status = '{s}' THEN 1 ELSE 0 END) AS st_{s}" for s in names]
    p += [last(n, "MONTHS_BALANCE", f"{n}_last") for n in lasts]
    a = ["count(*) AS cc_count_prev_loans, CAST(sum(months) AS BIGINT) AS cc_count_total_months"]
    a += ["min(mb_min) AS cc_months_balance_min, max(mb_max) AS cc_months_balance_max"]
    a += [stat(f"{n}_{k}", f"cc_{n}", k) for k, n in pairs]
    a += ["CAST(sum(cd_total) AS BIGINT) AS cc_cnt_drawings_total_sum"]
    a += [f"sum(cd_{c}) AS cc_cnt_drawings_{c}_sum" for c in ("atm", "pos")]
    a += [f"CAST(sum({d}_pos) AS BIGINT) AS cc_{d}_positive_months_total" for d in ("sk_dpd", "sk_dpd_def")]
    a += ["sum(sk_dpd_pos) / sum(months) AS cc_rate_dpd_positive, sum(sk_dpd_def_pos) / sum(months) AS cc_rate_dpd_def_positive"]
    a += [f"CAST(sum(st_{s}) AS BIGINT) AS cc_count_status_{s}" for s in names]
    a += [last(f"{n}_last", "mb_max", f"cc_{n}_last") for n in lasts]
    a += ["1 AS has_credit_card_history"]
    return final(
        (
            f"WITH cards AS ({CREDIT_CARD}), prev AS ({CARD_LOANS}), loans AS (SELECT SK_ID_PREV, {', '.join(p)} FROM cards GROUP BY 1)",
            f"SELECT SK_ID_CURR, {', '.join(a)} FROM loans JOIN prev USING (SK_ID_PREV) GROUP BY 1",
        ),
        ROUND["credit_card"],
    )
