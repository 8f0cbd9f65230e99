"""Roll-ups of the five child-table families to one row per applicant.

Every level is one groupBy: partial aggregation runs before each shuffle, so a
hot applicant or loan costs no more than its partial rows. Loans are rolled up
before they meet the key map, which keeps the join narrow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendframe.functions import columns as C
from lendframe.operators.joins import through_parent

APPLICANT = "SK_ID_CURR"
LOAN = "SK_ID_PREV"

# Fixed values of the source tables.
MONTH_STATUS = ("0", "1", "2", "3", "4", "5", "C", "X")
MONTH_STATUS_CODES = {"0": 0, "1": 1, "2": 2, "3": 3, "4": 4, "5": 5}
CREDIT_STATES = {"active": "Active", "closed": "Closed", "bad_debt": "Bad debt", "sold": "Sold"}
CONTRACT_STATUS_CODES = {"Approved": 0, "Refused": 1, "Canceled": 2, "Unused offer": 3}
CLIENT_TYPE_CODES = {"New": 0, "Repeater": 1, "Refreshed": 2}
CONTRACT_TYPE_CODES = {"Cash loans": 0, "Consumer loans": 1, "Revolving loans": 2}
POS_STATUS = ("Active", "Completed", "Signed", "Demand", "Returned to the store", "Approved", "Amortized debt")
CARD_STATUS = ("Active", "Completed", "Demand", "Sent proposal", "Signed", "Approved", "Refused")

PRESENCE = {
    "bureau": "has_bureau_history",
    "previous_application": "has_previous_application",
    "pos_cash": "has_pos_cash_history",
    "installments": "has_installment_history",
    "credit_card": "has_credit_card_history",
}

_STATS = {"sum": "sum", "mean": "avg", "max": "max", "min": "min", "std": "stddev_samp"}

_KINDS = {"avg": "mean", "stddev_samp": "std"}


def _agg(function: str, source: str, name: str) -> Column:
    return C.made(F.expr(f"{function}({source})"), name, _KINDS.get(function, function))


def _rows(name: str) -> Column:
    return C.made(F.count(F.lit(1)), name, "count")


def _stats(source: str, name: str, *stats: str) -> list[Column]:
    return [_agg(_STATS[s], source, f"{name}_{s}") for s in stats]


#: Whole numbers that `Merged.distinct` counts by bits, and those of one state.
VERSIONS, WORD = 186, 62


def _is_odd(source: str) -> Column:
    x = F.col(source).cast("double")
    return F.isnan(x) | (x < 0) | (x >= VERSIONS) | (x != F.floor(x))


class Merged:
    """Aggregates of a group that are put together from those of its parts, so that the parts can be counted by the way.

    `parts` are the states of a part: counts, sums, extremes, means with squared deviations, and last values with their keys.
    Each method adds the states it needs and returns the aggregate over the parts.
    """

    def __init__(self):
        self.parts: dict[str, Column] = {}
        self.keys: dict[str, Column] = {}  # columns that the rows need first: each is made once, outside the aggregate's code

    def _state(self, function: str, source: str) -> Column:
        name = f"_{function}_{source}"
        self.parts[name] = F.expr(f"{function}({source})")
        return F.col(name)

    def rows(self, name: str) -> Column:
        return C.made(F.sum(self._state("count", "1").cast("bigint")), name, "count")

    def stats(self, source: str, name: str, *stats: str) -> list[Column]:
        return [self.stat(s, source, f"{name}_{s}") for s in stats]

    def stat(self, stat: str, source: str, name: str) -> Column:
        if stat in ("sum", "min", "max"):
            value = F.expr(f"{stat}(_{stat}_{source})")
            self._state(stat, source)
        else:
            n, total = self._state("count", source), self._state("sum", source)
            value = F.sum(total) / F.nullif(F.sum(n), F.lit(0))
            if stat == "std":  # squared deviations within the parts, and of their means
                mean = total / F.nullif(n, F.lit(0))
                spread = F.sum(self._state("var_pop", source) * n) + F.sum(total * mean) - F.sum(n) * value * value
                value = F.when(F.sum(n) > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / (F.sum(n) - 1)))
        return C.made(value, name, stat)

    def distinct(self, source: str, name: str) -> Column:
        """Different values: whole numbers below VERSIONS by bits, all others as parts of their own, which `odd` names."""
        x, words = F.col(source).cast("double"), []
        for low in range(0, VERSIONS, WORD):
            here = (x >= low) & (x < min(low + WORD, VERSIONS)) & ~_is_odd(source)
            self.parts[f"_{name}_{low}"] = F.bit_or(F.when(here, F.call_function("shiftleft", F.lit(1).cast("bigint"), (x - low).cast("int"))))
            words.append(F.coalesce(F.bit_count(F.bit_or(f"_{name}_{low}")), F.lit(0)))
        return C.made(sum(words, F.count("_odd")), name, "nunique")

    def last(self, value: Column, order: Column, name: str) -> Column:
        key = f"_{name}_at"
        self.keys[key] = C.last_order(value, order)
        self.parts[f"_{name}"], self.parts[f"_{name}_key"] = F.max_by(value, F.col(key)), F.max(key)
        return C.made(F.max_by(f"_{name}", f"_{name}_key"), name, "last")

    def states(self) -> list[Column]:
        return [c.alias(n) for n, c in self.parts.items()]


def _finish(df: DataFrame, flag: str) -> DataFrame:
    return C.ordered_columns(df.withColumn(flag, C.made(F.lit(1), flag, "presence")), APPLICANT)


# --- bureau -----------------------------------------------------------------


def bureau_months(bureau_balance: DataFrame) -> DataFrame:
    """Monthly bureau statuses to one row per credit."""
    status = C.clean_text(F.col("STATUS"), upper=True)
    months = bureau_balance.select("SK_ID_BUREAU", status.alias("STATUS")).withColumn(
        "level", C.ordinal(F.col("STATUS"), MONTH_STATUS_CODES)
    )
    out = months.groupBy("SK_ID_BUREAU").agg(
        _agg("max", "level", "bb_max_status"),
        _agg("avg", "level", "bb_mean_status"),
        _rows("bb_count_months"),
        *C.known_counts(F.col("STATUS"), MONTH_STATUS, "bb_count_status_"),
    )
    late = {n: sum((F.col(f"bb_count_status_{i}") for i in range(n + 1, 6)), F.col(f"bb_count_status_{n}")) for n in (1, 3)}
    return out.withColumns(
        {
            "bb_months_at_1_plus": late[1],
            "bb_months_at_3_plus": late[3],
            "bb_ever_closed": C.ever(F.col("bb_count_status_c")),
            "bb_ever_unknown": C.ever(F.col("bb_count_status_x")),
        }
    )


def bureau_enriched(bureau: DataFrame, per_credit: DataFrame) -> DataFrame:
    """Every credit with its monthly summary, where it has one."""
    return bureau.join(per_credit, "SK_ID_BUREAU", "left")


def rollup_bureau(bureau: DataFrame, bureau_balance: DataFrame) -> DataFrame:
    """Bureau credits and their months to one row per applicant (F1)."""
    rows = bureau_enriched(bureau, bureau_months(bureau_balance))
    aggs = [_rows("bureau_count_credits")]
    aggs += [
        C.made(C.count_where(F.col("CREDIT_ACTIVE") == value), f"bureau_count_{name}", "count")
        for name, value in CREDIT_STATES.items()
    ]
    credit = "bureau_credit_sum"
    aggs += [
        _agg("sum", "AMT_CREDIT_SUM", f"{credit}_total"),
        *_stats("AMT_CREDIT_SUM", credit, "mean", "max", "min", "std"),
        _agg("sum", "AMT_CREDIT_SUM_DEBT", f"{credit}_debt_total"),
        *_stats("AMT_CREDIT_SUM_DEBT", f"{credit}_debt", "mean", "max"),
        _agg("sum", "AMT_CREDIT_SUM_LIMIT", f"{credit}_limit_total"),
        *_stats("AMT_CREDIT_SUM_LIMIT", f"{credit}_limit", "mean"),
        _agg("sum", "AMT_CREDIT_SUM_OVERDUE", f"{credit}_overdue_total"),
        *_stats("AMT_CREDIT_SUM_OVERDUE", f"{credit}_overdue", "max"),
        *_stats("AMT_CREDIT_MAX_OVERDUE", "bureau_credit_max_overdue", "max"),
        *_stats("CNT_CREDIT_PROLONG", "bureau_cnt_prolong", "sum", "max"),
        *_stats("DAYS_CREDIT", "bureau_days_credit", "min", "max", "mean"),
        *_stats("DAYS_CREDIT_ENDDATE", "bureau_days_credit_enddate", "min", "max"),
        *_stats("DAYS_ENDDATE_FACT", "bureau_days_enddate", "min", "max"),
        *_stats("DAYS_CREDIT_UPDATE", "bureau_days_credit_update", "min", "max"),
        *_stats("bb_max_status", "bb_max_status", "max", "mean"),
        *_stats("bb_mean_status", "bb_mean_status", "mean"),
        *[_agg("sum", c, f"{c}_total") for c in ("bb_count_months", "bb_months_at_1_plus", "bb_months_at_3_plus")],
        *_stats("bb_ever_closed", "bb_ever_closed", "sum"),
        *_stats("bb_ever_unknown", "bb_ever_unknown", "sum"),
    ]
    return _finish(rows.groupBy(APPLICANT).agg(*aggs), PRESENCE["bureau"])


# --- previous applications --------------------------------------------------

_PREV_AMOUNTS = {
    "AMT_CREDIT": "amt_credit",
    "AMT_APPLICATION": "amt_application",
    "AMT_ANNUITY": "amt_annuity",
    "AMT_GOODS_PRICE": "amt_goods_price",
    "AMT_DOWN_PAYMENT": "amt_down_payment",
    "CNT_PAYMENT": "cnt_payment",
    "RATE_DOWN_PAYMENT": "rate_down_payment",
}
_PREV_RATES = {
    "RATE_INTEREST_PRIMARY": "rate_interest_primary",
    "RATE_INTEREST_PRIVILEGED": "rate_interest_privileged",
}
_PREV_DAYS = {
    "DAYS_DECISION": "days_decision",
    "DAYS_FIRST_DRAWING": "days_first_drawing",
    "DAYS_FIRST_DUE": "days_first_due",
    "DAYS_LAST_DUE_1ST_VERSION": "days_last_due_1st",
    "DAYS_LAST_DUE": "days_last_due",
    "DAYS_TERMINATION": "days_termination",
}
_PREV_LAST = (
    "AMT_CREDIT",
    "AMT_ANNUITY",
    "AMT_APPLICATION",
    "DAYS_DECISION",
    "DAYS_FIRST_DRAWING",
    "DAYS_LAST_DUE",
    "CNT_PAYMENT",
    "RATE_DOWN_PAYMENT",
)
_PREV_LAST_CODES = {
    "NAME_CONTRACT_STATUS": CONTRACT_STATUS_CODES,
    "NAME_CLIENT_TYPE": CLIENT_TYPE_CODES,
    "NAME_CONTRACT_TYPE": CONTRACT_TYPE_CODES,
}


def rollup_previous(previous: DataFrame) -> DataFrame:
    """Earlier applications to one row per applicant (F2); absent source columns are skipped."""
    have = set(previous.columns)
    group_counts = {
        "NAME_CONTRACT_STATUS": ("Approved", "Refused", "Canceled", "Unused offer"),
        "NAME_CONTRACT_TYPE": ("Cash loans", "Consumer loans", "Revolving loans"),
        "NAME_CLIENT_TYPE": ("New", "Repeater", "Refreshed"),
    }
    prefix = {"NAME_CONTRACT_STATUS": "prev_count_", "NAME_CONTRACT_TYPE": "prev_count_", "NAME_CLIENT_TYPE": "prev_count_client_"}
    aggs = [_rows("prev_count_total")]
    for source, values in group_counts.items():
        if source in have:
            aggs += C.known_counts(F.col(source), values, prefix[source])
    families = ((_PREV_AMOUNTS, ("sum", "mean", "max", "min")), (_PREV_RATES, ("mean", "max")), (_PREV_DAYS, ("min", "max", "mean")))
    for table, stats in families:
        for source, name in table.items():
            if source in have:
                aggs += _stats(source, f"prev_{name}", *stats)
    key = C.last_by(F.col("DAYS_DECISION"), F.col(LOAN))
    for source in (*_PREV_LAST, *_PREV_LAST_CODES):
        if source in have:
            codes = _PREV_LAST_CODES.get(source)  # texts are coded first: a number fits the hash aggregate
            value = C.ordinal(F.col(source), codes) if codes else F.col(source)
            aggs.append(C.made(F.max_by(value, key), f"prev_last_{source.lower()}", "last"))
    out = previous.groupBy(APPLICANT).agg(*aggs)
    derived: dict[str, Column] = {}
    if "NAME_CONTRACT_TYPE" in have:
        known = [F.col(f"prev_count_{C.slug(v)}") for v in group_counts["NAME_CONTRACT_TYPE"]]
        name = "prev_count_other_contract_type"
        derived[name] = C.made(F.col("prev_count_total") - sum(known[1:], known[0]), name, "count")
    if "NAME_CONTRACT_STATUS" in have:
        for name, part in (("prev_approval_rate", "approved"), ("prev_refusal_rate", "refused")):
            derived[name] = C.made(F.col(f"prev_count_{part}") / F.col("prev_count_total"), name, "rate")
    return _finish(out.withColumns(derived) if derived else out, PRESENCE["previous_application"])


# --- POS and cash balances --------------------------------------------------


def pos_cash_per_loan(pos_cash: DataFrame) -> DataFrame:
    """Monthly POS / cash snapshots to one row per loan."""
    rows = pos_cash.withColumns(
        {
            "_status": C.clean_text(F.col("NAME_CONTRACT_STATUS")),
            "_dpd": C.positive_flag(F.col("SK_DPD")),
            "_dpd_def": C.positive_flag(F.col("SK_DPD_DEF")),
        }
    )
    p = "pos_prev"
    out = rows.groupBy(LOAN).agg(
        _rows(f"{p}_count_months"),
        *_stats("SK_DPD", f"{p}_sk_dpd", "max", "mean", "sum"),
        _agg("sum", "_dpd", f"{p}_sk_dpd_positive_months"),
        *_stats("SK_DPD_DEF", f"{p}_sk_dpd_def", "max", "mean", "sum"),
        _agg("sum", "_dpd_def", f"{p}_sk_dpd_def_positive_months"),
        *_stats("CNT_INSTALMENT", f"{p}_cnt_instalment", "max", "mean"),
        *_stats("CNT_INSTALMENT_FUTURE", f"{p}_cnt_instalment_future", "max", "mean"),
        C.made(C.last_non_null(F.col("CNT_INSTALMENT_FUTURE"), F.col("MONTHS_BALANCE")), f"{p}_cnt_instalment_future_last", "last"),
        *_stats("MONTHS_BALANCE", f"{p}_months_balance", "min", "max"),
        *C.known_counts(F.col("_status"), POS_STATUS, f"{p}_status_"),
        C.made(C.residual_count(F.col("_status"), POS_STATUS), f"{p}_status_other", "count"),
    )
    return out.withColumns({f"{p}_ever_{C.slug(s)}": C.ever(F.col(f"{p}_status_{C.slug(s)}")) for s in POS_STATUS})


def rollup_pos_cash(pos_cash: DataFrame, previous: DataFrame) -> DataFrame:
    """POS / cash loans to one row per applicant."""
    rows = through_parent(pos_cash_per_loan(pos_cash), previous, LOAN, APPLICANT)
    p, q = "pos_prev", "pos"
    slugs = [C.slug(s) for s in POS_STATUS]
    aggs = [_rows(f"{q}_count_prev_loans"), _agg("sum", f"{p}_count_months", f"{q}_count_total_months")]
    for dpd in ("sk_dpd", "sk_dpd_def"):
        aggs += [
            _agg("max", f"{p}_{dpd}_max", f"{q}_{dpd}_max"),
            _agg("avg", f"{p}_{dpd}_mean", f"{q}_{dpd}_mean"),
            _agg("sum", f"{p}_{dpd}_sum", f"{q}_{dpd}_sum"),
            _agg("sum", f"{p}_{dpd}_positive_months", f"{q}_{dpd}_positive_months_total"),
        ]
    for name in ("cnt_instalment", "cnt_instalment_future"):
        aggs += [_agg("max", f"{p}_{name}_max", f"{q}_{name}_max"), _agg("avg", f"{p}_{name}_mean", f"{q}_{name}_mean")]
    aggs += [
        _agg("sum", f"{p}_cnt_instalment_future_last", f"{q}_cnt_instalment_future_current"),
        _agg("min", f"{p}_months_balance_min", f"{q}_months_balance_min"),
        _agg("max", f"{p}_months_balance_max", f"{q}_months_balance_max"),
        *[_agg("sum", f"{p}_status_{s}", f"{q}_count_status_{s}") for s in (*slugs, "other")],
        *[_agg("sum", f"{p}_ever_{s}", f"{q}_count_ever_{s}") for s in slugs],
    ]
    out = rows.groupBy(APPLICANT).agg(*aggs).withColumns(
        {
            f"{q}_rate_dpd_positive": C.made(C.rate(F.col(f"{q}_sk_dpd_positive_months_total"), F.col(f"{q}_count_total_months")), f"{q}_rate_dpd_positive", "rate"),
            f"{q}_rate_dpd_def_positive": C.made(C.rate(F.col(f"{q}_sk_dpd_def_positive_months_total"), F.col(f"{q}_count_total_months")), f"{q}_rate_dpd_def_positive", "rate"),
        }
    )
    return _finish(out, PRESENCE["pos_cash"])


# --- installments -----------------------------------------------------------


def installments_per_loan(installments: DataFrame) -> DataFrame:
    """Installment payments to one row per loan."""
    due, paid = F.col("AMT_INSTALMENT"), F.col("AMT_PAYMENT")
    rows = installments.withColumns(
        {
            "_delay": F.col("DAYS_ENTRY_PAYMENT") - F.col("DAYS_INSTALMENT"),
            "_short": due - paid,
            "_ratio": C.guarded_ratio(paid, due),
        }
    ).withColumns(
        {
            "_late": C.positive_flag(F.col("_delay")),
            "_short_flag": C.positive_flag(F.col("_short")),
            "_underpaid": C.flag(F.col("_ratio") < 1),
        }
    )
    p, entry = "inst_prev", F.col("DAYS_ENTRY_PAYMENT")
    m = Merged()
    wanted = [
        m.rows(f"{p}_count_installments"),
        m.distinct("NUM_INSTALMENT_VERSION", f"{p}_count_distinct_versions"),
        *m.stats("NUM_INSTALMENT_NUMBER", f"{p}_num_instalment", "max"),
        *m.stats("_delay", f"{p}_delay", "max", "mean", "sum", "std"),
        m.stat("sum", "_late", f"{p}_delay_positive_count"),
        *m.stats("_short", f"{p}_underpayment", "max", "mean", "sum"),
        m.stat("sum", "_short_flag", f"{p}_underpayment_positive_count"),
        *m.stats("_ratio", f"{p}_payment_ratio", "mean", "min", "max"),
        m.stat("sum", "_underpaid", f"{p}_underpaid_count"),
        *m.stats("AMT_INSTALMENT", f"{p}_amt_instalment", "sum", "mean"),
        *m.stats("AMT_PAYMENT", f"{p}_amt_payment", "sum", "mean", "max"),
        *m.stats("DAYS_INSTALMENT", f"{p}_days_instalment", "min", "max"),
        *m.stats("DAYS_ENTRY_PAYMENT", f"{p}_days_entry", "min", "max"),
        m.last(F.col("_delay"), entry, f"{p}_delay_last"),
        m.last(F.col("_ratio"), entry, f"{p}_payment_ratio_last"),
        m.last(paid, entry, f"{p}_amt_payment_last"),
    ]
    # one scan: a loan is one part, with bits for its versions, and one more for each version that has no bit
    odd = F.when(_is_odd("NUM_INSTALMENT_VERSION"), F.col("NUM_INSTALMENT_VERSION"))
    parts = rows.withColumns(m.keys).withColumn("_odd", odd).groupBy(LOAN, "_odd").agg(*m.states())
    return parts.groupBy(LOAN).agg(*wanted)


def rollup_installments(installments: DataFrame, previous: DataFrame) -> DataFrame:
    """Installment loans to one row per applicant."""
    rows = through_parent(installments_per_loan(installments), previous, LOAN, APPLICANT)
    p, q = "inst_prev", "inst"
    same = {
        "max": ("num_instalment_max", "delay_max", "underpayment_max", "amt_payment_max", "days_instalment_max", "days_entry_max"),
        "min": ("payment_ratio_min", "days_instalment_min", "days_entry_min"),
        "avg": ("delay_mean", "underpayment_mean", "payment_ratio_mean", "amt_instalment_mean", "amt_payment_mean"),
        "sum": (
            "delay_sum",
            "delay_positive_count",
            "underpayment_sum",
            "underpayment_positive_count",
            "underpaid_count",
            "amt_instalment_sum",
            "amt_payment_sum",
        ),
    }
    aggs = [
        _rows(f"{q}_count_prev_loans"),
        _agg("sum", f"{p}_count_installments", f"{q}_count_installments_total"),
        _agg("sum", f"{p}_count_distinct_versions", f"{q}_count_distinct_versions_total"),
    ]
    aggs += [_agg(fn, f"{p}_{n}", f"{q}_{n}") for fn, names in same.items() for n in names]
    aggs += [
        C.made(C.last_non_null(F.col(f"{p}_{n}"), F.col(f"{p}_days_entry_max")), f"{q}_{n}", "last")
        for n in ("delay_last", "payment_ratio_last", "amt_payment_last")
    ]
    total = F.col(f"{q}_count_installments_total")
    out = rows.groupBy(APPLICANT).agg(*aggs).withColumns(
        {
            f"{q}_delay_positive_rate": C.made(C.rate(F.col(f"{q}_delay_positive_count"), total), f"{q}_delay_positive_rate", "rate"),
            f"{q}_underpaid_rate": C.made(C.rate(F.col(f"{q}_underpaid_count"), total), f"{q}_underpaid_rate", "rate"),
        }
    )
    return _finish(out, PRESENCE["installments"])


# --- credit cards -----------------------------------------------------------

_CARD_LAST = {
    "balance": "AMT_BALANCE",
    "credit_limit": "AMT_CREDIT_LIMIT_ACTUAL",
    "utilization": "_utilization",
    "sk_dpd": "SK_DPD",
    "payment_current": "AMT_PAYMENT_CURRENT",
    "cnt_instalment_mature": "CNT_INSTALMENT_MATURE_CUM",
}
# feature stem -> (source column, statistics kept at both levels)
_CARD_STATS = {
    "months_balance": ("MONTHS_BALANCE", ("min", "max")),
    "balance": ("AMT_BALANCE", ("max", "mean", "min")),
    "credit_limit": ("AMT_CREDIT_LIMIT_ACTUAL", ("max", "mean", "min")),
    "utilization": ("_utilization", ("max", "mean", "min")),
    "drawings_total": ("AMT_DRAWINGS_CURRENT", ("sum", "max")),
    "drawings_atm": ("AMT_DRAWINGS_ATM_CURRENT", ("sum",)),
    "drawings_pos": ("AMT_DRAWINGS_POS_CURRENT", ("sum",)),
    "drawings_other": ("AMT_DRAWINGS_OTHER_CURRENT", ("sum",)),
    "cnt_drawings_total": ("CNT_DRAWINGS_CURRENT", ("sum",)),
    "cnt_drawings_atm": ("CNT_DRAWINGS_ATM_CURRENT", ("sum",)),
    "cnt_drawings_pos": ("CNT_DRAWINGS_POS_CURRENT", ("sum",)),
    "payment_total": ("AMT_PAYMENT_TOTAL_CURRENT", ("sum", "mean")),
    "payment_current": ("AMT_PAYMENT_CURRENT", ("sum",)),
    "inst_min_regularity": ("AMT_INST_MIN_REGULARITY", ("mean", "max")),
    "payment_to_min_ratio": ("_payment_to_min", ("mean", "min")),
    "net_drawing": ("_net_drawing", ("sum", "mean")),
    "receivable_principal": ("AMT_RECEIVABLE_PRINCIPAL", ("max", "mean")),
    "receivable_total": ("AMT_TOTAL_RECEIVABLE", ("max", "mean")),
    "cnt_instalment_mature": ("CNT_INSTALMENT_MATURE_CUM", ("max",)),
    "sk_dpd": ("SK_DPD", ("max", "mean")),
    "sk_dpd_def": ("SK_DPD_DEF", ("max", "mean")),
}


def credit_card_per_loan(credit_card: DataFrame) -> DataFrame:
    """Monthly card snapshots to one row per card."""
    rows = credit_card.withColumns(
        {
            "_status": C.clean_text(F.col("NAME_CONTRACT_STATUS")),
            "_utilization": C.guarded_ratio(F.col("AMT_BALANCE"), F.col("AMT_CREDIT_LIMIT_ACTUAL")),
            "_payment_to_min": C.guarded_ratio(F.col("AMT_PAYMENT_CURRENT"), F.col("AMT_INST_MIN_REGULARITY")),
            "_net_drawing": F.col("AMT_DRAWINGS_CURRENT") - F.col("AMT_PAYMENT_CURRENT"),
            "_dpd": C.positive_flag(F.col("SK_DPD")),
            "_dpd_def": C.positive_flag(F.col("SK_DPD_DEF")),
        }
    )
    p = "cc_prev"
    aggs = [_rows(f"{p}_count_months")]
    for stem, (source, stats) in _CARD_STATS.items():
        aggs += _stats(source, f"{p}_{stem}", *stats)
    aggs += [
        _agg("sum", "_dpd", f"{p}_sk_dpd_positive_months"),
        _agg("sum", "_dpd_def", f"{p}_sk_dpd_def_positive_months"),
        *C.known_counts(F.col("_status"), CARD_STATUS, f"{p}_status_"),
        C.made(C.residual_count(F.col("_status"), CARD_STATUS), f"{p}_status_other", "count"),
        *[C.made(C.last_non_null(F.col(source), F.col("MONTHS_BALANCE")), f"{p}_{n}_last", "last") for n, source in _CARD_LAST.items()],
    ]
    return rows.groupBy(LOAN).agg(*aggs)


def rollup_credit_card(credit_card: DataFrame, previous: DataFrame) -> DataFrame:
    """Cards to one row per applicant."""
    rows = through_parent(credit_card_per_loan(credit_card), previous, LOAN, APPLICANT)
    p, q = "cc_prev", "cc"
    aggs = [_rows(f"{q}_count_prev_loans"), _agg("sum", f"{p}_count_months", f"{q}_count_total_months")]
    for stem, (_, stats) in _CARD_STATS.items():
        aggs += [_agg(_STATS[s], f"{p}_{stem}_{s}", f"{q}_{stem}_{s}") for s in stats]
    aggs += [
        _agg("sum", f"{p}_{dpd}_positive_months", f"{q}_{dpd}_positive_months_total") for dpd in ("sk_dpd", "sk_dpd_def")
    ]
    aggs += [_agg("sum", f"{p}_status_{s}", f"{q}_count_status_{s}") for s in (*map(C.slug, CARD_STATUS), "other")]
    aggs += [
        C.made(C.last_non_null(F.col(f"{p}_{n}_last"), F.col(f"{p}_months_balance_max")), f"{q}_{n}_last", "last") for n in _CARD_LAST
    ]
    total = F.col(f"{q}_count_total_months")
    out = rows.groupBy(APPLICANT).agg(*aggs).withColumns(
        {
            f"{q}_rate_dpd_positive": C.made(C.rate(F.col(f"{q}_sk_dpd_positive_months_total"), total), f"{q}_rate_dpd_positive", "rate"),
            f"{q}_rate_dpd_def_positive": C.made(C.rate(F.col(f"{q}_sk_dpd_def_positive_months_total"), total), f"{q}_rate_dpd_def_positive", "rate"),
        }
    )
    return _finish(out, PRESENCE["credit_card"])
