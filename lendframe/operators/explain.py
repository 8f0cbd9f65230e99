"""Contributions, importance, reason codes, notices and batch scoring.

Contributions are wide: one column per feature, next to their applicant. Top-k
and reason codes then sort a short array inside the row, without any shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendframe.functions.ordered import long_form
from lendframe.operators import decide as D

KEY = "SK_ID_CURR"
SAMPLE_ROWS = 5000
N_PRIMARY, N_ADDITIONAL = 4, 6

# Feature, code, description, direction.
REASONS = (
    ("EXT_SOURCE_1", "LOW_EXTERNAL_SCORE_1", "Low score from external credit source 1", "negative"),
    ("EXT_SOURCE_2", "LOW_EXTERNAL_SCORE_2", "Low score from external credit source 2", "negative"),
    ("EXT_SOURCE_3", "LOW_EXTERNAL_SCORE_3", "Low score from external credit source 3", "negative"),
    ("bureau_credit_sum_overdue_max", "HIGH_BUREAU_OVERDUE", "High maximum overdue amount on credit bureau records", "positive"),
    ("bureau_count_bad_debt", "PRIOR_BAD_DEBT", "Prior bad-debt record in credit bureau history", "positive"),
    ("bureau_count_credits", "HIGH_CREDIT_COUNT", "Large number of existing credit accounts", "positive"),
    ("inst_delay_positive_rate", "RECENT_LATE_PAYMENTS", "History of late installment payments", "positive"),
    ("inst_delay_max", "HIGH_MAX_PAYMENT_DELAY", "Significant maximum delay on prior loan installments", "positive"),
    ("inst_underpaid_rate", "UNDERPAID_INSTALLMENTS", "History of underpaid installment amounts", "positive"),
    ("pos_sk_dpd_max", "POS_CASH_DPD", "Days past due on prior POS or cash loans", "positive"),
    ("cc_sk_dpd_max", "CREDIT_CARD_DPD", "Days past due on credit card accounts", "positive"),
    ("cc_utilization_last", "HIGH_CREDIT_UTILIZATION", "High utilization of credit card limit", "positive"),
    ("bb_max_status_max", "BUREAU_BALANCE_DELINQUENCY", "Delinquency in bureau balance history", "positive"),
    ("DAYS_BIRTH", "SHORT_CREDIT_HISTORY", "Limited credit history based on applicant age", "positive"),
    ("AMT_CREDIT", "HIGH_LOAN_AMOUNT", "Requested loan amount relative to income", "positive"),
    ("AMT_INCOME_TOTAL", "LOW_INCOME", "Reported income below threshold", "negative"),
    ("DAYS_EMPLOYED", "SHORT_EMPLOYMENT_TENURE", "Limited employment history", "positive"),
    ("prev_refusal_rate", "PRIOR_APPLICATION_REFUSALS", "High rate of prior application refusals", "positive"),
    ("prev_count_refused", "MULTIPLE_PRIOR_REFUSALS", "Multiple prior applications refused", "positive"),
    ("NAME_EDUCATION_TYPE", "EDUCATION_PROFILE", "Education profile contributes to risk assessment", "positive"),
)
# Fixed text of the notice.
NOTICE_TITLE = "Adverse Action Notice"
NOTICE_INTRO = (
    "Your application was reviewed and could not be approved at this time."
    " The primary factors considered in this decision were:"
)
NOTICE_MORE = "Additional factors considered:"
NOTICE_CLOSE = "This decision was made using an automated system. You have the right to request a human review of this decision."

REASON = "array<struct<feature:string,code:string,description:string,contribution:double>>"


def linear_contributions(df: DataFrame, weights: Mapping[str, float], keep: Sequence[str] = (KEY,)) -> DataFrame:
    """weight x value per feature, in place (X1); every weighted feature must be there."""
    missing = [f for f in weights if f not in df.columns]
    extra = [c for c in df.columns if c not in weights and c not in keep]
    if missing or extra:
        raise ValueError(f"weights and features do not match: missing {missing}, without weight {extra}")
    return df.select(*keep, *[(F.col(f"`{f}`") * F.lit(float(w))).alias(f) for f, w in weights.items()])


def sample_rows(df: DataFrame, n: int = SAMPLE_ROWS, key: str = KEY, seed: int = 42) -> DataFrame:
    """The n rows with the smallest key hash: the same sample on every run."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}-"), F.col(key).cast("string"))), key).limit(n)


def global_importance(contributions: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean absolute and mean signed contribution per feature, ranked."""
    long = long_form(contributions, [], features)
    means = long.groupBy("feature").agg(F.avg(F.abs("value")).alias("mean_abs"), F.avg("value").alias("mean_signed"))
    # one row per feature
    rank = F.row_number().over(Window.orderBy(F.col("mean_abs").desc(), "feature"))
    return means.select(rank.alias("rank"), "feature", "mean_abs", "mean_signed")


def _entries(features: Sequence[str], **fields) -> Column:
    """Array of structs over wide contribution columns, with their position."""
    return F.array(
        *[
            F.struct(F.lit(i).alias("i"), F.lit(f).alias("feature"), F.col(f"`{f}`").cast("double").alias("contribution"), *[fn(f).alias(n) for n, fn in fields.items()])
            for i, f in enumerate(features)
        ]
    )


def top_contributions(contributions: DataFrame, features: Sequence[str], k: int, values: Mapping[str, Column] | None = None) -> Column:
    """Array of the k largest contributions by absolute value, with the feature's value.

    Equal sizes rank by feature name; missing contributions rank last as 0.
    """
    if not 1 <= k <= 50:
        raise ValueError("top k must be between 1 and 50")
    value = (lambda f: values[f].cast("double") if f in values else F.lit(None).cast("double")) if values else (lambda f: F.lit(None).cast("double"))
    ranked = F.transform(
        _entries(features, value=value),
        lambda e: F.struct((-F.abs(F.coalesce(e["contribution"], F.lit(0.0)))).alias("o"), e["feature"].alias("feature"), e["contribution"].alias("contribution"), e["value"].alias("value")),
    )
    top = F.slice(F.array_sort(ranked), 1, k)
    return F.transform(top, lambda e: F.struct(e["feature"].alias("feature"), e["contribution"].alias("contribution"), e["value"].alias("value")))


def reason_columns(
    features: Sequence[str],
    decision: Column,
    reasons: Sequence[tuple[str, str, str, str]] = REASONS,
    n_primary: int = N_PRIMARY,
    n_additional: int = N_ADDITIONAL,
    respect_direction: bool = True,
) -> tuple[Column, Column]:
    """(primary, additional) reason arrays from the contribution columns of the row.

    Only positive contributions of mapped features count; features marked
    negative are left out. Approved applicants get none. Equal contributions
    keep the order of `features`.
    """
    by_name = {r[0]: r for r in reasons if not (respect_direction and r[3] == "negative")}
    used = [f for f in features if f in by_name]
    none = F.array().cast(REASON)
    if not used:
        return none, none
    entries = _entries(used, code=lambda f: F.lit(by_name[f][1]), description=lambda f: F.lit(by_name[f][2]))
    positive = F.filter(entries, lambda e: e["contribution"] > 0)
    keyed = F.transform(positive, lambda e: F.struct((-e["contribution"]).alias("o"), e["i"].alias("i"), e.alias("e")))
    ordered = F.transform(
        F.array_sort(keyed),
        lambda s: F.struct(
            s["e"]["feature"].alias("feature"), s["e"]["code"].alias("code"), s["e"]["description"].alias("description"), s["e"]["contribution"].alias("contribution")
        ),
    )
    wanted = F.when(decision == D.APPROVE, none).otherwise(ordered)
    return F.slice(wanted, 1, n_primary), F.slice(wanted, n_primary + 1, n_additional)


def reason_codes(
    decisions: DataFrame, contributions: DataFrame, features: Sequence[str], key: str = "applicant_id", **options
) -> DataFrame:
    """Notices of a batch, matched by applicant."""
    rows = decisions.select(key, "pd", "decision").join(contributions, key)
    primary, additional = reason_columns(features, F.col("decision"), **options)
    return rows.select(key, "pd", "decision", primary.alias("primary_reasons"), additional.alias("additional_reasons"))


def notice_text(applicant: Column, decision: Column, primary: Column, additional: Column) -> Column:
    """Plain-language notice."""

    def numbered(reasons: Column) -> Column:
        return F.transform(reasons, lambda r, i: F.concat(F.lit("  "), (i + 1).cast("string"), F.lit(". "), r["description"]))

    head = F.array(
        F.lit(NOTICE_TITLE), F.concat(F.lit("Applicant ID: "), applicant), F.concat(F.lit("Decision: "), decision), F.lit(""), F.lit(NOTICE_INTRO), F.lit("")
    )
    empty = F.array().cast("array<string>")
    more = F.when(F.size(additional) > 0, F.concat(F.array(F.lit(""), F.lit(NOTICE_MORE), F.lit("")), numbered(additional))).otherwise(empty)
    lines = F.concat(head, numbered(primary), more, F.array(F.lit(""), F.lit(NOTICE_CLOSE)))
    return F.when(decision == D.APPROVE, F.concat(F.lit("Applicant "), applicant, F.lit(": APPROVED"))).otherwise(F.array_join(lines, "\n"))


# --- batch requests ---------------------------------------------------------


def request_features(requests: DataFrame, features: Sequence[str], column: str = "features", keep: Sequence[str] = ()) -> DataFrame:
    """One column per contracted feature from the request map: absent is null, unknown names are ignored."""
    return requests.select(*keep, *[F.try_element_at(F.col(column), F.lit(f)).cast("double").alias(f) for f in features])


def score_requests(requests: DataFrame, features: Sequence[str], score, calibrate=None, policy: D.Policy | None = None, **options) -> DataFrame:
    """Decision per request.

    `score` takes a DataFrame with one column per feature and returns it with a
    `raw_pd` column; `calibrate` maps that column. Both stay lazy.
    """
    carried = [c for c in ("applicant_id", "segment", "policy_flags") if c in requests.columns]
    scored = score(request_features(requests, features, keep=carried))
    pd = F.col("raw_pd") if calibrate is None else calibrate(F.col("raw_pd"))
    ready = scored.withColumn("pd", F.greatest(F.lit(0.0), F.least(F.lit(1.0), pd)))
    return D.decide(
        ready,
        policy,
        segment="segment" if "segment" in carried else None,
        flags="policy_flags" if "policy_flags" in carried else None,
        **options,
    )


def explain_requests(
    requests: DataFrame,
    features: Sequence[str],
    score,
    weights: Mapping[str, float],
    calibrate=None,
    policy: D.Policy | None = None,
    top_k: int = 5,
    **options,
) -> DataFrame:
    """Decision, top contributions, reasons and notice per request (X9), in one pass over the requests."""
    values = {f: F.col(f"_v_{i}") for i, f in enumerate(features)}

    def scored(df: DataFrame) -> DataFrame:
        out = score(df)
        raw = {f"_v_{i}": F.col(f"`{f}`") for i, f in enumerate(features)}
        return out.withColumns(raw)

    kept = [f"_v_{i}" for i in range(len(features))]
    decided = score_requests(requests, features, scored, calibrate, policy, keep=kept, **options)
    names = [f for f in features if f in weights]
    wide = decided.withColumns({f: values[f] * F.lit(float(weights[f])) for f in names})
    primary, additional = reason_columns(names, F.col("decision"))
    out = wide.withColumns(
        {"top_contributions": top_contributions(wide, names, top_k, values), "primary_reasons": primary, "additional_reasons": additional}
    )
    text = notice_text(F.col("applicant_id"), F.col("decision"), F.col("primary_reasons"), F.col("additional_reasons"))
    return out.select("applicant_id", "pd", "decision", "top_contributions", "primary_reasons", "additional_reasons", text.alias("notice_text"))
