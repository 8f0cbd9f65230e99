"""Decisions from calibrated probabilities.

The policy is configuration: it turns into one expression per output column, so
a decision needs no join and no shuffle, and the same code takes a stream.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendframe.functions.ordered import attach_groups
from lendframe.operators import metrics as M

APPROVE, REFER, DECLINE = "APPROVE", "REFER", "DECLINE"
REVIEW_SHARE = 0.1

# Fixed values of the decision policy.
COST_FN, COST_FP = 20.0, 1.0
DEFAULT_LIMITS = (0.040, 0.200)
SEGMENT_LIMITS = {"new_customer": (0.060, 0.150), "existing_customer": (0.100, 0.220)}
OVERRIDES = (
    ("sanctions_list", DECLINE, "Applicant appears on sanctions list"),
    ("internal_blacklist", DECLINE, "Applicant is on internal blacklist"),
    ("fraud_flag", DECLINE, "Application flagged as potential fraud"),
    ("vip_customer", APPROVE, "Pre-approved VIP customer"),
)
POLICY_VERSION, MODEL_NAME, MODEL_VERSION = "1.0.0", "challenger", "0.1.0"


class PolicyError(ValueError):
    """A policy breaks its own bounds."""


@dataclass(frozen=True)
class Policy:
    """Costs, limits per segment and ordered overrides.

    A segment named `default` is ignored: the default limits apply to every
    segment without its own.
    """

    cost_fn: float = COST_FN
    cost_fp: float = COST_FP
    default_limits: tuple[float, float] = DEFAULT_LIMITS
    segments: Mapping[str, tuple[float, float]] = field(default_factory=lambda: dict(SEGMENT_LIMITS))
    overrides: Sequence[tuple[str, str, str]] = OVERRIDES
    version: str = POLICY_VERSION
    model: str = MODEL_NAME
    model_version: str = MODEL_VERSION

    def __post_init__(self) -> None:
        if self.cost_fn <= 0 or self.cost_fp <= 0:
            raise PolicyError("costs must be positive")
        for name, (approve, review) in {"default": self.default_limits, **self.segments}.items():
            if not (0 <= approve <= 1 and 0 <= review <= 1 and approve < review):
                raise PolicyError(f"segment {name!r}: limits must satisfy 0 <= approve < review <= 1")
        for name, decision, _ in self.overrides:
            if decision not in (APPROVE, REFER, DECLINE):
                raise PolicyError(f"override {name!r}: unknown decision {decision!r}")

    def limit(self, segment: Column, which: int) -> Column:
        out = F.lit(self.default_limits[which])
        for name, limits in self.segments.items():
            if name != "default":
                out = F.when(segment == name, F.lit(limits[which])).otherwise(out)
        return out


def checked_probability(pd: Column) -> Column:
    """The probability, or a task error when it is null or outside [0, 1]."""
    return F.when(pd.between(0, 1), pd).otherwise(F.raise_error(F.concat(F.lit("pd must be in [0, 1], got "), F.coalesce(pd.cast("string"), F.lit("null")))))


def reject_invalid(df: DataFrame, pd: str = "pd") -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows) for jobs that must not stop on a bad score."""
    ok = F.coalesce(F.col(pd).between(0, 1), F.lit(False))
    return df.where(ok), df.where(~ok)


def first_override(policy: Policy, flags: Column) -> Column:
    """(name, decision, reason) of the first raised flag in policy order, else null (D3)."""
    out = F.lit(None)
    for name, decision, reason in reversed(policy.overrides):
        hit = F.struct(F.lit(name).alias("name"), F.lit(decision).alias("decision"), F.lit(reason).alias("reason"))
        out = F.when(F.coalesce(F.try_element_at(flags, F.lit(name)), F.lit(False)), hit).otherwise(out)
    return out


def threshold_decision(policy: Policy, pd: Column, segment: Column) -> tuple[Column, Column]:
    """Decision and the limit it rests on (D2): approve strictly below the first limit, refer strictly below the second."""
    approve, review = policy.limit(segment, 0), policy.limit(segment, 1)
    decision = F.when(pd < approve, APPROVE).when(pd < review, REFER).otherwise(DECLINE)
    return decision, F.when(pd < approve, approve).otherwise(review)


def expected_cost(policy: Policy, pd: Column, decision: Column) -> Column:
    """Cost of a decision at a given probability."""
    return (
        F.when(decision == APPROVE, policy.cost_fn * pd)
        .when(decision == DECLINE, policy.cost_fp * (1 - pd))
        .otherwise(F.lit(REVIEW_SHARE * policy.cost_fp))
    )


def decide(
    df: DataFrame,
    policy: Policy | None = None,
    applicant: str = "applicant_id",
    pd: str = "pd",
    segment: str | None = None,
    flags: str | None = None,
    decided_at: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Twelve outcome columns per applicant (D5); `keep` names further input columns to carry along."""
    policy = policy or Policy()
    missing = [c for c in (applicant, pd) if c not in df.columns]
    if missing:
        raise KeyError(f"applicants lack columns {missing}")
    rows = df.select(
        *[F.col(c) for c in keep],
        F.col(applicant).cast("string").alias("applicant_id"),
        checked_probability(F.col(pd).cast("double")).alias("_pd"),
        (F.coalesce(F.col(segment), F.lit("default")) if segment else F.lit("default")).alias("segment"),
        (first_override(policy, F.col(flags)) if flags else F.lit(None).cast("struct<name:string,decision:string,reason:string>")).alias("_o"),
    )
    decision, limit = threshold_decision(policy, F.col("_pd"), F.col("segment"))
    forced = F.col("_o").isNotNull()
    at = F.lit(decided_at) if decided_at else F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return rows.select(
        *keep,
        "applicant_id",
        F.round("_pd", 6).alias("pd"),
        F.coalesce("_o.decision", decision).alias("decision"),
        F.round(F.when(forced, 0.0).otherwise(limit), 6).alias("threshold_used"),
        "segment",
        F.col("_o.name").alias("override_applied"),
        F.col("_o.reason").alias("override_reason"),
        F.round(F.when(forced, 0.0).otherwise(expected_cost(policy, F.col("_pd"), decision)), 6).alias("expected_cost"),
        F.lit(policy.model).alias("model"),
        F.lit(policy.model_version).alias("model_version"),
        F.lit(policy.version).alias("config_version"),
        at.alias("decided_at"),
    )


def decision_distribution(df: DataFrame, by: Sequence[str], label: str, decision: str = "decision") -> DataFrame:
    """Count, percent and default rate per band."""
    by = list(by)
    cells = df.groupBy(*by, decision).agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(label)).alias("default_rate"))
    whole = cells.groupBy(*by).agg(F.sum("n").alias("_all"))
    joined = attach_groups(cells, whole, by)
    return joined.select(*by, decision, "n", (F.col("n") / F.col("_all") * 100).alias("percent"), "default_rate")


def threshold_gap(df: DataFrame, by: Sequence[str], score: str, label: str, policy: Policy | None = None) -> DataFrame:
    """Cost-optimal threshold against the configured one."""
    policy = policy or Policy()
    best = M.cost_optimal(df, by, score, label, [policy.cost_fn / policy.cost_fp], policy.cost_fp)
    return best.withColumns(
        {"configured": F.lit(policy.default_limits[0]), "delta": F.col("threshold") - F.lit(policy.default_limits[0])}
    )
