"""Column expressions shared by the roll-ups. All of them stay JVM-side."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Metadata key of `made`.
MADE = "aggregation"
#: Orders lie below this in size; null stands at its end.
OPEN_ORDER = 1 << 62
#: Steps between two powers of two, as a double counts them.
STEPS = 1 << 52


def count_where(condition: Column) -> Column:
    """Rows of the group that satisfy the condition; 0 when none does (A2)."""
    return F.count_if(condition)


def slug(value: str) -> str:
    """Column suffix of a category value."""
    return value.lower().replace(" ", "_").replace("-", "_")


def known_counts(column: Column, values: Iterable[str], prefix: str) -> list[Column]:
    """One zero-filled count per known value, so the schema never depends on the data."""
    return [made(count_where(column == v), prefix + slug(v), "count") for v in values]


def residual_count(column: Column, values: Iterable[str]) -> Column:
    """Rows whose value is null or outside the known list."""
    return count_where(column.isNull() | ~column.isin(*values))


def ever(count: Column) -> Column:
    """1 when the count is positive (A10)."""
    return (count > 0).cast("int")


def flag(condition: Column) -> Column:
    """1 when the condition holds, 0 otherwise and for null."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def positive_flag(column: Column) -> Column:
    """1 when positive, 0 otherwise and for null."""
    return flag(column > 0)


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """Null unless the denominator is positive."""
    return numerator / F.when(denominator > 0, denominator)


def rate(part: Column, whole: Column) -> Column:
    """Null when the whole is zero."""
    return part / F.nullif(whole, F.lit(0))


def made(column: Column, name: str, kind: str) -> Column:
    """Named column that carries how it was made; the mark survives projections, joins and Parquet."""
    return column.alias(name, metadata={MADE: kind})


def whole_rank(value: Column) -> Column:
    """A bigint that rises strictly with a double: how many doubles lie between it and zero, with its sign; NaN is largest.

    |value| is split into a power of two and a factor from 1 to 2; both are exact, whatever the logarithm's last bit says.
    There is no conditional expression around the parts that repeat, so that Spark makes each of them once.
    """
    x = F.abs(value.cast("double"))

    def one(condition: Column) -> Column:
        return condition.cast("int")

    power = F.greatest(F.lit(-1022.0), F.least(F.lit(1023.0), F.coalesce(F.floor(F.log2(x)).cast("double"), F.lit(-1022.0))))
    factor = F.least(x / F.pow(F.lit(2.0), power), F.lit(3.0))  # infinity and NaN become 3
    low, high = one(factor < 1) * one(power > -1022), one(factor >= 2)  # below 2**-1022 factors stay below 1
    steps = ((factor * (low + 1 - high * 0.5) - 1) * float(STEPS)).cast("bigint")
    size = F.least((power + 1023 + high - low).cast("bigint") * STEPS + steps, F.lit(2047 * STEPS))
    nan = F.isnan(x).cast("bigint")
    return (size * (1 - nan) + nan * F.lit(2**63 - 1)) * (1 - 2 * one(value.cast("double") < 0))


def _tie_key(order: Column, value: Column) -> Column:
    """One decimal that sorts by `order` (whole numbers below OPEN_ORDER, null last), then by value, over the range of either.

    A decimal is a buffer the hash aggregate can update in place; a struct would make it sort all rows.
    """
    at = F.greatest(F.lit(-OPEN_ORDER + 1), F.least(F.lit(OPEN_ORDER - 1), order.cast("bigint")))
    at = F.when(order.isNull(), F.lit(OPEN_ORDER)).otherwise(at).cast("decimal(19,0)")
    return (at * F.lit(str(1 << 64)).cast("decimal(20,0)")).cast("decimal(38,0)") + whole_rank(value).cast("decimal(19,0)")


def last_non_null(value: Column, order: Column) -> Column:
    """Last non-null value of the group by `order`, null orders last.

    Each column skips its own nulls, so two columns of one group may come from
    different rows. Rows that tie on `order` resolve to the largest value.
    """
    return F.max_by(value, last_order(value, order))


def last_order(value: Column, order: Column) -> Column:
    """The key by which `last_non_null` chooses, null for a null value; its maximum lets parts of a group choose again among their last values."""
    return _tie_key(order, value)


def row_at_max(fields: Iterable[str], order: str, *ties: str) -> Column:
    """Struct of `fields` from the row with the largest non-null `order`, nulls kept."""
    key = F.struct(*[F.col(c) for c in (order, *ties)])
    return F.max_by(F.struct(*fields), F.when(F.col(order).isNotNull(), key))


def last_by(order: Column, tie: Column) -> Column:
    """Key of the row with the largest whole-number `order`, then the largest `tie` (a bigint); null where the order is.

    With it, `max_by` of single columns picks them all from one row (A16) and stays in the hash aggregate.
    """
    at = (order.cast("bigint") * F.lit("2e19").cast("decimal(20,0)")).cast("decimal(37,0)")
    return at + F.coalesce(tie.cast("bigint"), F.lit(-(2**63))).cast("decimal(20,0)")


def ordinal(column: Column, codes: Mapping[str, int]) -> Column:
    """Code of a known value, null for anything else."""
    table = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    return F.try_element_at(table, column)


def clean_text(column: Column, upper: bool = False) -> Column:
    """Strip blanks, tabs and line ends on both sides."""
    stripped = F.btrim(column, F.lit(" \t\n\r\f\x0b"))
    return F.upper(stripped) if upper else stripped


def pick(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Plain projection of many columns; names go over as text, which keeps wide plans quick to build."""
    return df.selectExpr(*[f"`{n}`" for n in names])


def ordered_columns(df: DataFrame, *first: str, last: Iterable[str] = ()) -> DataFrame:
    """Named columns first, the others by name, then the trailing ones."""
    tail = list(last)
    middle = sorted(c for c in df.columns if c not in first and c not in tail)
    return pick(df, [*first, *middle, *tail])


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into null in every floating column: missing has one spelling inside the package."""
    return df.select(
        *[
            F.when(~F.isnan(F.col(f"`{n}`")), F.col(f"`{n}`")).alias(n) if t in ("double", "float") else F.col(f"`{n}`")
            for n, t in df.dtypes
        ]
    )
