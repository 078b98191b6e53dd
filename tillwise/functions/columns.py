"""Column expressions shared by the operators; all run inside the JVM."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.config import CHURN_CUTS, CHURN_TIERS, STATE_NAMES

MONEY_UNITS = 10_000
UNIT_BLOCK = 1_000_000


def week_start(day: Column) -> Column:
    """Monday of the week."""
    return F.date_trunc("week", day).cast("date")


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def add_weeks(day: Column, weeks: int) -> Column:
    return F.date_add(day, 7 * weeks)


def whole_days(later: Column, earlier: Column) -> Column:
    """Complete 24-hour days between two timestamps."""
    return F.timestamp_diff("DAY", earlier.cast("timestamp"), later.cast("timestamp"))


def _money_total(amount: Column) -> Column:
    """Sum of integer ten-thousandths as two long sums, of millions of units and of the rest.

    Both stay far below a long's range for any table, and integers make the row order irrelevant.
    """
    units = F.rint(amount * MONEY_UNITS)
    millions = F.floor(units / UNIT_BLOCK)
    rest = (units - millions * UNIT_BLOCK).cast("long")
    return (F.sum(millions.cast("long")).cast("double") * UNIT_BLOCK + F.sum(rest)) / MONEY_UNITS


def money_sum(amount: Column) -> Column:
    """Sum of money to ten-thousandths, the same for any row order; 0 without amounts."""
    return F.coalesce(_money_total(amount), F.lit(0.0))


def money_mean(amount: Column) -> Column:
    """Mean of the non-null amounts, independent of row order."""
    return F.try_divide(_money_total(amount), F.count(amount))


def clip(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """Bound a value; nulls stay null."""
    out = value
    if low is not None:
        out = F.greatest(out, F.lit(float(low)))
    if high is not None:
        out = F.least(out, F.lit(float(high)))
    return F.when(value.isNotNull(), out)


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0, also for null."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def is_month_end(week: Column) -> Column:
    """The next week starts in another month."""
    return flag(F.month(add_weeks(week, 1)) != F.month(week))


def calendar_parts(week: Column) -> dict[str, Column]:
    """Date parts used as model inputs."""
    month = F.month(week)
    return {
        "week_of_year": F.weekofyear(week),
        "month": month,
        "quarter": F.quarter(week),
        "year": F.year(week),
        "is_q4": flag(month >= 10),
        "is_january": flag(month == 1),
    }


def constant_map(key: Column, values: Mapping[str, str]) -> Column:
    """Look a key up in a small constant map; unknown keys give null."""
    pairs = [F.lit(part) for pair in values.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), key)


def tier(value: Column, cuts: Sequence[float], labels: Sequence[str], right: bool = False) -> Column:
    """Label a value by ascending cuts; a value on a cut belongs to the upper label, or to
    the lower one with ``right``. A null takes the last label."""
    below = [(value <= cut) if right else (value < cut) for cut in cuts]
    first = F.when(below[0], labels[0])
    return reduce(lambda acc, pair: acc.when(*pair), zip(below[1:], labels[1:]), first).otherwise(labels[-1])


def churn_tier(score: Column) -> Column:
    return tier(score, CHURN_CUTS, CHURN_TIERS)


def stock_status(weeks: Column) -> Column:
    """Status from weeks of cover, tested after rounding to one decimal."""
    return tier(weeks, (2.0, 4.0), ("Critical", "Warning", "Safe"), right=True)


def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    """Customer segment; the rules are fixed and the first that holds wins (a null score fails a rule)."""
    return (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
        .when((r >= 3) & (f >= 3), "Loyal customers")
        .when((r >= 4) & (f <= 2), "New customers")
        .when((r >= 3) & (f >= 2) & (m >= 3), "Potential loyalists")
        .when((r == 2) & (f >= 2), "At risk")
        .when((r <= 2) & (f >= 3), "Cannot lose them")
        .when((r <= 2) & (f <= 2) & (m <= 2), "Lost")
        .otherwise("Needs attention")
    )


def product_label(product: Column, category: Column) -> Column:
    """``FOODS_3_586`` of category ``FOODS`` reads ``Foods · Item 586``."""
    parts = F.split(product, "_")
    family = F.when(F.length(category) > 0, category).otherwise(F.get(parts, F.lit(0)))
    return F.concat(F.initcap(family), F.lit(" · Item "), F.element_at(parts, -1))


def store_name(store: Column) -> Column:
    """``CA_1`` reads ``CA_1 — California Store 1``."""
    parts = F.split(store, "_")
    state = constant_map(F.get(parts, F.lit(0)), STATE_NAMES)
    return F.concat(store, F.lit(" — "), state, F.lit(" Store "), F.get(parts, F.lit(1)))


def order_key(store: Column, day: Column) -> Column:
    return F.concat_ws("_", store, F.date_format(day, "yyyyMMdd"))


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating-point column half-even in binary, without negative zeros."""
    scale = float(10**digits)
    return df.select(*[
        (F.rint(F.col(f.name) * scale) / scale + 0.0).alias(f.name)
        if f.dataType.typeName() in ("double", "float") else F.col(f.name)
        for f in df.schema.fields
    ])
