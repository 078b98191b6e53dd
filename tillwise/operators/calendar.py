"""Day calendar to weekly event and benefit-payment features."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwise.config import EVENT_TYPES, MAJOR_HOLIDAYS, NAMED_HOLIDAYS, STATES
from tillwise.functions.columns import flag, is_month_end, week_start

SLOTS = ("1", "2")
NEVER = 365


def _any_slot(prefix: str, test) -> Column:
    checks = [flag(test(F.col(f"{prefix}_{slot}"))) for slot in SLOTS]
    return F.max(F.greatest(*checks))


def weekly_calendar(
    calendar: DataFrame, holidays: tuple[str, ...] = MAJOR_HOLIDAYS, states: tuple[str, ...] = STATES
) -> DataFrame:
    """One row per week: event counts and flags, benefit days per state, neighbours.

    Serves history and future alike. A holiday name counts wherever it is contained, so
    OrthodoxChristmas is a Christmas week too. The windows run over the weeks of the
    calendar in one task: one row per week, whatever the size of the sales.
    """
    named = [F.count(F.col(f"event_name_{slot}")) for slot in SLOTS]
    weekly = calendar.groupBy(week_start(F.col("date")).alias("week")).agg(
        reduce(lambda a, b: a + b, named).cast("int").alias("n_events"),
        _any_slot("event_name", lambda c: c.isin(*holidays)).alias("has_major_holiday"),
        *[_any_slot("event_type", lambda c, t=t: c == t).alias(n) for n, t in EVENT_TYPES.items()],
        *[_any_slot("event_name", lambda c, t=t: c.contains(t)).alias(n) for n, t in NAMED_HOLIDAYS.items()],
        *[F.sum(f"snap_{s}").cast("int").alias(f"snap_days_{s}") for s in states],
    )
    order = W.orderBy("week")
    so_far = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    place = F.row_number().over(order)
    return (
        weekly.withColumn("has_event", flag(F.col("n_events") > 0))
        .withColumn("_place", place)
        .withColumns({
            "is_month_end": is_month_end(F.col("week")),
            "event_week_before": F.lead("has_major_holiday", 1, 0).over(order),
            "event_week_after": F.lag("has_major_holiday", 1, 0).over(order),
            "_last": F.max(F.when(F.col("has_event") == 1, F.col("_place"))).over(so_far),
        })
        .withColumn(
            "days_since_last_event",
            F.coalesce((F.col("_place") - F.col("_last")) * 7, F.lit(NEVER)).cast("int"),
        )
        .drop("_place", "_last")
    )


def average_snap(calendar: DataFrame, states: tuple[str, ...] = STATES) -> DataFrame:
    """Mean benefit days per week and state, the default beyond the calendar; one row."""
    return calendar.agg(*[(F.avg(f"snap_{s}") * 7).alias(f"snap_days_{s}") for s in states])


def state_snap_days(state: Column, states: tuple[str, ...] = STATES) -> Column:
    """The benefit days of the row's own state; an unknown state takes the last one."""
    picks = [F.when(state == s, F.col(f"snap_days_{s}")) for s in states[:-1]]
    return F.coalesce(*picks, F.col(f"snap_days_{states[-1]}"))
