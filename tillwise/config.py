"""Every tunable constant of the library, in one place."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

# Event names that count as a major holiday.
MAJOR_HOLIDAYS = (
    "SuperBowl", "Thanksgiving", "Christmas", "OrthodoxChristmas", "IndependenceDay",
    "LaborDay", "Easter", "OrthodoxEaster", "Mother's day", "Father's day", "Halloween",
    "NewYear", "ChristmasEve", "Chanukah End", "Purim End", "MartinLutherKingDay",
    "PresidentsDay", "MemorialDay", "ColumbusDay", "VeteransDay",
)

# Flag column -> text that the event name contains.
NAMED_HOLIDAYS = {
    "is_thanksgiving": "Thanksgiving",
    "is_christmas": "Christmas",
    "is_superbowl": "SuperBowl",
    "is_easter": "Easter",
    "is_independence": "IndependenceDay",
    "is_laborday": "LaborDay",
    "is_mothersday": "Mother",
}

# Flag column -> event type.
EVENT_TYPES = {
    "is_sporting": "Sporting",
    "is_cultural": "Cultural",
    "is_national": "National",
    "is_religious": "Religious",
}

# States with benefit-payment days, their names and regions.
STATES = ("CA", "TX", "WI")
STATE_NAMES = {"CA": "California", "TX": "Texas", "WI": "Wisconsin"}
STATE_REGION = {"CA": "West", "TX": "South", "WI": "Midwest"}

LAGS = (1, 2, 3, 4, 8, 12, 52)
ROLLING = (4, 8, 12)

EVENT_FLAGS = (
    "has_event", "n_events", "has_major_holiday", *EVENT_TYPES, *NAMED_HOLIDAYS,
    "event_week_before", "event_week_after",
)

# The 49 model inputs.
FEATURES = (
    *(f"lag_{k}" for k in LAGS),
    *(f"rolling_{s}_{w}" for w in ROLLING for s in ("mean", "std")),
    "yoy_growth",
    "unit_price", "price_lag_1", "price_change", "price_vs_median_ratio",
    "snap_days", "snap",
    *EVENT_FLAGS,
    "days_since_last_event",
    "is_month_end",
    "week_of_year", "month", "quarter", "year", "is_q4", "is_january",
    "weeks_since_start",
    "store_encoded", "product_encoded", "cat_encoded", "dept_encoded",
)

# Segment -> chart colour.
SEGMENT_COLOURS = {
    "Champions": "#00c4a0",
    "Loyal customers": "#4a9eff",
    "Potential loyalists": "#a78bfa",
    "At risk": "#f5a623",
    "New customers": "#5DCAA5",
    "Cannot lose them": "#D4537E",
    "Needs attention": "#526070",
    "Lost": "#f04b5a",
}

CHURN_CUTS, CHURN_TIERS = (0.25, 0.5, 0.75), ("Low", "Medium", "High", "Critical")
CLUSTER_LABELS = ("High value", "Mid value", "Low value", "Inactive")


@dataclass(frozen=True)
class PanelConfig:
    top_n: int = 200
    min_weeks: int = 52
    chunk_days: int = 200
    velocity_weeks: int = 8


@dataclass(frozen=True)
class CustomerConfig:
    churn_days: int = 90
    annual_discount: float = 0.10
    projection_weeks: int = 52
    clv_months: int = 12
    penalizer: float = 0.01
    clusters: int = 4


@dataclass(frozen=True)
class SplitConfig:
    train_end: date = date(2014, 12, 31)
    val_end: date = date(2015, 12, 31)


@dataclass(frozen=True)
class BoostConfig:
    """Tree boosting budget."""

    rounds: int = 1000
    depth: int = 7
    step: float = 0.05
    row_fraction: float = 0.8
    column_fraction: float = 0.8
    min_rows: int = 20
    seed: int = 42
