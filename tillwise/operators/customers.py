"""Invoice lines to customer measures, scores and segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.functions.columns import (
    MONEY_UNITS, clip, money_sum, rfm_segment, week_start, whole_days,
)
from tillwise.operators.ranks import quintile_by_edges, quintile_by_rank
from tillwise.staging import stage

CUSTOMER = "customer_id"


def clean_transactions(lines: DataFrame) -> DataFrame:
    """Sales only: a customer, positive quantity and price, not a cancelled invoice."""
    return lines.where(
        F.col(CUSTOMER).isNotNull()
        & (F.col("quantity") > 0)
        & (F.col("price") > 0)
        & ~F.coalesce(F.col("invoice").cast("string").startswith("C"), F.lit(False))
    ).withColumn("revenue", F.col("quantity") * F.col("price"))


def line_totals() -> list[Column]:
    """Aggregates of quantity and price that invoice totals carry."""
    return [
        money_sum(F.col("quantity") * F.col("price")).alias("revenue"),
        F.sum("quantity").alias("items"),
        F.count("*").alias("lines"),
    ]


def invoice_totals(transactions: DataFrame) -> DataFrame:
    """One row per customer, invoice, date and country. Everything downstream starts from
    here, so the lines of a huge customer are spread over the customer's invoices."""
    return transactions.groupBy(CUSTOMER, "invoice", "invoice_date", "country").agg(*line_totals())


def _latest(df: DataFrame, column: str) -> Column:
    """The column's maximum as a literal, passed as text so that no driver time zone enters."""
    text = df.agg(F.max(column).cast("string")).first()[0]
    return F.lit(text).cast(df.schema[column].dataType)


def rfm_base(invoices: DataFrame, one_row_per_invoice: bool = False) -> DataFrame:
    """Recency, frequency and spend per customer; staged, one row per customer.

    Days count from one week after the last purchase of all. The mean order value is the
    mean over invoice lines. An invoice split over several dates or countries counts once;
    the caller may promise that there is none.
    """
    country = F.array_compact(F.array("country"))
    if not one_row_per_invoice:
        invoices = invoices.groupBy(CUSTOMER, "invoice").agg(
            F.max("invoice_date").alias("invoice_date"), F.min("invoice_date").alias("_first"),
            money_sum(F.col("revenue")).alias("revenue"), F.sum("items").alias("items"),
            F.sum("lines").alias("lines"), F.collect_set("country").alias("_countries"),
        )
        first, country = F.col("_first"), F.col("_countries")
    else:
        first = F.col("invoice_date")
    per_customer = invoices.groupBy(CUSTOMER).agg(
        F.max("invoice_date").alias("last_purchase"), F.min(first).alias("first_purchase"),
        F.count("invoice").alias("frequency"),
        money_sum(F.col("revenue")).alias("monetary"),
        F.sum("lines").alias("lines"), F.sum("items").alias("total_items"),
        # A set of countries, bounded by their number.
        F.size(F.array_distinct(F.flatten(F.collect_set(country)))).alias("countries"),
    )
    customers = stage(per_customer, "customers")
    lifespan = whole_days(F.col("last_purchase"), F.col("first_purchase")) / 7
    snapshot = _latest(customers, "last_purchase") + F.expr("INTERVAL 7 DAYS")
    return (
        customers.withColumn("recency", whole_days(snapshot, F.col("last_purchase")).cast("int"))
        .withColumn("avg_order_value", F.col("monetary") / F.col("lines"))
        .withColumn("lifespan_weeks", clip(lifespan, low=1))
        .withColumn("weekly_purchase_rate", F.col("frequency") / F.col("lifespan_weeks"))
        .drop("lines", "first_purchase", "last_purchase")
    )


def rfm_scores(base: DataFrame, duplicates: str = "raise") -> DataFrame:
    """Scores 1..5: recency by value edges (recent is 5), frequency and spend by rank."""
    n = base.count()
    scored = quintile_by_edges(base, "recency", "R", reverse=True, duplicates=duplicates)
    scored = quintile_by_rank(scored, "frequency", CUSTOMER, "F", n)
    scored = quintile_by_rank(scored, "monetary", CUSTOMER, "M", n)
    return scored.withColumns({
        "rfm_score": F.col("R") * 100 + F.col("F") * 10 + F.col("M"),
        "rfm_total": F.col("R") + F.col("F") + F.col("M"),
    })


def rfm_segments(scores: DataFrame) -> DataFrame:
    return scores.withColumn("segment", rfm_segment(F.col("R"), F.col("F"), F.col("M")))


def customer_rfm(transactions: DataFrame) -> DataFrame:
    """Clean lines to segmented customers."""
    return rfm_segments(rfm_scores(rfm_base(invoice_totals(clean_transactions(transactions)))))


def repeat_summary(invoices: DataFrame, period_days: int = 7) -> DataFrame:
    """Repeat purchases per customer in weekly periods.

    frequency: periods with a purchase after the first; recency: periods from the first to
    the last; T: periods from the first to the end of observation (a week after the last
    purchase of all); monetary_value: mean spend of the later periods, 0 without any.
    """
    weekly = invoices.groupBy(CUSTOMER, week_start(F.col("invoice_date")).alias("_week")).agg(
        money_sum(F.col("revenue")).alias("_spend"), F.max("invoice_date").alias("_last")
    )
    customers = stage(
        weekly.groupBy(CUSTOMER).agg(
            (F.count("*") - 1).alias("frequency"),
            F.min("_week").alias("_first_week"), F.max("_week").alias("_last_week"),
            F.max("_last").alias("_last"),
            F.sum(F.rint(F.col("_spend") * MONEY_UNITS).cast("decimal(28,0)")).alias("_all"),
            F.min_by(F.rint(F.col("_spend") * MONEY_UNITS).cast("decimal(28,0)"), "_week").alias("_opening"),
        ),
        "repeat",
    )
    last_week = week_start(_latest(customers, "_last") + F.expr("INTERVAL 7 DAYS"))
    later = (F.col("_all") - F.col("_opening")).cast("double") / MONEY_UNITS
    return customers.select(
        CUSTOMER, "frequency",
        (F.datediff("_last_week", "_first_week") / period_days).alias("recency"),
        (F.datediff(last_week, F.col("_first_week")) / period_days).alias("T"),
        F.coalesce(F.try_divide(later, F.col("frequency")), F.lit(0.0)).alias("monetary_value"),
    )


def linear_clv(rate: Column, order_value: Column, weeks: int = 52, discount: float = 0.10) -> Column:
    """Spend projected from the purchase rate, discounted once."""
    return rate * order_value * weeks / (1 + discount)


def add_linear_clv(base: DataFrame) -> DataFrame:
    """Historical and projected value where no probability model is fitted."""
    projected = linear_clv(F.col("weekly_purchase_rate"), F.col("avg_order_value"))
    return base.withColumns({
        "clv_historical": F.col("monetary"),
        "clv_projected_12m": F.bround(projected, 2),
        "clv_model_type": F.lit("linear_projection"),
    })
