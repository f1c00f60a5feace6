"""Curated queries over the marts and staging."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coinweir.functions import hours_crossed, lit_time


# Presentation order of each mart; the last column breaks ties.
_ORDER = {
    "spend_by_category": [("transaction_month", "asc"), ("total_spend", "desc"), ("category", "asc")],
    "monthly_cashflow": [("transaction_month", "desc")],
    "merchant_summary": [("total_spend", "desc"), ("merchant_id", "asc")],
    "subscriptions": [("months_charged", "desc"), ("charge_amount", "desc"), ("merchant_id", "asc")],
}


def in_order(mart: DataFrame, name: str) -> DataFrame:
    """A mart's rows in their presentation order, NULLs last."""
    return mart.orderBy(*[getattr(F.col(column), f"{way}_nulls_last")() for column, way in _ORDER[name]])


def spend_by_category(mart: DataFrame, month: str | None = None) -> DataFrame:
    """Spend per month and category, biggest first within a month. `month` ("YYYY-MM")
    keeps one month; it becomes a literal bound, which reaches the scan."""
    if month:
        start = F.lit(f"{month}-01").try_cast("timestamp_ntz")
        mart = mart.filter((F.col("transaction_month") == start) & F.lit(len(month) == 7))
    return in_order(mart, "spend_by_category").select(
        "transaction_month", "category", "category_label", "total_spend", "transaction_count"
    )


def monthly_cashflow(mart: DataFrame, months: int | None = None) -> DataFrame:
    """Cashflow, newest month first; `months` keeps that many."""
    ordered = in_order(mart, "monthly_cashflow").select("transaction_month", "income", "expenses", "net")
    return ordered if months is None else ordered.limit(int(months))


def top_merchants(mart: DataFrame, limit: int = 10) -> DataFrame:
    """The merchants with the highest spend; equal spend is ordered by merchant id."""
    return (
        in_order(mart, "merchant_summary")
        .limit(int(limit))
        .select(
            "merchant_name",
            "merchant_category",
            "total_spend",
            "transaction_count",
            "avg_transaction_amount",
            "last_transaction_at",
        )
    )


def subscriptions(mart: DataFrame) -> DataFrame:
    """Recurring charges, longest-running first, then by amount."""
    return in_order(mart, "subscriptions").select(
        "merchant_name",
        "merchant_category",
        "charge_amount",
        "months_charged",
        "charge_count",
        "last_charged_at",
    )


def staging_profile(staging: DataFrame, as_of: datetime | str | None) -> DataFrame:
    """One row of counts over staging, with the hours since the newest transaction (how
    recent the data is, not whether ingestion runs) and whether any id repeats.

    Ids are counted by one shuffle of their own. The other distinct counts are taken from one row for each group of account, category
    and merchant, so that no row of staging is multiplied for them."""
    latest = F.col("latest_transaction_at")
    ids = staging.groupBy("transaction_id").agg(F.lit(1)).agg(F.count("transaction_id"))
    groups = staging.groupBy("account_id", "category", "merchant_id").agg(
        F.count("*").alias("n"),
        F.sum(F.when(F.col("is_declined"), 1).otherwise(0)).alias("declined"),
        F.min("created_at").alias("earliest"),
        F.max("created_at").alias("latest"),
    )
    return (
        groups.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("transaction_count"),
            F.coalesce(ids.scalar(), F.lit(0)).alias("distinct_transaction_ids"),
            F.countDistinct("account_id").alias("account_count"),
            F.countDistinct("category").alias("category_count"),
            F.countDistinct("merchant_id").alias("merchant_count"),
            F.sum("declined").alias("declined_count"),
            F.min("earliest").alias("earliest_transaction_at"),
            F.max("latest").alias("latest_transaction_at"),
        )
        .withColumn("hours_since_last_transaction", hours_crossed(latest, lit_time(as_of)))
        .withColumn(
            "has_duplicate_transaction_ids",
            F.col("transaction_count") != F.col("distinct_transaction_ids"),
        )
    )


def mart_row_counts(marts: dict[str, DataFrame]) -> DataFrame:
    """Rows per mart."""
    counts = [
        mart.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("mart"), "row_count")
        for name, mart in marts.items()
    ]
    union = counts[0]
    for one in counts[1:]:
        union = union.unionByName(one)
    return union


def data_quality_report(
    staging: DataFrame, marts: dict[str, DataFrame], as_of: datetime | str | None = None
) -> DataFrame:
    """The staging profile plus a map of rows per mart, in one row."""
    entries = mart_row_counts(marts).agg(F.collect_list(F.struct("mart", "row_count")).alias("e"))
    return staging_profile(staging, as_of).withColumn(
        "mart_row_counts", F.map_from_entries(entries.scalar())
    )
