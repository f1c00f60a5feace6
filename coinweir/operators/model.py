"""Dimensions and the fact, from staging rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coinweir.functions import category_label, lit_time, major_units, month_start, partition_number
from coinweir.schemas import PARTITION_COLUMNS


def dim_account(staging: DataFrame) -> DataFrame:
    """One row per account seen, with its activity."""
    return staging.groupBy("account_id").agg(
        F.min("created_at").alias("first_transaction_at"),
        F.max("created_at").alias("last_transaction_at"),
        F.count("*").alias("transaction_count"),
    )


def dim_category(staging: DataFrame) -> DataFrame:
    """Distinct categories with a readable label, made once per category."""
    seen = staging.filter(F.col("category").isNotNull()).select("category").distinct()
    return seen.withColumn("category_label", category_label(F.col("category")))


def dim_merchant(staging: DataFrame) -> DataFrame:
    """One row per merchant; each attribute is its smallest non-NULL value.

    Rows are first reduced to distinct combinations by a hash aggregate. A minimum of
    strings alone would sort every staging row. The count is used, if trivially, because
    Spark folds a plain distinct into the minimum and the sort is back.
    """
    attributes = {
        "merchant_name": "merchant_name",
        "merchant_category": "merchant_category",
        "merchant_emoji": "merchant_emoji",
        "is_online_merchant": "merchant_online",
        "is_atm": "merchant_atm",
    }
    combinations = (
        staging.filter(F.col("merchant_id").isNotNull())
        .groupBy("merchant_id", *attributes.values())
        .agg(F.count("*").alias("n"))
    )
    seen = F.col("n") > 0
    return combinations.groupBy("merchant_id").agg(
        *[F.min(F.when(seen, F.col(column))).alias(name) for name, column in attributes.items()]
    )


def fct_transactions(staging: DataFrame) -> DataFrame:
    """One row per transaction, declined attempts included."""
    minor = F.col("amount_minor_units")
    return staging.select(
        "transaction_id",
        "account_id",
        "merchant_id",
        "category",
        "created_at",
        "settled_at",
        month_start(F.col("created_at")).alias("transaction_month"),
        "is_settled",
        "is_declined",
        "amount_minor_units",
        major_units(minor).alias("amount"),
        (minor > 0).alias("is_credit"),
        (minor < 0).alias("is_debit"),
        "currency",
        "description",
        "notes",
        "ingestion_source",
    )


def recent_lookback(staging: DataFrame, as_of: datetime | str | None, hours: int = 24) -> DataFrame:
    """Rows created in the last `hours` up to `as_of`, across all accounts.

    The bound is a literal, so it reaches the Parquet scan; on published staging it also
    becomes a bound on the partitions, and older months are not opened.
    """
    since = lit_time(as_of) - F.expr(f"interval {int(hours)} hours")
    recent = staging.filter(F.col("created_at") >= since)
    if set(PARTITION_COLUMNS) <= set(staging.columns):
        year, month = (F.col(name) for name in PARTITION_COLUMNS)
        recent = recent.filter(partition_number(year, month) >= F.year(since) * 100 + F.month(since))
    return recent
