"""Marts, from the fact and the dimensions.

Money is summed as integer minor units and converted once, so totals do not depend on
the order of summing. Each mart aggregates before it joins a dimension: the join then sees
one row per group, and a group with a third of all rows shrinks inside the tasks that read it.

The aggregates before the joins can be kept by month (`month_parts`): a month that is rebuilt replaces its own, and `marts_of_parts` puts the marts
together from those of all months without a look at other months' rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coinweir.functions import major_units, month_start
from coinweir.operators.model import dim_category, dim_merchant, fct_transactions

MIN_MONTHS = 2


def _spending(fact: DataFrame) -> DataFrame:
    """Money going out that was not declined."""
    return fact.filter(F.col("is_debit") & ~F.col("is_declined"))


def _spent() -> Column:
    return F.sum(-F.col("amount_minor_units"))


def mart_spend_by_category(fact: DataFrame, categories: DataFrame) -> DataFrame:
    """Monthly spend per category. Categories unknown to the dimension, and rows without
    one, form one group with a NULL category."""
    return _labelled_spend(_category_parts(fact), categories)


def _category_parts(fact: DataFrame) -> DataFrame:
    return (
        _spending(fact)
        .groupBy("transaction_month", F.col("category").alias("fact_category"))
        .agg(_spent().alias("spent"), F.count("*").alias("n"))
    )


def _labelled_spend(per_group: DataFrame, categories: DataFrame) -> DataFrame:
    labelled = per_group.join(categories, F.col("fact_category") == F.col("category"), "left")
    return labelled.groupBy("transaction_month", "category", "category_label").agg(
        major_units(F.sum("spent")).alias("total_spend"), F.sum("n").alias("transaction_count")
    )


def mart_monthly_cashflow(fact: DataFrame) -> DataFrame:
    """Income, expenses and net per month, declined rows left out."""
    return _money(_cashflow_parts(fact))


def _cashflow_parts(fact: DataFrame) -> DataFrame:
    minor = F.col("amount_minor_units")
    none = F.lit(0).cast("bigint")
    return (
        fact.filter(~F.col("is_declined"))
        .groupBy("transaction_month")
        .agg(
            F.sum(F.when(F.col("is_credit"), minor).otherwise(none)).alias("income"),
            F.sum(F.when(F.col("is_debit"), -minor).otherwise(none)).alias("expenses"),
            F.sum(minor).alias("net"),
        )
    )


def _money(flow: DataFrame) -> DataFrame:
    return flow.select("transaction_month", *[major_units(F.col(name)).alias(name) for name in ("income", "expenses", "net")])


def mart_merchant_summary(fact: DataFrame, merchants: DataFrame) -> DataFrame:
    """Spend per merchant; rows without a merchant in the dimension drop out.

    Both sides of the join are grouped by merchant, so the join needs no further shuffle.
    """
    return _summaries(_merchant_parts(fact), merchants)


def _merchant_parts(fact: DataFrame, *by: str) -> DataFrame:
    return (
        _spending(fact)
        .filter(F.col("merchant_id").isNotNull())
        .groupBy("merchant_id", *by)
        .agg(
            _spent().alias("spent"),
            F.count("*").alias("transaction_count"),
            F.min("created_at").alias("first_transaction_at"),
            F.max("created_at").alias("last_transaction_at"),
        )
    )


def _summaries(per_merchant: DataFrame, merchants: DataFrame) -> DataFrame:
    total = major_units(F.col("spent"))
    return per_merchant.join(merchants, "merchant_id").select(
        "merchant_id",
        "merchant_name",
        "merchant_category",
        total.alias("total_spend"),
        "transaction_count",
        (total / F.col("transaction_count")).alias("avg_transaction_amount"),
        "first_transaction_at",
        "last_transaction_at",
    )


def mart_subscriptions(fact: DataFrame, merchants: DataFrame, min_months: int = MIN_MONTHS) -> DataFrame:
    """Merchants that charged one exact amount in at least `min_months` calendar months.

    Grouped on the integer amount, never on a double. Counting per month first keeps a busy
    (merchant, amount) pair small before its months are counted.
    """
    return _recurring(_charge_parts(fact), merchants, min_months)


def _charge_parts(fact: DataFrame) -> DataFrame:
    return (
        _spending(fact)
        .filter(F.col("merchant_id").isNotNull())
        .groupBy("merchant_id", "amount_minor_units", "transaction_month")
        .agg(
            F.count("*").alias("n"),
            F.min("created_at").alias("first_at"),
            F.max("created_at").alias("last_at"),
        )
    )


def _recurring(per_month: DataFrame, merchants: DataFrame, min_months: int) -> DataFrame:
    recurring = (
        per_month.groupBy("merchant_id", "amount_minor_units")
        .agg(
            F.count("transaction_month").alias("months_charged"),
            F.sum("n").alias("charge_count"),
            F.min("first_at").alias("first_charged_at"),
            F.max("last_at").alias("last_charged_at"),
        )
        .filter(F.col("months_charged") >= min_months)
    )
    return recurring.join(merchants, "merchant_id", "left").select(
        "merchant_id",
        "merchant_name",
        "merchant_category",
        major_units(-F.col("amount_minor_units")).alias("charge_amount"),
        "months_charged",
        "charge_count",
        "first_charged_at",
        "last_charged_at",
    )


#: Columns of staging that dimensions are made from.
_MERCHANT = ["merchant_id", "merchant_name", "merchant_category", "merchant_emoji", "merchant_online", "merchant_atm"]


def month_parts(staging: DataFrame) -> dict[str, DataFrame]:
    """What the marts need of each month, as rows per `transaction_month`: sums, counts, first and last times, and the values that dimensions are made
    from. Months don't share rows, so the parts of some months can be worked out from those months alone."""
    fact = fct_transactions(staging)
    month = month_start(F.col("created_at")).alias("transaction_month")
    return {
        "cashflow": _cashflow_parts(fact),
        "categories": _category_parts(fact),
        "merchants": _merchant_parts(fact, "transaction_month"),
        "charges": _charge_parts(fact),
        "category_values": staging.select("category", month).distinct(),
        # a distinct would be folded into the minimum that follows in the dimension, and sort all rows
        "merchant_values": staging.groupBy(*_MERCHANT, month).agg(F.count("*").alias("n")),
    }


def marts_of_parts(parts: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The four marts from `month_parts` of all months; they equal the marts made from all rows."""
    categories, merchants = dim_category(parts["category_values"]), dim_merchant(parts["merchant_values"])
    totals = (
        parts["merchants"]
        .groupBy("merchant_id")
        .agg(
            F.sum("spent").alias("spent"),
            F.sum("transaction_count").alias("transaction_count"),
            F.min("first_transaction_at").alias("first_transaction_at"),
            F.max("last_transaction_at").alias("last_transaction_at"),
        )
    )
    return {
        "spend_by_category": _labelled_spend(parts["categories"], categories),
        "monthly_cashflow": _money(parts["cashflow"]),
        "merchant_summary": _summaries(totals, merchants),
        "subscriptions": _recurring(parts["charges"], merchants, MIN_MONTHS),
    }
