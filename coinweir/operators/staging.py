"""Raw events to staging rows: flatten, then keep one row per transaction id."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coinweir.functions import blank_to_null, wall_time
from coinweir.schemas import STAGING
from coinweir.vocab import RECONCILIATION


def flatten_transactions(raw: DataFrame) -> DataFrame:
    """The 20 staging columns of each raw event, duplicates included."""
    settled_at = wall_time(blank_to_null(F.col("transaction.settled")))
    columns = {
        "transaction_id": F.col("transaction.id"),
        "account_id": F.col("transaction.account_id"),
        "amount_minor_units": F.col("transaction.amount"),
        "currency": F.col("transaction.currency"),
        "created_at": wall_time(F.col("transaction.created")),
        "settled_at": settled_at,
        "is_settled": settled_at.isNotNull(),
        "is_declined": F.col("transaction.decline_reason").isNotNull(),
        "description": F.col("transaction.description"),
        "category": F.col("transaction.category"),
        "notes": blank_to_null(F.col("transaction.notes")),
        "is_load": F.col("transaction.is_load"),
        "decline_reason": F.col("transaction.decline_reason"),
        "merchant_id": F.col("transaction.merchant.id"),
        "merchant_name": F.col("transaction.merchant.name"),
        "merchant_category": F.col("transaction.merchant.category"),
        "merchant_emoji": F.col("transaction.merchant.emoji"),
        "merchant_online": F.col("transaction.merchant.online"),
        "merchant_atm": F.col("transaction.merchant.atm"),
        "ingestion_source": F.col("source"),
    }
    return raw.select(*[columns[name].alias(name) for name in STAGING.fieldNames()])


def keep_authoritative(rows: DataFrame) -> DataFrame:
    """One row per transaction id: the reconciled copy if there is one, else the newest.

    Every other column that is not derived breaks remaining ties, so the result does not
    depend on row order. Rows without an id fall together into one row.

    A rank filtered to its first row makes Spark cut each id to one row per task before
    the shuffle, so an id with a third of all deliveries still sends few rows.
    """
    settled = ("transaction_id", "created_at", "is_settled", "is_declined")
    order = ["created_at"] + [name for name in STAGING.fieldNames() if name not in settled]
    newest_first = Window.partitionBy("transaction_id").orderBy(
        (F.col("ingestion_source") == RECONCILIATION).desc_nulls_last(),
        *[F.col(name).desc_nulls_last() for name in order],
    )
    return (
        rows.withColumn("_rank", F.row_number().over(newest_first))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def stage_transactions(raw: DataFrame) -> DataFrame:
    """Staging rows of a set of raw events."""
    return keep_authoritative(flatten_transactions(raw))
