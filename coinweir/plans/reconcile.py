"""The authoritative pull as a batch job: recent transactions of a table, landed as reconciled."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coinweir.functions import lit_time, month_text
from coinweir.layout import Layout
from coinweir.schemas import TRANSACTION
from coinweir.sources.landing import append_landing, append_rejects
from coinweir.streaming.heartbeat import record_run
from coinweir.vocab import RECONCILIATION, REJECT_BAD_TIME, REJECT_MISSING

LOOKBACK_HOURS = 24


def reconcile(
    spark: SparkSession,
    layout: Layout,
    transactions: DataFrame,
    as_of: datetime | None = None,
    lookback_hours: int | None = LOOKBACK_HOURS,
    time_column: str | None = None,
) -> int:
    """Land the transactions of all accounts created in the last `lookback_hours` up to
    `as_of` (None lands all, for a backfill), then write the heartbeat. Returns their number.

    The lookback should span several runs, so that a missed run is caught up by the next;
    landing a transaction again is harmless. A time without a zone is UTC. `transactions`
    has the columns of the declared transaction struct. `created` is text, which no scan can be
    pruned by; a `time_column`, a date or time of the source, is compared as it is, so that older partitions and
    row groups are not read. A row without an id or a readable creation time is rejected
    like a delivery, whatever the lookback.
    """
    as_of = as_of or datetime.now(timezone.utc)
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=timezone.utc)
    created = F.col("created").try_cast("timestamp_ntz")
    if lookback_hours is not None:
        since = lit_time(as_of) - F.expr(f"interval {int(lookback_hours)} hours")
        if time_column is not None:
            kind = transactions.schema[time_column].dataType
            transactions = transactions.filter(F.col(time_column) >= since.cast(kind))
        transactions = transactions.filter(created.isNull() | (created >= since))
    reason = F.when(F.col("id").isNull() | F.col("created").isNull(), REJECT_MISSING + "id, created")
    rows = transactions.select(
        created.cast("date").alias("created_date"),
        F.col("id").alias("transaction_id"),
        F.lit(RECONCILIATION).alias("source"),
        F.lit(RECONCILIATION).alias("meta_source"),
        F.lit(as_of.timestamp()).cast("timestamp").alias("arrived_at"),
        F.lit(f"reconcile-{uuid.uuid4().hex}").alias("arrived_file"),
        F.lit(0).cast("bigint").alias("arrived_block"),
        F.monotonically_increasing_id().alias("arrived_row"),
        F.to_json(F.struct(*TRANSACTION.fieldNames())).alias("payload"),
        month_text(created).alias("landing_month"),
        reason.otherwise(F.when(created.isNull(), REJECT_BAD_TIME)).alias("reject_reason"),
    ).persist()
    try:
        deliveries = rows.filter(F.col("reject_reason").isNull())
        append_landing(deliveries, layout.landing)
        append_rejects(
            rows.filter(F.col("reject_reason").isNotNull()).withColumn("body", F.col("payload")), layout.rejects
        )
        written = deliveries.count()
    finally:
        rows.unpersist()
    record_run(spark, layout, written, as_of)
    return written
