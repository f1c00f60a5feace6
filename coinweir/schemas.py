"""Declared schemas. Nothing here is inferred: the feed omits optional keys, so a
batch without a key must still yield the column (as NULL)."""

from pyspark.sql import types as T

MERCHANT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("emoji", T.StringType()),
        T.StructField("online", T.BooleanType()),
        T.StructField("atm", T.BooleanType()),
    ]
)

TRANSACTION = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("account_id", T.StringType()),
        T.StructField("amount", T.LongType()),
        T.StructField("currency", T.StringType()),
        T.StructField("created", T.StringType()),
        T.StructField("settled", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("notes", T.StringType()),
        T.StructField("is_load", T.BooleanType()),
        T.StructField("decline_reason", T.StringType()),
        T.StructField("merchant", MERCHANT),
    ]
)

RAW_EVENT = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("transaction", TRANSACTION),
    ]
)

STAGING = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("account_id", T.StringType()),
        T.StructField("amount_minor_units", T.LongType()),
        T.StructField("currency", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("settled_at", T.TimestampNTZType()),
        T.StructField("is_settled", T.BooleanType()),
        T.StructField("is_declined", T.BooleanType()),
        T.StructField("description", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("notes", T.StringType()),
        T.StructField("is_load", T.BooleanType()),
        T.StructField("decline_reason", T.StringType()),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("merchant_name", T.StringType()),
        T.StructField("merchant_category", T.StringType()),
        T.StructField("merchant_emoji", T.StringType()),
        T.StructField("merchant_online", T.BooleanType()),
        T.StructField("merchant_atm", T.BooleanType()),
        T.StructField("ingestion_source", T.StringType()),
    ]
)

# Partition columns stay strings: letting Spark infer them turns '02' into 2, and a
# later write would open a second directory beside the first.
PARTITION_COLUMNS = ("transaction_year", "transaction_month")

PUBLISHED_STAGING = T.StructType(
    STAGING.fields + [T.StructField(name, T.StringType()) for name in PARTITION_COLUMNS]
)

# One accepted delivery. `payload` is the transaction's JSON text exactly as delivered,
# so keys the declared schema does not know yet are not lost.
LANDING = T.StructType(
    [
        T.StructField("created_date", T.DateType()),
        T.StructField("transaction_id", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("meta_source", T.StringType()),
        T.StructField("arrived_at", T.TimestampType()),
        T.StructField("arrived_file", T.StringType()),
        T.StructField("arrived_block", T.LongType()),
        T.StructField("arrived_row", T.LongType()),
        T.StructField("payload", T.StringType()),
        T.StructField("landing_month", T.StringType()),
    ]
)

HEARTBEAT = T.StructType(
    [
        T.StructField("last_run_at", T.TimestampType()),
        T.StructField("transactions_written", T.LongType()),
    ]
)
