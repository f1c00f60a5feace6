"""Transaction feeds derived from star-schema tables (orders, line items, events).

The star schema carries no card transactions. These views give each line item the raw
event shape, so that the same operators run over it as over a real feed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from coinweir.functions import wall_time
from coinweir.schemas import TRANSACTION
from coinweir.sources.files import ANY_FILE_AGE, matching_folders, rename
from coinweir.vocab import RECONCILIATION, WEBHOOK


#: Most events of a compressed file of raw lines.
EVENTS_A_FILE = 100_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _iso(moment: str) -> Column:
    return F.concat(F.replace(F.col(moment).cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))


def card_feed(spark: SparkSession, folder: str) -> DataFrame:
    """One raw event per line item. Left joins keep every delivery, whatever it refers to."""
    lines = table(spark, folder, "lineitem")
    orders, parts, suppliers = (table(spark, folder, name) for name in ("orders", "part", "supplier"))
    joined = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    )
    minor = (F.col("l_quantity") * 100).cast("bigint")
    merchant = F.struct(
        F.col("s_suppkey").cast("string").alias("id"),
        F.col("s_name").alias("name"),
        F.concat(F.lit("nation_"), F.col("s_nationkey").cast("string")).alias("category"),
        F.lit(None).cast("string").alias("emoji"),
        (F.col("s_acctbal") > 0).alias("online"),
        F.lit(False).alias("atm"),
    )
    transaction = F.struct(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"),
        F.col("o_custkey").cast("string").alias("account_id"),
        F.when(F.col("l_returnflag") == "A", minor).otherwise(-minor).alias("amount"),
        F.lit("GBP").alias("currency"),
        _iso("l_shipdate").alias("created"),
        F.when(F.col("l_linestatus") == "F", _iso("o_orderdate")).otherwise("").alias("settled"),
        F.col("p_type").alias("description"),
        F.lower(F.replace("p_name", F.lit(" "), F.lit("_"))).alias("category"),
        F.when(F.col("l_linestatus") == "F", F.col("p_brand")).otherwise("").alias("notes"),
        F.lit(False).alias("is_load"),
        F.when(
            (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"), "INSUFFICIENT_FUNDS"
        ).alias("decline_reason"),
        F.when(F.col("l_linenumber") != 7, merchant).alias("merchant"),
    )
    source = F.when(F.col("l_tax") < 0.04, RECONCILIATION).otherwise(WEBHOOK)
    return joined.select(source.alias("source"), transaction.alias("transaction"))


def one_of_each_source(feed: DataFrame) -> DataFrame:
    """The events that stand among those of one id and source, by the order that staging keeps rows in."""
    fields = ["created", "account_id", "amount", "settled", "description", "category", "notes", "decline_reason", "merchant.id"]
    members = TRANSACTION.fieldNames()
    # fields of a struct that a window asks for would be shuffled beside it
    flat = feed.select("source", "transaction.*")
    order = [F.col(field).desc_nulls_last() for field in fields]
    ranked = flat.withColumn("_rank", F.row_number().over(Window.partitionBy("source", "id").orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).select("source", F.struct(*members).alias("transaction"))


def write_lines(events: DataFrame, path: str) -> None:
    """Events written as JSON lines, compressed. Compressed files are not split, so that none holds more than tasks can sort in memory."""
    events.write.option("compression", "gzip").option("maxRecordsPerFile", EVENTS_A_FILE).json(path)


def write_incoming(events: DataFrame, path: str) -> None:
    """Events of one source written as that source delivers them, as JSON lines: envelopes from the webhook, bare transactions from reconciliation."""
    envelope = F.struct(F.lit("transaction.created").alias("type"), F.col("transaction").alias("data"))
    write_lines(events.filter(F.col("source") == WEBHOOK).select(envelope.alias("e")).select("e.*"), f"{path}/{WEBHOOK}")
    write_lines(events.filter(F.col("source") == RECONCILIATION).select("transaction.*"), f"{path}/{RECONCILIATION}")


def write_raw_halves(events: DataFrame, path: str) -> None:
    """Events written as raw JSON lines, one file for each half of a month, below YYYY/MM/01 or YYYY/MM/15. Spark names folders after columns as well;
    they are renamed, days first."""
    spark = events.sparkSession
    day = wall_time(F.col("transaction.created")).cast("date")
    half = F.when(F.dayofmonth(day) < 15, "01").otherwise("15")
    dated = events.withColumns({"year": F.date_format(day, "yyyy"), "month": F.date_format(day, "MM"), "day": half})
    halves = dated.repartition("year", "month", "day").write.option("compression", "gzip")
    halves.partitionBy("year", "month", "day").json(path)
    for level in ("/*/*/day=*", "/*/month=*", "/year=*"):
        for folder in matching_folders(spark, f"{path}{level}"):
            rename(spark, folder, f"{folder.rpartition('/')[0]}/{folder.rpartition('=')[2]}")


def feed_paths(staging_rows: DataFrame) -> DataFrame:
    """The raw file path each delivery would land under."""
    day = F.replace(F.col("created_at").cast("date").cast("string"), F.lit("-"), F.lit("/"))
    return staging_rows.select(
        F.concat(F.lit("raw/"), day, F.lit("/"), F.col("transaction_id"), F.lit(".json")).alias("path")
    )


def event_deliveries(spark: SparkSession, folder: str) -> DataFrame:
    """Deliveries that repeat a (date, id) key: one per event, keyed by day and user.

    Purchases come from the reconciled feed; sign-ups stand for old deliveries that carry
    no metadata.
    """
    events = table(spark, folder, "events")
    source = F.when(F.col("event_type") == "purchase", RECONCILIATION).otherwise(WEBHOOK)
    return events.select(
        F.col("ts").cast("date").alias("created_date"),
        F.col("user_id").cast("string").alias("transaction_id"),
        source.alias("source"),
        F.when(F.col("event_type") != "signup", source).alias("meta_source"),
        F.struct("ts", "event_id").alias("arrival"),
        F.col("event_id").alias("delivery_id"),
    )


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The events table read as a stream, with the place of arrival of each row. The path is
    a glob because a stream takes a folder or a glob, and the table may be a single file."""
    return (
        spark.readStream.schema(table(spark, folder, "events").schema)
        .option("maxFileAge", ANY_FILE_AGE)
        .parquet(f"{folder}/events.parque[t]")
        .select(
            "*",
            F.col("_metadata.file_modification_time").alias("arrived_at"),
            F.col("_metadata.file_path").alias("arrived_file"),
            F.col("_metadata.file_block_start").alias("arrived_block"),
        )
    )


def with_envelope(events: DataFrame) -> DataFrame:
    """Adds `body`, an envelope text, to event rows. Views have another event type, errors
    break off inside the text, clicks lack an amount, sign-ups lack an account and a creation
    time, and low-valued purchases carry an amount that is present but NULL."""
    kind = F.col("event_type")

    def member(key: str, value: Column) -> Column:
        return F.concat(F.lit(f'"{key}":'), value)

    amount = F.when(F.col("value") < 10, F.lit("null")).otherwise(F.get_json_object("props", "$.k"))
    created = F.concat(F.lit('"'), _iso("ts"), F.lit('"'))
    members = F.concat_ws(
        ",",
        member("id", F.concat(F.lit('"tx_'), F.col("user_id").cast("string"), F.lit('"'))),
        F.when(kind != "signup", member("account_id", F.concat(F.lit('"'), "user_id", F.lit('"')))),
        F.when(kind != "click", member("amount", amount)),
        member("currency", F.lit('"GBP"')),
        F.when(kind != "signup", member("created", created)),
    )
    name = F.when(kind == "view", F.lit("transaction.updated")).otherwise(F.lit("transaction.created"))
    text = F.concat(F.lit('{"type":"'), name, F.lit('","data":{'), members, F.lit("}}"))
    broken = F.concat(F.lit('{"type":"'), name, F.lit('","data":'), "props")
    return events.withColumn("body", F.when(kind == "error", broken).otherwise(text))
