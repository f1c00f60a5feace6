"""Every operator as a query over the star-schema tables in one folder.

The card feed has repeated deliveries, which is what gives the checks something to find:
they compare the deliveries of one feed with the transactions of another.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coinweir.functions import lit_time, wall_time
from coinweir.layout import Layout
from coinweir.operators import backfill, checks, incremental, model, queries
from coinweir.operators.events import validate_events
from coinweir.operators.landing import resolve_deliveries
from coinweir.operators.staging import flatten_transactions, keep_authoritative, stage_transactions
from coinweir.plans import api, completeness, pipeline, quality
from coinweir.plans.pipeline import model_relations
from coinweir.plans.reconcile import reconcile
from coinweir.schemas import PARTITION_COLUMNS, STAGING
from coinweir.session import work_dir
from coinweir.sources.compaction import compact_landing
from coinweir.sources.landing import read_landed_events, read_landing
from coinweir.sources.marts import read_mart
from coinweir.sources.raw import raw_line_keys, raw_month_counts, raw_path_keys, read_raw, read_raw_window, write_raw_keys
from coinweir.sources.staging import (
    publish_staging,
    published_months,
    read_staging,
    rows_before_month,
    with_partition_columns,
)
from coinweir.sources.star import (
    card_feed,
    event_deliveries,
    event_stream,
    feed_paths,
    one_of_each_source,
    table,
    with_envelope,
    write_incoming,
    write_lines,
    write_raw_halves,
)
from coinweir.streaming.heartbeat import HEARTBEAT_MAX_HOURS, MART_MAX_HOURS, read_heartbeat
from coinweir.streaming.ingest import ingest, land_stream, read_rejects
from coinweir.vocab import MARTS, RECONCILIATION, WEBHOOK

# Clock values the registered queries use in place of the current time.
TODAY = "2000-01-01"
LOOKBACK_AS_OF = "2001-06-30"
BACKFILL_AS_OF = "2002-01-01"
SPINE_START = "1994-11-15"
SPINE_END = "2002-03-01"
PROFILE_AS_OF = "2002-01-01 09:30:00"
LIVENESS_AS_OF = "2024-02-01 12:00:00"
SPEND_MONTH = "1998-07"
PRUNE_MONTH = date(1999, 1, 1)
RAW_THROUGH = date(2002, 1, 1)
WIDE_LOOKBACK_DAYS = 365
ADHOC_SQL = """select s.category, count(*) as n_months, sum(s.transaction_count) as transaction_count,
  max(f.expenses) as highest_expenses
from spend_by_category s join monthly_cashflow f on f.transaction_month = s.transaction_month
group by s.category"""


def _deliveries(spark: SparkSession, folder: str) -> DataFrame:
    return flatten_transactions(card_feed(spark, folder))


def _from_source(rows: DataFrame, source: str) -> DataFrame:
    return rows.filter(F.col("ingestion_source") == source)


def _staging(spark: SparkSession, folder: str) -> DataFrame:
    return keep_authoritative(_deliveries(spark, folder))


def _relation(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: model_relations(_staging(spark, folder))[name]


def _mart(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """A mart over staging that is written once: the fact and a dimension both come from it."""
    return lambda spark, folder: _marts(spark, folder)[name]


def _marts(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    relations = model_relations(_stored(spark, _staging(spark, folder)))
    return {name: relations[name] for name in MARTS}


def _published(spark: SparkSession, rows: DataFrame) -> str:
    """Publish staging rows into a new work folder."""
    path = Layout(work_dir(spark)).staging
    publish_staging(rows, path)
    return path


def _stored(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Rows written once, for queries that go over them many times."""
    path = work_dir(spark)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _partition_paths(staging: DataFrame) -> DataFrame:
    """Paths of the partitions that staging rows are published under."""
    year, month = PARTITION_COLUMNS
    return with_partition_columns(staging).select(
        F.concat(
            F.lit(f"staging/{year}="), F.col(year), F.lit(f"/{month}="), F.col(month), F.lit("/part.parquet")
        ).alias("path")
    )


def _raw_layout(spark: SparkSession, folder: str) -> Layout:
    """The card feed written as raw JSON lines into a new layout; keys without a value are
    left out, as a real feed leaves them out."""
    layout = Layout(work_dir(spark))
    write_lines(card_feed(spark, folder), layout.raw)
    return layout


def raw_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The feed read back from raw JSON under the declared schema."""
    return flatten_transactions(read_raw(spark, _raw_layout(spark, folder).raw, lines=True))


def _raw_halves(spark: SparkSession, folder: str) -> Layout:
    """The feed as raw files in folders of months, two in each."""
    layout = Layout(work_dir(spark))
    write_raw_halves(card_feed(spark, folder), layout.raw)
    return layout


def raw_window(spark: SparkSession, folder: str) -> DataFrame:
    """The feed of the months from a date on, read from files in their folders; other months are not listed."""
    events, _ = read_raw_window(spark, _raw_halves(spark, folder).raw, PRUNE_MONTH, RAW_THROUGH, lines=True)
    return flatten_transactions(events)


def raw_files_listed(spark: SparkSession, folder: str) -> DataFrame:
    """Raw files by month, from a listing month by month: one for each half that has deliveries."""
    keys = write_raw_keys(spark, _raw_halves(spark, folder).raw, work_dir(spark))
    halves = keys.groupBy(F.trunc("path_date", "month").alias("month")).agg(F.count("*").alias("file_count"))
    return _dates_as_times(halves)


def q_adhoc_sql(spark: SparkSession, folder: str) -> DataFrame:
    """A whole build, raw JSON to published marts, then SQL over the mart views."""
    layout = _raw_layout(spark, folder)
    pipeline.publish_window(layout, pipeline.plan_window(spark, layout, full_refresh=True, lines=True))
    pipeline.refresh_marts(spark, layout)
    (result,) = api.run_sql(spark, layout, ADHOC_SQL)
    return result


def staging_publish_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    return read_staging(spark, _published(spark, _staging(spark, folder)))


def staging_scan_pruned(spark: SparkSession, folder: str) -> DataFrame:
    published = read_staging(spark, _published(spark, _staging(spark, folder)))
    return rows_before_month(published, PRUNE_MONTH).select(
        "transaction_id", "created_at", "amount_minor_units", *PARTITION_COLUMNS
    )


def stg_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """A first run that saw only the webhook feed, then an incremental run over both feeds."""
    path = _published(spark, keep_authoritative(_from_source(_deliveries(spark, folder), WEBHOOK)))
    mark = incremental.incremental_watermark(published_months(spark, path), WIDE_LOOKBACK_DAYS).first()
    events = card_feed(spark, folder)
    window = events.filter(wall_time(F.col("transaction.created")) >= lit_time(mark.scan_from))
    earlier = rows_before_month(read_staging(spark, path), mark.scan_from)
    return incremental.union_window(stage_transactions(window), earlier)


def incremental_watermark(spark: SparkSession, folder: str) -> DataFrame:
    return _dates_as_times(incremental.incremental_watermark(_partition_paths(_staging(spark, folder))))


def month_spine(spark: SparkSession, folder: str) -> DataFrame:
    """Candidate months between two dates, with the raw files in each, zero included."""
    counts = raw_month_counts(feed_paths(_deliveries(spark, folder)))
    ends = {"first": SPINE_START, "last": SPINE_END}
    bounds = spark.range(1).select(*[F.lit(day).cast("date").alias(end) for end, day in ends.items()])
    spine = incremental.month_spine(bounds).join(counts, "month", "left")
    return _dates_as_times(
        spine.select("month", F.coalesce("file_count", F.lit(0).cast("bigint")).alias("file_count"))
    )


def backfill_windows(spark: SparkSession, folder: str) -> DataFrame:
    staging = _stored(spark, _staging(spark, folder))
    accounts = model.dim_account(staging).select(
        "account_id", F.col("first_transaction_at").alias("opened_at")
    )
    return backfill.window_coverage(accounts, staging, BACKFILL_AS_OF)


def q_data_quality_report(spark: SparkSession, folder: str) -> DataFrame:
    return queries.staging_profile(_stored(spark, _staging(spark, folder)), PROFILE_AS_OF)


def q_mart_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    relations = model_relations(_stored(spark, _staging(spark, folder)))
    return queries.mart_row_counts({name: relations[name] for name in MARTS})


def dq_relationships(spark: SparkSession, folder: str) -> DataFrame:
    """The declared relationships, and webhook transactions that reconciliation never saw."""
    deliveries = _stored(spark, _deliveries(spark, folder))
    declared = quality.relationship_checks(model_relations(keep_authoritative(deliveries)))
    unconfirmed = checks.orphans(
        _from_source(deliveries, WEBHOOK),
        "transaction_id",
        _from_source(deliveries, RECONCILIATION),
        "transaction_id",
    )
    declared.append(quality.Check("relationships webhook to reconciliation", quality.ERROR, unconfirmed))
    return quality.details(declared)


def dq_liveness(spark: SparkSession, folder: str) -> DataFrame:
    """Liveness of two signals: the newest purchase event and the newest event of any type."""
    events = table(spark, folder, "events")

    def signal(rows: DataFrame, name: str, hours: int) -> DataFrame:
        last = rows.agg(F.max("ts").alias("last_at"))
        return last.select(F.lit(name).alias("signal"), "last_at", F.lit(hours).alias("max_hours"))

    purchases = events.filter(F.col("event_type") == "purchase")
    signals = signal(purchases, "heartbeat", HEARTBEAT_MAX_HOURS).unionByName(
        signal(events, "monthly_cashflow", MART_MAX_HOURS)
    )
    return checks.stale_signals(signals, LIVENESS_AS_OF)


def dq_suite(spark: SparkSession, folder: str) -> DataFrame:
    """Every declared column rule over the whole model."""
    staging = _stored(spark, _staging(spark, folder))
    categories, merchants = _stored(spark, model.dim_category(staging)), _stored(spark, model.dim_merchant(staging))
    relations = model_relations(staging, categories, merchants)
    relations["dim_account"] = _stored(spark, relations["dim_account"])
    return quality.column_suite({**relations, "stg_transactions": staging})


def recon_raw_vs_staging(spark: SparkSession, folder: str) -> DataFrame:
    """Raw files of the webhook feed against staging of both feeds."""
    deliveries = _stored(spark, _deliveries(spark, folder))
    keys = raw_path_keys(feed_paths(_from_source(deliveries, WEBHOOK)))
    return checks.raw_vs_staging(keys, keep_authoritative(deliveries), TODAY)


def recon_published_vs_model(spark: SparkSession, folder: str) -> DataFrame:
    """Webhook deliveries published as they came, against the reconciled transactions."""
    deliveries = _stored(spark, _deliveries(spark, folder))
    return checks.published_vs_model(
        _from_source(deliveries, WEBHOOK), keep_authoritative(_from_source(deliveries, RECONCILIATION))
    )


def recon_raw_by_month(spark: SparkSession, folder: str) -> DataFrame:
    """Raw files of the webhook feed against published staging of both feeds, through digests of months."""
    deliveries = _stored(spark, _deliveries(spark, folder))
    keys = raw_path_keys(feed_paths(_from_source(deliveries, WEBHOOK)))
    published = read_staging(spark, _published(spark, keep_authoritative(deliveries)))
    return completeness.raw_vs_staging(keys, published, TODAY, work_dir(spark))


def recon_published_by_month(spark: SparkSession, folder: str) -> DataFrame:
    """Webhook deliveries against the reconciled transactions, through digests of months."""
    deliveries = _stored(spark, _deliveries(spark, folder))
    reconciled = keep_authoritative(_from_source(deliveries, RECONCILIATION))
    return completeness.published_vs_model(_from_source(deliveries, WEBHOOK), reconciled, work_dir(spark))


def recon_marts_vs_fact(spark: SparkSession, folder: str) -> DataFrame:
    """Marts built from deliveries that were not deduplicated, against the fact."""
    deliveries = _stored(spark, _deliveries(spark, folder))
    published = model_relations(deliveries)
    return checks.marts_vs_fact(
        model.fct_transactions(keep_authoritative(deliveries)),
        published["monthly_cashflow"],
        published["spend_by_category"],
        published["merchant_summary"],
    )


def recon_subscriptions_vs_fact(spark: SparkSession, folder: str) -> DataFrame:
    """Recurring charges of deliveries that were not deduplicated, against the fact."""
    deliveries = _stored(spark, _deliveries(spark, folder))
    fact = model.fct_transactions(keep_authoritative(deliveries))
    return checks.subscriptions_vs_fact(fact, model_relations(deliveries)["subscriptions"])


def recon_raw_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Raw JSON lines of the webhook feed against staging of both feeds."""
    layout = Layout(work_dir(spark))
    write_lines(card_feed(spark, folder).filter(F.col("source") == WEBHOOK), layout.raw)
    keys = raw_line_keys(read_raw(spark, layout.raw, lines=True))
    return checks.raw_vs_staging(keys, _staging(spark, folder), TODAY)


def reconcile_heartbeat(spark: SparkSession, folder: str) -> DataFrame:
    """The heartbeat after a pull of the last day's transactions."""
    layout = Layout(work_dir(spark))
    transactions = card_feed(spark, folder).select("transaction.*")
    reconcile(spark, layout, transactions, datetime.fromisoformat(LOOKBACK_AS_OF))
    return read_heartbeat(spark, layout).select(
        F.col("last_run_at").cast("timestamp_ntz").alias("last_run_at"), "transactions_written"
    )


def landing_precedence(spark: SparkSession, folder: str) -> DataFrame:
    standing = resolve_deliveries(event_deliveries(spark, folder))
    return _dates_as_times(standing.drop("arrival"))


def _streamed_events(spark: SparkSession, folder: str, rebuild: bool) -> Layout:
    """Stream the events as webhook envelopes into a new layout, then stop."""
    layout = Layout(work_dir(spark))
    bodies = with_envelope(event_stream(spark, folder))
    land_stream(spark, layout, bodies, rebuild=rebuild).query.awaitTermination()
    return layout


def stream_landing(spark: SparkSession, folder: str) -> DataFrame:
    """The standing copy of every delivery that a stream of envelopes landed."""
    layout = _streamed_events(spark, folder, rebuild=False)
    return read_landed_events(spark, layout.landing).select(
        "source", "transaction.id", "transaction.account_id", "transaction.amount", "transaction.created"
    )


def landing_compacted(spark: SparkSession, folder: str) -> DataFrame:
    """The same copies after every month was folded and its former files were removed."""
    layout = _streamed_events(spark, folder, rebuild=False)
    for _ in range(2):
        compact_landing(spark, layout, as_of="2100-01-01", keep_hours=0)
    return read_landing(spark, layout.landing).select(
        "source", "transaction_id", "meta_source", F.col("created_date").cast("timestamp_ntz").alias("created_date")
    )


def stream_staging(spark: SparkSession, folder: str) -> DataFrame:
    """The staging months that the same stream rebuilt."""
    layout = _streamed_events(spark, folder, rebuild=True)
    return read_staging(spark, layout.staging).select(
        "transaction_id", "account_id", "amount_minor_units", "created_at", *PARTITION_COLUMNS
    )


def _streamed_feed(spark: SparkSession, folder: str) -> Layout:
    """The card feed delivered as files and streamed, first the webhook's and then reconciliation, which moves ids to other months of the seven years;
    marts are refreshed after each."""
    layout = Layout(work_dir(spark))
    incoming = work_dir(spark)
    write_incoming(one_of_each_source(card_feed(spark, folder)), incoming)
    for source in (WEBHOOK, RECONCILIATION):
        ingest(spark, layout, f"{incoming}/{source}", source, lines=True)
        pipeline.refresh_marts(spark, layout)
    return layout


def stream_moved_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Staging after the second feed: each id once, in the month of the copy that stands."""
    return read_staging(spark, _streamed_feed(spark, folder).staging).select(*STAGING.fieldNames())


def stream_marts(spark: SparkSession, folder: str) -> DataFrame:
    """The merchant mart put together from the months' aggregates after the second feed."""
    return read_mart(spark, _streamed_feed(spark, folder), "merchant_summary")


def stream_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """How many bodies the same stream rejected, by reason."""
    rejected = read_rejects(spark, _streamed_events(spark, folder, rebuild=False))
    return rejected.groupBy("reject_reason").agg(F.sum("n_bodies").alias("n_bodies"))


def _dates_as_times(rows: DataFrame) -> DataFrame:
    """Dates as midnight, so that both engines hand them over as one type."""
    return rows.select(
        *[
            (F.col(name).cast("timestamp_ntz") if kind == "date" else F.col(name)).alias(name)
            for name, kind in rows.dtypes
        ]
    )


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "raw_scan": raw_scan,
        "raw_window": raw_window,
        "raw_files_listed": raw_files_listed,
        "flatten_transactions": _deliveries,
        "stg_transactions": _staging,
        "stg_incremental": stg_incremental,
        "staging_scan_pruned": staging_scan_pruned,
        "staging_publish_roundtrip": staging_publish_roundtrip,
        "incremental_watermark": incremental_watermark,
        "month_spine": month_spine,
        "raw_path_keys": lambda s, f: _dates_as_times(raw_path_keys(feed_paths(_deliveries(s, f)))),
        "raw_month_counts": lambda s, f: _dates_as_times(raw_month_counts(feed_paths(_deliveries(s, f)))),
        "recent_lookback": lambda s, f: model.recent_lookback(_deliveries(s, f), LOOKBACK_AS_OF),
        "backfill_windows": backfill_windows,
        "dim_account": _relation("dim_account"),
        "dim_category": _relation("dim_category"),
        "dim_merchant": _relation("dim_merchant"),
        "fct_transactions": _relation("fct_transactions"),
        "mart_spend_by_category": _mart("spend_by_category"),
        "mart_monthly_cashflow": _relation("monthly_cashflow"),
        "mart_merchant_summary": _mart("merchant_summary"),
        "mart_subscriptions": _mart("subscriptions"),
        "q_spend_by_category": lambda s, f: queries.spend_by_category(_marts(s, f)["spend_by_category"]),
        "q_spend_by_category_month": lambda s, f: queries.spend_by_category(
            _marts(s, f)["spend_by_category"], SPEND_MONTH
        ),
        "q_monthly_cashflow": lambda s, f: queries.monthly_cashflow(_marts(s, f)["monthly_cashflow"], 12),
        "q_top_merchants": lambda s, f: queries.top_merchants(_marts(s, f)["merchant_summary"]),
        "q_subscriptions": lambda s, f: queries.subscriptions(_marts(s, f)["subscriptions"]),
        "q_data_quality_report": q_data_quality_report,
        "q_mart_row_counts": q_mart_row_counts,
        "q_adhoc_sql": q_adhoc_sql,
        "dq_unique": lambda s, f: checks.not_unique(_deliveries(s, f), "transaction_id"),
        "dq_duplicates": lambda s, f: checks.duplicate_keys(_deliveries(s, f), "merchant_id"),
        "dq_not_null": lambda s, f: checks.not_null(_deliveries(s, f), STAGING.fieldNames()),
        "dq_accepted_values": lambda s, f: quality.details(
            quality.accepted_value_checks({"stg_transactions": _staging(s, f)})
        ),
        "dq_relationships": dq_relationships,
        "dq_liveness": dq_liveness,
        "dq_suite": dq_suite,
        "recon_raw_vs_staging": recon_raw_vs_staging,
        "recon_published_vs_model": recon_published_vs_model,
        "recon_raw_by_month": recon_raw_by_month,
        "recon_published_by_month": recon_published_by_month,
        "recon_marts_vs_fact": recon_marts_vs_fact,
        "recon_subscriptions_vs_fact": recon_subscriptions_vs_fact,
        "landing_precedence": landing_precedence,
        "validate_events": lambda s, f: validate_events(with_envelope(table(s, f, "events"))).select(
            "event_id", "reject_reason"
        ),
        "iso_presentation": lambda s, f: api.for_presentation(table(s, f, "events").select("event_id", "ts")),
        "recon_raw_lines": recon_raw_lines,
        "reconcile_heartbeat": reconcile_heartbeat,
        "stream_rejects": stream_rejects,
        "stream_landing": stream_landing,
        "landing_compacted": landing_compacted,
        "stream_staging": stream_staging,
        "stream_moved_ids": stream_moved_ids,
        "stream_marts": stream_marts,
    }
