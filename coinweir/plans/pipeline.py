"""The batch build: raw or landed events, to staging, to marts, with checks."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coinweir.functions import lit_time
from coinweir.functions.columns import RAW_SUFFIXES
from coinweir.layout import Layout
from coinweir.operators import checks, model
from coinweir.operators import marts as mart_ops
from coinweir.operators.incremental import LOOKBACK_DAYS, incremental_watermark, union_window
from coinweir.operators.staging import flatten_transactions, stage_transactions
from coinweir.plans import completeness, quality
from coinweir.schemas import STAGING
from coinweir.session import work_dir
from coinweir.sources.claims import publishing
from coinweir.sources.files import holds_file, work_folder
from coinweir.sources.landing import landed_keys, read_landed_events
from coinweir.sources.marts import publish_mart, read_mart
from coinweir.sources.month_parts import read_parts, refresh_parts
from coinweir.sources.raw import (
    candidate_months,
    raw_line_keys,
    read_raw,
    read_raw_window,
    write_raw_keys,
)
from coinweir.sources.staging import (
    check_published_columns,
    publish_staging,
    published_months,
    read_staging,
    rows_before_month,
)
from coinweir.vocab import MARTS

RAW, LANDING = "raw", "landing"


@dataclass(frozen=True)
class Window:
    """What a build re-reads: all events, or those of the months from `scan_from` on."""

    events: DataFrame
    scan_from: date | None
    folders: list[str] | None = None  # of raw months, if only those are read


def plan_window(
    spark: SparkSession,
    layout: Layout,
    source: str = RAW,
    full_refresh: bool = False,
    lookback_days: int = LOOKBACK_DAYS,
    as_of: datetime | None = None,
    lines: bool = False,
) -> Window:
    """Find the months to re-read and open the events in them.

    The window runs through the current month or the newest published one, whichever is
    later. With nothing published, on a full refresh, or when no month of the window holds
    events, everything is read and nothing published is kept.
    """
    scan_from = latest = None
    if not full_refresh:
        check_published_columns(spark, layout.staging)
        mark = incremental_watermark(published_months(spark, layout.staging), lookback_days).first()
        scan_from, latest = mark.scan_from, mark.latest_month
    today = (as_of or datetime.now(timezone.utc)).date()
    through = today if latest is None else max(today, latest)
    if source == LANDING:
        return _landing_window(spark, layout, scan_from, through)
    if not holds_file(spark, layout.raw, RAW_SUFFIXES):
        raise FileNotFoundError(f"no raw events below {layout.raw}")
    events, folders = read_raw_window(spark, layout.raw, scan_from, through, lines)
    return Window(events, scan_from if folders else None, folders)


def _landing_window(spark: SparkSession, layout: Layout, scan_from: date | None, through: date) -> Window:
    if not holds_file(spark, layout.landing, ".parquet"):
        raise FileNotFoundError(f"no landed events below {layout.landing}")
    months = [] if scan_from is None else candidate_months(spark, scan_from, through)
    months = [m for m in months if holds_file(spark, f"{layout.landing}/landing_month={m}", ".parquet")]
    if months:
        return Window(read_landed_events(spark, layout.landing, months), scan_from)
    return Window(read_landed_events(spark, layout.landing), None)


def modelled_staging(spark: SparkSession, layout: Layout, window: Window) -> DataFrame:
    """All staging rows: the window's, plus the published rows of earlier months."""
    rows = stage_transactions(window.events)
    if window.scan_from is None:
        return rows
    earlier = rows_before_month(read_staging(spark, layout.staging), window.scan_from)
    return union_window(rows, earlier)


def publish_window(layout: Layout, window: Window) -> None:
    """Publish the window's rows; earlier months are neither read nor written."""
    rows = stage_transactions(window.events)
    if window.scan_from is not None:
        rows = rows.filter(F.col("created_at") >= lit_time(window.scan_from))
    publish_staging(rows, layout.staging, replace_all=window.scan_from is None)


def model_relations(
    staging: DataFrame, categories: DataFrame | None = None, merchants: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Dimensions, fact and marts over a staging relation. Dimensions that are stored
    already can be given."""
    fact = model.fct_transactions(staging)
    categories = model.dim_category(staging) if categories is None else categories
    merchants = model.dim_merchant(staging) if merchants is None else merchants
    return {
        "dim_account": model.dim_account(staging),
        "dim_category": categories,
        "dim_merchant": merchants,
        "fct_transactions": fact,
        "spend_by_category": mart_ops.mart_spend_by_category(fact, categories),
        "monthly_cashflow": mart_ops.mart_monthly_cashflow(fact),
        "merchant_summary": mart_ops.mart_merchant_summary(fact, merchants),
        "subscriptions": mart_ops.mart_subscriptions(fact, merchants),
    }


def refresh_marts(spark: SparkSession, layout: Layout) -> list[str]:
    """Rewrite the marts from aggregates by month, after those of the months that were published since have been worked out anew. Returns these months;
    of published staging, nothing else is read. Waits for other jobs that publish."""
    with publishing(spark, layout):
        return _refresh_marts(spark, layout)


def _refresh_marts(spark: SparkSession, layout: Layout) -> list[str]:
    changed = refresh_parts(spark, layout)
    for name, rows in mart_ops.marts_of_parts(read_parts(spark, layout)).items():
        publish_mart(rows, layout.mart(name))
    return changed


def check_build(
    spark: SparkSession,
    layout: Layout,
    window: Window,
    source: str = RAW,
    as_of: datetime | None = None,
    lines: bool = False,
    work: str | None = None,
) -> DataFrame:
    """Summary of all checks, read back from what was published.

    The published ids are compared with the ids of the events themselves, month by month: which copy of a
    delivery stands does not change the set of ids. Ids that are astray are written to `work`. Raw files of one event are compared by their names, of the
    months that the build read, which are listed month by month into `work`; files of JSON lines by the ids and dates in them.
    """
    work = work or work_dir(spark)
    published = read_staging(spark, layout.staging)
    staging = published.select(*STAGING.fieldNames())
    marts = {name: read_mart(spark, layout, name) for name in MARTS}
    relations = {**model_relations(staging), **marts, "stg_transactions": staging}
    fact = relations["fct_transactions"]

    model_ids = flatten_transactions(window.events).select("transaction_id", "created_at")
    if window.scan_from is not None:
        earlier = rows_before_month(published, window.scan_from)
        model_ids = model_ids.unionByName(earlier.select("transaction_id", "created_at"))
    staged = published
    if source == LANDING:
        keys = landed_keys(spark, layout.landing)
    elif lines:
        keys = raw_line_keys(read_raw(spark, layout.raw, window.folders, lines=True))
    else:
        keys = write_raw_keys(spark, layout.raw, f"{work}/names", window.folders)
    if window.folders is not None:
        keys = keys.filter(F.col("path_date") >= F.lit(window.scan_from))
        staged = published.filter(F.col("created_at") >= lit_time(window.scan_from))
    reconciliations = [
        quality.Check(
            "raw vs staging", quality.ERROR, completeness.raw_vs_staging(keys, staged, as_of, f"{work}/raw")
        ),
        quality.Check(
            "published vs model", quality.ERROR, completeness.published_vs_model(published, model_ids, f"{work}/model")
        ),
        quality.Check(
            "marts vs fact",
            quality.ERROR,
            checks.marts_vs_fact(
                fact, marts["monthly_cashflow"], marts["spend_by_category"], marts["merchant_summary"]
            ),
        ),
        quality.Check(
            "subscriptions vs fact", quality.ERROR, checks.subscriptions_vs_fact(fact, marts["subscriptions"])
        ),
    ]
    return quality.column_suite(relations).unionByName(quality.summary(reconciliations))


def build(
    spark: SparkSession,
    layout: Layout,
    source: str = RAW,
    full_refresh: bool = False,
    lookback_days: int = LOOKBACK_DAYS,
    as_of: datetime | None = None,
    lines: bool = False,
) -> list[str]:
    """Rebuild the window, refresh the marts, enforce the checks. Returns the warnings. Waits for other jobs that publish, and keeps them waiting."""
    with publishing(spark, layout) as claim, work_folder(spark) as work:
        window = plan_window(spark, layout, source, full_refresh, lookback_days, as_of, lines)
        claim.check()
        publish_window(layout, window)
        _refresh_marts(spark, layout)
        return quality.enforce(check_build(spark, layout, window, source, as_of, lines, work))
