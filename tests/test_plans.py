"""What the physical plans must and must not hold."""

import re

import pytest
from pyspark.sql import functions as F

from coinweir.functions import lit_time
from coinweir.operators import backfill, checks, model, queries
from coinweir.plans.pipeline import model_relations
from coinweir.plans.registry import registered
from coinweir.schemas import STAGING
from coinweir.session import session_builder, work_dir
from coinweir.sources.staging import read_staging

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def read_columns(df):
    """Columns of every Parquet scan in the plan."""
    schemas = re.findall(r"FileScan parquet \[([^\]]*)\]", plan(df))
    return [{re.sub(r"#\d+L?$", "", c) for c in s.split(",") if c} for s in schemas]


def published(spark, layout):
    return read_staging(spark, layout.staging).select(*STAGING.fieldNames())


@pytest.mark.parametrize("name", sorted(registered()))
def test_no_python_rows_and_no_pair_joins(spark, name):
    text = plan(registered()[name](spark, FOLDER))
    for banned in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "Cartesian", "NestedLoop"):
        assert banned not in text


MART_COLUMNS = {
    "monthly_cashflow": [{"amount_minor_units", "created_at", "is_declined"}],
    "spend_by_category": [{"amount_minor_units", "created_at", "is_declined", "category"}],
    "merchant_summary": [{"amount_minor_units", "created_at", "is_declined", "merchant_id"}],
    "subscriptions": [{"amount_minor_units", "created_at", "is_declined", "merchant_id"}],
    "dim_account": [{"account_id", "created_at"}],
    "dim_category": [{"category"}],
}


@pytest.mark.parametrize("name", sorted(MART_COLUMNS))
def test_marts_read_only_their_columns(spark, built, name):
    keys = {"transaction_year", "transaction_month"}
    staging = published(spark, built)
    categories = spark.createDataFrame([], "category string, category_label string")
    merchants = spark.createDataFrame([], model.dim_merchant(staging).schema)
    relations = model_relations(staging, categories, merchants)
    relations["dim_category"] = model.dim_category(staging)
    found = [columns - keys for columns in read_columns(relations[name])]
    assert sorted(map(sorted, found)) == sorted(map(sorted, MART_COLUMNS[name]))


def test_marts_sum_inside_the_tasks_first(spark, built):
    for name in ("monthly_cashflow", "spend_by_category", "merchant_summary", "subscriptions"):
        text = plan(model_relations(published(spark, built))[name])
        assert "partial_sum" in text


def test_merchants_are_hashed_before_any_sort(spark, built):
    steps = re.findall(r"(SortAggregate|HashAggregate|Sort|Exchange|FileScan) ?[\[(]?", plan(model.dim_merchant(published(spark, built))))
    scan = steps.index("FileScan")
    assert steps[scan - 3 : scan] == ["HashAggregate", "Exchange", "HashAggregate"]


def test_id_comparison_is_one_shuffle(spark, built):
    staging = published(spark, built)
    assert plan(checks.published_vs_model(staging, staging)).count("Exchange hashpartitioning") == 1


def test_top_merchants_do_not_sort_everything(spark, built):
    summary = spark.read.parquet(built.mart("merchant_summary"))
    text = plan(queries.top_merchants(summary))
    assert "TakeOrderedAndProject" in text and "Exchange" not in text


def test_month_filter_reaches_the_scan(spark, built):
    spend = spark.read.parquet(built.mart("spend_by_category"))
    text = queries.spend_by_category(spend, "2026-02")._jdf.queryExecution().toString()
    assert "EqualTo(transaction_month,2026-02-01T00:00)" in text


def test_created_filter_reaches_the_scan(spark, built):
    found = published(spark, built).filter(F.col("created_at") >= lit_time("2026-02-01"))
    assert "GreaterThanOrEqual(created_at,2026-02-01T00:00)" in found._jdf.queryExecution().toString()


def test_recent_rows_open_recent_months_only(spark, built):
    recent = model.recent_lookback(read_staging(spark, built.staging), "2026-03-08 00:00:00", hours=24 * 7)
    assert {r.transaction_id for r in recent.collect()} == {"t09", "t10", "t11", "t12"}
    files = {r[0] for r in recent.select("_metadata.file_path").distinct().collect()}
    assert files and all("transaction_month=03" in f for f in files)
    assert "transaction_year" in re.search(r"PartitionFilters: \[([^\]]*)\]", plan(recent)).group(1)


def test_profile_multiplies_groups_only(spark, built):
    """Distinct counts expand rows; what they expand has been grouped before."""
    found = plan(queries.staging_profile(read_staging(spark, built.staging), "2026-04-02"))
    expanded = re.findall(r"Expand.*", found)
    assert expanded and not any("transaction_id" in line or "created_at" in line for line in expanded)
    assert re.search(r"Expand(?s:.*?)HashAggregate\(keys=\[account_id", found)


def test_work_folder_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert work_dir(spark).startswith(shared) and work_dir(spark) != work_dir(spark)


def test_shuffle_width_follows_the_input():
    builder = session_builder(input_bytes=100 * 1024**4)
    assert builder._options["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "409600"


def test_hot_account_is_split_by_adaptive_execution(spark):
    """One account on a third of all rows, nearly all on the day that it was opened on: Spark is free to split that day."""
    rows = spark.range(0, 90000, 1, 8).selectExpr(
        "cast(id as string) as transaction_id",
        "if(id < 30000, 'hot', cast(id % 500 as string)) as account_id",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) as created_at",
    )
    accounts = rows.groupBy("account_id").agg(F.min("created_at").alias("opened_at"))
    later = accounts.select("account_id", F.expr("timestamp_ntz'2024-01-01 06:00:00'").alias("opened_at"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        covered = backfill.window_coverage(accounts, rows, "2025-06-01")
        assert covered.agg(F.sum("transaction_count")).first()[0] == 90000
        counted = covered.collect()
        assert {r.transaction_count for r in counted if r.account_id == "hot"} == {30000, 0}
        covered = backfill.window_coverage(later, rows, "2025-06-01")
        counted = covered.collect()
        assert {r.transaction_count for r in counted if r.account_id == "hot"} == {30000 - 6 * 3600, 0}
        assert sum(r.transaction_count for r in counted) == 90000 - 6 * 3600
        assert "skewed" in plan(covered) or "skew=true" in plan(covered)
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
