import shutil
from datetime import datetime

import pytest
from conftest import APRIL, put_raw, rows, transaction
from pyspark.sql import functions as F

from coinweir.layout import Layout
from coinweir.operators import checks, model
from coinweir.plans import quality
from coinweir.plans.pipeline import check_build, model_relations, plan_window, publish_window, refresh_marts
from coinweir.schemas import STAGING
from coinweir.sources.marts import publish_mart, read_mart
from coinweir.sources.raw import list_raw_paths, raw_path_keys
from coinweir.sources.staging import read_staging

def staging_of(spark, layout):
    return read_staging(spark, layout.staging).select(*STAGING.fieldNames())


def failing(spark, layout, as_of=APRIL):
    window = plan_window(spark, layout, as_of=as_of)
    return rows(check_build(spark, layout, window, as_of=as_of).filter("violations > 0"), "check_name", "violations")


def suite(spark, staging):
    relations = {**model_relations(staging), "stg_transactions": staging}
    report = quality.column_suite(relations)
    return report, rows(report.filter("violations > 0"), "check_name", "severity", "violations")


def test_clean_build_passes_every_check(spark, built):
    report, found = suite(spark, staging_of(spark, built))
    assert report.count() == 25 and found == []
    assert failing(spark, built) == []


def test_repeated_id(spark, built):
    staging = staging_of(spark, built)
    _, found = suite(spark, staging.unionByName(staging.filter("transaction_id = 't01'")))
    assert found == [
        ("unique fct_transactions.transaction_id", "error", 1),
        ("unique stg_transactions.transaction_id", "error", 1),
    ]


def test_nulls_are_counted_and_do_not_break_uniqueness(spark, built):
    staging = staging_of(spark, built)
    nulled = staging.withColumn("transaction_id", F.when(F.col("amount_minor_units") < 0, F.col("transaction_id")))
    _, found = suite(spark, nulled)
    assert found == [
        ("not_null fct_transactions.transaction_id", "error", 4),
        ("not_null stg_transactions.transaction_id", "error", 4),
    ]
    assert rows(checks.duplicate_keys(nulled, "transaction_id")) == [(None, 4)]


def test_unknown_category_only_warns(spark, built):
    staging = staging_of(spark, built).withColumn("category", F.when(F.col("category") != "bills", "pets"))
    report, found = suite(spark, staging)
    assert found == [("accepted_values stg_transactions.category", "warn", 1)]
    assert quality.enforce(report) == ["accepted_values stg_transactions.category"]


def test_unknown_currency_and_source_stop(spark, built):
    staging = staging_of(spark, built).withColumn("currency", F.lit("EUR")).withColumn("ingestion_source", F.lit("fax"))
    report, found = suite(spark, staging)
    assert [name for name, _, _ in found] == [
        "accepted_values stg_transactions.currency", "accepted_values stg_transactions.ingestion_source",
    ]
    with pytest.raises(quality.QualityError, match="currency"):
        quality.enforce(report)


def test_orphans_with_null_passing(spark, built):
    staging = staging_of(spark, built).withColumn("category", F.when(F.col("category") != "bills", F.col("category")))
    fact = model.fct_transactions(staging)
    parent = model.dim_category(staging).filter("category <> 'groceries'")
    assert rows(checks.orphans(fact, "category", parent, "category")) == [("groceries", 3)]


def test_missing_raw_file_and_missing_staging_rows(spark, built):
    keys = raw_path_keys(list_raw_paths(spark, built.raw))
    staging = staging_of(spark, built)
    fewer_keys = keys.filter("transaction_id <> 't03'")
    fewer_rows = staging.filter("transaction_id <> 't05'")
    assert rows(checks.raw_vs_staging(fewer_keys, fewer_rows, APRIL)) == [
        ("in_raw_but_not_in_stg_transactions", "t05"),
        ("in_stg_transactions_but_not_in_raw", "t03"),
    ]


def test_today_is_left_out_on_both_sides(spark, built):
    put_raw(built, transaction("new", "2026-04-02T01:00:00Z", -1))
    keys = raw_path_keys(list_raw_paths(spark, built.raw))
    assert rows(checks.raw_vs_staging(keys, staging_of(spark, built), APRIL)) == []
    assert rows(checks.raw_vs_staging(keys, staging_of(spark, built), datetime(2026, 4, 3))) == [
        ("in_raw_but_not_in_stg_transactions", "new")
    ]


def test_half_a_published_month_is_noticed(spark, built):
    """The fault of a window that begins inside a month."""
    holed = Layout(built.base + "/holed")
    shutil.copytree(built.raw, holed.raw)
    month = "transaction_year=2026/transaction_month=01"
    shutil.copytree(built.staging, holed.staging, ignore=shutil.ignore_patterns("transaction_month=01"))
    rest = staging_of(spark, built).filter("created_at >= '2026-01-08' and created_at < '2026-02-01'")
    rest.write.parquet(f"{holed.staging}/{month}")
    refresh_marts(spark, holed)
    assert failing(spark, holed) == [("published vs model", 2), ("raw vs staging", 2)]


def test_id_in_two_months_is_noticed(spark, built):
    """A moved creation time leaves the old month behind, when that month is not re-read."""
    put_raw(built, transaction("t01", "2026-03-02T00:00:00Z", 200000, "income"))
    window = plan_window(spark, built, lookback_days=0, as_of=APRIL)
    publish_window(built, window)
    model_ids = staging_of(spark, built).select("transaction_id").distinct()
    assert rows(checks.published_vs_model(staging_of(spark, built), model_ids)) == [
        ("duplicated_across_staging_partitions", "t01")
    ]


def test_published_ids_compare_null_as_a_value(spark):
    ids = "transaction_id string"
    published = spark.createDataFrame([("a",), (None,), ("b",)], ids)
    modelled = spark.createDataFrame([("b",), (None,), ("c",), ("c",)], ids)
    assert rows(checks.published_vs_model(published, modelled)) == [
        ("in_stg_transactions_but_not_published_to_staging", "c"),
        ("published_to_staging_but_not_in_stg_transactions", "a"),
    ]


@pytest.mark.parametrize(
    "mart,column,expected",
    [
        ("monthly_cashflow", "net", 2),
        ("monthly_cashflow", "income", 1),
        ("spend_by_category", "total_spend", 1),
        ("spend_by_category", "transaction_count", 1),
        ("merchant_summary", "total_spend", 1),
    ],
)
def test_changed_mart_is_noticed(spark, built, mart, column, expected):
    scratch = built.base + "/scratch"
    read_mart(spark, built, mart).withColumn(column, F.col(column) + 1).write.parquet(scratch)
    publish_mart(spark.read.parquet(scratch), built.mart(mart))
    assert failing(spark, built) == [("marts vs fact", expected)]


def test_sums_within_half_a_penny_pass(spark, built):
    fact = model.fct_transactions(staging_of(spark, built))
    flow, spend, merchants = (read_mart(spark, built, n) for n in ("monthly_cashflow", "spend_by_category", "merchant_summary"))
    near = spend.withColumn("total_spend", F.col("total_spend") + 0.0004)
    assert checks.marts_vs_fact(fact, flow, near, merchants).count() == 0
    assert checks.mart_sums(fact, flow, spend, merchants).count() == 5


def test_dropped_mart_rows_are_noticed(spark, built):
    fact = model.fct_transactions(staging_of(spark, built))
    flow, spend, merchants = (read_mart(spark, built, n) for n in ("monthly_cashflow", "spend_by_category", "merchant_summary"))
    found = checks.marts_vs_fact(fact, flow, spend, merchants.limit(0))
    assert rows(found, "published_value", "expected_value", "difference") == [(None, 69.99, None)]


def test_subscription_counts_are_compared(spark, built):
    fact = model.fct_transactions(staging_of(spark, built))
    charges = read_mart(spark, built, "subscriptions")
    assert checks.subscriptions_vs_fact(fact, charges).count() == 0
    off = charges.withColumn("charge_count", F.col("charge_count") + 1)
    assert rows(checks.subscriptions_vs_fact(fact, off), "published_value", "expected_value") == [(4, 3)]


def test_stale_signals(spark):
    signals = spark.createDataFrame(
        [("fresh", datetime(2026, 1, 1), 24), ("old", datetime(2025, 12, 31, 11, 59), 24), ("never", None, 24)],
        "signal string, last_at timestamp_ntz, max_hours int",
    )
    found = checks.stale_signals(signals, datetime(2026, 1, 2))
    assert rows(found, "signal", "is_stale") == [("fresh", False), ("never", True), ("old", True)]
