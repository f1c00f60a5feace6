import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from coinweir.functions import category_label, hours_crossed, iso_text, lit_time, month_start
from coinweir.operators import backfill, model
from coinweir.plans.pipeline import model_relations
from coinweir.schemas import STAGING

SMALL = "transaction_id string, account_id string, merchant_id string, merchant_name string, category string, "
SMALL += "created_at timestamp_ntz, amount_minor_units bigint, is_declined boolean"


def staging(spark, data):
    given = spark.createDataFrame(data, SMALL)
    return given.select(
        *[
            F.col(f.name) if f.name in given.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in STAGING
        ]
    )


def made_up(seed, n=400):
    """Random staging rows; a third belongs to one merchant, one account and one month."""
    pick = random.Random(seed)
    data = []
    for i in range(n):
        hot = i % 3 == 0
        merchant = "m0" if hot else pick.choice(["m1", "m2", "m3", None])
        data.append(
            (
                f"t{i}",
                "a0" if hot else pick.choice(["a1", "a2"]),
                merchant,
                pick.choice([None, "Shop"]) if merchant else None,
                pick.choice(["eating_out", "bills", None]),
                datetime(2025, 1 if hot else pick.randint(1, 12), pick.randint(1, 28), pick.randint(0, 23)),
                pick.choice([-100, -250, 0, 75]),
                pick.random() < 0.2,
            )
        )
    return data


@pytest.mark.parametrize("seed", [1, 2])
def test_marts_equal_a_plain_count(spark, seed):
    data = made_up(seed)
    relations = model_relations(staging(spark, data))
    spend, flow, merchants, charges = (defaultdict(list) for _ in range(4))
    for _, _, merchant, _, category, at, minor, declined in data:
        month = datetime(at.year, at.month, 1)
        if declined:
            continue
        flow[month].append(minor)
        if minor < 0:
            spend[month, category].append(-minor)
            if merchant:
                merchants[merchant].append((-minor, at))
                charges[merchant, -minor].append(at)
    assert rows(relations["monthly_cashflow"]) == sorted(
        (
            (m, sum(v for v in vs if v > 0) / 100, -sum(v for v in vs if v < 0) / 100, sum(vs) / 100)
            for m, vs in flow.items()
        ),
        key=repr,
    )
    assert rows(
        relations["spend_by_category"], "transaction_month", "category", "total_spend", "transaction_count"
    ) == sorted(((m, c, sum(vs) / 100, len(vs)) for (m, c), vs in spend.items()), key=repr)
    assert rows(
        relations["merchant_summary"], "merchant_id", "total_spend", "transaction_count", "first_transaction_at"
    ) == sorted(
        ((m, sum(a for a, _ in vs) / 100, len(vs), min(t for _, t in vs)) for m, vs in merchants.items()), key=repr
    )
    assert rows(
        relations["subscriptions"], "merchant_id", "charge_amount", "months_charged", "charge_count"
    ) == sorted(
        (
            (m, a / 100, len({(t.year, t.month) for t in ts}), len(ts))
            for (m, a), ts in charges.items()
            if len({(t.year, t.month) for t in ts}) >= 2
        ),
        key=repr,
    )


def test_merchant_attributes_skip_nulls(spark):
    data = [
        ("1", "a", "m", None, "c", datetime(2025, 1, 1), -1, False),
        ("2", "a", "m", "Shop", "c", datetime(2025, 1, 1), -1, False),
        ("3", "a", None, "Ghost", "c", datetime(2025, 1, 1), -1, False),
    ]
    assert rows(model.dim_merchant(staging(spark, data)), "merchant_id", "merchant_name") == [("m", "Shop")]


def test_fact_flags_and_month(spark):
    data = [
        ("1", "a", None, None, "c", datetime(2025, 1, 31, 23), 5, False),
        ("2", "a", None, None, "c", datetime(2025, 2, 1), 0, False),
        ("3", "a", None, None, "c", datetime(2025, 2, 1), -5, True),
    ]
    fact = model.fct_transactions(staging(spark, data))
    assert dict(fact.dtypes)["transaction_month"] == "timestamp_ntz"
    assert rows(fact, "transaction_id", "transaction_month", "amount", "is_credit", "is_debit") == [
        ("1", datetime(2025, 1, 1), 0.05, True, False),
        ("2", datetime(2025, 2, 1), 0.0, False, False),
        ("3", datetime(2025, 2, 1), -0.05, False, True),
    ]


def test_spend_without_a_dimension_row_is_one_null_group(spark):
    from coinweir.operators.marts import mart_spend_by_category

    data = [(str(i), "a", None, None, c, datetime(2025, 1, 2), -100, False) for i, c in enumerate(["x", "y", None, "z"])]
    stg = staging(spark, data)
    known = model.dim_category(stg).filter("category = 'x'")
    found = mart_spend_by_category(model.fct_transactions(stg), known)
    assert rows(found, "category", "category_label", "total_spend", "transaction_count") == [
        ("x", "X", 1.0, 1),
        (None, None, 3.0, 3),
    ]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Africa/Cairo"])
def test_column_functions_ignore_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        one = spark.createDataFrame(
            [(datetime(2026, 4, 24, 10, 59), datetime(2026, 4, 24, 12, 1, 2, 500), "eating_out")],
            "a timestamp_ntz, b timestamp_ntz, c string",
        )
        a, b = F.col("a"), F.col("b")
        got = one.select(
            hours_crossed(a, b), month_start(a), iso_text(a), iso_text(b), category_label(F.col("c")), lit_time("2026-04-24")
        ).first()
        assert list(got) == [
            2,
            datetime(2026, 4, 1),
            "2026-04-24T10:59:00",
            "2026-04-24T12:01:02.000500",
            "Eating out",
            datetime(2026, 4, 24),
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_recent_lookback_reaches_the_scan(spark, tmp_path):
    staging(spark, made_up(3)).write.parquet(str(tmp_path / "s"))
    stored = spark.read.schema(STAGING).parquet(str(tmp_path / "s"))
    recent = model.recent_lookback(stored, datetime(2025, 6, 2), hours=24)
    assert all(r.created_at >= datetime(2025, 6, 1) for r in recent.collect())
    assert "GreaterThanOrEqual(created_at,2025-06-01T00:00)" in recent._jdf.queryExecution().toString()


def test_backfill_windows(spark):
    accounts = spark.createDataFrame(
        [("a", datetime(2024, 1, 1, 6)), ("b", datetime(2025, 12, 31)), ("c", datetime(2026, 1, 1))],
        "account_id string, opened_at timestamp_ntz",
    )
    end = datetime(2026, 1, 1)
    year = timedelta(days=365)
    start = datetime(2024, 1, 1, 6)
    assert rows(backfill.backfill_windows(accounts, end), "account_id", "window_index", "window_start", "window_end") == [
        ("a", 0, start, start + year),
        ("a", 1, start + year, start + 2 * year),
        ("a", 2, start + 2 * year, end),
        ("b", 0, datetime(2025, 12, 31), end),
    ]


def test_coverage_equals_a_plain_count(spark):
    pick = random.Random(5)
    opened = {"a": datetime(2020, 3, 1, 13, 30, 0, 7), "b": datetime(2021, 1, 1), "quiet": datetime(2025, 1, 1)}
    as_of, width = datetime(2026, 1, 1), timedelta(days=365)
    moments = []
    for _ in range(500):
        account = pick.choice(["a", "a", "b", "stranger"])
        moments.append((account, datetime(2019, 6, 1) + timedelta(microseconds=pick.randrange(7 * 365 * 86400 * 10**6))))
    moments += [("a", opened["a"] + k * width) for k in range(6)]
    moments += [("a", opened["a"] + k * width - timedelta(microseconds=1)) for k in range(6)]
    accounts = spark.createDataFrame(list(opened.items()), "account_id string, opened_at timestamp_ntz")
    stamped = spark.createDataFrame(
        [(str(i), *moment) for i, moment in enumerate(moments)],
        "transaction_id string, account_id string, created_at timestamp_ntz",
    )
    found = backfill.window_coverage(accounts, stamped, as_of).collect()
    assert {r.account_id for r in found} == set(opened)
    for r in found:
        inside = [t for a, t in moments if a == r.account_id and r.window_start <= t < r.window_end]
        assert r.transaction_count == len(inside)
