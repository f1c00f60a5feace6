import random
from datetime import date, datetime

import pytest
from conftest import APRIL, put_raw, rows, transaction
from pyspark.sql import functions as F

from coinweir.operators import checks
from coinweir.plans import completeness
from coinweir.plans.pipeline import plan_window, publish_window
from coinweir.sources.staging import read_staging

IDS = "transaction_id string, created_at timestamp_ntz"
KEYS = "transaction_id string, path_date date"


def plan(df):
    df.collect()
    return df._jdf.queryExecution().toString()


@pytest.fixture
def work(tmp_path):
    return str(tmp_path / "work")


def times(spark, pairs):
    """Rows of (id, month of 2026)."""
    return spark.createDataFrame([(id, datetime(2026, month, 3, 4)) for id, month in pairs], IDS)


def keys(spark, pairs):
    return spark.createDataFrame([(id, date(2026, month, 3)) for id, month in pairs], KEYS)


def both(spark, left, right, work):
    """What the checks of whole relations find, after those by month have found the same."""
    raw = rows(checks.raw_vs_staging(keys(spark, left), times(spark, right), "2026-06-01"))
    assert rows(completeness.raw_vs_staging(keys(spark, left), times(spark, right), "2026-06-01", f"{work}/r")) == raw
    published = rows(checks.published_vs_model(times(spark, left), times(spark, right)))
    found = completeness.published_vs_model(times(spark, left), times(spark, right), f"{work}/p")
    assert rows(found) == published
    return raw, published


def test_equal_sides(spark, work):
    same = [("a", 1), ("b", 1), ("c", 2), (None, 3)]
    assert both(spark, same, same[::-1], work) == ([], [])
    assert both(spark, [], [], work + "2") == ([], [])


def test_one_side_empty(spark, work):
    raw, published = both(spark, [("a", 1), (None, 2)], [], work)
    assert [id for _, id in raw] == ["a", None] and [id for _, id in published] == ["a", None]
    raw, _ = both(spark, [], [("a", 1)], work + "2")
    assert raw == [("in_stg_transactions_but_not_in_raw", "a")]


def test_id_of_another_month_is_not_astray(spark, work):
    """`moved` lies in two months on the left and in one of them on the right: that one agrees."""
    left = [("moved", 1), ("moved", 2), ("kept", 2), (None, 1), (None, 3)]
    right = [("moved", 2), ("kept", 2), (None, 3)]
    raw, published = both(spark, left, right, work)
    assert raw == [] and [id for _, id in published] == ["moved", None]


def test_swapped_ids_of_a_month(spark, work):
    raw, _ = both(spark, [("a", 1), ("a", 1), ("b", 2)], [("c", 1), ("c", 1), ("b", 2)], work)
    assert [id for _, id in raw] == ["a", "c"]


def test_id_twice_on_both_sides_is_published_twice(spark, work):
    twice = [("a", 1), ("a", 2), ("b", 2)]
    assert both(spark, twice, twice, work)[1] == [("duplicated_across_staging_partitions", "a")]


@pytest.mark.parametrize("seed", range(4))
def test_same_findings_as_whole_relations(spark, work, seed):
    pick = random.Random(seed)
    ids = [*"abcdefghijklmnopqrst", None]
    left = [(pick.choice(ids), pick.randint(1, 5)) for _ in range(30)]
    right = [pair for pair in left if pick.random() < 0.9] + [(pick.choice(ids), pick.randint(1, 5)) for _ in range(pick.randint(0, 3))]
    both(spark, left, right, work)


def test_clean_months_shuffle_no_ids(spark, work, monkeypatch):
    """Only what may be a repeat is grouped by id; ids are never compared."""
    staging = spark.range(2000).selectExpr(
        "cast(id as string) as transaction_id", "timestamp_ntz'2026-01-01 00:00:00' + make_dt_interval(id % 100) as created_at"
    )
    digests = completeness.id_digests(completeness.ids_by_month(staging, "created_at"))
    assert "hashpartitioning(month" in plan(digests) and "hashpartitioning(transaction_id" not in plan(digests)
    assert digests.count() == 4

    def never(*sides):
        raise AssertionError("ids were compared")

    monkeypatch.setattr(checks, "compare_ids", never)
    raw = staging.withColumn("path_date", F.to_date("created_at"))
    assert rows(completeness.raw_vs_staging(raw, staging, "2027-01-01", work)) == []
    assert rows(completeness.published_vs_model(staging, staging, work)) == []


def test_only_differing_partitions_are_compared(spark, built, work, monkeypatch):
    """A new raw file of March: the ids of January and February are not read for the comparison."""
    compared = []
    plain = checks.compare_ids
    monkeypatch.setattr(checks, "compare_ids", lambda *sides: compared.extend(sides) or plain(*sides))
    published = read_staging(spark, built.staging)
    raw = published.select("transaction_id", F.to_date("created_at").alias("path_date"))
    new = spark.createDataFrame([("new", date(2026, 3, 9))], KEYS)
    found = completeness.raw_vs_staging(raw.unionByName(new), published, APRIL, work)
    assert rows(found) == [("in_raw_but_not_in_stg_transactions", "new")]
    assert {row.month for row in compared[1].select("month").distinct().collect()} == {"2026-03"}
    assert "transaction_month" in plan(compared[1]).split("PartitionFilters: [")[1].split("]")[0]


def test_moved_id_is_published_twice(spark, built, work):
    put_raw(built, transaction("t01", "2026-03-02T00:00:00Z", 200000, "income"))
    publish_window(built, plan_window(spark, built, lookback_days=0, as_of=APRIL))
    published = read_staging(spark, built.staging)
    model = published.select("transaction_id", "created_at").filter("transaction_id <> 't01' OR created_at >= '2026-03-01'")
    assert rows(completeness.published_vs_model(published, model, work)) == [("duplicated_across_staging_partitions", "t01")]


def test_rows_of_a_wrong_partition_are_still_found(spark, work):
    """Partition columns that do not fit the time only make months differ."""
    columns = [("x", datetime(2026, 1, 3)), ("y", datetime(2026, 2, 3))]
    ids = spark.createDataFrame(columns, IDS)
    odd = ids.withColumn("transaction_year", F.lit("2026")).withColumn("transaction_month", F.lit("05"))
    assert rows(completeness.published_vs_model(odd, ids, work)) == []
    assert rows(completeness.published_vs_model(odd.limit(1), ids, work + "2"))[0][1] == "y"
