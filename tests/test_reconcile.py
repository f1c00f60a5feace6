from datetime import datetime, timedelta, timezone

from conftest import YEAR, rows, transaction
from pyspark.sql import functions as F

from coinweir.plans.pipeline import LANDING, build
from coinweir.plans.reconcile import reconcile
from coinweir.schemas import TRANSACTION
from coinweir.sources.landing import read_landed_events, read_landing
from coinweir.sources.staging import read_staging
from coinweir.streaming.heartbeat import read_heartbeat
from coinweir.streaming.ingest import read_rejects

AS_OF = datetime(2026, 3, 8, 18, tzinfo=timezone.utc)


def table(spark, bodies=YEAR):
    return spark.createDataFrame([{f: b.get(f) for f in TRANSACTION.fieldNames()} for b in bodies], TRANSACTION)


def test_lookback_bounds_the_pull(spark, layout):
    assert reconcile(spark, layout, table(spark), AS_OF) == 3
    assert rows(read_landing(spark, layout.landing), "transaction_id", "source", "landing_month") == [
        ("t09", "reconciliation", "2026-03"), ("t11", "reconciliation", "2026-03"), ("t12", "reconciliation", "2026-03"),
    ]
    beat = read_heartbeat(spark, layout).first()
    assert beat.transactions_written == 3


def test_nothing_recent_still_beats(spark, layout):
    assert reconcile(spark, layout, table(spark), AS_OF + timedelta(days=90)) == 0
    assert read_heartbeat(spark, layout).first().transactions_written == 0


def test_overlapping_runs_keep_the_newest_copy(spark, layout):
    old, new = table(spark), table(spark).withColumn("amount", F.col("amount") * 2)
    reconcile(spark, layout, old, AS_OF, lookback_hours=None)
    reconcile(spark, layout, new, AS_OF + timedelta(hours=6), lookback_hours=36)
    landed = read_landed_events(spark, layout.landing)
    assert rows(landed.filter("transaction.id in ('t10', 't11')"), "transaction.id", "transaction.amount") == [
        ("t10", -999), ("t11", -2868),
    ]
    assert landed.count() == len(YEAR)


def test_backfill_then_build(spark, layout):
    assert reconcile(spark, layout, table(spark), AS_OF, lookback_hours=None) == len(YEAR)
    assert build(spark, layout, source=LANDING, as_of=datetime(2026, 4, 2)) == []
    staged = read_staging(spark, layout.staging)
    assert rows(staged.filter("merchant_name = 'Cinema'"), "transaction_id", "ingestion_source") == [
        ("t02", "reconciliation"), ("t06", "reconciliation"), ("t10", "reconciliation"),
    ]


def test_bad_rows_are_rejected_and_counted(spark, layout):
    bodies = [
        transaction("a", "2026-03-08T10:00:00Z", -1),
        transaction("b", None, -1),
        transaction("c", "soon", -1),
        dict(transaction("d", "2026-03-08T10:00:00Z", -1), id=None),
    ]
    for hours, landed in ((24, 1), (None, 1)):
        assert reconcile(spark, layout, table(spark, bodies), AS_OF, lookback_hours=hours) == landed
    reasons = read_rejects(spark, layout).groupBy("reject_reason").agg(F.sum("n_bodies").alias("n"))
    assert rows(reasons, "reject_reason", "n") == [("Missing fields: id, created", 4), ("Unreadable created time", 2)]
    assert read_landing(spark, layout.landing).filter("landing_month IS NULL").count() == 0


def test_a_time_column_prunes_the_source(spark, layout, tmp_path):
    source = table(spark).withColumn("day", F.col("created").cast("timestamp_ntz").cast("date"))
    source.write.partitionBy("day").parquet(str(tmp_path / "source"))
    stored = spark.read.parquet(str(tmp_path / "source"))
    assert reconcile(spark, layout, stored, AS_OF, time_column="day") == 3
