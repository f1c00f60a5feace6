import json
import shutil
import time
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from conftest import YEAR, put_raw, rows, touch, transaction

from coinweir.layout import Layout
from coinweir.operators.staging import stage_transactions
from coinweir.plans import api
from coinweir.plans.pipeline import LANDING, build
from coinweir.sources.landing import read_landed_events, read_landing
from coinweir.sources.raw import read_raw
from coinweir.sources.staging import read_staging
from coinweir.streaming.heartbeat import liveness, read_heartbeat, record_run
from coinweir.streaming.ingest import ingest, read_rejects, start_ingest
from coinweir.streaming.rebuild import start_landing_watch, start_raw_watch
from coinweir.vocab import REJECT_MISFIT

CLOCK = 1_700_000_000


def drop(folder, name, body, at=0):
    """Write one incoming file that arrived `at` seconds after the others."""
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / f"{name}.json"
    path.write_text(body if isinstance(body, str) else json.dumps(body))
    touch(path, CLOCK + at)


def webhook(body):
    return {"type": "transaction.created", "data": body}


@pytest.fixture
def incoming(tmp_path):
    return tmp_path / "in" / "webhook"


@pytest.fixture
def pulled(tmp_path):
    return tmp_path / "in" / "reconciliation"


def staged(spark, layout):
    return read_staging(spark, layout.staging)


def test_landing_staging_and_rejects(spark, layout, incoming):
    drop(incoming, "good", webhook(transaction("a", "2026-01-15T10:00:00Z", -100)))
    drop(incoming, "bad", "not json")
    drop(incoming, "other", {"type": "x", "data": {}})
    drop(incoming, "undated", webhook(transaction("b", "soon", -100)))
    run = ingest(spark, layout, str(incoming))
    assert (run.landed, run.months) == (1, {"2026-01"})
    assert rows(staged(spark, layout), "transaction_id", "ingestion_source") == [("a", "webhook")]
    assert rows(read_rejects(spark, layout), "reject_reason") == [
        ("Invalid JSON",), ("Unreadable created time",), ("Unsupported event type",),
    ]


def test_redelivery_is_harmless(spark, layout, incoming):
    body = webhook(transaction("a", "2026-01-15T10:00:00Z", -100))
    drop(incoming, "one", body)
    ingest(spark, layout, str(incoming))
    drop(incoming, "two", body, at=5)
    ingest(spark, layout, str(incoming))
    assert read_landing(spark, layout.landing).count() == 2
    assert staged(spark, layout).count() == 1


@pytest.mark.parametrize("webhook_at", [0, 60])
def test_reconciled_copy_stands_whatever_arrives_last(spark, layout, incoming, pulled, webhook_at):
    drop(incoming, "w", webhook(transaction("a", "2026-01-15T10:00:00Z", -100)), at=webhook_at)
    drop(pulled, "r", transaction("a", "2026-01-15T10:00:00Z", -150), at=30)
    first, second = (("webhook", incoming), ("reconciliation", pulled))[:: 1 if webhook_at == 0 else -1]
    for source, folder in (first, second):
        ingest(spark, layout, str(folder), source)
    assert rows(staged(spark, layout), "amount_minor_units", "ingestion_source") == [(-150, "reconciliation")]


def test_last_webhook_delivery_stands(spark, layout, incoming):
    drop(incoming, "z-first", webhook(transaction("a", "2026-01-15T10:00:00Z", -1)), at=0)
    drop(incoming, "a-last", webhook(transaction("a", "2026-01-15T10:00:00Z", -2)), at=9)
    ingest(spark, layout, str(incoming))
    assert rows(staged(spark, layout), "amount_minor_units") == [(-2,)]


def test_order_within_one_file_of_lines(spark, layout, incoming):
    lines = [webhook(transaction("a", "2026-01-15T10:00:00Z", -n)) for n in range(1, 200)]
    drop(incoming, "many", "\n".join(json.dumps(line) for line in lines))
    ingest(spark, layout, str(incoming), lines=True)
    assert rows(staged(spark, layout), "amount_minor_units") == [(-199,)]


def test_a_replayed_batch_changes_nothing(spark, layout, incoming):
    """A lost checkpoint makes the stream read everything again."""
    for body in YEAR:
        drop(incoming, body["id"], webhook(body))
    drop(incoming, "bad", "{")
    ingest(spark, layout, str(incoming))
    before = rows(staged(spark, layout))
    again = Layout(layout.base + "/again")
    for kept in ("landing", "staging", "rejects"):
        shutil.copytree(getattr(layout, kept), getattr(again, kept))
    ingest(spark, again, str(incoming))
    assert read_landing(spark, again.landing).count() == 2 * len(YEAR)
    assert rows(staged(spark, again)) == before
    assert read_rejects(spark, again).count() == 1


def test_crash_between_landing_and_publishing(spark, layout, incoming, monkeypatch):
    for body in YEAR[:4]:
        drop(incoming, body["id"], webhook(body))

    def crash(*_):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as broken:
        broken.setattr("coinweir.streaming.ingest.rebuild_landed_months", crash)
        with pytest.raises(Exception, match="lost the driver"):
            ingest(spark, layout, str(incoming))
    assert read_landing(spark, layout.landing).count() == 4
    run = ingest(spark, layout, str(incoming))
    assert run.landed == 4 and read_landing(spark, layout.landing).count() == 8
    assert rows(staged(spark, layout), "transaction_id") == [("t01",), ("t02",), ("t03",), ("t04",)]


def test_stream_equals_batch(spark, layout, incoming):
    """Two files per batch, out of order and with repeats."""
    for i, body in enumerate(reversed(YEAR)):
        drop(incoming, f"{i}", webhook(body), at=i)
        if i % 3 == 0:
            drop(incoming, f"again{i}", webhook(body), at=i + 100)
    ingest(spark, layout, str(incoming), max_files=6)
    batch = stage_transactions(read_landed_events(spark, layout.landing))
    assert rows(staged(spark, layout).select(*batch.columns)) == rows(batch)
    for body in YEAR:
        put_raw(layout, body)
    assert rows(stage_transactions(read_raw(spark, layout.raw))) == rows(batch)


def test_late_rows_rebuild_their_month_and_are_counted(spark, layout, incoming):
    drop(incoming, "1", webhook(transaction("new", "2026-06-15T10:00:00Z", -1)))
    ingest(spark, layout, str(incoming))
    drop(incoming, "2", webhook(transaction("late", "2024-02-15T10:00:00Z", -1)), at=9)
    ingest(spark, layout, str(incoming))
    assert rows(staged(spark, layout), "transaction_id", "transaction_month") == [("late", "02"), ("new", "06")]
    assert rows(spark.read.parquet(layout.late_rows), "created_month", "n_deliveries") == [("2024-02", 1)]


def test_build_from_landing(spark, layout, incoming):
    for body in YEAR:
        drop(incoming, body["id"], webhook(body))
    run = ingest(spark, layout, str(incoming), rebuild=False)
    assert run.landed == len(YEAR) and not Path(layout.staging).exists()
    for _ in range(2):
        assert build(spark, layout, source=LANDING, as_of=datetime(2026, 4, 2)) == []
        assert staged(spark, layout).count() == len(YEAR)
    assert rows(api.get_subscriptions(spark, layout), "merchant_name") == [("Cinema",)]


def test_payload_that_breaks_the_schema_is_rejected(spark, layout, incoming, pulled):
    drop(incoming, "1", webhook(dict(transaction("a", "2026-01-15T10:00:00Z", -1), amount={"pence": 1})))
    drop(incoming, "2", webhook(dict(transaction("b", "2026-01-15T10:00:00Z", -1), amount="abc")))
    drop(incoming, "3", webhook(dict(transaction("c", "2026-01-15T10:00:00Z", -1), merchant="a name")))
    drop(incoming, "4", webhook(dict(transaction("d", "2026-01-15T10:00:00Z", -1), unknown={"x": 1})))
    assert ingest(spark, layout, str(incoming)).landed == 1
    drop(incoming, "5", webhook(transaction("e", "2026-01-16T10:00:00Z", -1)), at=9)
    assert ingest(spark, layout, str(incoming)).landed == 1
    drop(pulled, "6", dict(transaction("f", "2026-01-15T10:00:00Z", -1), amount=[1]))
    assert ingest(spark, layout, str(pulled), "reconciliation").landed == 0
    assert rows(staged(spark, layout), "transaction_id") == [("d",), ("e",)]
    assert rows(read_rejects(spark, layout), "reject_reason") == [(REJECT_MISFIT,)] * 4
    assert build(spark, layout, source=LANDING, as_of=datetime(2026, 2, 2)) == []


def test_files_of_any_age_are_landed(spark, layout, incoming):
    drop(incoming, "1", webhook(transaction("a", "2026-01-15T10:00:00Z", -1)))
    ingest(spark, layout, str(incoming))
    drop(incoming, "2", webhook(transaction("old", "2026-01-15T10:00:00Z", -1)), at=-400 * 86400)
    drop(incoming, "3", webhook(transaction("b", "2026-01-15T10:00:00Z", -1)), at=9)
    ingest(spark, layout, str(incoming))
    assert rows(staged(spark, layout), "transaction_id") == [("a",), ("b",), ("old",)]


def published(spark, layout):
    return rows(staged(spark, layout), "transaction_id", "transaction_month")


def test_an_id_that_moves_to_another_month_is_published_once(spark, layout, incoming):
    drop(incoming, "1", webhook(transaction("m", "2026-01-31T10:00:00Z", -1)))
    drop(incoming, "2", webhook(transaction("x", "2026-03-01T10:00:00Z", -1)))
    ingest(spark, layout, str(incoming))
    drop(incoming, "3", webhook(transaction("m", "2026-02-01T10:00:00Z", -2)), at=9)
    ingest(spark, layout, str(incoming))
    assert published(spark, layout) == [("m", "02"), ("x", "03")]
    # a later event of the former month does not bring the id back there
    drop(incoming, "4", webhook(transaction("n", "2026-01-05T10:00:00Z", -1)), at=19)
    ingest(spark, layout, str(incoming))
    assert published(spark, layout) == [("m", "02"), ("n", "01"), ("x", "03")]
    assert build(spark, layout, source=LANDING, full_refresh=True, as_of=datetime(2026, 4, 2)) == []
    assert published(spark, layout) == [("m", "02"), ("n", "01"), ("x", "03")]


def test_a_moved_id_in_the_raw_watch(spark, layout):
    put_raw(layout, transaction("m", "2026-01-31T10:00:00Z", -1))
    put_raw(layout, transaction("x", "2026-01-30T10:00:00Z", -1))
    start_raw_watch(spark, layout, marts=False).awaitTermination()
    put_raw(layout, transaction("m", "2026-02-01T10:00:00Z", -2))
    start_raw_watch(spark, layout, marts=False).awaitTermination()
    assert [row[0] for row in published(spark, layout)] == ["m", "x"]


def test_running_query_picks_up_new_files(spark, layout, incoming):
    drop(incoming, "1", webhook(transaction("a", "2026-01-15T10:00:00Z", -1)))
    run = start_ingest(spark, layout, str(incoming), every="0 seconds", rebuild=False)
    try:
        run.query.processAllAvailable()
        drop(incoming, "2", webhook(transaction("b", "2026-01-15T10:00:00Z", -1)))
        run.query.processAllAvailable()
        assert run.landed == 2
    finally:
        run.query.stop()


def test_raw_watch_rebuilds_touched_months(spark, layout):
    for body in YEAR:
        put_raw(layout, body)
    start_raw_watch(spark, layout).awaitTermination()
    assert staged(spark, layout).count() == len(YEAR)
    february = Path(layout.staging, "transaction_year=2026/transaction_month=02")
    untouched = sorted(p.name for p in february.iterdir())
    put_raw(layout, transaction("t13", "2026-03-30T00:00:00Z", -100, "bills"))
    start_raw_watch(spark, layout).awaitTermination()
    assert staged(spark, layout).count() == len(YEAR) + 1
    assert sorted(p.name for p in february.iterdir()) == untouched
    assert rows(api.get_spend_by_category(spark, layout, "2026-03"), "category")[0] == ("bills",)


def test_two_feeds_land_while_one_job_publishes(spark, layout, incoming, pulled):
    drop(incoming, "w1", webhook(transaction("a", "2026-01-15T10:00:00Z", -100)))
    drop(incoming, "w2", webhook(transaction("b", "2026-02-15T10:00:00Z", -100)))
    drop(pulled, "r1", transaction("a", "2026-01-15T10:00:00Z", -150))
    ingest(spark, layout, str(incoming), rebuild=False)
    ingest(spark, layout, str(pulled), "reconciliation", rebuild=False)
    start_landing_watch(spark, layout).awaitTermination()
    assert rows(staged(spark, layout), "transaction_id", "amount_minor_units") == [("a", -150), ("b", -100)]
    february = Path(layout.staging, "transaction_year=2026/transaction_month=02")
    untouched = sorted(p.name for p in february.iterdir())
    drop(pulled, "r2", transaction("c", "2026-01-20T10:00:00Z", -1))
    ingest(spark, layout, str(pulled), "reconciliation", rebuild=False)
    start_landing_watch(spark, layout).awaitTermination()
    assert staged(spark, layout).count() == 3
    assert sorted(p.name for p in february.iterdir()) == untouched
    assert rows(api.get_monthly_cashflow(spark, layout), "expenses") == [(1.0,), (1.51,)]


def test_equal_rejects_are_counted(spark, layout, incoming):
    drop(incoming, "many", "\n".join(["junk", json.dumps(webhook(YEAR[0])), "junk", "other"]))
    ingest(spark, layout, str(incoming), lines=True)
    assert rows(read_rejects(spark, layout), "body", "n_bodies") == [("junk", 2), ("other", 1)]


def test_heartbeat_counts_the_run_also_when_empty(spark, layout, pulled):
    drop(pulled, "1", transaction("a", "2026-01-15T10:00:00Z", -1))
    ingest(spark, layout, str(pulled), "reconciliation")
    first = read_heartbeat(spark, layout).first()
    assert first.transactions_written == 1
    time.sleep(0.01)
    ingest(spark, layout, str(pulled), "reconciliation")
    second = read_heartbeat(spark, layout).first()
    assert second.transactions_written == 0 and second.last_run_at > first.last_run_at


def test_failed_run_leaves_the_heartbeat(spark, layout, pulled, monkeypatch):
    record_run(spark, layout, 7, datetime(2026, 1, 1, tzinfo=timezone.utc))
    drop(pulled, "1", transaction("a", "2026-01-15T10:00:00Z", -1))

    def crash(*_):
        raise RuntimeError("lost the disk")

    monkeypatch.setattr("coinweir.streaming.ingest.append_landing", crash)
    with pytest.raises(Exception, match="lost the disk"):
        ingest(spark, layout, str(pulled), "reconciliation")
    assert read_heartbeat(spark, layout).first().transactions_written == 7


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
def test_liveness(spark, layout, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert rows(liveness(spark, layout), "signal", "is_stale") == [("heartbeat", True), ("monthly_cashflow", True)]
        now = datetime.now(timezone.utc)
        record_run(spark, layout, 0, now)
        spark.range(0).write.parquet(layout.mart("monthly_cashflow"))
        for hours, stale in ((1, (False, False)), (25, (True, False)), (49, (True, True))):
            found = rows(liveness(spark, layout, now + timedelta(hours=hours)), "signal", "is_stale")
            assert found == [("heartbeat", stale[0]), ("monthly_cashflow", stale[1])]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
