"""Compressed raw and incoming files, and work that a feed does once."""

import gzip
import json
from datetime import date
from pathlib import Path

import pytest
from conftest import rows, transaction
from pyspark.sql import functions as F
from test_stream import webhook

from coinweir.operators.staging import flatten_transactions
from coinweir.plans import completeness
from coinweir.plans.pipeline import plan_window, publish_window
from coinweir.schemas import RAW_EVENT, TRANSACTION
from coinweir.sources.raw import list_raw_paths, raw_path_keys, read_raw, read_raw_window, write_raw_keys
from coinweir.sources.staging import read_staging
from coinweir.sources.star import EVENTS_A_FILE, one_of_each_source, write_incoming, write_lines, write_raw_halves
from coinweir.streaming import ingest as ingest_module
from coinweir.streaming import rebuild as rebuild_module
from coinweir.streaming.ingest import ingest, sweep

BODIES = [transaction("a", "2026-01-05T10:00:00Z", -1, merchant="Grocer"), transaction("b", "2026-02-20T10:00:00Z", -2)]


def zipped(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(gzip.compress("\n".join(json.dumps(line) for line in lines).encode()))


def feed(spark, bodies, source="webhook"):
    return spark.createDataFrame([(source, body) for body in bodies], RAW_EVENT)


def test_compressed_raw_files_are_read_and_listed(spark, layout, tmp_path):
    for body in BODIES:
        zipped(Path(layout.raw, body["created"][:10].replace("-", "/"), f"{body['id']}.json.gz"), {"source": "webhook", "transaction": body})
    assert rows(read_raw(spark, layout.raw), "transaction.id") == [("a",), ("b",)]
    days = [("a", date(2026, 1, 5)), ("b", date(2026, 2, 20))]
    assert rows(raw_path_keys(list_raw_paths(spark, layout.raw))) == days
    assert rows(write_raw_keys(spark, layout.raw, str(tmp_path / "keys"))) == days
    events, folders = read_raw_window(spark, layout.raw, date(2026, 2, 1), date(2026, 3, 1))
    assert len(folders) == 1 and rows(events, "transaction.id") == [("b",)]
    publish_window(layout, plan_window(spark, layout, full_refresh=True))
    assert rows(read_staging(spark, layout.staging), "transaction_id") == [("a",), ("b",)]


@pytest.mark.parametrize("take", [sweep, ingest])
def test_compressed_bodies_land(spark, layout, tmp_path, take):
    zipped(tmp_path / "in" / "x.json.gz", *[webhook(body) for body in BODIES])
    assert take(spark, layout, str(tmp_path / "in"), lines=True).landed == 2
    assert rows(read_staging(spark, layout.staging), "transaction_id") == [("a",), ("b",)]


def test_what_is_written_as_lines_is_compressed(spark, layout, tmp_path):
    """Uncompressed, a feed of 216 million events is 73 GB."""
    events = feed(spark, BODIES)
    write_lines(events, layout.raw)
    write_raw_halves(events, str(tmp_path / "halves"))
    write_incoming(events, str(tmp_path / "in"))
    for folder in (layout.raw, tmp_path / "halves", tmp_path / "in" / "webhook"):
        files = [path for path in Path(folder).rglob("part-*")]
        assert files and all(path.name.endswith(".json.gz") for path in files)
    assert rows(read_raw(spark, layout.raw, lines=True)) == rows(events)
    assert rows(read_raw(spark, str(tmp_path / "halves"), lines=True)) == rows(events)
    assert EVENTS_A_FILE <= 1_000_000  # a compressed file is one task's


def test_one_of_each_source_shuffles_no_value_twice(spark):
    later = dict(BODIES[0], created="2026-01-06T10:00:00Z", amount=-3)
    events = feed(spark, [BODIES[0], later, BODIES[1]]).union(feed(spark, BODIES, "reconciliation"))
    found = one_of_each_source(events)
    assert found.schema["transaction"].dataType == TRANSACTION
    kept = [(source, id, amount) for source in ("reconciliation", "webhook") for id, amount in (("a", -1), ("b", -2))]
    kept[2] = ("webhook", "a", -3)
    assert rows(found, "source", "transaction.id", "transaction.amount") == kept
    exchanged = found._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit [source" in exchanged and "transaction#" not in exchanged.split("WindowGroupLimit [source")[1].split("ORDER")[0]


def test_a_batch_is_parsed_and_folded_once(spark, layout, tmp_path, monkeypatch):
    """Nothing is held by executors, and rebuilt months take their events from what was written once."""
    held, written = [], []
    rebuild, stored = ingest_module.rebuild_landed_months, rebuild_module.stored

    def watched(*arguments):
        held.append(spark.sparkContext._jsc.getPersistentRDDs().size())
        rebuild(*arguments)

    monkeypatch.setattr(ingest_module, "rebuild_landed_months", watched)
    monkeypatch.setattr(rebuild_module, "stored", lambda rows, path: written.append(path.rpartition("/")[2]) or stored(rows, path))
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    zipped(tmp_path / "in" / "x.json.gz", *[webhook(body) for body in BODIES])
    sweep(spark, layout, str(tmp_path / "in"), lines=True)
    assert held == [before] and "events" in written
    assert rows(read_staging(spark, layout.staging), "transaction_id") == [("a",), ("b",)]


def test_raw_keys_are_worked_out_once(spark, tmp_path):
    """The comparison of ids reads them from where they were written; it parsed each path once for every mention of its month."""
    counted = spark.sparkContext.accumulator(0)

    def parse(batches):
        for batch in batches:
            counted.add(batch.num_rows)
            yield batch

    keys = spark.createDataFrame([(f"t{i}", date(2026, 1, 5)) for i in range(20)], "transaction_id string, path_date date")
    staging = flatten_transactions(feed(spark, BODIES)).filter(F.col("transaction_id") == "b")
    found = completeness.raw_vs_staging(keys.mapInArrow(parse, keys.schema), staging, "2026-06-01", str(tmp_path / "work"))
    assert found.count() == 21 and counted.value == 20
