import random
from datetime import date, datetime, timezone

import pytest
from conftest import rows

from coinweir.schemas import LANDING
from coinweir.sources import compaction
from coinweir.sources.compaction import closed_months, compact_landing
from coinweir.sources.files import matching_folders, some_files
from coinweir.sources.landing import append_landing, landed_keys, read_landed_events, read_landing

COLUMNS = ["source", "transaction.id", "transaction.amount", "transaction.notes"]


def deliver(spark, layout, pick, n=40):
    """Append a batch of deliveries for two months, an id with a third of them."""
    batch = []
    for i in range(n):
        id = "hot" if i % 3 == 0 else f"t{pick.randint(0, 12)}"
        month, source = pick.choice([1, 2]), pick.choice(["webhook", "webhook", "reconciliation"])
        payload = f'{{"id": "{id}", "amount": {pick.randint(1, 99)}, "notes": "{pick.random()}"}}'
        arrived = datetime(2026, 3, 1, pick.randint(0, 23), tzinfo=timezone.utc)
        meta = pick.choice([source, source, None])
        batch.append((date(2026, month, pick.choice([3, 4])), id, source, meta, arrived, f"f{pick.randint(0, 9)}", 0, i, payload, f"2026-0{month}"))
    append_landing(spark.createDataFrame(batch, LANDING), layout.landing)


def standing(spark, layout):
    return rows(read_landed_events(spark, layout.landing), *COLUMNS)


def names(spark, layout):
    return sorted(file.rpartition("/")[2] for file in some_files(spark, layout.landing, ".parquet", 1000))


@pytest.fixture
def landed(spark, layout):
    pick = random.Random(5)
    for _ in range(3):
        deliver(spark, layout, pick)
    return layout


def test_fold_keeps_what_stands(spark, landed):
    before, keys = standing(spark, landed), rows(landed_keys(spark, landed.landing).distinct())
    former = names(spark, landed)
    assert closed_months(spark, landed, "2026-02-10") == ["2026-01"]
    assert compact_landing(spark, landed) == ["2026-01", "2026-02"]
    assert set(former) < set(names(spark, landed)) and standing(spark, landed) == before
    assert compact_landing(spark, landed) == []  # replaced files wait, and are not folded again
    assert set(former) < set(names(spark, landed))
    assert compact_landing(spark, landed, keep_hours=0) == []
    assert not set(former) & set(names(spark, landed))
    assert standing(spark, landed) == before and rows(landed_keys(spark, landed.landing)) == keys
    assert read_landing(spark, landed.landing).count() == len(before)  # one row for each
    assert matching_folders(spark, f"{landed.landing_folds}/*/*") == []


def test_deliveries_that_land_meanwhile_stay(spark, landed, monkeypatch):
    pick, plain = random.Random(6), compaction.move_into

    def late(*given):
        deliver(spark, landed, pick)
        plain(*given)

    monkeypatch.setattr(compaction, "move_into", late)
    assert compact_landing(spark, landed, ["2026-01"]) == ["2026-01"]
    expected = standing(spark, landed)
    monkeypatch.undo()
    assert compact_landing(spark, landed, ["2026-01"], keep_hours=0) == ["2026-01"]
    assert compact_landing(spark, landed, ["2026-01"], keep_hours=0) == []
    assert standing(spark, landed) == expected
    assert any(name.startswith("part-") for name in names(spark, landed))  # of the other month


class Lost(Exception):
    pass


@pytest.mark.parametrize("step", ["fold", "move", "note", "remove"])
def test_a_job_lost_at_any_step_changes_nothing(spark, landed, monkeypatch, step):
    before = standing(spark, landed)

    def lost(*given):
        raise Lost

    if step == "fold":
        monkeypatch.setattr(compaction, "move_into", lost)
    elif step == "move":
        plain = compaction.move_into

        def half(spark, folder, target, prefix):
            plain(spark, folder, target, prefix)
            raise Lost

        monkeypatch.setattr(compaction, "move_into", half)
    elif step == "note":
        monkeypatch.setattr(compaction.F, "current_timestamp", lost)
    else:
        compact_landing(spark, landed)
        plain_remove, removed = compaction.remove, []

        def first_only(spark, uri):
            if removed:
                raise Lost
            removed.append(uri)
            plain_remove(spark, uri)

        monkeypatch.setattr(compaction, "remove", first_only)
    with pytest.raises(Lost):
        compact_landing(spark, landed, keep_hours=0)
    monkeypatch.undo()
    assert standing(spark, landed) == before
    for _ in range(3):
        compact_landing(spark, landed, keep_hours=0)
    assert standing(spark, landed) == before and read_landing(spark, landed.landing).count() == len(before)
    assert all(name.startswith("fold-") for name in names(spark, landed))


def test_nothing_landed(spark, layout):
    assert compact_landing(spark, layout) == [] and compact_landing(spark, layout, ["2026-01"]) == []
