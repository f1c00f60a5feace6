from __future__ import annotations

import json
import os
import shutil
import sys
from datetime import datetime
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from coinweir.layout import Layout  # noqa: E402
from coinweir.plans.pipeline import build  # noqa: E402
from coinweir.session import session_builder  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        session_builder("tests")
        .master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("work")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def layout(tmp_path):
    return Layout(str(tmp_path))


def transaction(id, created, amount, category="groceries", merchant=None, **extra):
    """One transaction; `merchant` is a name, its id follows from it."""
    body = {
        "id": id,
        "account_id": extra.pop("account_id", "acc_1"),
        "amount": amount,
        "currency": "GBP",
        "created": created,
        "category": category,
        **extra,
    }
    if merchant is not None:
        body["merchant"] = {"id": f"m_{merchant}", "name": merchant, "category": "shops", "online": False, "atm": False}
    return body


def put_raw(layout, body, source="webhook", indent=None):
    """Write one raw file under its date and return its path."""
    year, month, day = body["created"][:10].split("-")
    folder = Path(layout.raw, year, month, day)
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / f"{body['id']}.json"
    path.write_text(json.dumps({"source": source, "transaction": body}, indent=indent))
    return path


# Three months: a salary, a fixed charge, a varying charge, a one-off without a merchant,
# and one declined attempt.
YEAR = [
    transaction("t01", "2026-01-25T09:00:00Z", 200000, "income"),
    transaction("t02", "2026-01-05T08:00:00Z", -999, "entertainment", "Cinema", settled="2026-01-05T09:00:00Z"),
    transaction("t03", "2026-01-07T18:00:00Z", -1234, "groceries", "Grocer", settled=""),
    transaction("t04", "2026-01-09T18:00:00Z", -5000, "bills", notes=""),
    transaction("t05", "2026-02-25T09:00:00Z", 200000, "income"),
    transaction("t06", "2026-02-05T08:00:00Z", -999, "entertainment", "Cinema"),
    transaction("t07", "2026-02-07T18:00:00Z", -1334, "groceries", "Grocer"),
    transaction("t08", "2026-02-11T12:00:00Z", -9999, "shopping", "Grocer", decline_reason="LIMIT"),
    transaction("t09", "2026-03-25T09:00:00Z", 200000, "income"),
    transaction("t10", "2026-03-05T08:00:00Z", -999, "entertainment", "Cinema"),
    transaction("t11", "2026-03-07T18:00:00Z", -1434, "groceries", "Grocer", account_id="acc_2"),
    transaction("t12", "2026-03-08T18:00:00Z", 0, "general", "Grocer"),
]


APRIL = datetime(2026, 4, 2)


@pytest.fixture(scope="session")
def _built_once(spark, tmp_path_factory):
    layout = Layout(str(tmp_path_factory.mktemp("built")))
    for i, body in enumerate(YEAR):
        put_raw(layout, body, indent=2 if i % 2 else None)
    assert build(spark, layout, as_of=APRIL) == []
    return layout


@pytest.fixture
def built(_built_once, tmp_path):
    """A layout of its own in which YEAR has been built."""
    shutil.copytree(_built_once.base, tmp_path / "built")
    return Layout(str(tmp_path / "built"))


def touch(path, seconds):
    """Set a file's modification time."""
    os.utime(path, (seconds, seconds))


def rows(df, *columns):
    """All rows as sorted tuples."""
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
