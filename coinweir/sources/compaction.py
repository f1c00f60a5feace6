"""Folding closed months of the landing table while feeds go on appending to it.

The fold of deliveries gives the same answer however often one of them is there, and whether it meets all of them or what is left of
an earlier fold. So a month may hold former files beside their fold, or some of them: every reader sees the same standing copies.

Nothing is removed before its fold lies in the month and a note of what it replaces is written:

1. The files that are there are folded into a work folder. Files that a feed adds meanwhile are not among them, and stay.
2. The fold's files are moved into the month, one by one.
3. The names of the replaced files are noted.
4. A later run removes noted files once they are old enough for jobs that had listed them to be done, and then the note.

A job that is lost between any two of these leaves a month that reads the same, and the next run goes on from there. Two runs at
once fold twice, and lose nothing: what one of them removes is in a fold that the other one has read or has not replaced.
"""

from __future__ import annotations

import sys
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coinweir.layout import Layout
from coinweir.operators.landing import resolve_deliveries
from coinweir.schemas import LANDING
from coinweir.sources.files import first_file, matching_folders, move_into, remove, some_files, work_folder
from coinweir.sources.landing import ARRIVAL

FOLD = "fold"

# Files replaced by a fold stay this long.
KEEP_HOURS = 7 * 24

NOTE = "file string, folded_at timestamp"


def standing_deliveries(deliveries: DataFrame) -> DataFrame:
    """The deliveries that stand, in the shape of the landing table."""
    standing = resolve_deliveries(deliveries.withColumn("arrival", F.struct(*ARRIVAL)))
    return standing.select(*LANDING.fieldNames())


def closed_months(spark: SparkSession, layout: Layout, as_of: datetime | str | None = None) -> list[str]:
    """Landing months ("YYYY-MM") before that of `as_of` (now)."""
    now = str(as_of or datetime.now(timezone.utc))[:7]
    folders = matching_folders(spark, f"{layout.landing}/landing_month=*")
    months = [folder.rstrip("/").rpartition("=")[2] for folder in folders]
    return [month for month in months if month < now]


def compact_landing(
    spark: SparkSession,
    layout: Layout,
    months: list[str] | None = None,
    keep_hours: float = KEEP_HOURS,
    as_of: datetime | str | None = None,
) -> list[str]:
    """Fold the given landing months, or all closed ones, and remove files replaced at least `keep_hours` ago. Returns the months that were folded.

    A month whose files are one fold already is left alone. The driver holds the names of one month's files.
    """
    folded = []
    for month in closed_months(spark, layout, as_of) if months is None else months:
        replaced = _clean(spark, layout, month, keep_hours)
        if _fold(spark, layout, month, replaced):
            folded.append(month)
    return folded


def _folder(layout: Layout, month: str) -> str:
    return f"{layout.landing}/landing_month={month}"


def _clean(spark: SparkSession, layout: Layout, month: str, keep_hours: float) -> set[str]:
    """Remove replaced files that are old enough, and return the names of the others."""
    waiting = set()
    for note in matching_folders(spark, f"{layout.landing_folds}/{month}/*"):
        if first_file(spark, note, "_SUCCESS") is None:
            remove(spark, note)  # of a job that was lost while it wrote: its fold will be folded with what it meant to replace
            continue
        old = F.col("folded_at") <= F.current_timestamp() - F.expr(f"make_dt_interval(0, 0, 0, {keep_hours * 3600:f})")
        rows = spark.read.schema(NOTE).parquet(note).select("file", old.alias("old")).collect()
        if all(row.old for row in rows):
            for row in rows:
                remove(spark, f"{_folder(layout, month)}/{row.file}")
            remove(spark, note)
        else:
            waiting.update(row.file for row in rows)
    return waiting


def _fold(spark: SparkSession, layout: Layout, month: str, replaced: set[str]) -> bool:
    folder = _folder(layout, month)
    found = [file.rpartition("/")[2] for file in some_files(spark, folder, ".parquet", sys.maxsize)]
    names = sorted(name for name in found if name not in replaced)
    folds = {name.rpartition("-")[0] if name.startswith(f"{FOLD}-") else None for name in names}
    if not names or (len(folds) == 1 and None not in folds):
        return False
    with work_folder(spark) as work:
        rows = spark.read.schema(LANDING).option("basePath", layout.landing).parquet(*[f"{folder}/{name}" for name in names])
        standing_deliveries(rows).drop("landing_month").hint("rebalance").write.parquet(work)
        move_into(spark, work, folder, f"{FOLD}-{uuid.uuid4().hex}")
    note = spark.createDataFrame([(name,) for name in names], "file string").withColumn("folded_at", F.current_timestamp())
    note.coalesce(1).write.parquet(f"{layout.landing_folds}/{month}/{uuid.uuid4().hex}")
    return True
