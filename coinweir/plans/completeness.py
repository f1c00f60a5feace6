"""Whether two sides hold the same ids, found out month by month.

A clean month costs one row of counts and hash sums for each side. Ids themselves are compared only in months whose digests
differ, and an id that looks astray there is then looked up in the other months. The driver sees names of months, as many as
the calendar has.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coinweir.functions import lit_time, month_text
from coinweir.operators import checks
from coinweir.schemas import PARTITION_COLUMNS
from coinweir.sources.files import stored
from coinweir.vocab import (
    MODEL_NOT_PUBLISHED,
    PUBLISHED_NOT_MODEL,
    PUBLISHED_TWICE,
    RAW_NOT_STAGED,
    STAGED_NOT_RAW,
)

ISSUES = "issue string, transaction_id string"


def ids_by_month(rows: DataFrame, time: str) -> DataFrame:
    """(month, transaction_id). The month comes from partition columns where there are any, so that a filter on it opens those partitions only."""
    if set(PARTITION_COLUMNS) <= set(rows.columns):
        month = F.concat_ws("-", *[F.col(name) for name in PARTITION_COLUMNS])
    else:
        month = F.coalesce(month_text(F.col(time)), F.lit(""))
    return rows.select(month.alias("month"), "transaction_id")


def id_digests(ids: DataFrame) -> DataFrame:
    """(month, n, low, high): how many rows each month has, and sums of two 64-bit hashes of their ids. The sums do not depend on the order of
    rows, and equal ids count as often as they occur. Tasks add up their own rows, so that a row for each task and month is shuffled."""
    wide = "decimal(20,0)"
    return ids.groupBy("month").agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("transaction_id").cast(wide)).alias("low"),
        F.sum(F.xxhash64("transaction_id", F.lit("high")).cast(wide)).alias("high"),
    )


def differing_months(left: DataFrame, right: DataFrame) -> list[str]:
    """Months in which two relations of (month, transaction_id) do not hold the same ids equally often."""
    sides = id_digests(left).withColumn("side", F.lit(1)).unionByName(id_digests(right).withColumn("side", F.lit(-1)))
    sums = [F.sum(F.col(name) * F.col("side")).alias(name) for name in ("n", "low", "high")]
    found = sides.groupBy("month").agg(*sums).filter("n <> 0 OR low <> 0 OR high <> 0")
    return sorted(row.month for row in found.select("month").collect())


def one_sided(left: DataFrame, right: DataFrame, only_left: str, only_right: str, work: str) -> DataFrame:
    """(issue, transaction_id) of ids that one of two relations of (month, transaction_id) lacks altogether; NULL counts as an id.

    A month that agrees has the same ids on both sides, so an id that only one side has lies in months that differ, and one that
    is astray there but also lies in a month that agrees is on both sides. What is astray is written to `work`: its size is then
    known, and Spark need not shuffle the months that agree to look it up.
    """
    months = differing_months(left, right)
    if not months:
        return left.sparkSession.createDataFrame([], ISSUES)
    differs = F.col("month").isin(months)
    counted = checks.compare_ids(left.filter(differs), right.filter(differs))
    has_left, has_right = F.col("n_left") > 0, F.col("n_right") > 0
    issue = F.when(has_left & ~has_right, only_left).when(has_right & ~has_left, only_right)
    astray = stored(counted.select(issue.alias("issue"), "transaction_id").filter("issue IS NOT NULL"), f"{work}/astray")
    agreeing = right.filter(~differs).select(F.col("transaction_id").alias("id"))
    named = astray.select(F.col("transaction_id").alias("named"))
    elsewhere = agreeing.join(named, F.col("id").eqNullSafe(F.col("named")), "left_semi").distinct()
    return astray.join(elsewhere, F.col("transaction_id").eqNullSafe(F.col("id")), "left_anti")


def raw_vs_staging(raw_keys: DataFrame, staging: DataFrame, today: datetime | str | None, work: str) -> DataFrame:
    """What `checks.raw_vs_staging` finds. Deliveries that repeat an id make a month differ, and so compare its ids; compacted landing months have none."""
    day = lit_time(today).cast("date")
    # keys that are read out of paths or events are worked out once; a filter on their month would work them out again for each mention
    raw = stored(ids_by_month(raw_keys.filter(F.col("path_date") < day), "path_date"), f"{work}/keys")
    staged = ids_by_month(staging.filter(F.col("created_at") < day.cast("timestamp_ntz")), "created_at")
    return one_sided(raw, staged, RAW_NOT_STAGED, STAGED_NOT_RAW, work)


def published_vs_model(published: DataFrame, model: DataFrame, work: str) -> DataFrame:
    """What `checks.published_vs_model` finds. Both sides have `created_at` or partition columns beside the ids. Repeated ids are searched for
    among the published ids alone: digests that agree could both hold an id twice."""
    left, right = ids_by_month(published, "created_at"), ids_by_month(model, "created_at")
    twice = checks.duplicate_keys(published, "transaction_id")
    return one_sided(left, right, PUBLISHED_NOT_MODEL, MODEL_NOT_PUBLISHED, work).unionByName(
        twice.select(F.lit(PUBLISHED_TWICE).alias("issue"), F.col("value").alias("transaction_id"))
    )
