"""Bounded history windows per account, and how many rows fall in each."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coinweir.functions import clock_micros, lit_time

MAX_WINDOW_DAYS = 365

_DAY = 86400 * 1000000  # microseconds


def backfill_windows(
    accounts: DataFrame, as_of: datetime | str | None, max_days: int = MAX_WINDOW_DAYS
) -> DataFrame:
    """Consecutive windows of at most `max_days` from each account's `opened_at` to `as_of`.

    Windows include their start and not their end; the last one is cut at `as_of`. An
    account opened at or after `as_of` has none.
    """
    end, width = lit_time(as_of), F.expr(f"interval {int(max_days)} days")
    return _window_starts(accounts, end, max_days).withColumn("window_end", F.least(F.col("window_start") + width, end))


def _window_starts(accounts: DataFrame, end: Column, max_days: int) -> DataFrame:
    """(account_id, window_index, window_start) of the windows that start before `end`."""
    width = F.expr(f"interval {int(max_days)} days")
    starts = F.when(F.col("opened_at") < end, F.sequence(F.col("opened_at"), end, width))
    windows = accounts.select("account_id", F.posexplode(starts).alias("window_index", "window_start"))
    return windows.filter(F.col("window_start") < end)


def window_coverage(
    accounts: DataFrame,
    rows: DataFrame,
    as_of: datetime | str | None,
    max_days: int = MAX_WINDOW_DAYS,
) -> DataFrame:
    """Number of `rows` in each account's windows, zero included.

    Windows have one width, so a row's window is computed, not searched for: no range join.
    Rows are counted by (account, day) inside the tasks that read them, so that an account
    with a third of all rows meets its `opened_at` as one row a day. A day counts for the
    window it ends in. Where a window starts within a day, the rows of that day before the
    start belong to the window before, and are moved there: they are found by (account, day),
    a key that divides a large account, and adaptive execution may split such a day as well.
    """
    before_end = rows.filter(F.col("created_at") < lit_time(as_of)).select(
        "account_id", "created_at", F.col("created_at").cast("date").alias("day")
    )
    days = before_end.groupBy("account_id", "day").agg(F.count("*").alias("n"))
    day_end = clock_micros(F.col("day").cast("timestamp_ntz")) + F.lit(_DAY - 1)
    index = F.floor((day_end - clock_micros(F.col("opened_at"))) / F.lit(max_days * _DAY)).cast("int")
    whole = days.join(accounts.select("account_id", "opened_at"), "account_id").select("account_id", index.alias("window_index"), "n")

    starts = _window_starts(accounts, lit_time(as_of) + F.expr("interval 1 day"), max_days)
    starts = starts.withColumn("day", F.col("window_start").cast("date")).filter(F.col("window_start") > F.col("day").cast("timestamp_ntz"))
    early = before_end.join(starts, ["account_id", "day"]).filter(F.col("created_at") < F.col("window_start"))
    early = early.groupBy("account_id", "window_index").agg(F.count("*").alias("n"))
    moves = F.inline(
        F.array(
            F.struct(F.col("window_index").alias("window_index"), (-F.col("n")).alias("n")),
            F.struct((F.col("window_index") - 1).alias("window_index"), F.col("n").alias("n")),
        )
    )
    counts = (
        whole.unionByName(early.select("account_id", moves))
        .groupBy("account_id", "window_index")
        .agg(F.sum("n").alias("transaction_count"))
    )
    return (
        backfill_windows(accounts, as_of, max_days)
        .join(counts, ["account_id", "window_index"], "left")
        .withColumn("transaction_count", F.coalesce("transaction_count", F.lit(0).cast("bigint")))
    )
