"""Data checks. Each returns the violating rows: an empty result is a pass."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coinweir.functions import clock_micros, lit_time, major_units
from coinweir.vocab import (
    CHECK_COUNT,
    CHECK_MERCHANT,
    CHECK_NET,
    CHECK_SPEND,
    CHECK_SPLIT,
    MODEL_NOT_PUBLISHED,
    PUBLISHED_NOT_MODEL,
    PUBLISHED_TWICE,
    RAW_NOT_STAGED,
    STAGED_NOT_RAW,
)

TOLERANCE = 0.005


def duplicate_keys(rows: DataFrame, column: str) -> DataFrame:
    """Values of `column` on more than one row, NULL included."""
    return (
        rows.groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def not_unique(rows: DataFrame, column: str) -> DataFrame:
    """Like `duplicate_keys`, but any number of NULLs passes."""
    return duplicate_keys(rows.filter(F.col(column).isNotNull()), column)


def null_counts(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column, one scan for all columns."""
    counted = rows.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    return counted.unpivot([], list(columns), "column_name", "n_records")


def key_and_nulls(rows: DataFrame, key: str | None, columns: Sequence[str]) -> DataFrame:
    """One row: how many values of `key` repeat, NULL left out, as `repeated`, and the NULLs of each of the
    columns. Nulls are counted per key, so that both come from one scan and one shuffle of partial counts."""
    nulls = [F.count_if(F.col(name).isNull()).alias(f"null_{name}") for name in columns]
    if key is None:
        return rows.agg(F.lit(0).cast("bigint").alias("repeated"), *nulls)
    per_key = rows.groupBy(F.col(key).alias("value")).agg(F.count("*").alias("n"), *nulls)
    repeated = F.count_if(F.col("value").isNotNull() & (F.col("n") > 1)).alias("repeated")
    return per_key.agg(
        repeated, *[F.coalesce(F.sum(f"null_{name}"), F.lit(0)).alias(f"null_{name}") for name in columns]
    )


def vocabularies(rows: DataFrame, accepted: dict[str, Sequence[str]]) -> DataFrame:
    """One row: for each column, how many of its values are not accepted; NULL passes. The values of all columns come from one scan."""
    each = F.array(*[F.struct(F.lit(name).alias("name"), F.col(name).alias("value")) for name in accepted])
    found = rows.select(F.inline(each)).distinct()
    return found.agg(
        *[
            F.count_if((F.col("name") == name) & ~F.col("value").isin(*values)).alias(name)
            for name, values in accepted.items()
        ]
    )


def not_null(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns that hold NULLs, with their number."""
    return null_counts(rows, columns).filter(F.col("n_records") > 0)


def outside_vocabulary(rows: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    """Values of `column` that are not accepted, with their number; NULL passes."""
    return (
        rows.groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("n_records"))
        .filter(~F.col("value").isin(*accepted))
    )


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Values of `column` without a parent row; NULL passes.

    The child is reduced to one row per value before it meets the parent.
    """
    values = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("n_records"))
    )
    known = parent.select(F.col(parent_column).alias("value"))
    return values.join(known, "value", "left_anti")


def compare_ids(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows per id on each side, in one shuffle: NULL counts as an id, and an id with many
    rows is counted inside the tasks that read it."""
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    tagged = left.select("transaction_id", one.alias("l"), zero.alias("r")).unionByName(
        right.select("transaction_id", zero.alias("l"), one.alias("r"))
    )
    return tagged.groupBy("transaction_id").agg(F.sum("l").alias("n_left"), F.sum("r").alias("n_right"))


def _issues(counted: DataFrame, rules: dict[str, Column]) -> DataFrame:
    found = F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]))
    return counted.select(F.explode(found).alias("issue"), "transaction_id")


def raw_vs_staging(raw_keys: DataFrame, staging: DataFrame, today: datetime | str | None) -> DataFrame:
    """Ids in raw but not in staging, and the reverse, leaving out `today` on both sides:
    deliveries still arrive while this runs. `raw_keys` holds transaction_id, path_date."""
    day = lit_time(today).cast("date")
    raw = raw_keys.filter(F.col("path_date") < day)
    staged = staging.filter(F.col("created_at") < day.cast("timestamp_ntz"))
    left, right = F.col("n_left") > 0, F.col("n_right") > 0
    return _issues(compare_ids(raw, staged), {RAW_NOT_STAGED: left & ~right, STAGED_NOT_RAW: right & ~left})


def published_vs_model(published: DataFrame, model: DataFrame) -> DataFrame:
    """Ids missing from, unexpected in, and repeated in the published rows."""
    in_published, in_model = F.col("n_left") > 0, F.col("n_right") > 0
    return _issues(
        compare_ids(published, model),
        {
            MODEL_NOT_PUBLISHED: in_model & ~in_published,
            PUBLISHED_NOT_MODEL: in_published & ~in_model,
            PUBLISHED_TWICE: F.col("n_left") > 1,
        },
    )


def _exact_sum(money: Column) -> Column:
    """Sum of doubles that does not depend on the order of rows."""
    return F.sum(money.cast("decimal(28,6)")).cast("double")


def mart_sums(fact: DataFrame, cashflow: DataFrame, spend: DataFrame, merchants: DataFrame) -> DataFrame:
    """One row per sum check: what a mart adds up to and what the fact says it should.

    Every relation is reduced to one row on its own and the rows are matched by check name,
    so nothing is joined.
    """
    minor, kept = F.col("amount_minor_units"), ~F.col("is_declined")
    spent = F.col("is_debit") & kept
    both = spent & F.col("merchant_id").isNotNull()
    expected = fact.agg(
        major_units(F.sum(F.when(kept, minor))).alias(CHECK_NET),
        major_units(F.sum(F.when(spent, -minor))).alias(CHECK_SPEND),
        F.count_if(spent).cast("double").alias(CHECK_COUNT),
        major_units(F.sum(F.when(both, -minor))).alias(CHECK_MERCHANT),
    )
    flow = cashflow.agg(
        _exact_sum(F.col("net")).alias("net"),
        (_exact_sum(F.col("income")) - _exact_sum(F.col("expenses"))).alias("split"),
    )
    by_category = spend.agg(
        _exact_sum(F.col("total_spend")).alias(CHECK_SPEND),
        F.sum("transaction_count").cast("double").alias(CHECK_COUNT),
    )
    by_merchant = merchants.agg(_exact_sum(F.col("total_spend")).alias(CHECK_MERCHANT))
    missing = F.lit(None).cast("double")

    def long_form(one_row: DataFrame, *checks: tuple[str, Column, Column]) -> DataFrame:
        parts = [
            F.struct(F.lit(name).alias("check_name"), p.alias("published"), e.alias("expected"))
            for name, p, e in checks
        ]
        return one_row.select(F.inline(F.array(*parts)))

    sides = [
        long_form(expected, *[(n, missing, F.col(f"`{n}`")) for n in expected.columns]),
        long_form(
            flow,
            (CHECK_NET, F.col("net"), missing),
            (CHECK_SPLIT, F.col("split"), F.col("net")),
        ),
        long_form(by_category, *[(n, F.col(f"`{n}`"), missing) for n in by_category.columns]),
        long_form(by_merchant, (CHECK_MERCHANT, F.col(f"`{CHECK_MERCHANT}`"), missing)),
    ]
    union = sides[0]
    for side in sides[1:]:
        union = union.unionByName(side)
    return union.groupBy("check_name").agg(
        F.max("published").alias("published_value"), F.max("expected").alias("expected_value")
    )


def marts_vs_fact(fact: DataFrame, cashflow: DataFrame, spend: DataFrame, merchants: DataFrame) -> DataFrame:
    """Sum checks that differ by more than half a penny."""
    published, expected = F.col("published_value"), F.col("expected_value")
    zero = F.lit(0.0)
    return (
        mart_sums(fact, cashflow, spend, merchants)
        .withColumn("difference", published - expected)
        .filter(F.abs(F.coalesce(published, zero) - F.coalesce(expected, zero)) > TOLERANCE)
    )


def subscriptions_vs_fact(fact: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Recurring charges whose charge count differs from the fact's rows for that merchant
    and amount."""
    minor = F.round(-F.col("charge_amount") * 100).cast("bigint")
    published = subscriptions.select(
        "merchant_id", minor.alias("amount_minor_units"), F.col("charge_count").alias("published_value")
    )
    expected = (
        fact.filter(F.col("is_debit") & ~F.col("is_declined"))
        .groupBy("merchant_id", "amount_minor_units")
        .agg(F.count("*").alias("expected_value"))
    )
    keys = ["merchant_id", "amount_minor_units"]
    return published.join(expected, keys, "left").filter(
        ~F.col("published_value").eqNullSafe(F.col("expected_value"))
    )


def stale_signals(signals: DataFrame, as_of: datetime | str | None) -> DataFrame:
    """Age of each (signal, last_at, max_hours) row at `as_of` and whether it is too old; a
    signal that was never seen is too old."""
    age = (clock_micros(lit_time(as_of)) - clock_micros(F.col("last_at"))) / F.lit(3600e6)
    return signals.select(
        "signal",
        "last_at",
        "max_hours",
        age.alias("age_hours"),
        F.coalesce(age > F.col("max_hours"), F.lit(True)).alias("is_stale"),
    )
