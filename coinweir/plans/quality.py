"""The declared check suite, its summary, and enforcement."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coinweir.operators import checks
from coinweir.vocab import CATEGORIES, CURRENCIES, RECONCILIATION, WEBHOOK

ERROR, WARN = "error", "warn"

# Column rules per relation.
UNIQUE = {
    "stg_transactions": "transaction_id",
    "dim_account": "account_id",
    "dim_category": "category",
    "dim_merchant": "merchant_id",
    "fct_transactions": "transaction_id",
    "monthly_cashflow": "transaction_month",
    "merchant_summary": "merchant_id",
}
NOT_NULL = {
    "stg_transactions": ["transaction_id", "account_id", "amount_minor_units", "currency", "created_at"],
    "dim_account": ["account_id"],
    "dim_category": ["category"],
    "dim_merchant": ["merchant_id"],
    "fct_transactions": ["transaction_id", "account_id"],
    "spend_by_category": ["total_spend"],
    "monthly_cashflow": ["transaction_month"],
    "merchant_summary": ["merchant_id"],
}
ACCEPTED = [
    ("stg_transactions", "currency", CURRENCIES, ERROR),
    ("stg_transactions", "category", CATEGORIES, WARN),
    ("stg_transactions", "ingestion_source", (WEBHOOK, RECONCILIATION), ERROR),
]
RELATIONSHIPS = [
    ("fct_transactions", "account_id", "dim_account", "account_id"),
    ("fct_transactions", "category", "dim_category", "category"),
]


class QualityError(Exception):
    """At least one check of severity `error` found violations."""


@dataclass(frozen=True)
class Check:
    """`violations` has one row per finding; no row means the check passes."""

    name: str
    severity: str
    violations: DataFrame


def accepted_value_checks(relations: dict[str, DataFrame]) -> list[Check]:
    return [
        Check(f"accepted_values {name}.{column}", severity, checks.outside_vocabulary(relations[name], column, values))
        for name, column, values, severity in ACCEPTED
        if name in relations
    ]


def relationship_checks(relations: dict[str, DataFrame]) -> list[Check]:
    return [
        Check(
            f"relationships {child}.{column} to {parent}.{field}",
            ERROR,
            checks.orphans(relations[child], column, relations[parent], field),
        )
        for child, column, parent, field in RELATIONSHIPS
        if child in relations and parent in relations
    ]


def _long(one_row: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """A row per rule (name, severity, column) of a relation's only row."""
    each = [
        F.struct(
            F.lit(name).alias("check_name"),
            F.lit(severity).alias("severity"),
            F.coalesce(F.col(f"`{column}`"), F.lit(0)).cast("bigint").alias("violations"),
        )
        for name, severity, column in rules
    ]
    return one_row.select(F.inline(F.array(*each)))


def key_and_null_rows(relations: dict[str, DataFrame]) -> list[DataFrame]:
    """The unique and not-null rules of a relation, from one scan of it."""
    rows = []
    for name in [*UNIQUE, *(name for name in NOT_NULL if name not in UNIQUE)]:
        if name in relations:
            key, columns = UNIQUE.get(name), NOT_NULL.get(name, [])
            rules = [(f"unique {name}.{key}", ERROR, "repeated")] if key else []
            rules += [(f"not_null {name}.{column}", ERROR, f"null_{column}") for column in columns]
            rows.append(_long(checks.key_and_nulls(relations[name], key, columns), rules))
    return rows


def accepted_value_rows(relations: dict[str, DataFrame]) -> list[DataFrame]:
    """The accepted-value rules of a relation, from one scan of it."""
    rows = []
    for relation in dict.fromkeys(name for name, *_ in ACCEPTED):
        if relation in relations:
            own = [(column, values, severity) for name, column, values, severity in ACCEPTED if name == relation]
            rules = [(f"accepted_values {relation}.{column}", severity, column) for column, _, severity in own]
            counted = checks.vocabularies(relations[relation], {column: values for column, values, _ in own})
            rows.append(_long(counted, rules))
    return rows


def details(declared: list[Check]) -> DataFrame:
    """Findings of value-level checks side by side: check, severity, value, n_records."""
    rows = [
        check.violations.select(
            F.lit(check.name).alias("check_name"),
            F.lit(check.severity).alias("severity"),
            F.col("value").cast("string").alias("value"),
            "n_records",
        )
        for check in declared
    ]
    return _union(rows)


def summary(declared: list[Check], counted_rows: list[DataFrame] = ()) -> DataFrame:
    """One row per check: name, severity, number of violations; `counted_rows` have that shape already."""
    counted = [
        check.violations.agg(F.count("*").alias("violations")).select(
            F.lit(check.name).alias("check_name"), F.lit(check.severity).alias("severity"), "violations"
        )
        for check in declared
    ]
    return _union(counted + list(counted_rows))


def column_suite(relations: dict[str, DataFrame]) -> DataFrame:
    """Summary of every declared column rule over the given relations."""
    counted = key_and_null_rows(relations) + accepted_value_rows(relations)
    return summary(relationship_checks(relations), counted)


def enforce(report: DataFrame) -> list[str]:
    """Names of the checks that warn; raises if any of severity `error` fails. The report has
    one row per declared check."""
    failed = report.filter(F.col("violations") > 0).orderBy("check_name").collect()
    errors = [f"{row.check_name}: {row.violations}" for row in failed if row.severity == ERROR]
    if errors:
        raise QualityError("; ".join(errors))
    return [row.check_name for row in failed]


def _union(frames: list[DataFrame]) -> DataFrame:
    """All frames in one union, paired up like a tree: a chain would be analysed again in
    full at every link."""
    if len(frames) == 1:
        return frames[0]
    middle = len(frames) // 2
    return _union(frames[:middle]).unionByName(_union(frames[middle:]))
