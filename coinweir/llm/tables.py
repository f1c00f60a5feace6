"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coinweir.session import work_dir

#: Words are maximal runs of other bytes than these; `bytes.split()` splits at exactly the same ones.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(rows: DataFrame, *partition_by: str, compression: str | None = None) -> DataFrame:
    """The rows written once to the folder that all executors share, and read back."""
    path = work_dir(rows.sparkSession)
    rows.write.partitionBy(*partition_by).parquet(path, compression=compression)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def fresh(name: str, taken: list[str]) -> str:
    """A column name like `name` that none of `taken` has, whatever its case."""
    used = {other.lower() for other in taken}
    while name.lower() in used:
        name = f"_{name}"
    return name


def text_of(column: str) -> Column:
    """A text, with null taken as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def remainder(column: str, modulus: int) -> Column:
    """crc32 of a value's text, modulo `modulus`; null counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def field(rows: DataFrame, column: str, name: str | None = None) -> T.StructField:
    """A nullable field of the type that a column has."""
    return T.StructField(name or column, rows.schema[column].dataType)
