"""The corpus pipeline: each stage takes the documents that the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coinweir.llm import line_dedup, packing, repeats, simhash, toxicity
from coinweir.llm.tables import fresh, stored, table


def _with_text(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of documents, the number of characters brought up to date."""
    return rows.select(
        *[F.length("text").cast(rows.schema[column].dataType).alias(column) if column == "n_chars" else F.col(column) for column in columns]
    )


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the machine, fitted on the labels, gives a probability below one half."""
    score = fresh("score", docs.columns)
    machine = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, machine, name=score).filter(F.col(score) < 0.5).select(*docs.columns)


def shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier one has; one that loses all of its lines goes."""
    rows = line_dedup.without_shared_lines(docs)
    removed = fresh("n_removed", docs.columns)
    return _with_text(rows.filter((F.col(removed) == 0) | (F.trim("text") != "")), docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.one_of_each(docs, words_each=3, max_bits=2)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without strings that occur again; one of which nothing is left goes."""
    rows = repeats.texts_without_repeats(docs, length=200)
    removed = fresh("n_removed", docs.columns)
    return _with_text(rows.filter((F.col(removed) == 0) | (F.trim("text") != "")), docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of the documents' tokens in sequences of 4096."""
    path = public_tokenizers.path("word_bpe_49k.json")
    made = packing.pieces(docs, path, end_id=1, capacity=4096, keep=["doc_id"])
    return packing.pack(made.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), capacity=4096)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxic),
    ("line_dedup", shared_lines),
    ("simhash", near_copies),
    ("repeats", repeated_strings),
    ("packing", packed),
]

#: Trained weights, fingerprints and packing are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each stage's rows are written and read again."""
    rows = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        rows = stored(stage(spark, rows, sf_dir))
    return rows
