"""Toxicity by a factorization machine over hashed terms.

Terms are the lower-case words of a text and the stems that words begin with, hashed to a fixed number of buckets. Over the labelled
texts of a bounded sample, Spark counts in how many of either label each bucket occurs; the buckets whose counts depend most on the
label are kept. The machine, w0 + sum of w_i x_i + sum over pairs of <v_i, v_j> x_i x_j, is fitted on them by gradient steps, so that
a pair of terms can weigh more, or less, than its two linear weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coinweir.llm.memory import give_back, keep_only
from coinweir.llm.tables import stored, text_of

#: Buckets that terms are hashed to, and how many of them the machine may use.
BUCKETS = 1 << 20
FEATURES = 2048

#: A bucket counts only in so many texts; a single text's label says nothing about others.
LEAST_TEXTS = 2

#: Code points of a word's stems, beside the whole word.
STEMS = (4, 5)

#: Bound on the labels that the machine is fitted on.
SAMPLE = 20_000

FACTORS = 8
STEPS = 200
DECAY = 1e-4
NOT_WORD = r"[^\p{L}\p{N}]+"

#: Texts that a worker scores at a time.
SCORED = 512


@dataclass
class Machine:
    """Weights by position; `position` gives a bucket's, or `len(linear)` - 1, the place of buckets without weight."""

    buckets: np.ndarray
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        """The probability that each text, given by its distinct buckets, is toxic."""
        parts = [self._scores(texts[at : at + SCORED]) for at in range(0, len(texts), SCORED)]
        return np.concatenate([np.empty(0), *parts])

    def _scores(self, texts: list[np.ndarray]) -> np.ndarray:
        rows = np.repeat(np.arange(len(texts)), [len(text) for text in texts])
        terms = np.concatenate(texts).astype(np.int64) if len(rows) else np.empty(0, np.int64)
        place = np.searchsorted(self.buckets, terms)
        known = place < len(self.buckets)
        known[known] = self.buckets[place[known]] == terms[known]
        return _sigmoid(self.raw(rows[known], place[known], len(texts))[0])

    def raw(self, rows: np.ndarray, features: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The machine's value for each of `size` texts, and its sums of factors. Values are scaled by the number of
        features in a text, so that long texts don't outweigh short ones."""
        scale = 1 / np.sqrt(np.maximum(np.bincount(rows, minlength=size), 1))
        weight = scale[rows]
        linear = np.bincount(rows, self.linear[features] * weight, size)
        each = self.factors[features] * weight[:, None]
        sums = np.stack([np.bincount(rows, each[:, f], size) for f in range(each.shape[1])], axis=1)
        squares = np.bincount(rows, (each**2).sum(axis=1), size)
        return self.bias + linear + 0.5 * ((sums**2).sum(axis=1) - squares), sums


def _sigmoid(values: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(values, -40, 40)))


def hashed_terms(documents: DataFrame, keep: list[str], text_column: str = "text") -> DataFrame:
    """`keep` and `terms`, the distinct buckets of each whole text's words and stems."""
    words = F.filter(F.array_distinct(F.split(F.lower(text_of(text_column)), NOT_WORD)), lambda word: word != "")
    rows = documents.select(*keep, words.alias("_words"))
    stems = [
        F.transform("_words", lambda word, size=size: F.concat(F.substring(word, 1, size), F.lit("*"))) for size in STEMS
    ]
    buckets = F.transform(F.concat("_words", *stems), lambda term: F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int"))
    return rows.select(*keep, F.array_distinct(buckets).alias("terms"))


def _informative(labelled: DataFrame, features: int) -> np.ndarray:
    """The buckets whose texts' labels differ most from the labels at large, by a chi-square statistic over all rows."""
    whole = labelled.agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).first()
    clean, toxic = whole.n - (whole.toxic or 0), whole.toxic or 0
    if not clean or not toxic:
        return np.empty(0, np.int64)
    counts = labelled.select("toxic", F.explode("terms").alias("bucket")).groupBy("bucket")
    counts = counts.agg(F.count("*").cast("double").alias("n"), F.sum("toxic").cast("double").alias("hits"))
    counts = counts.filter(F.col("n") >= LEAST_TEXTS)
    expected = F.col("n") * (toxic / whole.n)
    other = F.col("n") * (clean / whole.n)
    excess = F.col("hits") - expected
    chosen = counts.select("bucket", (excess * excess * (1 / expected + 1 / other)).alias("chi"))
    top = chosen.orderBy(F.col("chi").desc(), "bucket").limit(features)
    return np.sort(np.array([row.bucket for row in top.collect()], np.int64))


def fit(
    documents: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    features: int = FEATURES,
    sample: int = SAMPLE,
) -> Machine:
    """A machine for `labels` (id, `toxic` 0 or 1) of the documents.

    It is fitted on the texts of `sample` labels at most, those with the lowest hashes of their ids. Of several labels of a document the
    highest counts; null labels and ids are passed over. Without texts of both labels, the machine has no weights and gives
    every text the share of toxic labels, or 0.
    """
    marks = labels.filter(F.col("toxic").isNotNull() & F.col(id_column).isNotNull())
    marks = marks.groupBy(id_column).agg(F.max("toxic").cast("int").alias("toxic"))
    marks = marks.orderBy(F.xxhash64(F.col(id_column).cast("string")), id_column).limit(sample)
    # `sample` bounds what is broadcast
    labelled = documents.select(id_column, F.col(text_column).alias("_text")).join(F.broadcast(marks), id_column)
    labelled = stored(hashed_terms(labelled, [id_column, "toxic"], "_text"))
    buckets = _informative(labelled, features)
    known = F.array_sort(F.array_intersect("terms", F.lit(buckets.tolist()).cast("array<int>")))
    rows = labelled.select("toxic", known.alias("terms")).orderBy(F.xxhash64(F.col(id_column).cast("string")), "terms").limit(sample)
    rows = rows.toArrow()
    terms = rows.column("terms").combine_chunks()
    texts = np.split(terms.flatten().to_numpy(), np.cumsum(terms.value_lengths().to_numpy())[:-1])
    return _train(buckets, texts[: len(rows)], rows.column("toxic").to_numpy().astype(float))


def _train(buckets: np.ndarray, texts: list[np.ndarray], toxic: np.ndarray) -> Machine:
    """Adam steps over the whole sample; the labels weigh alike."""
    share = float(toxic.mean()) if len(toxic) else 0.0
    start = float(np.log(share / (1 - share))) if 0 < share < 1 else (40.0 if share else -40.0)
    random = np.random.default_rng(7)
    machine = Machine(buckets, start, np.zeros(len(buckets)), random.normal(0, 0.01, (len(buckets), FACTORS)))
    if not len(buckets) or not 0 < share < 1:
        return machine
    # bounded by the sample and the features
    there = np.zeros((len(texts), len(buckets)), np.float32)
    for row, text in zip(there, texts, strict=True):
        row[np.searchsorted(buckets, text)] = 1
    weight = np.where(toxic == 1, 0.5 / share, 0.5 / (1 - share)) / len(toxic)
    scale = 1 / np.sqrt(np.maximum(there.sum(axis=1, dtype=float), 1))
    machine.bias = 0.0
    values = [np.array([0.0]), machine.linear, machine.factors]
    moments = [(np.zeros_like(value), np.zeros_like(value)) for value in values]
    for step in range(1, STEPS + 1):
        machine.bias = float(values[0][0])
        factors = machine.factors
        inputs = np.column_stack([machine.linear, (factors**2).sum(axis=1), factors]).astype(np.float32)
        linear, squares, *sums = (there @ inputs).T.astype(float)
        sums = np.stack(sums, axis=1) * scale[:, None]
        raw = machine.bias + linear * scale + 0.5 * ((sums**2).sum(axis=1) - squares * scale**2)
        slope = (_sigmoid(raw) - toxic) * weight
        at = slope * scale
        outputs = np.column_stack([at, at * scale, at[:, None] * sums]).astype(np.float32)
        pull, own, *each = (there.T @ outputs).T.astype(float)
        gradients = [
            np.array([slope.sum()]),
            pull + DECAY * machine.linear,
            np.stack(each, axis=1) - own[:, None] * factors + DECAY * factors,
        ]
        for value, gradient, (mean, square), rate in zip(values, gradients, moments, (0.05, 0.1, 0.03), strict=True):
            mean += 0.1 * (gradient - mean)
            square += 0.001 * (gradient**2 - square)
            value -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
    machine.bias = float(values[0][0])
    return machine


def score(documents: DataFrame, machine: Machine, text_column: str = "text", name: str = "score", keep: list[str] | None = None) -> DataFrame:
    """The rows (or their columns `keep`) with `name`, the probability that the whole text is toxic; null and empty
    texts get the machine's bias. The machine's size is bounded by its features and factors."""
    columns = documents.columns if keep is None else keep
    renamed = {f"_c{place}": column for place, column in enumerate(columns)}
    rows = documents.select(*[F.col(column).alias(alias) for alias, column in renamed.items()], F.col(text_column).alias("_text"))
    hashed = hashed_terms(rows, list(renamed), "_text").withColumnRenamed("terms", "_terms")

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        keep_only()
        for texts in batches:
            yield pd.Series(machine.scores([np.asarray(text) for text in texts]))
        give_back()

    scored = F.pandas_udf(run, T.DoubleType())
    return hashed.select(*[F.col(alias).alias(column) for alias, column in renamed.items()], scored("_terms").alias(name))
