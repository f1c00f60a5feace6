"""Quality rules whose cutoffs keep a bound on false rejections, by DataFrame functions only.

Each rule compares one signal of a text with a cutoff. Labelled documents are the holdout: for every stratum, rule and candidate
cutoff, the good ones that the cutoff would reject are counted, and an exact binomial test asks whether their share among all
good documents of that stratum could still exceed the limit. The limit is shared out over the rules and the error level over rules and
strata (Bonferroni). The cutoffs of a rule are tested from the loosest down and none behind one that fails, which needs no correction of its own; a lower
cutoff rejects no fewer documents, so those that pass come first. So, with probability 1 - `error` no stratum loses more than `limit` of its good documents. Of the cutoffs that pass,
the lowest is used; a rule without one rejects nothing in that stratum.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coinweir.llm.tables import fresh, stored, text_of

BLANKS = r"[\x20\x09-\x0D]+"
NOT_BLANK = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"

#: Candidate cutoffs of each signal; a text is rejected above its cutoff.
CUTOFFS: dict[str, tuple[float, ...]] = {
    "symbol_share": (0.01, 0.02, 0.04, 0.06, 0.08, 0.1, 0.15, 0.2, 0.3, 0.5),
    "dup_line_share": (0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.7),
    "repeat_word_share": (0.02, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4),
    "word_length": (8.0, 10.0, 12.0, 15.0, 20.0, 30.0, 50.0),
}


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _repeat_words(windows: Column) -> Column:
    """Words under windows that occur twice or more. Windows are sorted with their places, so that equal ones
    are neighbours; the places of those are put back in order, and each adds what the next does not cover."""
    placed = F.sort_array(F.transform(windows, lambda window, at: F.struct(window.alias("w"), at.alias("at"))))

    def repeated(item: Column, at: Column, items: Column) -> Column:
        same = [F.coalesce(F.get(items, at + step)["w"] == item["w"], F.lit(False)) for step in (-1, 1)]
        return same[0] | same[1]

    # one-element arrays hold an intermediate value, so that it is worked out once
    places = F.transform(
        F.array(placed),
        lambda items: F.sort_array(
            F.transform(F.filter(items, lambda item, at: repeated(item, at, items)), lambda item: item["at"])
        ),
    )
    covered = F.transform(
        places,
        lambda at: F.aggregate(
            F.transform(at, lambda place, turn: F.least(F.lit(3), F.coalesce(F.get(at, turn + 1) - place, F.lit(3)))),
            F.lit(0),
            lambda total, each: total + each,
        ),
    )
    return F.get(covered, F.lit(0)).cast("long")


def signals(documents: DataFrame, keep: list[str], text_column: str = "text") -> DataFrame:
    """`keep` and the measures of every whole text: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines.

    Null and empty texts have zeros. A line counts if it holds a word.
    """
    text, words, windows = F.col("_text"), F.col("_words"), F.col("_windows")
    lines = F.col("_lines")
    n_words = F.size(words)
    rows = documents.select(*keep, text_of(text_column).alias("_text"))
    rows = rows.select(
        "*",
        F.filter(F.split(text, BLANKS), lambda word: word != "").alias("_words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(NOT_BLANK)).alias("_lines"),
    )
    rows = rows.select(
        *keep,
        n_words.cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.size(lines).cast("long").alias("n_lines"),
        F.when(
            n_words >= 3,
            F.slice(
                F.transform(words, lambda word, at: F.concat_ws(" ", word, F.get(words, at + 1), F.get(words, at + 2))),
                F.lit(1),
                n_words - 2,
            ),
        )
        .otherwise(F.array().cast("array<string>"))
        .alias("_windows"),
    )
    repeats = F.when(F.size(F.array_distinct(windows)) < F.size(windows), _repeat_words(windows))
    return rows.select("*", F.coalesce(repeats, F.lit(0)).cast("long").alias("n_repeat_words")).drop("_windows")


def with_shares(measured: DataFrame) -> DataFrame:
    """The measures with the signals that the rules look at."""
    return measured.select(
        "*",
        _share(F.col("n_symbols"), F.col("word_chars")).alias("symbol_share"),
        _share(F.col("n_dup_lines"), F.col("n_lines")).alias("dup_line_share"),
        _share(F.col("n_repeat_words"), F.col("n_words")).alias("repeat_word_share"),
        _share(F.col("word_chars"), F.col("n_words")).alias("word_length"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def binomial_tail(tries: Column, hits: Column, share: float) -> Column:
    """P(X <= hits) for X ~ Binomial(tries, share), exactly summed from the term at `hits` downwards, or 1 where
    `hits` reach the mean; there no bound below `share` can hold."""
    log_term = (
        F.aggregate(
            F.when(hits > 0, F.sequence(F.lit(1).cast("long"), hits)).otherwise(F.array().cast("array<bigint>")),
            F.lit(0.0),
            lambda total, at: total + F.log((tries - hits + at) / at),
        )
        + hits * F.log(F.lit(share))
        + (tries - hits) * F.log(F.lit(1.0 - share))
    )
    falling = F.aggregate(
        F.when(hits > 0, F.sequence(hits, F.lit(1).cast("long"), F.lit(-1).cast("long"))).otherwise(F.array().cast("array<bigint>")),
        F.struct(F.lit(1.0).alias("sum"), F.lit(1.0).alias("term")),
        lambda seen, at: F.struct(
            (seen["sum"] + seen["term"] * at / (tries - at + 1) * ((1.0 - share) / share)).alias("sum"),
            (seen["term"] * at / (tries - at + 1) * ((1.0 - share) / share)).alias("term"),
        ),
        lambda seen: seen["sum"],
    )
    return F.when(hits < tries * share, F.exp(log_term + F.log(falling))).otherwise(F.lit(1.0))


def cutoffs(good: DataFrame, stratum: str, limit: float, error: float) -> DataFrame:
    """One row per stratum of the good documents: `stratum` and the chosen cutoff of each signal, null for none.

    `good` holds the signals of labelled good documents. A null stratum is one of its own.
    """
    share = limit / len(CUTOFFS)
    counts = good.groupBy(stratum).agg(
        F.count("*").alias("_tries"),
        *[
            F.count_if(F.col(signal) > cutoff).alias(f"_{signal}_{place}")
            for signal, candidates in CUTOFFS.items()
            for place, cutoff in enumerate(candidates)
        ],
    )
    strata = counts.agg((F.count("*") * len(CUTOFFS)).alias("_tests"))
    level = F.lit(error) / F.col("_tests")
    chosen = [
        F.coalesce(
            *[
                F.when(binomial_tail(F.col("_tries"), F.col(f"_{signal}_{place}"), share) <= level, F.lit(cutoff))
                for place, cutoff in enumerate(candidates)
            ]
        ).alias(f"{signal}_cutoff")
        for signal, candidates in CUTOFFS.items()
    ]
    return counts.join(F.broadcast(strata)).select(stratum, *chosen)  # `strata` is one row


def judge(
    documents: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    stratum: str = "lang",
    limit: float = 0.02,
    error: float = 0.05,
) -> DataFrame:
    """Every document's id, stratum, measures, `base_failed`, `failed_rules` and `kept`.

    `labels` has the id and `quality`, 1 for good; of several labels of a document the lowest counts, null labels and null ids are
    passed over. Documents with a null or empty text have no words and fail the base rules. Repeated rows are judged alike, once
    each; the holdout counts a document once, by its largest measures. Without labels no cutoff is certain, so that only the base rules reject. Measures are written once, because they
    serve the choice of cutoffs and its use.
    """
    measured = stored(with_shares(signals(documents, [id_column, stratum], text_column)).withColumn("base_failed", base_failed()))
    good = labels.groupBy(id_column).agg(F.min("quality").alias("_quality")).filter("_quality = 1").select(id_column)
    held = measured.filter(~F.col("base_failed")).join(good, id_column, "left_semi")
    held = held.groupBy(id_column, stratum).agg(*[F.max(signal).alias(signal) for signal in CUTOFFS])  # repeated rows are no further trials
    found = cutoffs(held, stratum, limit, error)
    key = fresh("stratum", measured.columns)
    found = found.withColumnRenamed(stratum, key)
    above = {signal: F.coalesce(F.col(signal) > F.col(f"{signal}_cutoff"), F.lit(False)) for signal in CUTOFFS}
    judged = measured.join(found, F.col(stratum).eqNullSafe(F.col(key)), "left")
    return judged.select(
        *measured.columns,
        F.array_compact(F.array(*[F.when(fails, F.lit(signal)) for signal, fails in above.items()])).alias("failed_rules"),
        (~F.col("base_failed") & ~reduce(Column.__or__, above.values())).alias("kept"),
    )
