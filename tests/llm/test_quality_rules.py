import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from coinweir.llm import quality_rules
from coinweir.llm.queries import op3_quality_rules


def measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[at : at + 3]) for at in range(len(words) - 2)]
    often = Counter(windows)
    covered = {at + step for at, window in enumerate(windows) if often[window] > 1 for step in range(3)}
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_measures_of_the_table(spark, folder, documents):
    texts = dict(documents)
    rows = op3_quality_rules(spark, folder).collect()
    assert len(rows) == len(texts)
    for row in rows:
        found = (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words)
        assert found == measures(texts[row.doc_id])
        assert row.base_failed == (row.n_words < 50 or 100 * row.n_repeat_words > 50 * row.n_words)
        assert not (row.base_failed and row.kept)


@pytest.mark.parametrize("text", [None, "", " \n\t", "a", "a b a b a b", "x y z " * 40, "é　ü é　ü\x0b\x0c a\n\n a\na", "a b c\nb c a b c", "one\n one\none\n"])
def test_measures_of_odd_texts(spark, text):
    row = quality_rules.signals(spark.createDataFrame([(1, text)], "doc_id int, text string"), ["doc_id"]).first()
    assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == measures(text)


def tail(tries, hits, share):
    logs = [
        math.lgamma(tries + 1) - math.lgamma(at + 1) - math.lgamma(tries - at + 1) + at * math.log(share) + (tries - at) * math.log(1 - share)
        for at in range(hits + 1)
    ]
    return sum(map(math.exp, logs))


def test_binomial_tail_is_exact(spark):
    cases = [(tries, hits) for tries in (1, 5, 40, 400, 3000) for hits in range(12) if hits < tries * 0.05]
    rows = spark.createDataFrame(cases, "tries long, hits long")
    for row in rows.withColumn("p", quality_rules.binomial_tail(F.col("tries"), F.col("hits"), 0.05)).collect():
        assert row.p == pytest.approx(tail(row.tries, row.hits, 0.05), rel=1e-9)


def test_cutoffs_keep_the_limit_in_each_stratum(spark):
    # in "noisy" 1 of 20 good texts is full of symbols, in "calm" 1 of 2000; "few" has too few labels for any bound
    good = [("noisy", 0.4 if at % 20 == 0 else 0.0) for at in range(4000)]
    good += [("calm", 0.4 if at % 2000 == 0 else 0.0) for at in range(4000)] + [("few", 0.0)] * 20
    rows = spark.createDataFrame(good, "lang string, symbol_share double")
    rows = rows.select("*", *[F.lit(0.0).alias(name) for name in quality_rules.CUTOFFS if name != "symbol_share"])
    found = {row.lang: row for row in quality_rules.cutoffs(rows, "lang", 0.04, 0.05).collect()}
    assert found["noisy"].symbol_share_cutoff == 0.5
    assert found["calm"].symbol_share_cutoff == 0.01
    assert found["few"].symbol_share_cutoff is None
    tests = 3 * len(quality_rules.CUTOFFS)
    assert tail(4000, 2, 0.01) <= 0.05 / tests < tail(4000, 200, 0.01)


def test_nulls_repeats_and_no_labels(spark):
    text = " ".join(f"word{at}" for at in range(60))
    rows = [(1, text, "en"), (1, text, "en"), (None, text, None), (2, None, "en"), (3, "", None)]
    documents = spark.createDataFrame(rows, "doc_id int, text string, lang string").withColumn("n_words", F.lit("x"))
    for labels in ([], [(1, 1), (1, None), (None, 1)]):
        judged = quality_rules.judge(documents, spark.createDataFrame(labels, "doc_id int, quality int")).collect()
        assert sorted((str(row.doc_id), row.kept) for row in judged) == [("1", True), ("1", True), ("2", False), ("3", False), ("None", True)]
    assert quality_rules.judge(documents.limit(0), spark.createDataFrame([], "doc_id int, quality int")).count() == 0


def test_repeated_rows_are_one_trial(spark):
    """60 good documents say nothing about 0.5 %, however often one of them is repeated."""
    draw = [" ".join(f"word{at}x{word}" for word in range(60)) for at in range(60)]
    rows = [(at, text, "en") for at, text in enumerate(draw)]
    rows += [(0, draw[0], "en")] * 2000 + [(99, draw[0] + " " + "#" * 400, "en")]
    documents = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    labels = spark.createDataFrame([(at, 1) for at in range(60)], "doc_id int, quality int")
    assert all(row.kept for row in quality_rules.judge(documents, labels).collect())


def test_no_python_in_the_plan(spark, folder):
    plan = op3_quality_rules(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
