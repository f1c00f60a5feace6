import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from coinweir.llm import katz
from coinweir.llm.queries import op2_katz
from coinweir.llm.tables import remainder


def trains(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 != 2


def plain(documents):
    """The same model by dictionaries; also checks that what follows a history sums to one."""
    words_of = lambda text: (text or "").encode().lower().split() + ["end"]
    single, pairs = Counter(), defaultdict(Counter)
    for _, text, training in documents:
        before = "start"
        for word in words_of(text) if training else []:
            single[word] += 1
            pairs[before][word] += 1
            before = word

    def factors(counts):
        seen = Counter(counts)
        return katz.discounts([seen[count] for count in range(1, katz.DISCOUNTED + 2)])

    tokens, vocabulary = sum(single.values()), len(single)
    one, two = factors(single.values()), factors([count for after in pairs.values() for count in after.values()])
    kept = lambda by, count: (by[count] if count <= katz.DISCOUNTED else 1.0) * count
    lost = sum(count - kept(one, count) for count in single.values())
    total = tokens if lost else tokens + 1
    rest = (lost / tokens if lost else 1 / total) if tokens else 1.0

    def lower(word):
        return (kept(one, single[word]) / total if single[word] else rest) if tokens else 1.0

    known = {}

    def higher(word, before):
        if before not in pairs:
            return lower(word)
        after = pairs[before]
        if before not in known:
            count = sum(after.values())
            gone = sum(each - kept(two, each) for each in after.values())
            divisor = count if gone else count + 1
            known[before] = divisor, (gone or 1) / divisor / max(1 - sum(map(lower, after)), rest)
        divisor, alpha = known[before]
        return kept(two, after[word]) / divisor if after[word] else alpha * lower(word)

    for before in [*list(pairs)[:5], "never"] if tokens else []:
        assert sum(higher(word, before) for word in single) + higher("unknown", before) == pytest.approx(1, abs=1e-9)
    results = []
    for doc_id, text, training in documents:
        words = words_of(text)
        base = sum(math.log10((single[word] + 1) / (tokens + vocabulary + 1)) for word in words)
        score = sum(math.log10(higher(word, before)) for word, before in zip(words, ["start", *words], strict=False))
        results.append((doc_id, training, len(words), sum(single[word] > 0 for word in words), tokens, base, score))
    return results


def same(rows, documents):
    key = lambda row: (str(row[0]), row[2], row[5])
    found, expected = sorted(map(tuple, rows), key=key), sorted(plain(documents), key=key)
    assert [row[:5] for row in found] == [row[:5] for row in expected]
    for one, other in zip(found, expected, strict=True):
        assert one[5:] == pytest.approx(other[5:], rel=1e-9, abs=1e-9)


def test_query_over_the_table(spark, folder, documents):
    rows = op2_katz(spark, folder).withColumn("held_out", ~F.col("held_out")).collect()
    same(rows, [(doc_id, text, trains(doc_id)) for doc_id, text in documents])
    held = [row for row in rows if not row.held_out]
    assert sum(row.score for row in held) > sum(row.base_score for row in held)


def test_many_blocks_partitions_and_frequent_histories(spark, folder, documents, monkeypatch):
    monkeypatch.setattr(katz, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(katz, "PARTITION_TOKENS", 5000)
    monkeypatch.setattr(katz, "FREQUENT", 1 / 50)
    rows = op2_katz(spark, folder).withColumn("held_out", ~F.col("held_out")).collect()
    same(rows, [(doc_id, text, trains(doc_id)) for doc_id, text in documents])


SMALL = [(1, "A b c a b"), (2, "a b c d"), (2, "a b c d"), (3, None), (None, "x y z"), (4, ""), (5, "q w"), (6, "a a a a"), (7, "É é E e"), (15, "never seen words a b"), (16, "b d a")]


@pytest.mark.parametrize("training", ["some", "none", "all"])
def test_nulls_repeats_and_unknown_words(spark, training):
    rows = spark.createDataFrame(SMALL, "doc_id int, text string").coalesce(1).withColumn("training", F.lit(1)).withColumn("id", F.lit(2))
    choice = {"some": remainder("doc_id", 7) != 2, "none": F.lit(None).cast("boolean"), "all": F.lit(True)}[training]
    chosen = {"some": trains, "none": lambda _: False, "all": lambda _: True}[training]
    same(katz.score(rows, choice).collect(), [(doc_id, text, chosen(doc_id)) for doc_id, text in SMALL])


def test_no_documents(spark):
    assert katz.score(spark.createDataFrame([], "doc_id int, text string"), F.lit(True)).count() == 0
