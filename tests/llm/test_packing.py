import random
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from coinweir.llm import packing
from coinweir.llm.queries import op4_packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def filled(counts, capacity):
    """Checks a plan and returns how many bins it has."""
    bins, seen = defaultdict(list), Counter()
    for length, first, stop, bin_, each, offset in packing.plan(counts, capacity):
        for rank in range(stop - first):
            bins[bin_ + rank // each].append((offset + rank % each * length, length))
        seen[length] += stop - first
    assert seen == Counter(counts)
    for contents in bins.values():
        at = 0
        for offset, length in sorted(contents):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_plans_are_whole_and_close_to_best_fit():
    draw = random.Random(1)
    for _ in range(200):
        capacity = draw.choice([10, 50, 100])
        counts = {draw.randint(1, capacity): draw.randint(1, 30) for _ in range(draw.randint(0, 20))}
        gaps, opened = [], 0
        for length in sorted((length for length, count in counts.items() for _ in range(count)), reverse=True):
            at = bisect_left(gaps, length)
            opened += at == len(gaps)
            insort(gaps, (gaps.pop(at) if at < len(gaps) else capacity) - length)
        assert filled(counts, capacity) <= 1.12 * opened + 1


def test_large_items_are_matched_as_often_as_they_can():
    assert filled({60: 5, 40: 5}, 100) == 5
    assert filled({50: 7}, 100) == 4
    assert filled({70: 1, 40: 2, 35: 1}, 100) == 3
    assert filled({100: 3, 1: 100}, 100) == 4


def test_lengths_that_no_sequence_holds():
    for length in (0, 11):
        with pytest.raises(ValueError):
            packing.plan({length: 1}, 10)


def check(rows, texts, capacity, counts=None):
    library = Tokenizer.from_file(PATH)
    by_document, sequences = defaultdict(list), defaultdict(list)
    for row in rows:
        by_document[row.doc_id].append(row)
        sequences[row.sequence_id].append((row.offset, row.length))
    for doc_id, text in texts:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        pieces = sorted(by_document[doc_id], key=lambda row: row.piece)
        assert [row.piece for row in pieces] == list(range(-(-len(ids) // capacity)))
        for row in pieces:
            own = ids[row.start : row.start + row.length]
            assert (row.start, row.ids_crc32) == (row.piece * capacity, zlib.crc32(own.tobytes()))
        assert sum(row.length for row in pieces) == len(ids)
    for contents in sequences.values():
        at = 0
        for offset, length in sorted(contents):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_query_over_the_table(spark, folder, documents):
    rows = op4_packing(spark, folder).collect()
    sequences = check(rows, documents, 4096)
    assert sequences <= -(-sum(row.length for row in rows) // 4096) + 1


def test_cuts_nulls_and_clashing_columns(spark):
    texts = [(1, "one two three " * 30), (2, None), (3, ""), (None, "x"), (4, "<|endoftext|> É é \x1c"), (5, "solo")]
    documents = spark.createDataFrame(texts, "doc_id int, text string").withColumn("length", F.lit("x")).withColumn("task", F.lit(1))
    with pytest.raises(ValueError):
        packing.pieces(documents, PATH, 1, 16)
    made = packing.pieces(documents, PATH, 1, 16, keep=["doc_id", "task"]).withColumn("ids_crc32", F.crc32("ids"))
    check(packing.pack(made, 16).collect(), texts, 16)
    assert packing.pack(made.limit(0), 16).count() == 0


def test_repeated_rows_each_get_a_place(spark):
    made = spark.createDataFrame([(1, 5)] * 7 + [(2, 3)] * 2, "doc_id int, length int").repartition(3)
    rows = packing.pack(made, 10).collect()
    assert len({(row.sequence_id, row.offset) for row in rows}) == 9
    assert len({row.sequence_id for row in rows}) == 5


def test_strings_of_special_tokens():
    """As the library takes them: a special token where the string is written as it is, ordinary text otherwise."""
    library = Tokenizer.from_file(PATH)
    special = [token.content for token in library.get_added_tokens_decoder().values()]
    assert "<|startoftext|>" in special
    texts = [f"{before}{mark}{behind}" for mark in [*special, special[0].upper(), special[0][:-1]] for before in ("", "a ", "A.") for behind in ("", " B", "c,")]
    encoder = packing.Encoder(PATH)
    for text, found in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(found, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode(["a <|startoftext|> b"])[0], "<u4").tolist() == [320, 49406, 321]


def test_marks_that_compose_in_one_case_only():
    """A small t and a diaeresis behind it are one letter, a capital T and it are not; lower-casing comes after that."""
    library = Tokenizer.from_file(PATH)
    texts = ["T̈", "aT̈b", "H̱ W̊", "ẗ", "É", "é"]
    for text, found in zip(texts, packing.Encoder(PATH).encode(texts), strict=True):
        assert np.frombuffer(found, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_simple_words_are_cut_without_the_whole_tokenizer():
    """Normalizing and cutting each new word took half of the time; other words still go through the library as a whole."""
    library = Tokenizer.from_file(PATH)
    draw, whole = random.Random(3), []
    letters = [*map(chr, range(0x21, 0x7F)), *map(chr, range(0xC0, 0x100)), "'s", "'LL", "the", "É", "##"]
    texts = ["".join(draw.choices(letters, k=draw.randint(1, 8))) for _ in range(3000)]
    encoder = packing.Encoder(PATH)
    found = encoder.encode(texts)
    assert [np.frombuffer(each, "<u4").tolist() for each in found] == [library.encode(text, add_special_tokens=False).ids for text in texts]

    class Watched:
        def encode(self, words, **how):
            whole.extend(words)
            return library.encode(words, **how)

    encoder = packing.Encoder(PATH)
    encoder._tokenizer = Watched()
    encoder.encode(["The word's Été, 12##", "漢 é", "漢"])
    assert whole == ["漢", "é"]
