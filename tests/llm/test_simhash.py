import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from coinweir.llm import simhash
from coinweir.llm.components import components
from coinweir.llm.queries import op9_simhash


def fingerprint(text, words_each=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda found: found[0].lower(), text or ""))
    shingles = [" ".join(words[at : at + words_each]) for at in range(max(1, len(words) - words_each + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(shingle.encode(), 42) for shingle in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(each >> bit & 1 for each in hashes) > len(hashes))


def joined(nodes, edges):
    top = {node: node for node in nodes}

    def root(node):
        while top[node] != node:
            node = top[node]
        return node

    for one, other in edges:
        one, other = root(one), root(other)
        top[max(one, other)] = min(one, other)
    return {node: root(node) for node in nodes}


def close(values, bits):
    array = np.array(values, np.uint64)
    return [(values[at], values[place]) for at in range(len(values)) for place in np.flatnonzero(np.bitwise_count(array ^ array[at]) <= bits)]


def test_query_over_the_table(spark, folder, documents):
    prints = {doc_id: fingerprint(text) for doc_id, text in documents}
    groups = joined(set(prints.values()), close(sorted(set(prints.values())), 2))
    least = {}
    for doc_id, value in prints.items():
        least[groups[value]] = min(doc_id, least.get(groups[value], doc_id))
    rows = op9_simhash(spark, folder).collect()
    assert len(rows) == len(documents)
    for row in rows:
        assert row.fingerprint == f"{prints[row.doc_id]:016x}"
        assert row.component_id == least[groups[prints[row.doc_id]]]


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
@pytest.mark.parametrize("crowded", [2, simhash.CROWDED])
def test_no_link_is_lost(spark, monkeypatch, bits, crowded):
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    draw = random.Random(bits)
    values = {0, (1 << 64) - 1}
    for _ in range(15):  # groups of values a few bits apart, and groups that share one half
        base = draw.getrandbits(64)
        values |= {base ^ sum({1 << draw.randrange(64) for _ in range(draw.randint(0, 4))}) for _ in range(12)}
        values |= {base ^ draw.getrandbits(6) for _ in range(6)}
    values = sorted(values)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    rows = spark.createDataFrame([(value,) for value in signed], "fingerprint long")
    found = {frozenset(pair) for pair in simhash.links(rows, bits).collect()}
    names = dict(zip(values, signed, strict=True))
    assert found == {frozenset((names[one], names[other])) for one, other in close(values, bits) if one != other}


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(5, "a b c d"), (5, "a b c d"), (4, "A B C D"), (None, "a b c d"), (3, None), (2, " \n"), (None, "lonely words here"), (6, "one"), (7, "one two")]
    documents = spark.createDataFrame(rows, "doc_id int, text string").withColumn("fingerprint", F.lit("x")).withColumn("group", F.lit(1))
    found = sorted(((row.doc_id, row.component_id) for row in simhash.near_duplicates(documents).collect()), key=str)
    assert found == sorted([(5, 4), (5, 4), (4, 4), (None, 4), (3, 2), (2, 2), (None, None), (6, 6), (7, 7)], key=str)
    one = simhash.one_of_each(documents)
    assert one.columns == documents.columns
    assert sorted((row.doc_id for row in one.collect()), key=str) == sorted([4, 2, None, 6, 7], key=str)
    assert simhash.near_duplicates(documents.limit(0)).count() == simhash.one_of_each(documents.limit(0)).count() == 0


def test_components_of_a_long_chain_a_star_and_loops(spark):
    chain = [(at, at + 1) for at in range(1000, 1300)]
    star = [(at, 7) for at in range(2000, 2300)]
    draw = random.Random(1)
    wild = [(draw.randint(3000, 3400), draw.randint(3000, 3400)) for _ in range(250)]
    edges = [*chain, *star, *wild, (1, 1), (None, 5), (6, None), (9, 8), (9, 8), (8, 9)]
    rows = components(spark.createDataFrame(edges, "src int, dst int").repartition(8)).collect()
    real = [(a, b) for a, b in edges if a is not None and b is not None and a != b]
    assert {row.node: row.component for row in rows} == joined({node for edge in real for node in edge}, real)
    assert len(rows) == len({row.node for row in rows})
    assert components(spark.createDataFrame([], "src string, dst string")).count() == 0


def test_exploded_tables_are_not_broadcast(spark):
    """A table of 33 rows for each fingerprint is sized like the fingerprints, so that of a few hundred thousand it would be broadcast."""
    pairs = simhash.links(spark.range(1000).select(F.xxhash64("id").alias("fingerprint")), 2)
    pairs.collect()
    joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin)(?:\(skew=true\))? \[([^\]]*)\]", pairs._jdf.queryExecution().executedPlan().toString())
    assert {join for join, keys in joins if "part" in keys} == {"SortMergeJoin"}
