import numpy as np
import pytest
from pyspark.sql import functions as F

from coinweir.llm import neighbours
from coinweir.llm.queries import op10_neighbours


def usable(vector):
    return vector is not None and all(x is not None and np.isfinite(x) for x in vector) and any(vector)


def recall(rows, data, asked, k):
    """The share of the true nearest that was found; checks order, scores and completeness on the way."""
    ids = np.array([number for number, vector in data if usable(vector)])
    vectors = np.array([vector for _, vector in data if usable(vector)], np.float64)
    by_query = {}
    for row in rows:
        by_query.setdefault(row.query_id, []).append(row)
    assert set(by_query) == ({number for number in ids.tolist() if asked(number)} if len(ids) > 1 else set())
    hits = wanted = 0
    for query, found in by_query.items():
        at = int(np.flatnonzero(ids == query)[0])
        scores = vectors @ vectors[at]
        found = sorted(found, key=lambda row: row.rank)
        assert [row.rank for row in found] == list(range(1, min(k, len(ids) - 1) + 1))
        assert all(row.score == pytest.approx(scores[ids == row.vec_id][0], rel=1e-12) and row.vec_id != query for row in found)
        assert all((-a.score, a.vec_id) < (-b.score, b.vec_id) for a, b in zip(found, found[1:], strict=False))
        scores[at] = -np.inf
        best = ids[np.lexsort((ids, -scores))[: len(found)]]
        hits, wanted = hits + len({row.vec_id for row in found} & set(best.tolist())), wanted + len(found)
    return hits / max(wanted, 1)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_query_over_the_table(spark, folder):
    rows = op10_neighbours(spark, folder).collect()
    data = [(row.vec_id, row.embedding) for row in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    assert recall(rows, data, lambda number: number % 20 == 0, 20) >= 0.95


def test_recall_where_few_leaves_are_opened(spark):
    random = np.random.default_rng(3)
    centres = random.normal(size=(60, 16))
    data = [(at, (centres[at % 60] * (1 + at % 3) + 0.3 * random.normal(size=16)).tolist()) for at in range(6000)]
    vectors = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    data = [(row.vec_id, row.embedding) for row in vectors.collect()]
    found = neighbours.nearest(vectors, F.col("vec_id") % 20 == 0, 10, sample=2000, leaf_rows=16, probes=240)
    found = found.withColumnRenamed("id", "vec_id").collect()
    assert recall(found, data, lambda number: number % 20 == 0, 10) >= 0.9


def test_odd_vectors_copies_and_ties(spark):
    data = [(at, [1.0, 0.0]) for at in range(0, 60)] + [(100, [2.0, 0.0]), (120, [0.0, 3.0]), (140, [0.0, -3.0])]
    data += [(160, None), (180, [0.0, 0.0]), (200, [float("nan"), 1.0]), (220, [float("inf"), 1.0]), (240, [None, 1.0]), (260, [1.0]), (280, [])]
    vectors = spark.createDataFrame([*data, (None, [1.0, 1.0])], "vec_id int, embedding array<double>").withColumn("class", F.lit(1))
    found = neighbours.nearest(vectors, F.col("vec_id") % 20 == 0, 5).withColumnRenamed("id", "vec_id").collect()
    kept = [(number, vector) for number, vector in data if number < 160]
    assert recall(found, kept, lambda number: number % 20 == 0, 5) == 1
    assert [row.vec_id for row in sorted(found, key=lambda row: row.rank) if row.query_id == 0] == [100, 1, 2, 3, 4]


def test_divided_leaves_and_few_vectors(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 3)
    monkeypatch.setattr(neighbours, "HELD", 1)
    data = [(at, [float(at % 7), float(at % 5), 1.0]) for at in range(90)]
    vectors = spark.createDataFrame(data, "vec_id int, embedding array<double>")
    found = neighbours.nearest(vectors, F.col("vec_id") % 20 == 0, 7, sample=20, leaf_rows=10).withColumnRenamed("id", "vec_id")
    assert recall(found.collect(), data, lambda number: number % 20 == 0, 7) == 1
    for few in (0, 1, 2):
        assert neighbours.nearest(vectors.limit(few), F.lit(True), 7).count() == few * (few - 1)
