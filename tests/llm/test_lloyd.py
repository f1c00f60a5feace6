import hashlib
import math
import random
from collections import Counter

import oracle
import pytest

from coinweir.llm import lloyd
from coinweir.llm.queries import op11_lloyd


def plain(rows, length=64, scale=64, k=16, rounds=3, seed=1):
    """Lloyd's rounds over whole vectors, one by one."""
    kept = []
    for number, vector in rows:
        if vector is not None and len(vector) == length and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((number, [math.floor(scale * x) for x in vector]))
    mark = lambda row: hashlib.sha256(f"{seed}:{'' if row[0] is None else row[0]}".encode()).hexdigest()
    centroids = [vector for _, vector in sorted(kept, key=lambda row: (mark(row), row[1]))[:k]]

    def nearest(vector):
        return min((sum((a - b) ** 2 for a, b in zip(vector, centroid)), at) for at, centroid in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, vector in kept:
            groups.setdefault(nearest(vector)[1], []).append(vector)
        for at, held in groups.items():
            centroids[at] = [sum(column) // len(held) for column in zip(*held)]
    near = [nearest(vector) for _, vector in kept]
    inertia = Counter()
    for distance, at in near:
        inertia[at] += distance
    sha = [hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest() for centroid in centroids]
    return Counter(
        (number, at, distance, inertia[at], sum(inertia.values()), sha[at]) for (number, _), (distance, at) in zip(kept, near)
    )


def found(spark, rows, kind="float", **options):
    schema = f"vec_id long, embedding array<{kind}>, key string, id int, cluster int, block int, slice int"
    rows = spark.createDataFrame([(*row, "clash", 0, 0, 0, 0) for row in rows], schema)
    made = lloyd.with_totals(lloyd.cluster(rows, **options))
    names = ["id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return Counter(map(tuple, made.select(*names).collect()))


def vectors(n, length, seed=0, values=None):
    draw = random.Random(seed)
    pick = (lambda: draw.choice(values)) if values else (lambda: draw.gauss(0, 1))
    return [(number, [pick() for _ in range(length)]) for number in range(n)]


ODD = [
    (7, None),
    (8, []),
    (9, [1.0] * 4),
    (10, [1.0] * 6),
    (11, [1.0, None, 1.0, 1.0, 1.0]),
    (12, [1.0, float("nan"), 1.0, 1.0, 1.0]),
    (13, [1.0, float("inf"), 1.0, 1.0, 1.0]),
    (14, [1.0, float("-inf"), 1.0, 1.0, 1.0]),
    (15, [0.0] * 5),
    (15, [0.0] * 5),
    (15, [-0.1] * 5),
    (None, [0.5] * 5),
    (None, [0.5] * 5),
]


def test_against_brute_force(spark):
    rows = vectors(200, 5) + ODD
    options = {"length": 5, "k": 6, "rounds": 4, "width": 2}
    assert found(spark, rows, "double", **options) == plain(rows, length=5, k=6, rounds=4)


def test_ties_and_clusters_that_lose_all_vectors(spark):
    rows = vectors(60, 3, values=[0.0, 1.0]) + [(number, [0.0] * 3) for number in range(60, 200)]
    for width in (1, 2, 3, 7):
        assert found(spark, rows, length=3, k=20, rounds=2, width=width) == plain(rows, length=3, k=20, rounds=2)


def test_negative_sums_are_rounded_down(spark):
    rows = [(number, [-0.02 * number, 0.01 * number, -1e6]) for number in range(11)]
    assert found(spark, rows, "double", length=3, k=2, rounds=3) == plain(rows, length=3, k=2, rounds=3)


def test_few_and_none(spark):
    rows = vectors(5, 4)
    assert found(spark, rows, "double", length=4, k=16) == plain(rows, length=4)
    assert found(spark, [], length=4) == found(spark, ODD[:8], length=5) == Counter()
    assert found(spark, rows, "double", length=4, rounds=0) == plain(rows, length=4, rounds=0)


def test_too_large_components_stop_the_job(spark):
    with pytest.raises(Exception, match="once scaled"):
        found(spark, [(1, [1e30] * 4)], length=4)


def test_shards_hold_their_own_columns_only(spark, tmp_path):
    rows = spark.createDataFrame(vectors(50, 10), "vec_id long, embedding array<double>")
    whole = lloyd.whole_vectors(rows, "vec_id", "embedding", 10, 64)
    shards = lloyd._shards(whole, 10, 4)
    assert {(row.block, len(row.slice)) for row in shards.collect()} == {(0, 4), (1, 4), (2, 2)}
    files = shards.select("block", "_metadata.file_path").distinct().collect()
    assert len({row.file_path for row in files}) == len(files)


def test_query_equals_sql_and_brute_force(spark, folder):
    made = op11_lloyd(spark, folder)
    assert oracle.normalised(made.toPandas()) == oracle.normalised(oracle.connect(folder).sql(lloyd.oracle()).df())
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()
    assert Counter(map(tuple, made.collect())) == plain([tuple(row) for row in rows])
