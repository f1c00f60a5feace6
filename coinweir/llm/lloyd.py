"""Lloyd's clustering over vectors whose dimensions are divided into shards.

Vectors are cut into blocks of columns; a shard holds the slices of one block, and of every centroid only the slice of that block. A round has two steps. Tasks work out
the exact partial distance of each slice to the centroid slices of its shard; the partial distances of a vector are added up under its key, and the
nearest centroid is taken. Each shard then updates its own centroid slices from its vector slices and the assignment. All numbers
are integers, so sums don't depend on their order. Only centroids reach the driver (k x length numbers).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coinweir.llm.tables import stored

#: Columns of a shard.
BLOCK = 16

#: Scaled components may not exceed this, so that a squared distance of up to 64 components fits a 64-bit integer; longer vectors may reach less.
LARGEST = 1 << 27


@dataclass(frozen=True)
class Clusters:
    """`members`: a row per vector, with `id`, `cluster` and the squared `distance`. `centroids`: their components, in order of number."""

    members: DataFrame
    centroids: list[list[int]]


def _scaled(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(scale * x.cast("double")))


def whole_vectors(rows: DataFrame, id_column: str, vector_column: str, length: int, scale: int) -> DataFrame:
    """(key, id, vector): the vectors with exactly `length` components, none null or non-finite, as integers floor(scale * x). `key` is a number of
    each row's own; rows are written to the shared folder, so it stays.

    A component that is larger than `LARGEST` once scaled stops the job, since distances would not fit their type.
    """
    vector, bound = F.col(vector_column), min(LARGEST, int((2**62 / length) ** 0.5) // 2)
    wrong = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    # a null vector, or one of another length, goes; coalesce keeps the condition from being null
    kept = rows.filter(F.coalesce((F.size(vector) == length) & ~wrong, F.lit(False)))
    too_large = F.exists(vector, lambda x: F.abs(scale * x.cast("double")) >= bound)
    checked = F.when(too_large, F.raise_error(F.lit(f"a component is {bound} or more once scaled"))).otherwise(vector)
    return stored(
        kept.select(F.monotonically_increasing_id().alias("key"), F.col(id_column).alias("id"), _scaled(checked, scale).alias("vector"))
    )


def seeds(vectors: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The `k` vectors with the smallest SHA-256 of `seed:id` (null: no digits), in ascending order of it; equal ones by their components. All, if there are fewer."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    return [row.vector for row in vectors.select(mark.alias("mark"), "vector").orderBy("mark", "vector").limit(k).collect()]


def _shards(vectors: DataFrame, length: int, width: int) -> DataFrame:
    """(key, block, slice): the slices of all vectors, each shard in a folder of its own."""
    starts = [F.struct(F.lit(at // width).alias("block"), F.slice("vector", at + 1, width).alias("slice")) for at in range(0, length, width)]
    return stored(vectors.select("key", F.inline(F.array(*starts))).select("key", "slice", "block"), "block")


def _slices(batch: pa.RecordBatch, name: str) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index(name))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def _by_block(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The rows of a batch, shard by shard; nearly always it holds one shard only."""
    blocks = batch.column(batch.schema.get_field_index("block")).to_numpy()
    for block in np.unique(blocks):
        yield int(block), batch.filter(pa.array(blocks == block))


def assigned(shards: DataFrame, centroids: list[list[int]], width: int) -> DataFrame:
    """(key, cluster, distance): the nearest centroid of each vector by exact squared distance; of equally near ones, that with the smaller number."""
    table = np.array(centroids, dtype=np.int64)
    names = [f"d{number}" for number in range(len(centroids))]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for block, batch in _by_block(whole):
                slices, own = _slices(batch, "slice"), table[:, block * width : (block + 1) * width]
                distances = [pa.array(((slices - centroid) ** 2).sum(axis=1)) for centroid in own]
                yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("key")), *distances], names=["key", *names])

    parts = shards.mapInArrow(partial, ", ".join(f"{name} long" for name in ["key", *names]))
    summed = parts.groupBy("key").agg(*[F.sum(name).alias(name) for name in names])
    near = F.array_min(F.array(*[F.struct(F.col(name).alias("distance"), F.lit(at).alias("cluster")) for at, name in enumerate(names)]))
    return summed.select("key", near.alias("near")).select("key", "near.cluster", "near.distance")


def updated(shards: DataFrame, nearest: DataFrame, centroids: list[list[int]], width: int) -> list[list[int]]:
    """The centroids after each shard has put floor(sum / count) of its own slices in their place; those without vectors stay.

    Tasks add up the slices they hold before anything is grouped, so a cluster with most vectors is no hot spot.
    """
    length = len(centroids[0])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], list] = {}
        for whole in batches:
            for block, batch in _by_block(whole):
                slices = _slices(batch, "slice")
                clusters = batch.column(batch.schema.get_field_index("cluster")).to_numpy()
                for cluster in np.unique(clusters):
                    own = slices[clusters == cluster]
                    total = sums.setdefault((block, int(cluster)), [0, np.zeros(own.shape[1], np.int64)])
                    total[0] += len(own)
                    total[1] += own.sum(axis=0)
        rows = [(block, cluster, at, int(x), n) for (block, cluster), (n, total) in sums.items() for at, x in enumerate(total)]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
        names = ("block", "cluster", "at", "total", "n")
        yield pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)], names=names)

    held = shards.join(nearest.select("key", "cluster"), "key").select("block", "slice", "cluster")
    parts = held.mapInArrow(added, "block int, cluster int, at int, total long, n long")
    sums = parts.groupBy("block", "cluster", "at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    moved = [list(centroid) for centroid in centroids]
    for row in sums.collect():  # k x length rows
        moved[row.cluster][row.block * width + row.at] = int(row.total) // row.n
    assert all(len(centroid) == length for centroid in moved)
    return moved


def cluster(
    rows: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    length: int = 64,
    scale: int = 64,
    k: int = 16,
    rounds: int = 3,
    seed: int = 1,
    width: int = BLOCK,
) -> Clusters:
    """`rounds` rounds of assignment and update from the `seeds`, and an assignment at the end.

    See `whole_vectors` for the vectors that take part: any others are left out. Repeated rows, and rows with a null id, each count as a vector. Fewer vectors than
    `k` make as many clusters, some of which can lose all vectors and then stay; none, none. Assignments are written to the shared folder in each round, so that a lost
    executor costs a round's tasks at most.
    """
    vectors = whole_vectors(rows, id_column, vector_column, length, scale)
    centroids = seeds(vectors, k, seed)
    if not centroids:
        return Clusters(vectors.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), [])
    shards = _shards(vectors, length, width)
    for _ in range(rounds):
        centroids = updated(shards, stored(assigned(shards, centroids, width)), centroids, width)
    nearest = assigned(shards, centroids, width)
    return Clusters(stored(vectors.select("key", "id").join(nearest, "key").select("id", "cluster", "distance")), centroids)


def with_totals(found: Clusters) -> DataFrame:
    """The members with `cluster_inertia` and `inertia`, distances added up over the cluster and over all, and `centroid_sha256`, of the centroid's components as decimal
    integers joined by commas. The totals are k rows."""
    spark = found.members.sparkSession
    distance = F.sum(F.col("distance").cast("decimal(38,0)"))
    totals = {row.cluster: int(row.total) for row in found.members.groupBy("cluster").agg(distance.alias("total")).collect()}
    of_each = [
        (number, totals[number], sum(totals.values()), hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest())
        for number, centroid in enumerate(found.centroids)
        if number in totals
    ]
    sums = spark.createDataFrame(of_each, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.members.join(F.broadcast(sums), "cluster")


def oracle(length: int = 64, scale: int = 64, k: int = 16, rounds: int = 3, seed: int = 1) -> str:
    """`cluster` and `with_totals` over `embeddings` as DuckDB SQL."""

    def nearest(name: str, centroids: str) -> str:
        apart = f"list_sum(list_transform(generate_series(1, {length}), lambda i: (v.q[i] - c.q[i]) * (v.q[i] - c.q[i])))::BIGINT"
        return f"""{name} AS MATERIALIZED (SELECT row, vec_id, q, min(struct_pack(distance := distance, number := number)) AS near
  FROM (SELECT v.row, v.vec_id, v.q, c.number, {apart} AS distance FROM kept v, {centroids} c) GROUP BY row, vec_id, q)"""

    parts = []
    for at in range(rounds):
        parts.append(nearest(f"near{at}", f"centroids{at}"))
        parts.append(f"""sums{at} AS (SELECT near.number AS number, list(s ORDER BY i) AS q FROM (
  SELECT near, i, (sum(q[i]) - (((sum(q[i]) % count(*)) + count(*)) % count(*))) // count(*) AS s
  FROM (SELECT struct_pack(number := near.number) AS near, q, unnest(generate_series(1, {length})) AS i FROM near{at}) GROUP BY near, i) GROUP BY near),
centroids{at + 1} AS MATERIALIZED (SELECT c.number, coalesce(s.q::BIGINT[], c.q) AS q FROM centroids{at} c LEFT JOIN sums{at} s ON s.number = c.number)""")
    parts.append(nearest("last", f"centroids{rounds}"))
    each = ",\n".join(parts)
    return f"""WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS q
  FROM embeddings WHERE len(embedding) = {length} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {length}),
centroids0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY mark, q) - 1)::INTEGER AS number, q
  FROM (SELECT sha256('{seed}:' || coalesce(vec_id::VARCHAR, '')) AS mark, q FROM kept ORDER BY mark, q LIMIT {k})),
{each}
SELECT vec_id, near.number AS cluster, near.distance AS distance,
  (sum(near.distance) OVER (PARTITION BY near.number))::BIGINT AS cluster_inertia, (sum(near.distance) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM last JOIN centroids{rounds} c ON c.number = near.number"""
