"""Approximate nearest neighbours by inner product: a forest of random-projection trees behind one priority queue.

The trees are fitted on a bounded sample and then every vector is put into a leaf of each. Vectors get one more component that
makes their norms equal, so that the largest inner product is also the smallest angle. A search keeps one queue over the branches of all
trees, ordered by how far its vector lies from the planes on the way, and opens leaves in that order. What they hold is
reranked by exact inner products. Equal vectors are indexed and searched once.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coinweir.llm.tables import stored

TREES = 16

#: Bound on the vectors that the trees are fitted on, and the rows of a sample leaf; together they bound the leaves of a tree.
SAMPLE = 8192
LEAF_ROWS = 32

#: Leaves that a search opens, over all trees.
PROBES = 640

#: Vectors of a leaf that are compared in one go; larger leaves are divided.
BLOCK_ROWS = 20_000

#: Searches whose best candidates a task holds before it hands them on.
HELD = 20_000


class Tree:
    """Planes of the inner nodes; a child is an inner node, or ~leaf."""

    def __init__(self, sample: np.ndarray, leaf_rows: int, random: np.random.Generator):
        planes, offsets, children, self.leaves = [], [], [], 0
        todo = [(np.arange(len(sample)), -1, 0)]
        self.root = -1  # the first leaf, if nothing is to be divided
        while todo:
            rows, parent, side = todo.pop()
            if len(rows) <= leaf_rows:
                number = ~self.leaves
                self.leaves += 1
            else:
                number = len(planes)
                vectors = sample[rows]
                direction = self._direction(vectors, random)
                along = vectors @ direction
                offset = float(np.median(along))
                right = along > offset
                if not right.any():  # half of the rows or more lie on the plane
                    right = np.arange(len(rows)) >= len(rows) // 2
                planes.append(direction)
                offsets.append(offset)
                children.append([0, 0])
                todo += [(rows[right], number, 1), (rows[~right], number, 0)]
            if parent < 0:
                self.root = number
            else:
                children[parent][side] = number
        self.planes = np.array(planes).reshape(len(planes), sample.shape[1])
        self.offsets = np.array(offsets)
        self.children = np.array(children, np.int64).reshape(-1, 2)

    @staticmethod
    def _direction(vectors: np.ndarray, random: np.random.Generator) -> np.ndarray:
        """A random direction, drawn towards where the vectors divide: between the centres of two random halves."""
        one, other = vectors[random.choice(len(vectors), 2, replace=False)]
        for _ in range(3):
            near = ((vectors - one) ** 2).sum(axis=1) < ((vectors - other) ** 2).sum(axis=1)
            if near.all() or not near.any():
                return random.normal(size=vectors.shape[1])
            one, other = vectors[near].mean(axis=0), vectors[~near].mean(axis=0)
        return (one - other) / np.linalg.norm(one - other)

    def leaf(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector."""
        at = np.full(len(vectors), self.root)
        while len(active := np.flatnonzero(at >= 0)):
            nodes = at[active]
            right = (vectors[active] * self.planes[nodes]).sum(axis=1) > self.offsets[nodes]
            at[active] = self.children[nodes, right.astype(int)]
        return ~at


class Forest:
    def __init__(self, sample: np.ndarray, longest: float, trees: int, leaf_rows: int):
        """`longest` is the largest norm of all vectors, in the sample or not."""
        random = np.random.default_rng(5)
        self.longest = longest
        sample = self.levelled(sample)
        self.trees = [Tree(sample, leaf_rows, random) for _ in range(trees)]

    def levelled(self, vectors: np.ndarray) -> np.ndarray:
        """Vectors with the component that gives all of them the largest norm."""
        rest = np.maximum(self.longest**2 - (vectors**2).sum(axis=1), 0)
        return np.column_stack([vectors, np.sqrt(rest)])

    def search(self, vectors: np.ndarray, probes: int) -> list[list[tuple[int, int]]]:
        """For each vector the (tree, leaf) that its queue opens first."""
        level = np.column_stack([vectors, np.zeros(len(vectors))])
        margins = [level @ tree.planes.T - tree.offsets for tree in self.trees]
        children = [tree.children.tolist() for tree in self.trees]
        found = []
        for row in range(len(vectors)):
            sides = [margin[row].tolist() for margin in margins]
            queue = [(0.0, number, tree.root) for number, tree in enumerate(self.trees)]
            heapq.heapify(queue)
            opened = []
            while queue and len(opened) < probes:
                far, number, node = heapq.heappop(queue)
                margin, below = sides[number], children[number]
                while node >= 0:
                    side = margin[node]
                    right = side > 0
                    heapq.heappush(queue, (max(far, abs(side)), number, below[node][not right]))
                    node = below[node][right]
                opened.append((number, ~node))
            found.append(opened)
        return found


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def _product(one: str, other: str) -> Column:
    return F.aggregate(F.zip_with(one, other, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)


def _stacked(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def nearest(
    vectors: DataFrame,
    asked: Column,
    k: int,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    trees: int = TREES,
    sample: int = SAMPLE,
    leaf_rows: int = LEAF_ROWS,
    probes: int = PROBES,
) -> DataFrame:
    """(query_id, rank, id, score): for each row where `asked` holds, the `k` rows found with the largest inner products, its own
    row excepted, best first, ties to the smaller id; all rows, if there are fewer.

    `score` is the inner product in double precision. Ids are unique integers; rows with a null id, or a vector that is null, zero, of another
    length than most, or holds a null or non-finite component, take no part. No rows, no results.
    """
    rows = vectors.select(
        F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("vector"), F.coalesce(asked, F.lit(False)).alias("asked")
    ).filter(F.col("id").isNotNull() & _usable(F.col("vector")))
    dimension = rows.agg(F.mode(F.size("vector"), deterministic=True).alias("size")).first()["size"] or 1
    rows = rows.filter(F.size("vector") == dimension)

    # one row for equal vectors; those of a class beyond its k + 1 smallest ids can't be among k results
    kinds = stored(rows.groupBy("vector").agg(F.min("id").alias("class"), F.bool_or("asked").alias("asked")))
    placed = stored(rows.join(kinds.select("vector", "class"), "vector").select("id", "class", "asked"))
    by_id = Window.partitionBy("class").orderBy("id")
    members = placed.withColumn("turn", F.row_number().over(by_id)).filter(F.col("turn") <= k + 1).select("class", "id")

    norm = F.sqrt(_product("vector", "vector"))
    size = kinds.agg(F.count("*").alias("n"), F.max(norm).alias("longest")).first()
    drawn = kinds.orderBy(F.xxhash64("class"), "class").limit(sample).select("vector").collect()
    forest = Forest(np.array([row.vector for row in drawn], np.float64).reshape(-1, dimension), size.longest or 0.0, trees, leaf_rows)
    parts = max(1, -(-size.n // (BLOCK_ROWS * max(forest.trees[0].leaves, 1))))  # of a leaf

    schema = "tree int, leaf int, part int, query boolean, class long, vector array<double>"
    names = ["tree", "leaf", "part", "query", "class", "vector"]

    def placing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                classes, vector, wanted = batch.slice(at, 1000).columns
                stacked = _stacked(vector, dimension)
                own = classes.to_numpy()
                level = forest.levelled(stacked)
                for number, tree in enumerate(forest.trees):
                    leaves = tree.leaf(level).astype(np.int32)
                    whole = len(leaves)
                    part = (own % parts).astype(np.int32)
                    arrays = [np.full(whole, number, np.int32), leaves, part, np.zeros(whole, bool)]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, arrays), classes, vector], names)
                queries = np.flatnonzero(wanted.to_numpy(zero_copy_only=False))
                for begin in range(0, len(queries), 50):
                    some = queries[begin : begin + 50]
                    opened = forest.search(stacked[some], probes)
                    found = [(row, *leaf, part) for row, each in zip(some, opened, strict=True) for leaf in each for part in range(parts)]
                    index, tree_, leaf_, part_ = np.array(found).T
                    arrays = [tree_.astype(np.int32), leaf_.astype(np.int32), part_.astype(np.int32), np.ones(len(index), bool)]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, arrays), classes.take(pa.array(index)), vector.take(pa.array(index))], names)

    def comparing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        leaf, ids, held = None, [], []
        stacked = other = None

        def handed() -> Iterator[pa.RecordBatch]:
            queries = list(best)
            for at in range(0, len(queries), 2000):
                some = queries[at : at + 2000]
                counts = [len(best[query][0]) for query in some]
                arrays = [np.repeat(some, counts), np.concatenate([best[query][0] for query in some]), np.concatenate([best[query][1] for query in some])]
                yield pa.RecordBatch.from_arrays([pa.array(each) for each in arrays], ["query", "class", "score"])
            best.clear()

        for batch in batches:
            keys = np.stack([batch.column(place).to_numpy() for place in range(3)], axis=1)
            query = batch.column(3).to_numpy(zero_copy_only=False)
            classes, vectors_ = batch.column(4).to_numpy(), _stacked(batch.column(5), dimension)
            turns = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1) | (query[1:] != query[:-1]))))
            for start, stop in zip(turns, np.append(turns[1:], len(keys)), strict=True):
                if leaf != tuple(keys[start]):
                    leaf, ids, held, stacked = tuple(keys[start]), [], [], None
                if not query[start]:
                    ids.append(classes[start:stop])
                    held.append(vectors_[start:stop])
                    continue
                if not held:
                    continue  # an empty leaf
                if stacked is None:
                    stacked, other = np.concatenate(held), np.concatenate(ids)
                for at in range(start, stop, 256):
                    scores = vectors_[at : min(at + 256, stop)] @ stacked.T
                    for row, own in enumerate(classes[at : min(at + 256, stop)].tolist()):
                        score, known = scores[row], best.get(own)
                        found = other
                        if known is not None and len(known[0]) > k:
                            chosen = np.flatnonzero(score >= known[1][-1])
                            if not len(chosen):
                                continue
                            score, found = score[chosen], other[chosen]
                        if known is not None:
                            found, score = np.concatenate((known[0], found)), np.concatenate((known[1], score))
                        order = np.lexsort((found, -score))
                        found, score = found[order], score[order]
                        _, firsts = np.unique(found, return_index=True)
                        firsts = np.sort(firsts)[: k + 1]
                        best[own] = found[firsts], score[firsts]
                if len(best) > HELD:
                    yield from handed()
        yield from handed()

    key = ["tree", "leaf", "part"]
    leaves = kinds.select("class", "vector", "asked").mapInArrow(placing, schema)
    leaves = leaves.repartition(*key).sortWithinPartitions(*key, "query")
    found = leaves.mapInArrow(comparing, "query long, class long, score double").groupBy("query", "class").agg(F.max("score").alias("score"))
    closest = Window.partitionBy("query").orderBy(F.col("score").desc(), "class")
    found = found.withColumn("turn", F.row_number().over(closest)).filter(F.col("turn") <= k + 1).select("query", "class")
    found = found.join(kinds.select("class", "vector"), "class")
    found = found.join(kinds.select(F.col("class").alias("query"), F.col("vector").alias("sought")), "query")
    found = found.select("query", "class", _product("sought", "vector").alias("score")).join(members, "class")
    best_ids = Window.partitionBy("query").orderBy(F.col("score").desc(), "id")
    found = found.withColumn("turn", F.row_number().over(best_ids)).filter(F.col("turn") <= k + 1).select("query", "id", "score")
    asking = placed.filter("asked").select(F.col("id").alias("query_id"), F.col("class").alias("query"))
    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    results = asking.join(found, "query").filter("id <> query_id").withColumn("rank", F.row_number().over(ranked))
    return results.filter(F.col("rank") <= k).select("query_id", "rank", "id", "score")
