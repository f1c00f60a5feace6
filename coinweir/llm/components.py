"""Connected components of a graph given by its edges."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coinweir.llm.tables import stored


NODES_HELD = 500_000


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What connects the nodes of one task's edges: each node with the smallest one it reaches there. The forest is handed
    on and begun anew whenever it holds `NODES_HELD`."""
    parent: dict = {}

    def root(node):
        top = node
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[node] != top:
            parent[node], node = top, parent[node]
        return top

    def stars() -> Iterator[pd.DataFrame]:
        nodes = [node for node in list(parent) if root(node) != node]
        for start in range(0, len(nodes), 50_000):
            part = nodes[start : start + 50_000]
            yield pd.DataFrame({"src": part, "dst": [root(node) for node in part]})

    for batch in batches:
        for one, other in zip(batch["src"].to_list(), batch["dst"].to_list(), strict=True):
            one, other = root(one), root(other)
            if one != other:
                parent[max(one, other)] = min(one, other)
        if len(parent) > NODES_HELD:
            yield from stars()
            parent.clear()
    yield from stars()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges `src`, `dst`; the component is its smallest node.

    Directions don't matter; loops, repeated edges and edges with a null end connect nothing. No edges, no rows. Each task first
    reduces its own edges to a forest, so that a dense group costs no more than its nodes. Then large-star and small-star
    steps alternate until every edge leads to the smallest node: minima are aggregated in tasks before the shuffle, and the joins are plain
    ones that adaptive execution splits where a node has very many edges. Each round is written to the shared folder.
    """
    kind = edges.schema["src"].dataType.simpleString()
    edges = edges.select("src", "dst").filter("src IS NOT NULL AND dst IS NOT NULL AND src <> dst")
    edges = stored(edges.mapInPandas(_forest, f"src {kind}, dst {kind}"))  # src is above dst

    def linked(rows: DataFrame) -> DataFrame:
        """Each node with its smallest neighbour, itself included."""
        return rows.groupBy("src").agg(F.min("dst").alias("least"))

    def total(rows: DataFrame) -> tuple:
        """A fingerprint of the edges; equal for two rounds only if nothing changed."""
        return tuple(rows.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first())

    before = total(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        least = both.groupBy("src").agg(F.least(F.min("dst"), F.first("src")).alias("least"))
        larger = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))  # neighbours above the node
        large = larger.join(least, "src").select(F.col("dst").alias("src"), F.col("least").alias("dst"))
        large = large.distinct()
        small = large.join(linked(large), "src")
        small = small.select(F.col("dst").alias("src"), F.col("least").alias("dst")).unionByName(
            small.select("src", F.col("least").alias("dst"))
        )
        edges = stored(small.filter("src <> dst").distinct())
        after = total(edges)
        if after == before:
            break
        before = after
    tops = edges.select(F.col("dst").alias("node")).distinct()
    return edges.select(F.col("src").alias("node"), F.col("dst").alias("component")).unionByName(
        tops.select("node", F.col("node").alias("component"))
    )
