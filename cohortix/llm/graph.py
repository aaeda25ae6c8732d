"""Connected components of an undirected graph, in rounds of distributed least stars."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize

#: Edges that a task contracts at once.
CONTRACT = 500_000
#: Edges (after the first contraction) that one task may finish; a few megabytes.
IN_ONE_TASK = 50_000
#: So many times as many may hold edges that several tasks found.
REPEATED = 4
#: Moves of centres that may be broadcast.
MOST_BROADCAST = 100_000
SALTS = 16


def components(edges: DataFrame, in_one_task: int = IN_ONE_TASK) -> DataFrame:
    """(a, b) edges -> (node, root): every node that has an edge, with the least node of its component.

    First each task replaces the edges it holds by least stars of their components, without a shuffle; up to in_one_task
    edges (REPEATED times as many while several tasks may have found the same), a single task then does the rest. Otherwise rounds follow: a node with several smaller neighbours links them
    to the least one and keeps only that, and a star whose centre has a smaller neighbour moves there, so long chains
    shrink geometrically. A node's neighbours are never gathered in a row, and the edges of a large star are never dealt
    by their centre alone. Each round is written to the shared folder; the rounds end when the edges are stars with
    disjoint centres. Nulls and loops are left out; the types of a and b may be any orderable type.
    """
    pairs = edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    kind = pairs.schema["u"].dataType.simpleString()
    current = materialize(pairs.mapInPandas(contract, f"u {kind}, v {kind}"), "stars")
    few = current.count() <= REPEATED * in_one_task
    if not few:
        current = replaced(current, current.distinct())
        few = current.count() <= in_one_task
    if few:
        return replaced(current, current.coalesce(1).mapInPandas(rooted, f"node {kind}, root {kind}"))
    while not is_forest(current):  # every round moves a node to a smaller one, so this ends
        current = replaced(current, *shortened(current))
    roots = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def replaced(old: DataFrame, new: DataFrame, *used: DataFrame) -> DataFrame:
    """The new stars, written, after which the old ones and the tables they were made from go."""
    written = materialize(new, "stars")
    discard(old, *used)
    return written


def shortened(stars: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One round: least smaller neighbours, then a step of every centre to its own. Also gives the two tables that it wrote."""
    least = stars.groupBy("u").agg(F.min("v").alias("m"), F.max("v").alias("most"))
    several = least.filter("m <> most").select(F.col("u").alias("w"), "m")
    others = stars.join(several, F.col("u") == F.col("w")).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    single = materialize(least.select("u", F.col("m").alias("v")).unionByName(others).distinct(), "stars")
    down = single.groupBy("u").agg(F.min("v").alias("to")).withColumnRenamed("u", "c")
    moves = materialize(down.join(single.select(F.col("v").alias("c")).distinct(), "c", "left_semi"), "moves")
    if moves.count() <= MOST_BROADCAST:
        moved = single.join(F.broadcast(moves), F.col("v") == F.col("c"), "left")
    else:  # a large star's edges are dealt to SALTS tasks
        salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt2")
        salted = single.withColumn("salt", F.pmod(F.xxhash64("u"), F.lit(SALTS)))
        moved = salted.join(moves.select("c", "to", salts), (F.col("v") == F.col("c")) & (F.col("salt") == F.col("salt2")), "left")
    return moved.select("u", F.coalesce("to", "v").alias("v")).distinct(), single, moves


def contract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edges (u, v) -> star edges (node, least node of its component among the edges seen together)."""
    parent: dict = {}

    def find(x):
        root = x
        while parent[root] != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    def flush() -> pd.DataFrame:
        rows = [(x, r) for x in parent if (r := find(x)) != x]
        return pd.DataFrame(rows, columns=["u", "v"])

    for batch in batches:
        for u, v in zip(batch["u"], batch["v"], strict=True):
            parent.setdefault(u, u)
            parent.setdefault(v, v)
            a, b = find(u), find(v)
            if a < b:
                parent[b] = a
            elif b < a:
                parent[a] = b
            if len(parent) > CONTRACT:
                yield flush()
                parent.clear()
    if parent:
        yield flush()


def rooted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """All edges (u, v), fewer than CONTRACT nodes -> (node, root) of every node."""
    for stars in contract(batches):
        roots = stars["v"].drop_duplicates()
        yield pd.DataFrame({"node": pd.concat([stars["u"], roots]), "root": pd.concat([stars["v"], roots])})


def is_forest(stars: DataFrame) -> bool:
    """Every node has one edge to a smaller node, or only edges to greater ones."""
    ends = stars.select(F.col("u").alias("x"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(stars.select(F.col("v").alias("x"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    sums = ends.groupBy("x").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return sums.filter("down > 1 OR down + up > 1").isEmpty()
