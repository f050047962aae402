"""Connected components of links that no driver ever sees."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import discard, materialise


def link_edges(links: DataFrame) -> DataFrame:
    """(a, b) links as a written table of edges (u, v) with u > v."""
    return materialise(links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc-edges")


def _each(table: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """(u, v) for each pair of columns of each row, in one pass."""
    made: list[Column] = [F.struct(F.col(a).alias("u"), F.col(b).alias("v")) for a, b in pairs]
    return table.select(F.explode(F.array(*made)).alias("e")).select("e.u", "e.v")


def contract(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step: as connected as before, and closer to stars of smallest nodes."""
    # large star: neighbours that are larger than a node go to its smallest neighbour
    near = _each(edges, ("u", "v"), ("v", "u"))
    least = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    large = near.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    # small star: neighbours that are smaller, and the node itself, go to its smallest neighbour
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    small = _each(large.join(least, "u"), ("v", "m"), ("u", "m")).where(F.col("u") != F.col("v"))
    return materialise(small.distinct(), "cc-edges")


def settled(edges: DataFrame) -> bool:
    """Do all edges lead to roots, one from each node?"""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("x"), F.lit(1).alias("out")), F.struct(F.col("v").alias("x"), F.lit(0).alias("out")))).alias("e")).select("e.x", "e.out")
    nodes = ends.groupBy("x").agg(F.sum("out").alias("out"), F.min("out").alias("root"))
    return not nodes.where("out > 1 or (out = 1 and root = 0)").agg(F.count("*")).first()[0]


def forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the (a, b) links, taken in order, join two parts that those before leave apart."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.get(x, x)) != x:
            root[x] = root.get(up, up)
            x = up
        return x

    out = np.zeros(len(a), bool)
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        x, y = find(x), find(y)
        if x != y:
            root[x] = y
            out[k] = True
    return out


def nearest(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that an edge leads to; the whole component's once all is settled."""
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(a, b) links to (node, component) but for roots, the component named by its smallest node.

    Alternating large-star and small-star steps: every node points to the smallest node it
    knows, and paths halve in each round, so a component of n nodes needs some log n rounds.
    Each round is a written table; a count of nodes that do not lead to a root tells the end.
    """
    edges = link_edges(links)
    for _ in range(most_rounds):
        if settled(edges):
            return nearest(edges)
        before, edges = edges, contract(edges)
        discard(before)
    raise RuntimeError(f"components are not settled after {most_rounds} rounds")
