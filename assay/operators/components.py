"""Connected components by randomised contraction, as joins and aggregations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from assay.scratch import Scratch


def _ranked(node: Column, level: int) -> Column:
    return F.struct(F.xxhash64(node, F.lit(level)).alias("r"), node.alias("id"))


def connected_components(edges: DataFrame, scratch: Scratch, a: str = "a", b: str = "b") -> DataFrame:
    """Rows ``(id, component)`` for every node of an edge; component is the smallest id reachable.

    In each round every node takes as parent the neighbour (or itself) that ranks lowest in an order
    drawn anew for the round, and edges move to the parents. The expected number of nodes falls by a
    constant factor, so the rounds are logarithmic whatever the shape (a chain, a hub). All aggregates
    are minima, which combine before the shuffle; no list of neighbours is ever gathered.
    Null ends and loops are ignored. An empty edge table gives an empty result.
    """
    x, y = F.col(a), F.col(b)
    e = edges.where(x.isNotNull() & y.isNotNull() & (x != y)).select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()
    e = scratch.save(e, "edges")
    parents: list[DataFrame] = []
    while not e.isEmpty():
        level = len(parents)
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(e.select("b", "a"))
        low = both.groupBy("u").agg(F.min(_ranked(F.col("v"), level)).alias("m"))
        m = low.select(F.col("u").alias("id"), F.least(F.col("m"), _ranked(F.col("u"), level))["id"].alias("parent"))
        m = scratch.save(m, f"parents{level}")
        parents.append(m)
        pa = m.select(F.col("id").alias("a"), F.col("parent").alias("pa"))
        pb = m.select(F.col("id").alias("b"), F.col("parent").alias("pb"))
        moved = e.join(pa, "a").join(pb, "b").where("pa != pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct()
        old, e = e, scratch.save(moved, f"edges{level + 1}")
        scratch.drop(old)
    if not parents:
        return e.select(F.col("a").alias("id"), F.col("b").alias("component"))
    found = parents[-1].select("id", F.col("parent").alias("root"))
    for m in reversed(parents[:-1]):
        up = found.select(F.col("id").alias("parent"), "root")
        found = m.join(up, "parent", "left").select("id", F.coalesce("root", "parent").alias("root"))
    found = scratch.save(found, "roots")
    scratch.drop(*parents)
    least = found.groupBy("root").agg(F.min("id").alias("least"))
    return found.join(least, "root").select("id", F.least("id", "least").alias("component"))
