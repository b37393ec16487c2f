"""Connected components of links given as rows, by star contraction: every round is joins and groupings of the links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from residua.functions.lookup import BROADCAST_ROWS, lookup_join
from residua.functions.materialize import materialize


def components(links: DataFrame) -> DataFrame:
    """Links (a, b), longs, in; one row (node, component) per linked node out: the smallest node it can reach.

    Every node that is linked to larger ones hands them its smallest neighbour, until all links point at the smallest node of
    their component. Each round's links are a written table. Self links and nulls are ignored.
    """
    now = materialize(_downward(links.where("a is not null and b is not null")), "links")
    state = _state(now)
    while True:
        most = 2 * state[0]  # nodes, at most
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # larger neighbours get the smallest one; then smaller neighbours, and the node itself, do
        large = materialize(_star(both, F.col("b") > F.col("a"), most), "star")
        small = _star(large, F.lit(True), most).unionByName(large.groupBy("a").agg(F.min("b").alias("b")))
        now = materialize(_downward(small), "links")
        before, state = state, _state(now)
        if state == before:
            # a fixed point has one link per node, to its smallest
            least = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
            roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            return least.unionByName(roots)


def _downward(links: DataFrame) -> DataFrame:
    return links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _star(rows: DataFrame, which: Column, most: int) -> DataFrame:
    """(neighbour, smallest of the node and its neighbours) for the neighbours that ``which`` names; ``most`` nodes."""
    least = rows.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
    if most > BROADCAST_ROWS:
        least = materialize(least, "least")
    met = lookup_join(rows, least, ["a"], most)
    return _downward(met.where(which).select(F.col("b").alias("a"), F.col("least").alias("b")))


def _state(links: DataFrame) -> tuple[int, object]:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
