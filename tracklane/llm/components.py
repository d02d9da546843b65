"""Connected components of an edge table by alternating large-star and small-star steps, as joins and minimums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklane.llm import common

MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in `edges` (a, b: long, any direction, repeats allowed), root the component's least node.

    Each round hangs a node's larger neighbours under its least one, then its smaller ones; the edges stay at most as
    many as before and the trees' depth falls by a constant factor. A node of very many edges is a skewed join key,
    which adaptive execution splits; no neighbour list is ever gathered. Each round is written to the shared folder.
    """
    now = common.cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    print_of = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
    seen = print_of(now)
    for _ in range(MAX_ROUNDS):
        if not seen[0]:
            break
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        then = common.cut(hung.union(least.select("a", F.col("m").alias("b"))).distinct())
        common.discard(now)
        now, before, seen = then, seen, print_of(then)
        if seen == before:
            break
    else:
        raise RuntimeError(f"no fixed point in {MAX_ROUNDS} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
