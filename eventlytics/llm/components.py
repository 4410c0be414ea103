"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlytics.llm.frames import written


def _state(edges: DataFrame) -> tuple:
    """What tells two sets of edges apart: their number and a sum of hashes."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).head())


def components(edges: DataFrame, name: str = "components", most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: comparable, not null);
    root is the smallest node of its component.

    Alternating large and small stars: each round links a node's larger
    neighbours to its smallest one, then its smaller neighbours to it, until
    every edge points to a root. The number of rounds grows with the
    logarithm of the longest path; each writes at most as many edges as there
    were before. The smallest neighbour comes from an aggregation (partial
    before the shuffle, and written, so that the join reads two shuffles and its
    hot keys can be split).
    """
    e = edges.where("a != b").select(F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u")).distinct()
    e = written(e, name)  # u > v
    state = _state(e)
    for _ in range(most_rounds):
        # large star: for each node, its larger neighbours go to the least of it and its neighbours
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), name)
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u != v").distinct())
        large = written(large, name)
        # small star: for each node, its smaller neighbours (and itself) go to the least of them
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), name)
        pair = lambda u: F.struct(F.col(u).alias("u"), F.col("m").alias("v"))
        small = large.join(least, "u").select(F.inline(F.array(pair("v"), pair("u")))).where("u != v").distinct()
        small = written(small, name)
        e, before, state = small, state, _state(small)
        if state == before:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
