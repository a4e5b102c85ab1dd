"""Connected components of a graph given as a table of edges, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careerlake.llm.common import Saved


class Forest:
    """Disjoint sets of small local graphs, for reducing a task's edges to a spanning forest."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while (p := up.get(x, x)) != x:
            up[x] = x = up.get(p, p)
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b: long); root is the smallest node reachable.

    Each round links every node's larger neighbours to the smallest of its neighbourhood, then does the same on
    the smaller side; stars are what is left. The rounds grow with the logarithm of the largest component, each ends in a
    table in the shared folder, and minima are taken by partial aggregation, joined so that large stars can be split.
    Loops and repeated edges are harmless; an empty table gives an empty result.
    """
    hi_lo = edges.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    now = Saved(hi_lo, "edges")
    mark = _mark(now.df)
    while mark[0]:
        both = now.df.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(now.df.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # larger neighbours of u go to the smallest around u
        large = now.df.select(F.col("lo").alias("u"), F.col("hi").alias("v")).join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        large = Saved(large, "edges")
        low = large.df.groupBy("hi").agg(F.min("lo").alias("m"))
        # smaller neighbours of a node, and the node itself, go to the smallest of them
        small = large.df.join(low, "hi").select(F.explode(F.array(F.struct("hi", F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e")).select("e.*").filter("hi <> lo").distinct()
        following = Saved(small, "edges")
        now.drop()
        large.drop()
        now, before = following, mark
        mark = _mark(now.df)
        if mark == before:
            break
    stars = now.df
    return stars.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionAll(stars.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
