"""Connected components of a table of links, by alternating large and small stars.

Each task first replaces its links by a spanning forest.  Then, in every round, each node hands its
larger neighbours, and after that its smaller ones, to the smallest node it knows, until each
component is one star around its smallest node.  Only minima are gathered per node, so a node with
very many links is no burden on one task; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stage


def _forest(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A task's links as (node, smallest node joined to it here), within a block of links."""
    for part in parts:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while parent.get(top, top) != top:
                top = parent[top]
            while parent.get(x, x) != top:
                parent[x], x = top, parent[x]
            return top

        for a, b in zip(part["a"].tolist(), part["b"].tolist()):
            x, y = root(a), root(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
        pairs = [(x, root(x)) for x in list(parent)]
        yield pd.DataFrame([p for p in pairs if p[0] != p[1]], columns=["a", "b"], dtype="int64")


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One star step over links with a > b."""
    if large:
        near = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        out = near.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = links.groupBy("a").agg(F.min("b").alias("m"))
        others = links.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        out = others.unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b) that isn't its component's smallest node."""
    ordered = links.select(F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b"))
    now = stage(ordered.where("a != b").mapInPandas(_forest, "a long, b long").distinct(), "links")
    mark = None
    while True:
        after = stage(_star(_star(now, large=True), large=False), "links")
        seen = after.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("h")).first()
        discard(now)
        now = after
        if mark == seen or not seen.n:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = seen
