"""Connected components of an edge list, by large-star and small-star rounds.

Each partition first shrinks its own edges to a forest, which has fewer edges than
nodes.  At most ``LOCAL`` edges (counted) go on to one task, whose forest is the
answer.  While there are more, a round replaces neighbours by the least one, with
joins and minima only, and partitions of ``LOCAL`` edges shrink theirs again; no
larger component is ever gathered in one task.  A hub of very many edges is one key of a join whose other
side has one row for it, which adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import cut


#: Edges that one task may hold.
LOCAL = 500_000


def _forest(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edges of a partition as (node, least node of its tree)."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = up
        return x

    for part in parts:
        for a, b in zip(part["a"].tolist(), part["b"].tolist(), strict=True):
            p, q = root(a), root(b)
            if p != q:
                parent[max(p, q)] = min(p, q)
    found = [(x, root(x)) for x in list(parent)]
    found = [(x, r) for x, r in found if x != r]
    for k in range(0, len(found), 50_000):
        yield pd.DataFrame(np.array(found[k : k + 50_000], np.int64), columns=["a", "b"])


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges: (a, b) with a > b."""
    near = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        near = near.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    # Cut off from the join, so that both its sides are shuffled and a hub's rows can be split.
    least = cut(near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    joined = near.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.explode(F.array("u", "v")).alias("a"), F.col("m").alias("b"))
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (long a, b): root is the least
    node of its component.  Loops and repeated edges change nothing."""
    ordered = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    forest = lambda df: cut(df.mapInPandas(_forest, "a long, b long"))
    now = forest(ordered)
    state = None
    while True:
        row = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if row[0] <= LOCAL:
            now = forest(now.coalesce(1))
            break
        if tuple(row) == state:
            break
        state = tuple(row)
        now = forest(_star(_star(now, True), False).coalesce(-(-row[0] // LOCAL)))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b")).distinct()
