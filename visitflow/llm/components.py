"""Connected components over stored links: distributed union-find."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

FOREST_ROWS = 500_000      # links held by one task at a time


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links of one partition -> (node, smallest node of its local tree), in bounded chunks."""
    def flush(us: list, vs: list) -> pd.DataFrame:
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            root = x
            while (p := parent.get(root, root)) != root:
                root = p
            while (p := parent.get(x, x)) != root:
                parent[x] = root
                x = p
            return root
        for u, v in zip(us, vs):
            a, b = find(u), find(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
        nodes = [n for n in parent if find(n) != n]
        return pd.DataFrame({"u": np.array(nodes, dtype=np.int64),
                             "v": np.array([find(n) for n in nodes], dtype=np.int64)})
    us: list = []
    vs: list = []
    for b in batches:
        us += b["u"].tolist()
        vs += b["v"].tolist()
        if len(us) >= FOREST_ROWS:
            yield flush(us, vs)
            us, vs = [], []
    if us:
        yield flush(us, vs)


def components(links: DataFrame, scratch: Scratch, max_rounds: int = 60,
               made_by: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]] | None = None) -> DataFrame:
    """Undirected links (u long, v long) -> (node long, component long: its smallest node).

    Each task first joins its own links by union-find. The forests that remain
    are contracted by alternating large-star and small-star rounds (Kiveris et
    al., 2014): every node's neighbourhood is reduced to its minimum by a
    partial aggregate, so a hub's links are never gathered in one task. The
    minima are stored before the join back, so both its sides are plain
    shuffles, and Spark splits a hub's links by itself. Each round is a
    stored table; the rounds end when one changes nothing.
    Nodes without links are not returned. Null ends and self-links are ignored.

    With ``made_by``, the links are what this function makes of the rows of
    ``links``, without null ends. A task then finds and joins its links in one
    Python worker; two functions in a row would hold two workers for each task,
    and the executor keeps them, grown, for all that follows.
    """
    if made_by is None:
        edges = (links.where("u IS NOT NULL AND v IS NOT NULL AND u != v").select("u", "v")
                 .mapInPandas(_forest, "u long, v long"))
    else:
        edges = links.mapInPandas(lambda rows: _forest(made_by(rows)), "u long, v long")
    edges = scratch.write(edges, "forest")
    before = None
    for _ in range(max_rounds):
        # large star: link every larger neighbour to the smallest of the neighbourhood
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = scratch.write(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "low")
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u != v").distinct())
        large = scratch.write(large, "large")
        # small star: each node's smaller neighbours and itself join the smallest of them
        low = scratch.write(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = (large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        new = scratch.write(small, "star")
        scratch.drop(edges)
        edges = new
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = state
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
