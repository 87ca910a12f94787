"""SimHash near-duplicate groups, searched with BK-trees over fingerprint shards."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, first_copy, fresh, row_key, small_batches, text_hash, with_row_key
from .components import components

SHINGLE_WORDS = 4          # words of a shingle
MAX_BITS = 4               # fingerprints link at this many differing bits or fewer
BLOCKS = 6                 # a fingerprint is cut into this many bit blocks
TREE_ROWS = 2048           # nodes of one shard tree; larger shards get several trees
BITS_CHUNK = 65536         # shingle hashes unpacked to bits at a time
LINKS_CHUNK = 65536        # links a search holds before it hands them on


def fingerprint(data: bytes, width: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of UTF-8 text: XXH64 (seed 42) of its word shingles, bit set in over half of them."""
    words = data.lower().split()           # bytes: only A-Z change case, only ASCII white space splits
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        return digest(b" ".join(words), 42)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(words) - width + 1
    h = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts[:n].tolist(), ends[width - 1:].tolist())),
                    np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, BITS_CHUNK):
        bits = np.unpackbits(h[i:i + BITS_CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def with_fingerprint(df: DataFrame, text: str = "text", name: str = "fp", width: int = SHINGLE_WORDS) -> DataFrame:
    """Adds the fingerprint of ``text`` as a signed 64-bit long (null and blank texts: 0)."""
    small_batches(df.sparkSession)

    @F.pandas_udf("long")
    def fp(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series([fingerprint(b, width) if b is not None else 0 for b in s],
                            dtype="uint64").astype("int64", copy=False) if len(s) else pd.Series([], dtype="int64")
    return df.withColumn(name, fp(F.col(text).cast("binary")))


class BKTree:
    """Fingerprints under integer Hamming edges: a child at key d differs from its parent in d bits."""

    def __init__(self, root: int):
        self.nodes = [root]
        self.children: list[dict[int, int]] = [{}]

    def add(self, fp: int) -> None:
        at = 0
        while True:
            d = (self.nodes[at] ^ fp).bit_count()
            nxt = self.children[at].get(d)
            if nxt is None:
                self.children[at][d] = len(self.nodes)
                self.nodes.append(fp)
                self.children.append({})
                return
            at = nxt

    def within(self, fp: int, radius: int) -> list[int]:
        """Nodes in the radius: only edges from d - radius to d + radius can lead to one."""
        found, stack = [], [0]
        while stack:
            at = stack.pop()
            d = (self.nodes[at] ^ fp).bit_count()
            if d <= radius:
                found.append(self.nodes[at])
            kids = self.children[at]
            if kids:
                for key in range(max(0, d - radius), d + radius + 1):
                    kid = kids.get(key)
                    if kid is not None:
                        stack.append(kid)
        return found


def _search(radius: int):
    """Sorted rows (shard, part, role, fp) of whole trees -> links (u, v) within the radius.

    Role 0 rows build the tree of (shard, part), role 1 rows query it. Trees
    of one tree row and one query are answered without building.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree, members, at = None, 0, None
        us: list[int] = []
        vs: list[int] = []
        for b in batches:
            for key, role, fp in zip(zip(b["shard"].tolist(), b["part"].tolist()), b["role"].tolist(), b["fp"].tolist()):
                value = fp & 0xFFFFFFFFFFFFFFFF
                if key != at:
                    tree, members, at = None, 0, key
                if role == 0:
                    members += 1
                    if tree is None:
                        tree = BKTree(value)
                    else:
                        tree.add(value)
                elif tree is not None and members:
                    for other in tree.within(value, radius):
                        if other > value:              # each link once; itself never
                            us.append(fp)
                            vs.append(other - (1 << 64) if other >> 63 else other)
                    if len(us) >= LINKS_CHUNK:
                        yield pd.DataFrame({"u": np.array(us, dtype=np.int64), "v": np.array(vs, dtype=np.int64)})
                        us, vs = [], []
            yield pd.DataFrame({"u": np.array(us, dtype=np.int64), "v": np.array(vs, dtype=np.int64)})
            us, vs = [], []
    return run


def fingerprint_links(fps: DataFrame, scratch: Scratch, radius: int = MAX_BITS, blocks: int = BLOCKS,
                      tree_rows: int = TREE_ROWS) -> DataFrame:
    """Distinct fingerprints (fp long) -> all links (u, v) of different ones within ``radius`` bits.

    Sharding is exact: with the 64 bits cut into ``blocks`` blocks, two
    fingerprints within the radius agree on at least ``blocks - radius`` of
    them, so they share the shard of that choice of blocks and its bits. Each
    shard holds BK-trees of at most ``tree_rows`` nodes on average; a shard
    with more gets several, each searched by all the shard's fingerprints in
    turn, so no task holds a whole shard. The trees stay in the tasks of their shard:
    their number grows with the corpus, so they are dealt out, not broadcast.
    """
    return _dealt(fps, scratch, radius, blocks, tree_rows).mapInPandas(_search(radius), "u long, v long")


def _dealt(fps: DataFrame, scratch: Scratch, radius: int, blocks: int, tree_rows: int = TREE_ROWS) -> DataFrame:
    """The rows that ``_search`` takes, whole trees to a task: see ``fingerprint_links``."""
    agree = blocks - radius
    if agree < 1:
        raise ValueError("blocks must exceed the radius")
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    shards = []
    for i, chosen in enumerate(combinations(range(blocks), agree)):
        mask = sum(((1 << cuts[b + 1]) - 1) ^ ((1 << cuts[b]) - 1) for b in chosen)
        mask -= (1 << 64) if mask >> 63 else 0
        shards.append(F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(mask).cast("long"))))
    rows = fps.select("fp", F.explode(F.array(*shards)).alias("shard"))
    sizes = scratch.write(rows.groupBy("shard").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
    sized = scratch.write(rows.join(sizes, "shard").select("shard", "fp", F.ceil(F.col("n") / tree_rows).alias("parts")),
                          "shards")
    part = F.pmod(F.xxhash64("fp", F.lit("part")), F.col("parts"))
    trees = sized.select("shard", part.alias("part"), F.lit(0).alias("role"), "fp")
    queries = sized.select("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
                           F.lit(1).alias("role"), "fp")
    return (trees.unionByName(queries).repartition("shard", "part")
            .sortWithinPartitions("shard", "part", "role", "fp"))


def simhash_groups(df: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = SHINGLE_WORDS,
                   radius: int = MAX_BITS, blocks: int = BLOCKS, name: str = "simhash") -> DataFrame:
    """One row per row of ``df``: (doc_id, text_key, fp, component, component_id).

    ``component_id`` is the smallest id reachable over links of fingerprints
    that differ in ``radius`` bits or fewer; ``text_key`` (a content hash)
    tells rows with one id and different texts apart, ``component`` is the
    group's smallest fingerprint. Documents of one fingerprint are one node, so copies cost nothing past the fingerprint.

    Null and blank texts have fingerprint 0 and link like any other. Rows
    with a null id take part; a component of null ids only has a null
    component_id. Repeated rows stay repeated. An empty table gives no rows.
    Other columns of ``df`` are ignored.
    """
    scratch = Scratch(df.sparkSession, name)
    base = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    marked = with_fingerprint(base.select("doc_id", text_hash("text").alias("text_key"), "text"), "text", "fp", width)
    marked = scratch.write(marked.drop("text"), "fingerprints")
    nodes = scratch.write(marked.groupBy("fp").agg(F.min("doc_id").alias("low")), "nodes")
    # found and joined in one Python worker a task: the links of a shard never leave it
    found = components(_dealt(nodes.select("fp"), scratch, radius, blocks), scratch, made_by=_search(radius))
    found = nodes.join(found, nodes["fp"] == found["node"], "left").select(
        "fp", "low", F.coalesce("component", "fp").alias("component"))
    found = scratch.write(found, "found")
    lows = scratch.write(found.groupBy("component").agg(F.min("low").alias("component_id")), "lows")
    # a component may hold a third of all fingerprints, a fingerprint a third of all documents: both sides of
    # these joins are stored, so AQE can split the hot one
    by_fp = scratch.write(found.join(lows, "component").select("fp", "component", "component_id"), "by_fp")
    return marked.join(by_fp, "fp").select("doc_id", "text_key", "fp", "component", "component_id")


def drop_near_copies(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of each SimHash group of ``df``, columns unchanged: smallest id (nulls last), then text key."""
    groups = simhash_groups(df, doc_id, text, **options)
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("best")
    stay = groups.groupBy("component").agg(best).select("best.doc_id", "best.text_key")
    rows, keys = with_row_key(df, doc_id, text)
    copy, = fresh(rows, "copy")
    rows = rows.join(row_key(stay, keys), keys, "left_semi").withColumn(copy, first_copy(keys))
    return rows.where(F.col(copy) == 1).select(*[F.col(f"`{c}`") for c in df.columns])
