"""Histogram sort: shards of near equal bytes, cut at exact key boundaries, one exchange."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

FIRST_BINS = 4096          # probes of the first round, at least
BINS = 256                 # probes of an interval that holds a shard boundary, while these are few
PROBES = 1 << 16           # of all such intervals together in a round, from which each gets fewer (at least 16)
TOLERANCE = 0.001          # of a shard's bytes


@dataclass
class Bin:
    """Keys from ``lo`` to ``hi``, both present (k2 counts only where all have one k1), with exact rows and bytes."""

    lo: tuple[int, int]
    hi: tuple[int, int]
    rows: int
    size: int
    parts: int = 0

    @property
    def one_group(self) -> bool:
        return self.lo[0] == self.hi[0]

    @property
    def point(self) -> tuple[int, int]:
        """Smallest key from which on rows belong here: the earlier bins' keys are below it."""
        return self.lo if self.one_group else (self.lo[0], 0)

    @property
    def step(self) -> int:
        """Width of a part of the probed key: k2 within one group, else k1."""
        first, last = (self.lo[1], self.hi[1]) if self.one_group else (self.lo[0], self.hi[0])
        return -((first - last - 1) // self.parts)


def _array(values: list[int]) -> Column:
    """An array constant in one expression, however long."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _locate(points: list[tuple[int, int]]) -> Column:
    """Number of ``points`` (sorted) at or below a row's key: a binary search, so the plan does not grow with them."""
    if not points:
        return F.lit(0)
    one, two = _array([p[0] for p in points]), _array([p[1] for p in points])
    steps = [1 << i for i in range(len(points).bit_length() - 1, -1, -1)]

    def take(at: Column, step: Column) -> Column:
        i = (at + step - 1).cast("int")                    # beyond the last point get() is null: not taken
        k1, k2 = F.get(one, i), F.get(two, i)
        return F.when((k1 < F.col("k1")) | ((k1 == F.col("k1")) & (k2 <= F.col("k2"))), at + step).otherwise(at)
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), take)


def _counted(keyed: DataFrame, bins: list[Bin]) -> list[Bin]:
    """Non-empty parts of ``bins`` (sorted, disjoint), with exact rows and bytes: one aggregate over all rows."""
    at = F.col("bin")
    rows = keyed.withColumn("bin", _locate([b.point for b in bins]) - 1)

    def of(values: list[int]) -> Column:
        return F.get(_array(values), at)
    last1, last2 = of([b.hi[0] for b in bins]), of([b.hi[1] for b in bins])
    by_k2 = of([int(b.one_group) for b in bins]) == 1
    inside = (F.col("k1") < last1) | ((F.col("k1") == last1) & (~by_k2 | (F.col("k2") <= last2)))
    probe = F.when(by_k2, F.col("k2")).otherwise(F.col("k1"))
    first = of([b.lo[1] if b.one_group else b.lo[0] for b in bins])
    rows = rows.where((at >= 0) & inside).select(
        "bin", "k1", "k2", "size", (probe - first).alias("past"), of([b.step for b in bins]).alias("step"))
    found = (rows.groupBy("bin", F.expr("past div step").alias("part"))
             .agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"), F.min("k1").alias("a"), F.max("k1").alias("c"),
                  F.min("k2").alias("b"), F.max("k2").alias("d")).collect())
    return [Bin((r["a"], r["b"]), (r["c"], r["d"]), r["rows"], r["bytes"]) for r in found]


def histogram_shards(df: DataFrame, group: list[str], tie: list[str], size: str, shards: int = 16,
                     ranges: int | None = None, tolerance: float = TOLERANCE,
                     name: str = "shards") -> DataFrame:
    """Deals all rows into ``shards`` of near equal total ``size``; adds shard int and slot long.

    The sort key is (hash of ``group``, hash of ``tie``): rows of one group
    lie side by side, and a group larger than a shard can still be cut.
    Histogram sort: one aggregate counts the exact rows and bytes between
    candidate key boundaries, and the first and last key there; intervals that
    hold a shard boundary not yet met within ``tolerance`` of a shard's size, or
    more than one task's share of rows and bytes, get new probes; when all
    splitters fit, every row is exchanged once, straight to its key range
    (``ranges`` tasks, by default spark.sql.shuffle.partitions), and sorted
    there. A row's slot is its range's exact count of rows before it in the
    shard plus its place in the range, so slots are gapless without another
    pass. The driver sees only the counts of probes: in a round some ten for
    each range, and 65,536 or 16 for each shard. Boundaries are array constants
    met by binary search, so plans stay small with thousands of ranges or shards.

    Nulls are keys like any other; a null ``size`` counts as zero. Rows equal
    in group and tie cannot be cut apart: they share a shard. With fewer rows
    than shards, some shards are empty; an empty table gives no rows. The
    columns k1, k2, size, bin and part are set aside under a struct, so
    columns of these names in ``df`` come back unchanged; existing shard and
    slot columns are replaced.
    """
    scratch = Scratch(df.sparkSession, name)
    m = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    keyed = df.select(
        F.shiftrightunsigned(F.xxhash64(*group), 1).alias("k1"),
        F.shiftrightunsigned(F.xxhash64(F.lit("tie"), *tie), 1).alias("k2"),
        F.coalesce(F.col(size).cast("long"), F.lit(0)).cast("long").alias("size"),
        F.struct(*columns).alias("row"))
    keyed = scratch.write(keyed, "keyed")
    total = keyed.agg(F.count("*").alias("rows"), F.coalesce(F.sum("size"), F.lit(0)).alias("size")).first()
    n, whole = total["rows"], total["size"]
    leaves = [Bin((0, 0), ((1 << 63) - 1, (1 << 63) - 1), n, whole)] if n else []

    def share(b: Bin) -> float:
        return b.rows / max(n, 1) + b.size / max(whole, 1)

    targets = [whole * i / shards for i in range(1, shards)]
    least = FIRST_BINS
    while leaves:
        below, cut, large = 0, [], []
        for b in leaves:
            i = bisect_right(targets, below)
            j = bisect_left(targets, below + b.size)
            if b.lo != b.hi and b.rows > 1:
                if any(min(t - below, below + b.size - t) > tolerance * whole / shards for t in targets[i:j]):
                    cut.append(b)
                elif share(b) > 1 / m:
                    large.append(b)
            below += b.size
        if not cut and not large:
            break
        for b in cut + large:
            b.parts = max(least, 2 + int(4 * m * share(b)))
        for b in cut:
            b.parts = max(b.parts, min(BINS, max(16, PROBES // len(cut))))
        least = 0
        chosen = set(map(id, cut + large))
        made = _counted(keyed, sorted(cut + large, key=lambda b: b.lo))
        leaves = sorted([b for b in leaves if id(b) not in chosen] + made, key=lambda b: b.lo)

    # shard boundaries: for each target the nearest leaf edge; ranges: leaves joined up to a task's share
    edges, below = [], 0
    for b in leaves:
        edges.append(below)
        below += b.size
    edges.append(whole)
    starts = []
    for t in targets:
        i = min(bisect_right(edges, t), len(edges) - 1)
        starts.append(min((i, max(i - 1, 0)), key=lambda j: abs(edges[j] - t)))
    points, shard_of, offset = [], [], []
    held, in_shard, shard = 0.0, 0, -1
    for i, b in enumerate(leaves):
        now = bisect_right(starts, i)
        if now != shard or held + share(b) > 2 / m:
            points.append(b.point)
            if now != shard:
                shard, in_shard = now, 0
            shard_of.append(shard)
            offset.append(in_shard)
            held = 0.0
        held += share(b)
        in_shard += b.rows

    if not points:
        return keyed.select("row.*", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    keyed = keyed.withColumn("range", _locate(points[1:]).cast("int"))
    order = ["k1", "k2", *(F.col("row")[c] for c in [*group, *tie, size] if c in columns)]
    dealt = keyed.repartitionById(len(points), F.col("range")).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1).cast("long"))

    def lookup(values: list[int], kind: str) -> Column:
        return F.get(_array(values), F.col("range")).cast(kind)

    return dealt.withColumn("place", place).select(
        "row.*", lookup(shard_of, "int").alias("shard"), (lookup(offset, "bigint") + F.col("place")).alias("slot"))
