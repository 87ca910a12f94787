"""Exact duplicates by deterministic block naming: collision-free identities from sorted blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CHARS, Scratch

BLOCK_BYTES = 4096
HASH_BITS = 64             # of a block's routing hash; names never depend on it being free of collisions


def _blocks(norm: Column, size: int) -> Column:
    """UTF-8 blocks of ``size`` bytes, in order; an empty text is one empty block."""
    data = norm.cast("binary")
    last = F.greatest(F.floor((F.octet_length(norm) - 1) / size), F.lit(0)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(data, i * size + 1, F.lit(size)))


def _names(rows: DataFrame, keys: list[str], scratch: Scratch, name: str) -> DataFrame:
    """Distinct ``keys``, each with one integer: sorted in every partition and numbered there.

    Map tasks combine equal keys before the shuffle, so a block that a third
    of all documents share arrives once per task.
    """
    distinct = rows.groupBy(*keys).agg(F.count("*").alias("_n")).drop("_n")
    return distinct.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id())


def exact_groups(df: DataFrame, doc_id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES,
                 hash_bits: int = HASH_BITS, name: str = "exact") -> DataFrame:
    """One row per row of ``df``: (doc_id, keep_id, group_size, kept, text_sha256).

    Texts are equal when identical after deleting space and tab to carriage
    return. Each text is cut into fixed blocks. Distinct blocks are sorted into
    integer names; then adjacent names are paired and the distinct pairs
    sorted into names again, until a text has one name. Equal names mean equal
    texts: every name stands for one content, no hash decides. (Names are
    joined back by a block's 64-bit hash; where two contents share a hash,
    which one aggregate finds out, that join compares the contents as well.)
    Only the first naming moves text, once; later rounds move integers, and
    half as many each time.

    Of a group, the row with the longest original text (code points) stays,
    then the smallest doc_id (nulls last), then one of the rows that repeat it.
    A null text counts as empty, and empty texts are equal. An empty table
    gives no rows. Other columns of ``df`` are ignored.
    """
    scratch = Scratch(df.sparkSession, name)
    rows = df.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("norm", F.translate("text", SPACE_CHARS, ""))

    def routed(block: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64(block), 64 - hash_bits)

    blocks = rows.select(F.explode(_blocks(F.col("norm"), block_bytes)).alias("block"))
    blocks = blocks.select(routed(F.col("block")).alias("h"), "block")
    names = scratch.write(_names(blocks, ["h", "block"], scratch, "blocks").select("h", "name"), "blocks")
    clash = scratch.write(names.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "clash")

    texts = rows.select(F.monotonically_increasing_id().alias("rid"), "doc_id", F.length("text").alias("chars"),
                        F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
                        _blocks(F.col("norm"), block_bytes).alias("blocks"))
    hashes = F.transform("blocks", routed).alias("hs")
    if clash.isEmpty():
        base = scratch.write(texts.select("rid", "doc_id", "chars", "text_sha256", hashes), "base")
        found = base.select("rid", F.size("hs").alias("n"), F.posexplode("hs").alias("pos", "h"))
        found = found.join(names, "h").select("rid", "n", "pos", "name")
    else:
        base = scratch.write(texts.select("rid", "doc_id", "chars", "text_sha256", hashes, "blocks"), "base")
        found = base.select("rid", F.size("hs").alias("n"), F.posexplode("blocks").alias("pos", "block"))
        found = found.withColumn("h", routed(F.col("block")))
        named = _names(blocks.join(clash, "h", "left_semi"), ["h", "block"], scratch, "clashes")
        named = scratch.write(named.withColumn("name", -1 - F.col("name")), "clashes")
        found = (found.join(clash, "h", "left_anti").join(names, "h").select("rid", "n", "pos", "name")
                 .unionByName(found.join(named, ["h", "block"]).select("rid", "n", "pos", "name")))
    found = scratch.write(found, "named")

    level, done = 0, []
    while True:
        done.append(found.where("n = 1").select("rid", F.lit(level).alias("level"), "name"))
        longest = found.agg(F.max("n")).first()[0] or 1
        if longest == 1:
            break
        level += 1
        # blocks of one text, two by two; an odd last block pairs with -1
        pairs = (found.where("n > 1").groupBy("rid", "n", F.expr("pos div 2").cast("int").alias("pos"))
                 .agg(F.max(F.expr("IF(pos % 2 = 0, name, NULL)")).alias("a"),
                      F.max(F.expr("IF(pos % 2 = 1, name, NULL)")).alias("b"))
                 .withColumn("b_set", F.col("b").isNotNull()).withColumn("b", F.coalesce("b", F.lit(0))))
        pairs = scratch.write(pairs, f"pairs{level}")
        names = scratch.write(_names(pairs, ["a", "b", "b_set"], scratch, "names"), f"names{level}")
        found = scratch.write(pairs.join(names, ["a", "b", "b_set"]).select(
            "rid", F.expr("(n + 1) div 2").cast("int").alias("n"), "pos", "name"), f"level{level}")
    ids = done[0]
    for more in done[1:]:
        ids = ids.unionByName(more)

    rows = scratch.write(base.select("rid", "doc_id", "chars", "text_sha256").join(ids, "rid"), "ids")
    best = rows.groupBy("level", "name").agg(
        F.count("*").alias("group_size"),
        F.min(F.struct(-F.col("chars"), F.col("doc_id").isNull(), "doc_id", "rid")).alias("best"))
    best = best.select("level", "name", "group_size", F.col("best.doc_id").alias("keep_id"),
                       F.col("best.rid").alias("keep_rid"))
    best = scratch.write(best, "best")           # stored, so AQE can split a hot group in the join
    return rows.join(best, ["level", "name"]).select(
        "doc_id", "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"), "text_sha256")
