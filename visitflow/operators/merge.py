"""Keyed table merges as DataFrame -> DataFrame functions.

``merge(target, updates, keys, mode)`` returns the new content of ``target``.
All modes are set-based (one join or one aggregate), never per-row lookups
(for targets stored in buckets by key see ``merge_bucketed``):

* increment      insert new keys, add the value to existing ones (K9)
* replace        insert new keys, overwrite existing ones (K10, K11)
* replace_group  drop every target row whose group occurs in the updates,
                 then insert all updates (K12: delete-then-insert by group)

Updates are pre-aggregated per key first: for increment the values are
summed; for replace the largest value wins (the merged counts are cumulative).
The reference checks existence for a whole batch before writing, so two new
rows with one key would both be inserted; summing them is the fixed rule.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MODES = ("increment", "replace", "replace_group")


def preaggregate(updates: DataFrame, keys: Sequence[str], value: str, how: str = "sum") -> DataFrame:
    """One row per key (partial aggregation before the shuffle)."""
    fn = F.sum if how == "sum" else F.max
    return updates.groupBy(*keys).agg(fn(value).alias(value))


def merge_increment(target: DataFrame, updates: DataFrame, keys: Sequence[str],
                    value: str = "click_count") -> DataFrame:
    """K9: union and re-aggregate; map-side combine keeps hot keys cheap."""
    cols = [*keys, value]
    return (target.select(*cols).unionByName(updates.select(*cols))
            .groupBy(*keys).agg(F.sum(value).alias(value)))


def merge_replace(target: DataFrame, updates: DataFrame, keys: Sequence[str],
                  value: str = "click_count") -> DataFrame:
    """Keep target rows without an update, then all (deduplicated) updates."""
    upd = preaggregate(updates, keys, value, "max")
    kept = target.join(upd.select(*keys), list(keys), "left_anti")
    return kept.select(*keys, value).unionByName(upd.select(*keys, value))


def merge_replace_group(target: DataFrame, updates: DataFrame, group_keys: Sequence[str]) -> DataFrame:
    """Delete every target row of a group present in the updates, insert all updates."""
    groups = updates.select(*group_keys).distinct()          # A17
    kept = target.join(groups, list(group_keys), "left_anti")
    return kept.unionByName(updates.select(*target.columns))


def merge(target: DataFrame, updates: DataFrame, keys: Sequence[str], mode: str,
          value: str = "click_count") -> DataFrame:
    if mode == "increment":
        return merge_increment(target, updates, keys, value)
    if mode == "replace":
        return merge_replace(target, updates, keys, value)
    if mode == "replace_group":
        return merge_replace_group(target, updates, keys)
    raise ValueError(f"mode must be one of {MODES}, got {mode!r}")


def store_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int) -> None:
    """Writes ``df`` as a catalog table bucketed and sorted by ``keys``, one file a bucket.

    This is the one time the rows are shuffled: ``merge_bucketed`` keeps them where they are.
    """
    _save_bucketed(df.repartition(buckets, *keys), table, keys, buckets)


def _save_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int) -> None:
    df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).format("parquet").saveAsTable(table)


def join_merge(target: DataFrame, updates: DataFrame, keys: Sequence[str], mode: str, value: str = "click_count") -> DataFrame:
    """K9-K11 as one full outer join on the keys, which keeps the target's partitioning.

    Updates are pre-aggregated and shuffled to the target's buckets; of a
    bucketed target no row moves. Keys must not be null, as in the tables'
    own keys (null keys would stay apart).
    """
    if mode not in ("increment", "replace"):
        raise ValueError(f"mode must be increment or replace, got {mode!r}")
    new = preaggregate(updates, keys, value, "sum" if mode == "increment" else "max").withColumnRenamed(value, "new_value")
    both = target.select(*keys, value).join(new, list(keys), "full_outer")
    old, add = F.col(value), F.col("new_value")
    zero = F.lit(0).cast("bigint")
    merged = F.coalesce(old, zero) + F.coalesce(add, zero) if mode == "increment" else F.coalesce(add, old)
    return both.select(*keys, merged.alias(value))


def merge_bucketed(spark: SparkSession, table: str, updates: DataFrame, keys: Sequence[str], mode: str, buckets: int,
                   value: str = "click_count") -> DataFrame:
    """Merges ``updates`` into the bucketed catalog table ``table`` and returns it as it is now.

    The merged rows are written from their buckets into a table beside it,
    without an exchange, and then take its name. If the write fails the
    table stays as it was.
    """
    following, previous = f"{table}_next", f"{table}_previous"
    merged = join_merge(spark.table(table), updates, keys, mode, value)
    _save_bucketed(merged, following, keys, buckets)
    spark.sql(f"DROP TABLE IF EXISTS {previous}")
    spark.sql(f"ALTER TABLE {table} RENAME TO {previous}")
    spark.sql(f"ALTER TABLE {following} RENAME TO {table}")
    spark.sql(f"DROP TABLE IF EXISTS {previous}")
    return spark.table(table)


def append_new_users(blacklist: DataFrame, candidates: DataFrame, key: str = "user_id") -> DataFrame:
    """K8: the blacklist after adding candidates not yet in it (no duplicates)."""
    new = candidates.select(key).distinct().join(blacklist.select(key), key, "left_anti")
    return blacklist.select(key).unionByName(new)


def lookup_counts(keys_df: DataFrame, counts: DataFrame, keys: Sequence[str],
                  value: str = "click_count") -> DataFrame:
    """The stored value per requested key, 0 when the key is absent."""
    req = keys_df.select(*keys).distinct()
    return (req.join(counts.select(*keys, value), list(keys), "left")
            .select(*keys, F.coalesce(F.col(value), F.lit(0).cast("bigint")).alias(value)))


def mark_existing(updates: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Updates with a boolean ``exists`` (key already in target): the insert/update split."""
    present = target.select(*keys).distinct().withColumn("exists", F.lit(True))
    return (updates.join(present, list(keys), "left")
            .withColumn("exists", F.coalesce(F.col("exists"), F.lit(False))))
