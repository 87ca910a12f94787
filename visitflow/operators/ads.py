"""Ad-click statistics over parsed log rows.

The same functions serve the batch job and every micro-batch of the stream.
Keys follow the reference's result tables: ``date`` is ``yyyy-MM-dd`` text,
``hour`` / ``minute`` two-digit text.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import empty_frame
from .merge import merge_increment, merge_replace_group

LOG_COLUMNS = ("ts", "date", "province", "city", "user_id", "ad_id")
USER_KEYS = ("date", "user_id", "ad_id")
STAT_KEYS = ("date", "province", "city", "ad_id")
PROVINCE_KEYS = ("date", "province")
AD_KEYS = (*PROVINCE_KEYS, "ad_id")
CELL_KEYS = ("date", "user_id", "province", "city", "ad_id")
TREND_KEYS = ("date", "hour", "minute", "ad_id")


def parse_log(lines: DataFrame, col: str = "value") -> DataFrame:
    """``epochMillis province city userId adId`` -> typed rows; malformed lines dropped.

    A line is kept only with exactly five single-space parts whose first,
    fourth and fifth parts are integers.
    """
    parts = F.split(F.col(col), " ")
    ms = F.try_element_at(parts, F.lit(1)).try_cast("bigint")
    user = F.try_element_at(parts, F.lit(4)).try_cast("bigint")
    ad = F.try_element_at(parts, F.lit(5)).try_cast("bigint")
    # outside years 0001-9999 the line is malformed (and timestamp_millis would raise under ANSI)
    ts = F.when(ms.between(-62135596800000, 253402300799999), F.timestamp_millis(ms))
    parsed = lines.select(
        (F.size(parts) == 5).alias("ok5"), ms.alias("ms"),
        ts.alias("ts"), F.date_format(ts, "yyyy-MM-dd").alias("date"),
        F.try_element_at(parts, F.lit(2)).alias("province"),
        F.try_element_at(parts, F.lit(3)).alias("city"),
        user.alias("user_id"), ad.alias("ad_id"))
    return (parsed.where(F.col("ok5") & F.col("ts").isNotNull() & F.col("user_id").isNotNull()
                         & F.col("ad_id").isNotNull())
            .select(*LOG_COLUMNS))


def click_cells(clicks: DataFrame) -> DataFrame:
    """Clicks per (date, user, province, city, ad): all a batch needs to know, combined before any shuffle."""
    return clicks.groupBy(*CELL_KEYS).agg(F.count(F.lit(1)).alias("click_count"))


def user_click_counts(clicks: DataFrame) -> DataFrame:
    """Clicks per (date, user, ad) — per batch these are the deltas for K9. Takes single clicks or cells."""
    return clicks.groupBy(*USER_KEYS).agg(_clicks(clicks))


def _clicks(rows: DataFrame):
    n = F.sum("click_count") if "click_count" in rows.columns else F.count(F.lit(1))
    return n.alias("click_count")


def blacklist_candidates(user_counts: DataFrame, threshold: int) -> DataFrame:
    """Users with any (date, ad) count at or above ``threshold``."""
    return user_counts.where(F.col("click_count") >= threshold).select("user_id").distinct()


FILTER_BITS = 1 << 23      # slots of the blacklist's bitmap: 256 rows of 4 KB, whatever the blacklist's size


def possible_members(clicks: DataFrame, users: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """``clicks`` with ``possible``: false only where the user is certainly not among ``users``.

    The users' hashes, modulo ``bits``, are set in a bitmap by Spark's bitmap
    aggregate. It has ``bits / 32768`` rows of 4 KB, a proven bound for the
    broadcast; many more users than bits only make more clicks possible.
    """
    slot = F.pmod(F.xxhash64("user_id"), F.lit(bits)) + 1
    bitmap = (users.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("bucket"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bitmap")))
    rows = clicks.withColumns({"bucket": F.bitmap_bucket_number(slot), "place": F.bitmap_bit_position(slot)})
    is_set = F.expr("getbit(CAST(conv(hex(substring(bitmap, CAST(place DIV 8 AS INT) + 1, 1)), 16, 10) AS INT), CAST(place % 8 AS INT)) = 1")
    return rows.join(F.broadcast(bitmap), "bucket", "left").select(
        *clicks.columns, (F.col("bitmap").isNotNull() & F.coalesce(is_set, F.lit(False))).alias("possible"))


def without_blacklisted(clicks: DataFrame, blacklist: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """Drop clicks of blacklisted users.

    A bitmap of the blacklist lets most clicks pass where they are; only those
    of possible members are shuffled to the exact anti join.
    """
    users = blacklist.select("user_id").distinct()
    marked = possible_members(clicks, users, bits)
    exact = marked.where("possible").drop("possible").join(users, "user_id", "left_anti").select(*clicks.columns)
    return marked.where("NOT possible").drop("possible").unionByName(exact)


def ad_stat(clicks: DataFrame) -> DataFrame:
    """Clicks per (date, province, city, ad). Takes single clicks or cells."""
    return clicks.groupBy(*STAT_KEYS).agg(_clicks(clicks))


def province_top3(stat: DataFrame, k: int = 3) -> DataFrame:
    """Per (date, province) the k ads with most clicks (ties: smaller ad id).

    The row_number filter becomes a partial WindowGroupLimit before the shuffle,
    so a hot province ships at most k rows per task.
    """
    return _first_k(_per_ad(stat), k)


def _per_ad(stat: DataFrame) -> DataFrame:
    return stat.groupBy(*AD_KEYS).agg(F.sum("click_count").alias("click_count"))


def _first_k(per_ad: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy(*PROVINCE_KEYS).orderBy(F.desc("click_count"), F.asc("ad_id"))
    return per_ad.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k).select(*AD_KEYS, "click_count")


def top3_updates(stat: DataFrame, top3: DataFrame, delta: DataFrame, k: int = 3) -> DataFrame:
    """C9 for a batch: the new top k of every (date, province) that ``delta`` touches.

    Counts only grow, so a group's new top k lies among its old top k and the
    ads of the batch: no ad outside both can pass the old ones. ``stat`` (before
    the batch) is summed for the batch's ads alone, no province is ranked whole.
    """
    batch = _per_ad(delta)
    before = _per_ad(stat.join(batch.select(*AD_KEYS), list(AD_KEYS), "left_semi"))
    totals = batch.unionByName(before).groupBy(*AD_KEYS).agg(F.sum("click_count").alias("click_count"))
    old = (top3.join(batch.select(*PROVINCE_KEYS).distinct(), list(PROVINCE_KEYS), "left_semi")
           .join(batch.select(*AD_KEYS), list(AD_KEYS), "left_anti").select(*AD_KEYS, "click_count"))
    return _first_k(totals.unionByName(old), k)


def new_blacklisted(counts: DataFrame, delta: DataFrame, threshold: int) -> DataFrame:
    """C7 for a batch: users whose count of some (date, ad) reaches ``threshold`` with it.

    Only keys of the batch can change; ``counts`` (before it) is summed for these alone.
    """
    before = counts.join(delta.select(*USER_KEYS), list(USER_KEYS), "left_semi")
    return blacklist_candidates(merge_increment(before, delta, USER_KEYS), threshold)


def click_trend(clicks: DataFrame) -> DataFrame:
    """Clicks per (date, hour, minute, ad)."""
    return (clicks.select(F.col("date"), F.date_format("ts", "HH").alias("hour"),
                          F.date_format("ts", "mm").alias("minute"), "ad_id")
            .groupBy(*TREND_KEYS).agg(F.count(F.lit(1)).alias("click_count")))


class AdState(NamedTuple):
    """The ad tables as DataFrames (the state the stream carries between batches).

    For a micro-batch, the date-keyed tables only need the dates the batch
    touches; the blacklist is read whole (it is one column of user ids).
    """

    counts: DataFrame      # ad_user_click_count: date, user_id, ad_id, click_count
    blacklist: DataFrame   # ad_blacklist: user_id
    stat: DataFrame        # ad_stat: date, province, city, ad_id, click_count
    top3: DataFrame        # ad_province_top3: date, province, ad_id, click_count


STATE_SCHEMAS = {
    "counts": "date string, user_id bigint, ad_id bigint, click_count bigint",
    "blacklist": "user_id bigint",
    "stat": "date string, province string, city string, ad_id bigint, click_count bigint",
    "top3": "date string, province string, ad_id bigint, click_count bigint",
}


def empty_state(spark) -> AdState:
    return AdState(**{k: empty_frame(spark, v) for k, v in STATE_SCHEMAS.items()})


def apply_batch(state: AdState, clicks: DataFrame, threshold: int) -> tuple[AdState, DataFrame]:
    """One micro-batch of parsed clicks applied to the state; returns (new state, new blacklist users).

    1. J3  drop clicks of users already blacklisted
    2. C6/K9  per (date, user, ad) deltas, increment-merged into the counts
    3. C7/K8  users whose merged count reaches ``threshold`` join the blacklist; their clicks passed
       step 1, so none of them is in it yet
    4. C8/K10 per (date, province, city, ad) counts; the stored counts are
       cumulative, so the merge adds the deltas (the same rows a replace with
       cumulative counts writes)
    5. C9/K12 the top 3 of every touched (date, province), from its old top 3 and the batch, replaces that group
    """
    clean = without_blacklisted(click_cells(clicks), state.blacklist)
    users, places = user_click_counts(clean), ad_stat(clean)
    new_users = new_blacklisted(state.counts, users, threshold)
    blacklist = state.blacklist.select("user_id").unionByName(new_users)
    top3 = merge_replace_group(state.top3, top3_updates(state.stat, state.top3, places), PROVINCE_KEYS)
    return AdState(merge_increment(state.counts, users, USER_KEYS), blacklist,
                   merge_increment(state.stat, places, STAT_KEYS), top3), new_users


def batch_stats(clicks: DataFrame, threshold: int, state: AdState | None = None) -> dict[str, DataFrame]:
    """The batch twin of the stream — ``clicks`` arriving as one micro-batch.

    ``ad_click_trend`` counts every click per minute (the stream computes it
    with a watermarked window over all clicks).
    """
    state = state or empty_state(clicks.sparkSession)
    new, _ = apply_batch(state, clicks, threshold)
    return {
        "ad_user_click_count": new.counts,
        "ad_blacklist": new.blacklist,
        "ad_stat": new.stat,
        "ad_province_top3": new.top3,
        "ad_click_trend": click_trend(clicks),
    }
