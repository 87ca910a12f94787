"""Reproducible stratified session extract.

Strata are (date, hour) of the session start. Each date yields about
``per_day`` sessions, split over its hours by their share of the date's
sessions: ``quota = min(n_hour, max(1, floor(per_day * n_hour / n_date)))``.
Inside a stratum the sessions with the smallest ``md5(seed || session_id)``
are taken (ties by session id), so the same seed gives the same sample on any
engine or partitioning.

Scale: no quota exceeds ``max(1, per_day)``, so the smallest that many of each
stratum are enough. They are a bottom-k: every task keeps its own (a partial
WindowGroupLimit) and ships at most k rows per stratum, however hot the hour.
The stratum sizes are an aggregate beside it; both read the exchange of the
sessions' own aggregate. Keyword and category sets are collected for the
sampled sessions alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .sessions import session_sets

# Result columns of session_random_extract (after taskid).
EXTRACT_COLUMNS = ("sessionid", "startTime", "searchKeywords", "clickCategoryIds")


def stratum_quotas(strata_counts: DataFrame, per_day: int, by: Sequence[str] = ()) -> DataFrame:
    """(by, date, hour, n_hour) -> quota per stratum; 24 rows a date."""
    n_date = F.sum("n_hour").over(Window.partitionBy(*by, "date"))
    quota = F.least(F.col("n_hour"),
                    F.greatest(F.lit(1).cast("bigint"),
                               F.floor(F.lit(float(per_day)) * F.col("n_hour") / n_date).cast("bigint")))
    return strata_counts.select(*by, "date", "hour", "n_hour", quota.alias("quota"))


def sample_sessions(sessions: DataFrame, per_day: int = 100, seed: str = "0", by: Sequence[str] = (),
                    carry: Sequence[str] = ()) -> DataFrame:
    """The sampled sessions: (by, session_id, start_time, carry)."""
    keyed = sessions.select(*by, "session_id", "start_time", *carry, F.substring("start_time", 1, 10).alias("date"),
                            F.substring("start_time", 12, 2).alias("hour"))
    strata = [*by, "date", "hour"]
    quotas = stratum_quotas(keyed.groupBy(*strata).agg(F.count("session_id").alias("n_hour")), per_day, by)
    hashed = keyed.withColumn("h", F.md5(F.concat(F.lit(seed), F.col("session_id"))))
    w = Window.partitionBy(*strata).orderBy("h", "session_id")
    first = hashed.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= max(1, int(per_day)))
    return (first.join(quotas, strata).where(F.col("rn") <= F.col("quota"))
            .select(*by, "session_id", "start_time", *carry))


def random_extract(sessions: DataFrame, per_day: int = 100, seed: str = "0", actions: DataFrame | None = None,
                   compat_null_zero: bool = False, by: Sequence[str] = ()) -> DataFrame:
    """The sampled sessions (by, sessionid, startTime, searchKeywords, clickCategoryIds).

    Sets that ``sessions`` hold already are carried along; else they are
    collected from ``actions``, for the sampled sessions alone.
    """
    sets = ("search_keywords", "click_category_ids")
    if actions is None:
        sample = sample_sessions(sessions, per_day, seed, by, sets)
    elif by:
        raise ValueError("with several groups the sessions have to hold their sets")
    else:
        sample = session_sets(sample_sessions(sessions, per_day, seed), actions, compat_null_zero)
    cols = [F.col("session_id").alias("sessionid"), F.col("start_time").alias("startTime"),
            F.array_join("search_keywords", ",").alias("searchKeywords"),
            F.array_join(F.transform("click_category_ids", lambda x: x.cast("string")), ",")
             .alias("clickCategoryIds")]
    return sample.select(*by, *cols)
