"""One session / stratum holding a third of all rows (derived from the events table)."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from visitflow.operators import categories as CG
from visitflow.operators import sessions as S
from visitflow.operators.extract import random_extract, stratum_quotas
from visitflow.operators.pageflow import CHUNK_SECONDS, page_pair_counts
from visitflow.sources import adapters as A
from visitflow.sources.tables import Tables

from paths import SF_ORACLE

HOT = "0_2024-01-05"


@pytest.fixture(scope="module")
def hot_actions(spark):
    ev = Tables(spark, SF_ORACLE).events
    # every third event moves to user 0 on 2024-01-05, keeping its time of day
    hot = F.col("event_id") % 3 == 0
    moved = ev.select(
        "event_id", "event_type", "value", "props",
        F.when(hot, F.lit(0).cast("bigint")).otherwise(F.col("user_id")).alias("user_id"),
        F.when(hot, F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.lit(5), F.hour("ts"), F.minute("ts"),
                                         F.second("ts")))
         .otherwise(F.col("ts")).alias("ts"))
    return A.user_visit_action(moved)


def test_hot_session_holds_a_third(hot_actions):
    total = hot_actions.count()
    hot = hot_actions.where(F.col("session_id") == HOT).count()
    assert hot >= total / 3 - 1


def test_page_pairs_split_hot_session_and_stay_exact(spark, hot_actions):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    # at this size AQE would merge all range partitions into one; at scale they fill 64 MB each
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spread = (hot_actions.where(F.col("session_id") == HOT)
                  .select(F.floor(F.unix_timestamp("action_ts") / CHUNK_SECONDS)).distinct().count())
        got = {(r[0], r[1]): r[2] for r in page_pair_counts(hot_actions).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert spread > 20                                  # the hot session is not one task's work
    w = Window.partitionBy("session_id").orderBy("action_ts", "event_id")
    brute = (hot_actions.withColumn("nxt", F.lead("page_id").over(w)).where(F.col("nxt").isNotNull())
             .groupBy("page_id", "nxt").count().collect())
    assert got == {(r[0], r[1]): r[2] for r in brute}


def test_hot_session_aggregate(hot_actions):
    row = S.aggregate_sessions(hot_actions).where(F.col("session_id") == HOT).collect()[0]
    assert row["step_length"] == hot_actions.where(F.col("session_id") == HOT).count()


def test_extract_with_hot_stratum(spark, hot_actions):
    sessions = S.aggregate_sessions(hot_actions)
    got = {r["sessionid"] for r in random_extract(sessions, per_day=40, seed="s").collect()}
    k = sessions.select("session_id", F.date_format("start_ts", "yyyy-MM-dd").alias("date"),
                        F.date_format("start_ts", "HH").alias("hour"),
                        F.md5(F.concat(F.lit("s"), "session_id")).alias("h"))
    q = stratum_quotas(k.groupBy("date", "hour").agg(F.count(F.lit(1)).alias("n_hour")), 40)
    w = Window.partitionBy("date", "hour").orderBy("h", "session_id")
    want = {r["session_id"] for r in k.withColumn("rn", F.row_number().over(w)).join(q, ["date", "hour"])
            .where(F.col("rn") <= F.col("quota")).collect()}
    assert got == want


def test_top_sessions_with_hot_session(hot_actions):
    top = CG.top_categories(hot_actions)
    got = CG.top_sessions_per_category(hot_actions, top).collect()
    assert any(r["sessionid"] == HOT for r in got)      # the hot session ranks first where it clicked
    per_cat = {}
    for r in got:
        per_cat.setdefault(r["categoryid"], []).append(r["clickCount"])
    assert all(len(v) <= 10 for v in per_cat.values())


def test_a_session_of_one_minute_is_many_windows(spark):
    """A third of all rows in one session and one minute, a tenth in one second: pieces are bounded, pairs exact."""
    from visitflow.operators.pageflow import _in_pieces
    ev = Tables(spark, SF_ORACLE).events
    hot, sec = F.col("event_id") % 3 == 0, F.when(F.col("event_id") % 10 == 0, 17).otherwise(F.col("event_id") % 60).cast("int")
    moved = ev.select("event_id", "event_type", "value", "props",
                      F.when(hot, F.lit(0).cast("bigint")).otherwise(F.col("user_id")).alias("user_id"),
                      F.when(hot, F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.lit(5), F.lit(9), F.lit(30), sec)).otherwise(F.col("ts")).alias("ts"))
    acts = A.user_visit_action(moved)
    limit = 100
    pieces = (_in_pieces(acts, ("action_ts", "event_id"), ["session_id"], CHUNK_SECONDS, limit).where(F.col("session_id") == HOT)
              .groupBy("chunk", "part", "alone", "range").count().collect())
    assert sum(p["count"] for p in pieces) >= acts.count() / 3 - 1
    assert len(pieces) > 20 and max(p["count"] for p in pieces) <= 2 * limit + 10
    got = {(r[0], r[1]): r[2] for r in page_pair_counts(acts, limit=limit).collect()}
    w = Window.partitionBy("session_id").orderBy("action_ts", "event_id")
    brute = (acts.withColumn("nxt", F.lead("page_id").over(w)).where(F.col("nxt").isNotNull())
             .groupBy("page_id", "nxt").count().collect())
    assert got == {(r[0], r[1]): r[2] for r in brute}
