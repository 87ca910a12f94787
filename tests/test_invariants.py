"""Invariants over the test tables."""

from pyspark.sql import functions as F

from visitflow.operators import detail as D
from visitflow.operators import stats as ST
from visitflow.plans import catalog as CAT
from visitflow.sources.tables import Tables

from paths import SF_SMALL


def test_same_stats_with_one_and_many_partitions(spark):
    t = Tables(spark, SF_SMALL)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = ST.session_aggr_stat(CAT.kept_sessions(t, CAT.FILTER_PARAMS["filter_age"])).collect()
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        many = ST.session_aggr_stat(CAT.kept_sessions(t, CAT.FILTER_PARAMS["filter_age"])).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert one == many


def test_detail_rows_equal_total_steps(spark):
    t = Tables(spark, SF_SMALL)
    p = CAT.TaskParams(sex=("male",), keywords=("kw1", "kw2", "kw3"))
    kept = CAT.kept_sessions(t, p)
    steps = kept.agg(F.sum("step_length")).collect()[0][0]
    assert steps > 0
    assert D.session_detail(CAT.actions(t, params=p), kept).count() == steps


def test_page_pairs_match_window_lead(spark):
    """The chunked pair count equals a per-session lead() on a small table."""
    from pyspark.sql import Window
    from visitflow.operators.pageflow import page_pair_counts
    t = Tables(spark, SF_SMALL)
    acts = CAT.actions(t, grain="month")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")      # sessions split across partitions
    try:
        got = {(r[0], r[1]): r[2] for r in page_pair_counts(acts).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    w = Window.partitionBy("session_id").orderBy("action_ts", "event_id")
    brute = (acts.withColumn("nxt", F.lead("page_id").over(w)).where(F.col("nxt").isNotNull())
             .groupBy("page_id", "nxt").count().collect())
    assert got == {(r[0], r[1]): r[2] for r in brute}


def test_extract_matches_plain_ranking(spark):
    """The bucketed extract equals ranking each stratum whole (brute force)."""
    from pyspark.sql import Window
    from visitflow.operators.extract import random_extract, stratum_quotas
    t = Tables(spark, SF_SMALL)
    s = CAT.kept_sessions(t, CAT.FILTER_PARAMS["filter_age"], sets=True)
    got = {r["sessionid"] for r in random_extract(s, per_day=3, seed="7").collect()}
    k = s.select("session_id", F.date_format("start_ts", "yyyy-MM-dd").alias("date"),
                 F.date_format("start_ts", "HH").alias("hour"),
                 F.md5(F.concat(F.lit("7"), "session_id")).alias("h"))
    q = stratum_quotas(k.groupBy("date", "hour").agg(F.count(F.lit(1)).alias("n_hour")), 3)
    w = Window.partitionBy("date", "hour").orderBy("h", "session_id")
    want = {r["session_id"] for r in k.withColumn("rn", F.row_number().over(w)).join(q, ["date", "hour"])
            .where(F.col("rn") <= F.col("quota")).collect()}
    assert got == want


def test_one_user_per_session(spark):
    """A2: user_id is constant inside a session (max(user_id) and early user pruning rely on it)."""
    for grain in ("day", "week", "month"):
        a = CAT.actions(Tables(spark, SF_SMALL), grain=grain)
        bad = a.groupBy("session_id").agg(F.countDistinct("user_id").alias("n")).where("n > 1").count()
        assert bad == 0, grain


def _visits(spark):
    """One session of users 1 (age 10) and 2 (age 20), two actions."""
    import datetime as dt
    rows = [("s", 1, 1, "2024-01-01", dt.datetime(2024, 1, 1, 10), "kw", 5, 1),
            ("s", 2, 2, "2024-01-01", dt.datetime(2024, 1, 1, 11), None, None, 2)]
    acts = spark.createDataFrame(rows, "session_id string, user_id long, page_id long, date string, action_ts timestamp, "
                                       "search_keyword string, click_category_id long, event_id long")
    users = spark.createDataFrame([(1, 10, "p", "c", "male"), (2, 20, "p", "c", "male")],
                                  "user_id long, age int, professional string, city string, sex string")
    return acts, users


def test_conditions_meet_the_sessions_user(spark):
    """All actions of a shared session count; its user (the largest id) decides."""
    from visitflow.operators import predicates as P, sessions as S
    acts, users = _visits(spark)
    full = S.attach_user_info(S.aggregate_sessions(acts), users)
    kept = P.filter_sessions(full, CAT.TaskParams(start_age=15, end_age=25)).collect()
    assert [(r["user_id"], r["step_length"]) for r in kept] == [(2, 2)]
    assert P.filter_sessions(full, CAT.TaskParams(start_age=5, end_age=12)).count() == 0


def test_pages_without_an_id_are_gaps(spark):
    from visitflow.operators.pageflow import convert_rates, page_pair_counts
    import datetime as dt
    at = dt.datetime(2024, 1, 1)
    rows = [("a", p, at + dt.timedelta(seconds=400 * i), i) for i, p in enumerate([1, None, 2, 3, 1, 2, None])]
    rows += [("b", p, at + dt.timedelta(seconds=1), i) for i, p in enumerate([1, 2, 3])]
    acts = spark.createDataFrame(rows, "session_id string, page_id long, action_ts timestamp, event_id long")
    got = {(r[0], r[1]): r[2] for r in page_pair_counts(acts).collect()}
    assert got == {(2, 3): 2, (3, 1): 1, (1, 2): 2}
    assert [(r["pair_count"], r["convert_rate"]) for r in convert_rates(acts, [1, 2, 3]).orderBy("step").collect()] == \
        [(2, 0.67), (2, 1.0)]


def test_half_up_rounding_goes_away_from_zero(spark):
    from visitflow.functions import round_half_up
    cases = [(-0.125, -0.13), (0.125, 0.13), (1e20, 1e20), (float("inf"), float("inf")), (float("nan"), 0.0),
             (-float("inf"), -float("inf")), (0.0, 0.0), (None, None), (2.005, 2.01)]
    df = spark.createDataFrame([(a,) for a, _ in cases], "x double")
    assert [r[0] for r in df.select(round_half_up("x")).collect()][:8] == [b for _, b in cases][:8]


def test_result_tables_read_back_with_taskid_first(spark, scratch):
    from visitflow.plans.sinks import discard, materialize, read_result, write_result
    kept = materialize(spark.range(3), "kept")
    write_result(kept, scratch, "r", 5)
    back = read_result(spark, scratch, "r", 5)
    assert back.columns == ["taskid", "id"] and sorted(map(tuple, back.collect())) == [(5, 0), (5, 1), (5, 2)]
    files = kept.inputFiles()
    discard(kept)
    import os
    assert files and not any(os.path.exists(f.replace("file://", "")) for f in files)


def test_appended_rows_are_seen(spark, scratch):
    spark.range(3).write.parquet(f"{scratch}/events.parquet")
    assert Tables(spark, scratch).table("events").count() == 3
    spark.range(4).write.mode("append").parquet(f"{scratch}/events.parquet")
    assert Tables(spark, scratch).table("events").count() == 7


def test_whole_table_runs_read_every_event(spark):
    """The job's reports exist without its date and age range; the extract covers each date of the events."""
    t = Tables(spark, SF_SMALL)
    for name in ("session_aggr_stat", "top10_category", "top10_category_session", "session_random_extract",
                 "page_convert_rate", "page_convert_rate_text", "area_top3_product"):
        assert CAT.queries()[f"whole_{name}"] is CAT.queries()[name]
    dates = {r[0] for r in CAT.actions(t).select("date").distinct().collect()}
    got = CAT.queries()["whole_session_random_extract"](spark, SF_SMALL).collect()
    assert {r["startTime"][:10] for r in got} == dates
