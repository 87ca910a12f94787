"""Registered queries: name -> (spark, data_dir) -> DataFrame.

Each query reads the test tables through the adapters, so its work grows with
the data. Outputs hold only plain types (bigint, int, double, string); sets
are comma text, times are text.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as FN
from ..operators import ads as AD
from ..operators import area as AR
from ..operators import categories as CG
from ..operators import extract as EX
from ..operators import pageflow as PF
from ..operators import detail as D
from ..operators import merge as M
from ..operators import predicates as P
from ..operators import sessions as S
from ..operators import stats as ST
from ..operators import task_set as TS
from ..sources import adapters as A
from ..sources.tables import Tables
from ..sources.tasks import TaskParams, decode_task_params, derived_tasks, find_task, load_task_params
from ..sources.visit_tables import ACTION_COLUMNS, EventTables, VisitTables, store_visit_tables
from . import jobs as J
from .sinks import materialize, read_result

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered filter queries (values exist in the test data).
FILTER_PARAMS: dict[str, TaskParams] = {
    "filter_age": TaskParams(start_age=20, end_age=40),
    "filter_any_of": TaskParams(professionals=tuple(f"professional{i}" for i in range(0, 100, 3)),
                                cities=("NATION_1", "NATION_3", "NATION_7", "NATION_12", "NATION_20"),
                                sex=("male",)),
    "filter_keywords": TaskParams(keywords=("kw1", "kw3")),
    "filter_categories": TaskParams(category_ids=("3", "4", "5", "10", "20")),
    "filter_all": TaskParams(start_date="2024-01-05", end_date="2024-01-25", start_age=10, end_age=50,
                             sex=("female",), keywords=("kw2", "kw5", "kw7"),
                             category_ids=tuple(str(i) for i in range(0, 100, 2))),
}
# The job's reports over all events: no date or age condition. Ranged runs take their parameters from a task row.
WHOLE_PARAMS = TaskParams(target_page_flow=(1, 2, 3, 4, 5, 6, 7))
EMPTY_PARAMS = TaskParams(start_age=100, end_age=120)      # no user is that old: no sessions
AS_OF = "2024-02-01 00:00:00"
SESSION_OUT = ("session_id", "user_id", "search_keywords", "click_category_ids",
               "visit_length", "step_length", "start_time")


def actions(t: Tables, grain="day", clock="real", params: TaskParams | None = None) -> DataFrame:
    p = params or TaskParams()
    return A.user_visit_action(t.events, grain, clock, p.start_date, p.end_date)


def users(t: Tables) -> DataFrame:
    return A.user_info(t.customer, t.nation)


def full_sessions(t: Tables, grain="day", clock="real", params: TaskParams | None = None, sets=True, **kw) -> DataFrame:
    """Sessions of the task's dates with user attributes; its user conditions apply to them, not to single actions."""
    acts = actions(t, grain, clock, params)
    return S.attach_user_info(S.aggregate_sessions(acts, params=params, sets=sets, **kw), users(t))


def kept_sessions(t: Tables, params: TaskParams, grain="day", clock="real", sets=False) -> DataFrame:
    """Sessions that meet every condition, those on keywords and categories folded into the aggregate."""
    return P.filter_sessions(full_sessions(t, grain, clock, params, sets), params)


def _session_rows(df: DataFrame, extra=()) -> DataFrame:
    return S.format_sets(df).select(*SESSION_OUT, *extra)


# --- step 1: sources, tasks ---------------------------------------------------

def q_actions_by_date_range(spark, d):
    t = Tables(spark, d)
    p = TaskParams(start_date="2024-01-10", end_date="2024-01-12")
    return actions(t, params=p).drop("action_ts")


def q_task_params(spark, d):
    return decode_task_params(derived_tasks(Tables(spark, d).events))


def q_task_by_id(spark, d):
    t = Tables(spark, d)
    tasks = derived_tasks(t.events)
    return find_task(tasks, 19737)          # the task of 2024-01-15


# --- step 2: sessions ---------------------------------------------------------

def q_session_aggregate(spark, d):
    t = Tables(spark, d)
    return _session_rows(S.aggregate_sessions(actions(t)))


def q_session_full_info(spark, d):
    t = Tables(spark, d)
    return _session_rows(full_sessions(t), S.USER_COLUMNS)


def q_session_as_of(spark, d):
    t = Tables(spark, d)
    return _session_rows(S.aggregate_sessions(actions(t), as_of=AS_OF))


def q_session_compat(spark, d):
    t = Tables(spark, d)
    return _session_rows(S.aggregate_sessions(actions(t, grain="week"), compat_substring=True,
                                              compat_null_zero=True))


# --- step 3: filters ----------------------------------------------------------

def _filter_query(name):
    def q(spark, d):
        t = Tables(spark, d)
        params = FILTER_PARAMS[name]
        kept = materialize(kept_sessions(t, params), name)          # read twice: as it is, and to collect its sets
        return _session_rows(S.session_sets(kept, actions(t, params=params)), S.USER_COLUMNS)
    q.__name__ = f"q_{name}"
    return q


def shared_sessions(t: Tables, params: TaskParams) -> DataFrame:
    """Actions whose session id several users share: the user's id modulo 25, and the date."""
    key = F.concat((F.col("user_id") % 25).cast("string"), F.lit("_"), F.col("date"))
    return actions(t, params=params).withColumn("session_id", key)


def q_filter_shared_sessions(spark, d):
    """P6 on sessions of several users: all their actions count, the conditions meet the session's user."""
    t = Tables(spark, d)
    params = FILTER_PARAMS["filter_age"]
    full = S.attach_user_info(S.aggregate_sessions(shared_sessions(t, params)), users(t))
    return _session_rows(P.filter_sessions(full, params), S.USER_COLUMNS)


def q_filter_equal(spark, d):
    """Sessions whose user's sex equals the parameter (whole-value equality)."""
    t = Tables(spark, d)
    s = full_sessions(t)
    return _session_rows(s.where(P.equal_predicate("sex", "female")), S.USER_COLUMNS)


# --- step 4: statistics -------------------------------------------------------

def _bucket_query(which, grain, clock):
    def q(spark, d):
        t = Tables(spark, d)
        return ST.bucket_distribution(S.aggregate_sessions(actions(t, grain, clock)), which)
    return q


def q_session_aggr_stat(spark, d):
    t = Tables(spark, d)
    return ST.session_aggr_stat(kept_sessions(t, WHOLE_PARAMS, grain="week", clock="value"))


def q_session_aggr_stat_empty(spark, d):
    t = Tables(spark, d)
    return ST.session_aggr_stat(kept_sessions(t, EMPTY_PARAMS))


# --- step 5: detail -----------------------------------------------------------

def q_session_detail(spark, d):
    t = Tables(spark, d)
    params = FILTER_PARAMS["filter_all"]
    return D.session_detail(actions(t, params=params), kept_sessions(t, params))


# --- step 6 and 10: ad clicks, merges ------------------------------------------

# Merge fixtures: the target is cut from the events before MERGE_TARGET_END, the
# updates from MERGE_UPDATE_START on, so keys of the overlap exist in both.
MERGE_TARGET_END = "2024-01-20 12:00:00"
MERGE_UPDATE_START = "2024-01-15 00:00:00"
BLACKLIST_THRESHOLD = 2


def ad_clicks(t: Tables, start: str | None = None, end: str | None = None) -> DataFrame:
    """Parsed ad-log clicks derived from events (optionally cut by time on the scan)."""
    ev = t.events
    if start:
        ev = ev.where(F.col("ts") >= F.lit(dt.datetime.fromisoformat(start)).cast("timestamp_ntz"))
    if end:
        ev = ev.where(F.col("ts") < F.lit(dt.datetime.fromisoformat(end)).cast("timestamp_ntz"))
    return AD.parse_log(A.ad_log_lines(ev, t.nation, t.region))


def _target_updates(t: Tables, build):
    return (build(ad_clicks(t, end=MERGE_TARGET_END)), build(ad_clicks(t, start=MERGE_UPDATE_START)))


def q_ad_log_parse(spark, d):
    c = ad_clicks(Tables(spark, d))
    return c.select(F.unix_millis("ts").alias("ms"), "date", "province", "city", "user_id", "ad_id")


def q_merge_increment(spark, d):
    tgt, upd = _target_updates(Tables(spark, d), AD.user_click_counts)
    return M.merge(tgt, upd, AD.USER_KEYS, "increment")


def q_merge_replace(spark, d):
    tgt, upd = _target_updates(Tables(spark, d), AD.ad_stat)
    return M.merge(tgt, upd, AD.STAT_KEYS, "replace")


def q_merge_replace_minute(spark, d):
    tgt, upd = _target_updates(Tables(spark, d), AD.click_trend)
    return M.merge(tgt, upd, AD.TREND_KEYS, "replace")


MERGE_BUCKETS = 8


def _bucketed_query(name, mode, build, keys):
    """The merge into a stored table bucketed by its keys; only the updates are shuffled."""
    def q(spark, d):
        from uuid import uuid4
        tgt, upd = _target_updates(Tables(spark, d), build)
        table = f"visitflow_{name}_{uuid4().hex}"
        M.store_bucketed(tgt, table, keys, MERGE_BUCKETS)
        try:
            return materialize(M.merge_bucketed(spark, table, upd, keys, mode, MERGE_BUCKETS), name)
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
    q.__name__ = f"q_{name}"
    return q


BUCKETED_MERGES = {
    "merge_bucketed_increment": ("increment", AD.user_click_counts, AD.USER_KEYS),
    "merge_bucketed_replace": ("replace", AD.ad_stat, AD.STAT_KEYS),
    "merge_bucketed_replace_minute": ("replace", AD.click_trend, AD.TREND_KEYS),
}


def q_merge_replace_group(spark, d):
    tgt, upd = _target_updates(Tables(spark, d), lambda c: AD.province_top3(AD.ad_stat(c)))
    return M.merge(tgt, upd, AD.PROVINCE_KEYS, "replace_group")


def q_blacklist_append(spark, d):
    black = lambda c: AD.blacklist_candidates(AD.user_click_counts(c), BLACKLIST_THRESHOLD)
    tgt, upd = _target_updates(Tables(spark, d), black)
    return M.append_new_users(tgt, upd)


def q_click_count_lookup(spark, d):
    t = Tables(spark, d)
    counts = AD.user_click_counts(ad_clicks(t, end=MERGE_TARGET_END))
    keys = ad_clicks(t, start=MERGE_UPDATE_START)
    return M.lookup_counts(keys, counts, AD.USER_KEYS)


def q_merge_existence(spark, d):
    tgt, upd = _target_updates(Tables(spark, d), AD.user_click_counts)
    return M.mark_existing(upd, tgt, AD.USER_KEYS)


def _ad_batch_query(name):
    def q(spark, d):
        return AD.batch_stats(ad_clicks(Tables(spark, d)), BLACKLIST_THRESHOLD)[name]
    q.__name__ = f"q_{name}"
    return q


# Two micro-batches: clicks before STREAM_CUT, then the rest (exercises J3).
STREAM_CUT = "2024-01-12 00:00:00"


STATE_NEEDED = {"counts": ("counts", "blacklist"), "blacklist": ("counts", "blacklist"), "stat": ("blacklist", "stat"),
                "top3": ("blacklist", "stat", "top3")}


def two_batch_state(t: Tables, needed=tuple(AD.STATE_SCHEMAS)) -> AD.AdState:
    """The state after two batches; only the tables in ``needed`` of the first are stored in between, as the stream's are."""
    first, _ = AD.apply_batch(AD.empty_state(t.spark), ad_clicks(t, end=STREAM_CUT), BLACKLIST_THRESHOLD)
    first = first._replace(**{f: materialize(getattr(first, f), f"first-{f}") for f in needed})
    second, _ = AD.apply_batch(first, ad_clicks(t, start=STREAM_CUT), BLACKLIST_THRESHOLD)
    return second


def _two_batch_query(field):
    def q(spark, d):
        return getattr(two_batch_state(Tables(spark, d), STATE_NEEDED[field]), field)
    q.__name__ = f"q_two_batch_{field}"
    return q


# --- step 7: column functions over whole tables ---------------------------------

def mock_time_text(ts_col="action_ts", date_col="date"):
    """The mock data's time text: one-digit hours stay unpadded."""
    ts = F.col(ts_col)
    return F.concat(F.col(date_col), F.lit(" "), F.hour(ts).cast("string"), F.lit(":"),
                    F.date_format(ts, "mm"), F.lit(":"), F.date_format(ts, "ss"))


def q_time_keys(spark, d):
    a = actions(Tables(spark, d))
    text = mock_time_text()
    parsed = FN.parse_time(text)
    noon = F.lit("2024-01-15 12:00:00")
    return a.select(
        "event_id", text.alias("mock_time"),
        FN.date_key(parsed).alias("date_key"), FN.minute_key(parsed).alias("minute_key"),
        FN.date_hour(parsed).alias("date_hour"), FN.date_hour_text(text).alias("date_hour_text"),
        FN.format_date(parsed).alias("day"), FN.format_time(parsed).alias("time_text"),
        FN.before(text, noon).alias("before_noon"), FN.after(text, noon).alias("after_noon"),
        FN.seconds_between(text, F.concat(F.col("date"), F.lit(" 0:00:00"))).alias("sec_of_day"),
        FN.parse_date_key(FN.date_key(parsed)).cast("string").alias("date_from_key"),
        FN.day_before(F.col("date")).alias("yesterday"))


def session_record_text(sessions: DataFrame):
    """The reference's ``k=v|`` session record, built from real columns."""
    s = S.format_sets(sessions)
    return F.concat(
        F.lit("sessionid="), s["session_id"], F.lit("|searchKeywords="), s["search_keywords"],
        F.lit("|clickCategoryIds="), s["click_category_ids"],
        F.lit("|visitLength="), s["visit_length"].cast("string"),
        F.lit("|stepLength="), s["step_length"].cast("string"),
        F.lit("|startTime="), s["start_time"], F.lit("|")), s


def q_kv_text_parse(spark, d):
    text, s = session_record_text(S.aggregate_sessions(actions(Tables(spark, d), grain="week")))
    rec = s.select("session_id", text.alias("record"))
    return rec.select(
        "session_id", "record",
        *[FN.kv_get("record", k).alias(f"f_{k}") for k in
          ("sessionid", "searchKeywords", "clickCategoryIds", "visitLength", "stepLength", "startTime", "age")])


def q_kv_text_set(spark, d):
    text, s = session_record_text(S.aggregate_sessions(actions(Tables(spark, d), grain="week")))
    rec = s.select("session_id", "step_length", text.alias("record"))
    return rec.select(
        "session_id",
        FN.kv_set("record", "visitLength", (F.col("step_length") * 10).cast("string")).alias("set_visit"),
        FN.kv_set("record", "age", "30").alias("set_unknown"))


def q_string_cleanup(spark, d):
    s = S.format_sets(S.aggregate_sessions(actions(Tables(spark, d), grain="month")))
    kws = F.col("search_keywords")
    return s.select(
        "session_id",
        FN.trim_one_comma(F.concat(F.lit(","), kws, F.lit(","))).alias("trim1"),
        FN.trim_one_comma(F.concat(F.lit(",,"), kws, F.lit(",,"))).alias("trim2"),
        FN.fill_two_digits(F.col("step_length").cast("string")).alias("step_text"),
        FN.fill_two_digits(F.col("visit_length").cast("string")).alias("visit_text"),
        FN.is_empty(kws).alias("kw_empty"), FN.is_not_empty(F.col("click_category_ids")).alias("cat_present"))


# --- step 8 and 9: categories, extract, page flow, areas -------------------------

EXTRACT_PER_DAY = 20
EXTRACT_SEED = "42"


def job_actions(t: Tables, params: TaskParams = WHOLE_PARAMS) -> DataFrame:
    """Actions of the sessions a task keeps."""
    return D.kept_actions(actions(t, params=params), kept_sessions(t, params))


def q_top10_category(spark, d):
    return CG.top_categories(job_actions(Tables(spark, d)))


def q_top10_category_session(spark, d):
    return CG.top_sessions_per_category(job_actions(Tables(spark, d)))


def q_session_random_extract(spark, d):
    t = Tables(spark, d)
    return EX.random_extract(kept_sessions(t, WHOLE_PARAMS), EXTRACT_PER_DAY, EXTRACT_SEED, actions(t))


def q_page_convert_rate(spark, d):
    views = materialize(PF.page_views(job_actions(Tables(spark, d))), "page-views")
    return PF.convert_rates(views, WHOLE_PARAMS.target_page_flow)


def q_page_convert_rate_text(spark, d):
    return PF.convert_rate_text(q_page_convert_rate(spark, d))


def q_area_top3_product(spark, d):
    t = Tables(spark, d)
    return AR.area_top_products(actions(t), A.city_info(t.nation, t.region), A.product_info(t.part))


# --- task-driven runs: a task row in, result tables written and read back -----------

TASK_ID = 19737                         # the task of 2024-01-15
TASK_TABLES = {
    J.run_session_job: ("session_aggr_stat", "session_detail", "session_random_extract", "top10_category", "top10_category_session"),
    J.run_page_job: ("page_split_convert_rate", "page_split_convert_steps"),
    J.run_product_job: ("area_top3_product",),
}


def _job_options() -> J.SessionOptions:
    return J.SessionOptions(extract_per_day=EXTRACT_PER_DAY, extract_seed=EXTRACT_SEED)


def _task_query(job, table, stored=False):
    """One task of the task table through its job, the result table read back."""
    def q(spark, d):
        from ..session import scratch_path
        source = stored_tables(spark, d) if stored else EventTables(spark, d)
        out = scratch_path(spark, "task-results")
        job(spark, source, TASK_ID, load_task_params(source.tasks(), TASK_ID), out, _job_options())
        return read_result(spark, out, table, TASK_ID)
    q.__name__ = f"q_{'table' if stored else 'task'}_{table}"
    return q


def _task_set_query(table):
    """The table of every task of the task table, from scans that all tasks share."""
    def q(spark, d):
        source = EventTables(spark, d)
        tasks = materialize(decode_task_params(source.tasks()), "tasks")
        kept = materialize(TS.task_sessions(source.actions(), source.users(), tasks), "task-sessions")
        views = materialize(J.task_views(source, tasks, kept), "task-views") if table.startswith("page") else None
        return J.task_reports(source, tasks, kept, _job_options(), views)[table]
    q.__name__ = f"q_tasks_{table}"
    return q


# --- the stored visit tables: dates in folders, text times, no event id --------------

def stored_tables(spark, d) -> VisitTables:
    from ..session import scratch_path
    return store_visit_tables(EventTables(spark, d), scratch_path(spark, "visit-tables"))


def q_table_actions_by_date_range(spark, d):
    """R1 as stored: the task's dates are partitions, the time text keeps its one-digit hours."""
    rows = stored_tables(spark, d).actions("2024-01-10", "2024-01-12")
    return rows.select(*ACTION_COLUMNS, F.unix_timestamp("action_ts").alias("action_sec"))


def q_table_session_full_info(spark, d):
    """A1-A10 and J1 from text times."""
    t = stored_tables(spark, d)
    return _session_rows(S.session_full_info(t.actions(), t.users()), S.USER_COLUMNS)


def q_table_session_compat(spark, d):
    """The substring and null rules where no id orders the actions of one second."""
    return _session_rows(S.aggregate_sessions(stored_tables(spark, d).actions(), compat_substring=True, compat_null_zero=True))


def q_table_page_convert_rate(spark, d):
    """C4 with the stored tables' order: time, then page."""
    t = stored_tables(spark, d)
    views = materialize(PF.page_views(t.actions(), t.order), "page-views")
    return PF.convert_rates(views, WHOLE_PARAMS.target_page_flow, t.order)


def q_table_view_sql(spark, d):
    """SQL texts over the registered views, as a user of the tables writes them."""
    stored_tables(spark, d).register()
    return spark.sql("""
        SELECT u.user_id, u.name, u.age, u.professional, u.city, u.sex, count(*) AS actions,
               count(DISTINCT a.session_id) AS sessions
        FROM (SELECT * FROM user_visit_action WHERE date >= '2024-01-08' AND date <= '2024-01-20') a
        JOIN (SELECT * FROM user_info) u ON a.user_id = u.user_id
        GROUP BY u.user_id, u.name, u.age, u.professional, u.city, u.sex""")


# --- step 11: the streams themselves, over log lines derived from the tables ------

def _stream_source(t: Tables) -> str:
    """Ad-log lines of the tables written as text files into the shared checkpoint folder."""
    from ..session import scratch_path
    root = scratch_path(t.spark, "ad-stream")
    A.ad_log_lines(t.events, t.nation, t.region).write.mode("overwrite").text(f"{root}/src")
    return root


def q_ad_stream_stat(spark, d):
    """The state stream run to completion (availableNow: one micro-batch); its ad_stat table."""
    from ..streaming import AdStateStore, run_to_completion, start_ad_stream
    root = _stream_source(Tables(spark, d))
    run_to_completion(start_ad_stream(spark, f"{root}/src", f"{root}/state", BLACKLIST_THRESHOLD,
                                      checkpoint=f"{root}/ckpt", trigger={"availableNow": True}))
    return AdStateStore(spark, f"{root}/state").state().stat


def _stream_query(field):
    """The state stream over two micro-batches: the lines before STREAM_CUT, then the rest."""
    def q(spark, d):
        from ..session import scratch_path
        from ..streaming import AdStateStore, run_to_completion, start_ad_stream
        t = Tables(spark, d)
        root = scratch_path(spark, "ad-stream")
        cut = F.lit(dt.datetime.fromisoformat(STREAM_CUT)).cast("timestamp_ntz")
        for part in (t.events.where(F.col("ts") < cut), t.events.where(F.col("ts") >= cut)):
            A.ad_log_lines(part, t.nation, t.region).write.mode("append").text(f"{root}/src")
            run_to_completion(start_ad_stream(spark, f"{root}/src", f"{root}/state", BLACKLIST_THRESHOLD,
                                              trigger={"availableNow": True}))
        return getattr(AdStateStore(spark, f"{root}/state").state(), field)
    q.__name__ = f"q_ad_stream_{field}"
    return q


def q_format_double(spark, d):
    """F10 over every event value, its negative and sizes beyond a bigint."""
    value = F.col("value")
    return Tables(spark, d).events.select(
        "event_id", FN.round_half_up(value).alias("rounded"), FN.round_half_up(-value).alias("negated"),
        FN.round_half_up(value * F.lit(1e18)).alias("large"), FN.round_half_up((F.col("event_id") - 500) / 8).alias("ties"))


def q_ad_stream_trend(spark, d):
    """The watermarked trend stream run to completion; its per-minute table."""
    from ..streaming import TrendStore, run_to_completion, start_trend_stream
    root = _stream_source(Tables(spark, d))
    run_to_completion(start_trend_stream(spark, f"{root}/src", f"{root}/trend", delay="1 day",
                                         checkpoint=f"{root}/ckpt", trigger={"availableNow": True}))
    return TrendStore(spark, f"{root}/trend").trend()


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {
        "actions_by_date_range": q_actions_by_date_range,
        "task_params": q_task_params,
        "task_by_id": q_task_by_id,
        "session_aggregate": q_session_aggregate,
        "session_full_info": q_session_full_info,
        "session_as_of": q_session_as_of,
        "session_compat": q_session_compat,
    }
    for name in FILTER_PARAMS:
        out[name] = _filter_query(name)
    out["filter_equal"] = q_filter_equal
    out["filter_shared_sessions"] = q_filter_shared_sessions
    for job, names in TASK_TABLES.items():
        for table in names:
            out[f"task_{table}"] = _task_query(job, table)
            out[f"tasks_{table}"] = _task_set_query(table)
            if table in ("session_aggr_stat", "session_random_extract", "area_top3_product"):
                out[f"table_{table}"] = _task_query(job, table, stored=True)
    for q in (q_table_actions_by_date_range, q_table_session_full_info, q_table_session_compat, q_table_page_convert_rate,
              q_table_view_sql):
        out[q.__name__[2:]] = q
    out["format_double"] = q_format_double
    out.update({
        "visit_buckets_real": _bucket_query("visit", "day", "real"),
        "visit_buckets_value": _bucket_query("visit", "day", "value"),
        "step_buckets_week": _bucket_query("step", "week", "real"),
        "step_buckets_month": _bucket_query("step", "month", "real"),
        "session_aggr_stat": q_session_aggr_stat,
        "session_aggr_stat_empty": q_session_aggr_stat_empty,
        "session_detail": q_session_detail,
        "ad_log_parse": q_ad_log_parse,
        "merge_increment": q_merge_increment,
        "merge_replace": q_merge_replace,
        "merge_replace_minute": q_merge_replace_minute,
        "merge_replace_group": q_merge_replace_group,
        "merge_existence": q_merge_existence,
        "blacklist_append": q_blacklist_append,
        "click_count_lookup": q_click_count_lookup,
    })
    out.update({
        "time_keys": q_time_keys,
        "kv_text_parse": q_kv_text_parse,
        "kv_text_set": q_kv_text_set,
        "string_cleanup": q_string_cleanup,
        "top10_category": q_top10_category,
        "top10_category_session": q_top10_category_session,
        "session_random_extract": q_session_random_extract,
        "page_convert_rate": q_page_convert_rate,
        "page_convert_rate_text": q_page_convert_rate_text,
        "area_top3_product": q_area_top3_product,
    })
    # the same reports under the names they had while others ran for a fixed range
    for name in ("session_aggr_stat", "top10_category", "top10_category_session", "session_random_extract",
                 "page_convert_rate", "page_convert_rate_text", "area_top3_product"):
        out[f"whole_{name}"] = out[name]
    for name, spec in BUCKETED_MERGES.items():
        out[name] = _bucketed_query(name, *spec)
    for name in ("ad_user_click_count", "ad_blacklist", "ad_stat", "ad_province_top3", "ad_click_trend"):
        out[name] = _ad_batch_query(name)
    for field in ("counts", "blacklist", "stat", "top3"):
        out[f"ad_two_batch_{field}"] = _two_batch_query(field)
    for field in ("counts", "blacklist", "top3"):
        out[f"ad_stream_{field}"] = _stream_query(field)
    out["ad_stream_stat"] = q_ad_stream_stat
    out["ad_stream_trend"] = q_ad_stream_trend
    return out
