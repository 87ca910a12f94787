"""Hand fixtures: tiny frames with exact expected values (FIXTURES.md section 3)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from visitflow import functions as FN
from visitflow.operators import merge as M
from visitflow.operators import predicates as P
from visitflow.operators import sessions as S
from visitflow.operators import stats as ST
from visitflow.operators.ads import parse_log
from visitflow.sources.tasks import TaskParams

ACTION_SCHEMA = ("session_id string, user_id bigint, action_ts timestamp, event_id bigint, "
                 "search_keyword string, click_category_id bigint, page_id bigint")


def sessions_of(spark, visit_lengths=None, step_lengths=None):
    rows = []
    for i, v in enumerate(visit_lengths or []):
        rows.append((f"v{i}", v, 1))
    for i, s in enumerate(step_lengths or []):
        rows.append((f"s{i}", 5, s))
    return spark.createDataFrame(rows, "session_id string, visit_length bigint, step_length bigint")


def test_visit_bucket_edges(spark):
    lengths = [0, 1, 3, 4, 6, 7, 9, 10, 29, 30, 59, 60, 179, 180, 599, 600, 1799, 1800]
    dist = {r["bucket"]: r["session_count"] for r in
            ST.bucket_distribution(sessions_of(spark, visit_lengths=lengths), "visit").collect()}
    assert dist == {None: 1, "1s_3s": 2, "4s_6s": 2, "7s_9s": 2, "10s_30s": 2, "30s_60s": 2,
                    "1m_3m": 2, "3m_10m": 2, "10m_30m": 2, "30m": 1}


def test_step_bucket_edges(spark):
    steps = [1, 3, 4, 6, 7, 9, 10, 29, 30, 59, 60]
    df = spark.createDataFrame([(f"s{i}", 0, s) for i, s in enumerate(steps)],
                               "session_id string, visit_length bigint, step_length bigint")
    dist = {r["bucket"]: r["session_count"] for r in ST.bucket_distribution(df, "step").collect()}
    assert dist == {"1_3": 2, "4_6": 2, "7_9": 2, "10_30": 2, "30_60": 2, "60": 1}


def test_bucket_sums_match_session_count(spark):
    lengths = [0, 1, 3, 4, 6, 7, 9, 10, 29, 30, 59, 60, 179, 180, 599, 600, 1799, 1800]
    row = ST.bucket_counts(sessions_of(spark, visit_lengths=lengths)).collect()[0]
    visits = sum(v for k, v in row.asDict().items() if k.startswith("visit_length_"))
    steps = sum(v for k, v in row.asDict().items() if k.startswith("step_length_"))
    assert visits + 1 == row["session_count"]          # one 0-second session
    assert steps == row["session_count"]


def test_no_sessions_gives_zero_ratios(spark):
    empty = spark.createDataFrame([], "session_id string, visit_length bigint, step_length bigint")
    row = ST.session_aggr_stat(empty).collect()[0].asDict()
    assert row.pop("session_count") == 0
    assert len(row) == 15 and set(row.values()) == {0.0}


def test_ratio_rounds_half_up(spark):
    df = spark.createDataFrame([(57, 200), (1, 8), (3, 40), (0, 0)], "a bigint, b bigint")
    got = [r[0] for r in df.select(FN.ratio("a", "b")).collect()]
    assert got == [0.29, 0.13, 0.08, 0.0]


def _one(spark, expr, schema="x string", value=None):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).collect()[0]["r"]


@pytest.mark.parametrize("start,end,age,expected", [
    (10, None, 5, True),      # one-sided range: no condition
    (None, 40, 5, True),
    (10, 40, None, False),    # null data, full range: dropped
    (10, 40, 25, True),
    (10, 40, 41, False),
])
def test_range_predicate(spark, start, end, age, expected):
    pred = P.range_predicate("age", start, end)
    df = spark.createDataFrame([(age,)], "age int")
    got = df.where(pred).count() == 1 if pred is not None else True
    assert got == expected


@pytest.mark.parametrize("param,expected", [(("b", "c"), True), (("c",), False), (None, True)])
def test_any_of_predicate(spark, param, expected):
    df = spark.createDataFrame([(["a", "b"],)], "kw array<string>")
    pred = P.any_of_predicate("kw", param, is_array=True)
    assert (df.where(pred).count() == 1 if pred is not None else True) == expected


def test_any_of_on_empty_set_is_false(spark):
    df = spark.createDataFrame([([],)], "kw array<string>")
    assert df.where(P.any_of_predicate("kw", ("a",), is_array=True)).count() == 0


def _actions(spark, rows):
    return spark.createDataFrame(rows, ACTION_SCHEMA)


def _ts(text):
    return dt.datetime.strptime(text, "%Y-%m-%d %H:%M:%S")


def test_substring_pair_exact_and_compat(spark):
    rows = [("s", 1, _ts("2024-01-01 10:00:00"), 1, None, 10, 1),
            ("s", 1, _ts("2024-01-01 10:00:05"), 2, None, 1, 2)]
    a = _actions(spark, rows)
    exact = S.aggregate_sessions(a).collect()[0]
    assert exact["click_category_ids"] == [1, 10]
    compat = S.aggregate_sessions(a, compat_substring=True).collect()[0]
    assert compat["click_category_ids"] == [10]


def test_null_category_ignored_or_zero(spark):
    rows = [("s", 1, _ts("2024-01-01 10:00:00"), 1, "kw1", None, 1)]
    a = _actions(spark, rows)
    assert S.aggregate_sessions(a).collect()[0]["click_category_ids"] == []
    compat = S.aggregate_sessions(a, compat_substring=True, compat_null_zero=True).collect()[0]
    assert compat["click_category_ids"] == [0]


def test_one_digit_hour_parses(spark):
    df = spark.createDataFrame([("2024-01-01 5:03:04", "2024-01-01 15:00:00")], "a string, b string")
    row = df.select(FN.seconds_between("b", "a").alias("d"), FN.parse_time("a").alias("t"),
                    FN.date_hour_text("a").alias("h")).collect()[0]
    assert row["d"] == 35816
    assert row["t"] == dt.datetime(2024, 1, 1, 5, 3, 4)
    assert row["h"] == "2024-01-01_5"


def test_one_action_session(spark):
    a = _actions(spark, [("s", 1, _ts("2024-01-01 10:00:00"), 1, None, None, 1)])
    r = S.aggregate_sessions(a).collect()[0]
    assert (r["visit_length"], r["step_length"]) == (0, 1)


def test_as_of_extends_end(spark):
    a = _actions(spark, [("s", 1, _ts("2024-01-01 10:00:00"), 1, None, None, 1)])
    r = S.aggregate_sessions(a, as_of="2024-01-01 10:10:00").collect()[0]
    assert r["visit_length"] == 600
    assert r["end_ts"] == dt.datetime(2024, 1, 1, 10, 10, 0)


def test_unknown_user_dropped(spark):
    a = _actions(spark, [("s", 7, _ts("2024-01-01 10:00:00"), 1, None, None, 1)])
    users = spark.createDataFrame([(1, 20, "p", "c", "male")],
                                  "user_id bigint, age int, professional string, city string, sex string")
    assert S.session_full_info(a, users).count() == 0


KEYS = ["k"]


def _kv(spark, rows, schema="k string, click_count bigint"):
    return spark.createDataFrame(rows, schema)


def _as_set(df):
    return {tuple(r) for r in df.collect()}


def test_increment_merge(spark):
    out = M.merge(_kv(spark, [("k", 5)]), _kv(spark, [("k", 2), ("k", 1), ("n", 4)]), KEYS, "increment")
    assert _as_set(out) == {("k", 8), ("n", 4)}


def test_replace_merge(spark):
    out = M.merge(_kv(spark, [("k", 5), ("j", 1)]), _kv(spark, [("k", 2), ("n", 4)]), KEYS, "replace")
    assert _as_set(out) == {("k", 2), ("j", 1), ("n", 4)}


def test_group_replace_merge(spark):
    schema = "d string, p string, click_count bigint"
    tgt = _kv(spark, [("d", "p", 1), ("d", "p", 2), ("d", "q", 9)], schema)
    upd = _kv(spark, [("d", "p", 3)], schema)
    assert _as_set(M.merge(tgt, upd, ["d", "p"], "replace_group")) == {("d", "p", 3), ("d", "q", 9)}


def test_lookup_miss_is_zero(spark):
    counts = _kv(spark, [("a", 3)])
    keys = spark.createDataFrame([("a",), ("b",)], "k string")
    assert _as_set(M.lookup_counts(keys, counts, KEYS)) == {("a", 3), ("b", 0)}


def test_blacklist_append_no_duplicates(spark):
    black = spark.createDataFrame([(1,)], "user_id bigint")
    cand = spark.createDataFrame([(1,), (2,), (2,)], "user_id bigint")
    assert _as_set(M.append_new_users(black, cand)) == {(1,), (2,)}


def test_kv_text(spark):
    text = "a=1|b=|c=x=y|d=2"
    got = [_one(spark, FN.kv_get(F.col("x"), k), value=text) for k in "abcd"]
    assert got == ["1", None, None, "2"]
    assert _one(spark, FN.kv_set(F.col("x"), "b", "9"), value=text) == "a=1|b=9|c=x=y|d=2"
    assert _one(spark, FN.kv_set(F.col("x"), "zz", "9"), value=text) == text


def test_fill_and_trim(spark):
    assert [_one(spark, FN.fill_two_digits(F.col("x")), value=v) for v in ("5", "12", "123")] == \
        ["05", "12", "0123"]
    assert _one(spark, FN.trim_one_comma(F.col("x")), value=",,a,,") == ",a,"


def test_province_with_underscore_kept_whole(spark):
    schema = "date string, province string, click_count bigint"
    tgt = _kv(spark, [("2024-01-01", "MIDDLE_EAST", 1), ("2024-01-01", "ASIA", 4)], schema)
    upd = _kv(spark, [("2024-01-01", "MIDDLE_EAST", 7)], schema)
    out = M.merge(tgt, upd, ["date", "province"], "replace_group")
    assert _as_set(out) == {("2024-01-01", "MIDDLE_EAST", 7), ("2024-01-01", "ASIA", 4)}


def test_bad_log_lines_dropped(spark):
    lines = spark.createDataFrame([("1704067200000 AFRICA NATION_0 7 3",), ("1704067200000 AFRICA NATION_0 7",),
                                   ("x AFRICA NATION_0 7 3",), ("1704067200000 AFRICA NATION_0 seven 3",),
                                   ("9000000000000000000 AFRICA NATION_0 7 3",)],
                                  "value string")
    rows = parse_log(lines).collect()
    assert len(rows) == 1 and rows[0]["user_id"] == 7 and rows[0]["date"] == "2024-01-01"


def test_task_params_decode():
    p = TaskParams.from_json('{"startAge":["10"],"endAge":["40"],"professionals":["p1,p2"],'
                             '"cities":[],"sex":[""],"targetPageFlow":["1,2,3"]}')
    assert (p.start_age, p.end_age, p.professionals, p.cities, p.sex) == (10, 40, ("p1", "p2"), None, None)
    assert p.target_page_flow == (1, 2, 3)
    assert TaskParams.from_json(p.to_json()) == p


def test_register_views_runs_reference_sql(spark):
    from visitflow.sources.adapters import register_views
    from visitflow.sources.tables import Tables
    register_views(Tables(spark, "/root/testdata/sf0.001"))
    n = spark.sql("select * from user_visit_action where date >= '2024-01-02' and date <= '2024-01-03'").count()
    assert n > 0
    assert spark.sql("select * from user_info").count() == 150


def test_run_date_and_yesterday(spark):
    row = spark.range(1).select(FN.run_date("2024-03-01").alias("d")).select(
        FN.day_before("d").alias("y")).collect()[0]
    assert row["y"] == "2024-02-29"


def test_bulk_task_decode_tolerates_bad_values(spark):
    from visitflow.sources.tasks import decode_task_params
    tasks = spark.createDataFrame(
        [(1, '{"startAge":["ten"],"endAge":["40"],"cities":[],"sex":[""],"keywords":["kw1,kw2"]}'),
         (2, '{}'), (3, 'not json')], "task_id bigint, task_param string")
    rows = {r["task_id"]: r for r in decode_task_params(tasks).collect()}
    assert rows[1]["startAge"] is None and rows[1]["endAge"] == 40
    assert rows[1]["cities"] is None and rows[1]["sex"] is None and rows[1]["keywords"] == "kw1,kw2"
    assert all(rows[2][c] is None for c in rows[2].asDict() if c != "task_id")
    assert all(rows[3][c] is None for c in rows[3].asDict() if c != "task_id")


def test_json_helpers(spark):
    df = spark.createDataFrame([('{"a":["x","y"],"b":[],"s":1}',)], "j string")
    row = df.select(FN.json_array_first("j", "a").alias("a"), FN.json_array_first("j", "b").alias("b"),
                    FN.json_array_first("j", "c").alias("c"), FN.json_field("j", "s").alias("s")).collect()[0]
    assert (row["a"], row["b"], row["c"], row["s"]) == ("x", None, None, "1")
