"""The stored visit tables and runs over every task of a task table."""

import pytest
from pyspark.sql import functions as F

from visitflow.operators import sessions as S
from visitflow.operators import stats as ST
from visitflow.operators import task_set as TS
from visitflow.plans import jobs as J
from visitflow.sources.tasks import TaskParams, decode_task_params
from visitflow.sources.visit_tables import ACTION_DDL, EventTables, VisitTables, store_visit_tables

from paths import SF_SMALL

ACTIONS = [  # user_id, session_id, page_id, action_time, search_keyword, click_category_id, ..., city_id, date
    (1, "s1", 1, "2024-01-01 9:59:58", "a", None, None, None, None, None, None, 3, "2024-01-01"),
    (1, "s1", 2, "2024-01-01 10:00:02", None, 7, 70, None, None, None, None, 3, "2024-01-01"),
    (1, "s1", 3, "2024-01-01 10:00:02", None, None, None, "1,2", "5", None, None, 3, "2024-01-01"),
    (2, "s2", 1, "no time", None, 8, 80, None, None, None, None, 4, "2024-01-02"),
    (2, "s2", 1, None, None, None, None, None, None, "9", "6", 4, "2024-01-02"),
    (None, None, None, None, None, None, None, None, None, None, None, None, "2024-01-03"),
]


@pytest.fixture()
def few(spark, scratch):
    spark.createDataFrame(ACTIONS, ACTION_DDL).write.partitionBy("date").parquet(f"{scratch}/user_visit_action")
    return VisitTables(spark, scratch)


def test_one_digit_hours_are_times_not_text(few):
    rows = {r["session_id"]: r for r in S.aggregate_sessions(few.actions()).collect()}
    assert rows["s1"]["visit_length"] == 4 and rows["s1"]["start_time"] == "2024-01-01 09:59:58"
    assert rows["s2"]["start_time"] is None and rows["s2"]["step_length"] == 2 and rows["s2"]["visit_length"] is None
    assert ST.bucket_counts(S.aggregate_sessions(few.actions())).first()["session_count"] == 3


def test_dates_are_partitions_and_text(few):
    assert few.actions("2024-01-02").count() == 3 and few.actions(None, "2024-01-01").count() == 3
    assert few.actions("2024-01-02", "2024-01-02").columns[0] == "date"
    assert dict(few.actions().dtypes)["date"] == "string"


@pytest.mark.parametrize("fmt", ["orc", "json"])
def test_other_formats_hold_the_same_rows(spark, scratch, fmt):
    t = store_visit_tables(EventTables(spark, SF_SMALL), f"{scratch}/{fmt}", fmt)
    want = EventTables(spark, SF_SMALL)
    assert t.actions().count() == want.actions().count() and t.users().count() == want.users().count()
    got = S.aggregate_sessions(t.actions()).select("session_id", "visit_length", "step_length")
    assert got.exceptAll(S.aggregate_sessions(want.actions()).select(*got.columns)).isEmpty()


def test_tables_of_the_catalog(spark, scratch):
    stored = store_visit_tables(EventTables(spark, SF_SMALL), f"{scratch}/tables")
    assert set(stored.register()) >= {"user_visit_action", "user_info", "task"}
    by_name = VisitTables(spark)
    assert by_name.actions("2024-01-05", "2024-01-06").count() == stored.actions("2024-01-05", "2024-01-06").count()
    assert by_name.tasks().count() == 30
    n = spark.sql("select * from user_visit_action where date >= '2024-01-05' and date <= '2024-01-06'").count()
    assert n == stored.actions("2024-01-05", "2024-01-06").count()


TASKS = [
    (1, TaskParams()), (2, TaskParams(start_date="2024-01-10")), (3, TaskParams(end_date="2024-01-10", sex=("male",))),
    (4, TaskParams(start_date="2024-01-05", end_date="2024-01-20", start_age=10, end_age=50, keywords=("kw2", "kw5"))),
    (5, TaskParams(category_ids=("3", "4", "99"), professionals=("professional1", "professional2", "professional7"))),
    (6, TaskParams(start_date="2024-01-20", end_date="2024-01-10")), (7, TaskParams(start_date="2031-01-01", end_date="2031-01-02")),
    (8, TaskParams(cities=("NATION_1", "NATION_3"), start_age=30)),
]


def test_every_task_equals_its_own_run(spark):
    """Open ranges, one-sided ages, empty and reversed ranges: the task set gives what single tasks give."""
    source = EventTables(spark, SF_SMALL, grain="week")
    rows = [(i, p.to_json()) for i, p in TASKS] + [(9, None), (10, "not json")]
    tasks = decode_task_params(spark.createDataFrame(rows, "task_id long, task_param string"))
    kept = TS.task_sessions(source.actions(), source.users(), tasks)
    got = {}
    for r in kept.collect():
        got.setdefault(r["task_id"], set()).add((r["session_id"], r["visit_length"], r["step_length"], tuple(r["search_keywords"])))
    stat = {r["task_id"]: r for r in TS.for_every_task(ST.session_aggr_stat(kept, TS.BY), tasks).collect()}
    assert set(stat) == set(range(1, 11))
    for i, p in [*TASKS, (9, TaskParams()), (10, TaskParams())]:
        one = J.kept_sessions(source, p, sets=True)
        want = {(r["session_id"], r["visit_length"], r["step_length"], tuple(r["search_keywords"])) for r in one.collect()}
        assert got.get(i, set()) == want, i
        assert tuple(stat[i])[1:] == tuple(ST.session_aggr_stat(one).first()), i
    assert got[1] and got[4] and 6 not in got and 7 not in got


def test_results_of_all_tasks_replace_their_own(spark, scratch):
    from visitflow.plans.sinks import read_result
    tasks = spark.createDataFrame([(i, p.with_(target_page_flow=(1, 2, 3)).to_json()) for i, p in TASKS[:4]], "task_id long, task_param string")
    source = EventTables(spark, SF_SMALL)
    paths = J.run_task_set(spark, source, scratch, tasks)
    assert set(paths) == set("session_aggr_stat session_detail session_random_extract top10_category top10_category_session "
                             "page_split_convert_rate page_split_convert_steps area_top3_product".split())
    before = read_result(spark, scratch, "session_aggr_stat").orderBy("taskid").collect()
    J.run_task_set(spark, source, scratch, tasks.where("task_id = 2"))
    assert read_result(spark, scratch, "session_aggr_stat").orderBy("taskid").collect() == before
    text = read_result(spark, scratch, "page_split_convert_rate", 4).collect()
    assert len(text) == 1 and text[0]["convertRate"].startswith("1_2=")
    assert read_result(spark, scratch, "session_detail").groupBy("taskid").count().count() == 4
    assert read_result(spark, scratch, "area_top3_product").agg(F.countDistinct("taskid")).first()[0] == 4
