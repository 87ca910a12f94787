"""Plans: pushdown, pruning, partial aggregates, shared scans (shapes that break at scale: see test_oracle)."""

import pytest

import __spark_entry__ as E
from visitflow.plans import catalog

from paths import SF_SMALL

QUERIES = {name: E.queries()[name] for name in catalog.queries()}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_date_range_reaches_the_scan(spark):
    plan = _plan(QUERIES["actions_by_date_range"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(ts,2024-01-10T00:00)" in plan and "LessThan(ts,2024-01-13T00:00)" in plan


def test_user_conditions_reach_a_stored_table(spark, scratch):
    from visitflow.operators import predicates as P
    from visitflow.sources import adapters as A
    from visitflow.sources.tables import Tables
    t = Tables(spark, SF_SMALL)
    A.user_info(t.customer, t.nation).write.parquet(f"{scratch}/users")
    params = catalog.TaskParams(start_age=20, end_age=40, professionals=("professional3",), cities=("NATION_1",),
                                sex=("male",))
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")          # else the plan text is cut
    plan = _plan(spark.read.parquet(f"{scratch}/users").where(P.user_predicate(params)))
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    for f in ("GreaterThanOrEqual(age,20)", "LessThanOrEqual(age,40)", "professional", "city", "sex"):
        assert f in pushed, (f, pushed)


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(QUERIES["session_aggr_stat"](spark, SF_SMALL))
    events_schema = [s for s in plan.split("ReadSchema: ")[1:] if "ts:timestamp_ntz" in s][0].split(">")[0]
    assert "event_id" not in events_schema               # the session stat never needs it


def test_bucketed_merges_move_no_target_row(spark):
    from uuid import uuid4
    from visitflow.operators import merge as M
    keys = ["date", "user_id", "ad_id"]
    table = f"merge_plan_{uuid4().hex}"
    rows = spark.range(2000).selectExpr("CAST(id % 7 AS STRING) AS date", "id AS user_id", "id % 5 AS ad_id", "id AS click_count")
    M.store_bucketed(rows, table, keys, 4)
    try:
        for mode in ("increment", "replace"):
            updates = spark.range(1500, 2500).selectExpr("CAST(id % 7 AS STRING) AS date", "id AS user_id", "id % 5 AS ad_id", "1L AS click_count")
            df = M.join_merge(spark.table(table), updates, keys, mode)
            plan = df._jdf.queryExecution().executedPlan().toString()
            side = plan[plan.index("SortMergeJoin"):]
            # two exchanges in all, both of the updates: their own aggregate's, and at most one to the buckets
            left = side[:side.index("Batched: true")]
            assert "Exchange" not in left and "Bucketed: true" in plan.replace("SelectedBucketsCount: 4 out of 4", "Bucketed: true")
            merged = {r["user_id"]: r["click_count"] for r in M.merge_bucketed(spark, table, updates, keys, mode, 4).collect()}
            assert len(merged) == 2500
        assert merged[10] == 10 and merged[1600] == 1 and merged[2400] == 1
        assert [c.name for c in spark.catalog.listTables() if c.name.startswith(table)] == [table]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


@pytest.mark.parametrize("name", ["top10_category_session", "ad_province_top3", "area_top3_product"])
def test_top_k_is_limited_before_the_shuffle(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan


def test_session_aggregation_is_partial(spark):
    plan = _plan(QUERIES["session_aggregate"](spark, SF_SMALL))
    assert "partial_min" in plan and "partial_collect_set" in plan


def _final_plan(df) -> str:
    """The plan that ran, without the first one AQE prints below it."""
    df.collect()
    return _plan(df).split("== Initial Plan ==")[0]


def _event_scans(plan: str) -> int:
    return sum("FileScan" in line and "events.parquet" in line for line in plan.splitlines())


def test_stored_dates_prune_partitions(spark, scratch):
    from visitflow.sources.visit_tables import EventTables, store_visit_tables
    t = store_visit_tables(EventTables(spark, SF_SMALL), f"{scratch}/tables")
    plan = _plan(t.actions("2024-01-10", "2024-01-12"))
    pruned = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "date" in pruned and "2024-01-10" in pruned and "2024-01-12" in pruned
    files = {f.split("date=")[1][:10] for f in t.actions("2024-01-10", "2024-01-12").inputFiles()}
    assert len(t.stored("user_visit_action").inputFiles()) >= 25 and files


@pytest.mark.parametrize("name", ["filter_keywords", "filter_categories", "session_aggr_stat", "area_top3_product"])
def test_no_sets_are_collected(spark, name):
    plan = _final_plan(QUERIES[name](spark, SF_SMALL))
    assert "collect_set" not in plan


def test_keyword_conditions_fold_into_the_aggregate(spark):
    plan = _final_plan(catalog.kept_sessions(catalog.Tables(spark, SF_SMALL), catalog.FILTER_PARAMS["filter_all"]))
    assert "collect_set" not in plan and "bool_or" in plan.replace("max(", "bool_or(")
    assert _event_scans(plan) == 1


def test_reports_share_one_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    # actions of kept sessions: one scan for the sessions, one for their actions
    for name, scans in (("top10_category_session", 2), ("area_top3_product", 1), ("session_random_extract", 2)):
        plan = _final_plan(QUERIES[name](spark, SF_SMALL))
        assert _event_scans(plan) == scans, (name, _event_scans(plan))
        assert "ReusedExchange" in plan, name
