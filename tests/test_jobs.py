"""End-to-end jobs write the same rows as the registered queries."""

from visitflow.plans import catalog as CAT
from visitflow.plans.jobs import SessionOptions, run_page_job, run_product_job, run_session_job
from visitflow.plans.sinks import read_result

from paths import SF_SMALL


def _rows(df, drop=("taskid",)):
    return sorted(tuple(r) for r in df.drop(*drop).collect())


def test_session_job_tables(spark, scratch):
    opts = SessionOptions(extract_per_day=CAT.EXTRACT_PER_DAY, extract_seed=CAT.EXTRACT_SEED)
    paths = run_session_job(spark, SF_SMALL, 7, CAT.WHOLE_PARAMS, scratch, opts)
    assert set(paths) == {"session_aggr_stat", "session_detail", "session_random_extract",
                          "top10_category", "top10_category_session"}
    for table, query in (("top10_category", CAT.q_top10_category),
                         ("top10_category_session", CAT.q_top10_category_session),
                         ("session_random_extract", CAT.q_session_random_extract)):
        assert _rows(read_result(spark, scratch, table, 7)) == _rows(query(spark, SF_SMALL), ()), table
    stat = read_result(spark, scratch, "session_aggr_stat", 7).collect()
    assert len(stat) == 1 and stat[0]["taskid"] == 7
    # rerunning the task replaces its rows instead of appending
    run_session_job(spark, SF_SMALL, 7, CAT.WHOLE_PARAMS, scratch, opts)
    assert read_result(spark, scratch, "session_aggr_stat", 7).count() == 1


def test_page_and_product_jobs(spark, scratch):
    run_page_job(spark, SF_SMALL, 3, CAT.WHOLE_PARAMS, scratch)
    text = read_result(spark, scratch, "page_split_convert_rate", 3).collect()
    assert len(text) == 1 and text[0]["convertRate"].startswith("1_2=")
    assert _rows(read_result(spark, scratch, "page_split_convert_steps", 3)) == \
        _rows(CAT.q_page_convert_rate(spark, SF_SMALL), ())
    run_product_job(spark, SF_SMALL, 4, CAT.WHOLE_PARAMS, scratch)
    assert _rows(read_result(spark, scratch, "area_top3_product", 4)) == \
        _rows(CAT.q_area_top3_product(spark, SF_SMALL), ())


def test_cli_runs_a_derived_task(spark, scratch, capsys):
    from visitflow.plans.cli import main
    main(["product", "--data", SF_SMALL, "--out", scratch, "--task-id", "19725"])   # task of 2024-01-03
    printed = capsys.readouterr().out
    assert "area_top3_product" in printed
    assert read_result(spark, scratch, "area_top3_product", 19725).count() > 0


def test_a_failing_table_leaves_the_earlier_results(spark, scratch):
    import os
    import pytest
    from visitflow.plans.sinks import write_results
    good = CAT.q_top10_category(spark, SF_SMALL)
    write_results({"a": good, "b": good}, scratch, 9)
    before = _rows(read_result(spark, scratch, "a", 9))
    bad = spark.range(1).selectExpr("raise_error('no') AS x")
    with pytest.raises(Exception):
        write_results({"a": good.limit(1), "b": bad}, scratch, 9)
    assert _rows(read_result(spark, scratch, "a", 9)) == before == _rows(read_result(spark, scratch, "b", 9))
    assert os.listdir(f"{scratch}/_pending") == []
    write_results({"a": good.limit(1), "b": good}, scratch, 9)
    assert read_result(spark, scratch, "a", 9).count() == 1


def test_cli_on_stored_tables_and_all_tasks(spark, scratch, capsys):
    from visitflow.plans.cli import main
    from visitflow.sources.visit_tables import EventTables, store_visit_tables
    store_visit_tables(EventTables(spark, SF_SMALL), f"{scratch}/tables")
    main(["session", "--tables", f"{scratch}/tables", "--out", f"{scratch}/a", "--task-id", "19737"])
    main(["session", "--data", SF_SMALL, "--out", f"{scratch}/b", "--task-id", "19737"])
    main(["tasks", "--data", SF_SMALL, "--out", f"{scratch}/c"])
    assert "area_top3_product" in capsys.readouterr().out
    for table in ("session_aggr_stat", "session_random_extract", "top10_category", "top10_category_session", "session_detail"):
        one = [_rows(read_result(spark, f"{scratch}/{x}", table, 19737)) for x in "bc"]
        assert one[0] == one[1], table
        if table != "session_detail":                    # its time text is the stored one
            assert _rows(read_result(spark, f"{scratch}/a", table, 19737)) == one[0], table


def test_cli_stream_once(spark, scratch):
    import os
    from visitflow.plans.cli import main
    from visitflow.sources import adapters as A
    from visitflow.sources.tables import Tables
    from visitflow.streaming import AdStateStore
    t = Tables(spark, SF_SMALL)
    src = os.path.join(scratch, "src")
    A.ad_log_lines(t.events, t.nation, t.region).write.text(src)
    main(["ad-stream", "--source", src, "--state", os.path.join(scratch, "state"), "--threshold", "2", "--once"])
    assert AdStateStore(spark, os.path.join(scratch, "state")).state().stat.count() > 0


def test_write_result_other_file_format(spark, scratch):
    from visitflow.plans.sinks import write_result
    df = CAT.q_top10_category(spark, SF_SMALL)
    write_result(df, scratch, "top10_category", 5, fmt="orc")
    back = read_result(spark, scratch, "top10_category", 5, fmt="orc")
    assert _rows(back) == _rows(df, ())
