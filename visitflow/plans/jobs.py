"""End-to-end jobs: a task's parameters in, the reference's result tables out.

* session job:  actions -> sessions -> filter -> session_aggr_stat, session_detail,
                session_random_extract, top10_category, top10_category_session
* page job:     actions of kept sessions -> page_split_convert_rate
* product job:  actions in the date range -> area_top3_product
* task set:     all of these for every task of a task table, from one set of scans
* ad batch:     log lines -> the ad tables, through the same state store as the stream

Input is a source of visit tables (``sources.visit_tables``): the stored
tables, or a folder of the test data, from which they are derived. The kept
sessions and their actions are written once to the shared checkpoint folder and
every output reads them from there.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import area as AR
from ..operators import categories as CG
from ..operators import detail as D
from ..operators import extract as EX
from ..operators import pageflow as PF
from ..operators import predicates as P
from ..operators import sessions as S
from ..operators import stats as ST
from ..operators import task_set as TS
from ..operators.ads import parse_log
from ..sources.tasks import TaskParams, decode_task_params
from ..sources.visit_tables import EventTables, VisitTables
from ..streaming.ad_stream import AdStateStore
from .sinks import discard, materialize, write_results, write_task_results

Source = EventTables | VisitTables | str


@dataclass(frozen=True)
class SessionOptions:
    grain: str = "day"
    clock: str = "real"
    as_of: str | None = None
    compat_substring: bool = False
    compat_null_zero: bool = False
    extract_per_day: int = 100
    extract_seed: str = "0"
    top_k: int = 10
    sink_format: str = "parquet"                  # any DataFrameWriter format; "jdbc" appends
    sink_options: tuple[tuple[str, str], ...] = ()


def source_of(spark: SparkSession, data: Source, opts: SessionOptions = SessionOptions()) -> EventTables | VisitTables:
    """A folder of the test data stands for the tables derived from it."""
    return EventTables(spark, data, opts.grain, opts.clock) if isinstance(data, str) else data


def _write_all(outputs: dict[str, DataFrame], out_dir: str, task_id: int, opts: SessionOptions) -> dict[str, str]:
    return write_results(outputs, out_dir, task_id, opts.sink_format, dict(opts.sink_options))


def kept_sessions(source: EventTables | VisitTables, params: TaskParams, opts: SessionOptions = SessionOptions(),
                  sets: bool = False) -> DataFrame:
    """Sessions that pass the task's conditions; without sets, unless the substring rule needs them."""
    actions = source.actions(params.start_date, params.end_date)
    sessions = S.aggregate_sessions(actions, as_of=opts.as_of, compat_substring=opts.compat_substring,
                                    compat_null_zero=opts.compat_null_zero, params=params, sets=sets)
    return P.filter_sessions(S.attach_user_info(sessions, source.users()), params)


def kept_sessions_and_actions(source: EventTables | VisitTables, params: TaskParams,
                              opts: SessionOptions) -> tuple[DataFrame, DataFrame]:
    kept = materialize(kept_sessions(source, params, opts), "kept_sessions")
    kept_actions = materialize(D.kept_actions(source.actions(params.start_date, params.end_date), kept), "kept_actions")
    return kept, kept_actions


def run_session_job(spark: SparkSession, data: Source, task_id: int, params: TaskParams, out_dir: str,
                    opts: SessionOptions = SessionOptions()) -> dict[str, str]:
    kept, acts = kept_sessions_and_actions(source_of(spark, data, opts), params, opts)
    counts = materialize(CG.session_category_counts(acts), "category_counts")
    out = {
        "session_aggr_stat": ST.session_aggr_stat(kept),
        "session_detail": acts.select(*[acts[src].alias(dst) for src, dst in D.DETAIL_COLUMNS]),
        "session_random_extract": EX.random_extract(kept, opts.extract_per_day, opts.extract_seed,
                                                    None if opts.compat_substring else acts, opts.compat_null_zero),
        "top10_category": CG.top_of_counts(counts, opts.top_k),
        "top10_category_session": CG.top_sessions_of_counts(counts, CG.top_of_counts(counts, opts.top_k), opts.top_k),
    }
    try:
        return _write_all(out, out_dir, task_id, opts)
    finally:
        for df in (kept, acts, counts):
            discard(df)


def run_page_job(spark: SparkSession, data: Source, task_id: int, params: TaskParams, out_dir: str,
                 opts: SessionOptions = SessionOptions()) -> dict[str, str]:
    if not params.target_page_flow or len(params.target_page_flow) < 2:
        raise ValueError("targetPageFlow needs at least two pages")
    source = source_of(spark, data, opts)
    kept = kept_sessions(source, params, opts)
    acts = D.kept_actions(source.actions(params.start_date, params.end_date), kept)
    views = materialize(PF.page_views(acts, source.order), "page_views")               # read for its counts and its moves
    rates = materialize(PF.convert_rates(views, params.target_page_flow, source.order), "rates")      # a few rows, used twice
    try:
        return _write_all({"page_split_convert_rate": PF.convert_rate_text(rates),
                           "page_split_convert_steps": rates}, out_dir, task_id, opts)
    finally:
        for df in (views, rates):
            discard(df)


def run_product_job(spark: SparkSession, data: Source, task_id: int, params: TaskParams, out_dir: str,
                    opts: SessionOptions = SessionOptions()) -> dict[str, str]:
    source = source_of(spark, data, opts)
    top = AR.area_top_products(source.actions(params.start_date, params.end_date), source.cities(), source.products())
    return _write_all({"area_top3_product": top}, out_dir, task_id, opts)


def task_reports(source: EventTables | VisitTables, tasks: DataFrame, kept: DataFrame, opts: SessionOptions = SessionOptions(),
                 views: DataFrame | None = None) -> dict[str, DataFrame]:
    """Every result table for all decoded ``tasks``, ``task_id`` first, from their stored kept sessions.

    ``views`` are the stored page views of the tasks' sessions; by default
    they are derived anew.
    """
    actions, by = source.actions(), TS.BY
    counts = TS.task_category_counts(actions, kept, tasks)
    top = CG.top_of_counts(counts, opts.top_k, by)
    if views is None:
        views = task_views(source, tasks, kept)
    rates = PF.rates_of_moves(PF.page_moves(views, source.order, by), PF.task_flow_steps(tasks), by)
    detail = TS.of_kept_sessions(actions, kept, tasks)
    return {
        "session_aggr_stat": TS.for_every_task(ST.session_aggr_stat(kept, by), tasks),
        "session_detail": detail.select("task_id", *[F.col(src).alias(dst) for src, dst in D.DETAIL_COLUMNS]),
        "session_random_extract": EX.random_extract(kept, opts.extract_per_day, opts.extract_seed, by=by),
        "top10_category": top,
        "top10_category_session": CG.top_sessions_of_counts(counts, top, opts.top_k, by),
        "page_split_convert_rate": PF.convert_rate_text(rates, by),
        "page_split_convert_steps": rates,
        "area_top3_product": AR.top_of_clicks(TS.task_product_clicks(actions, tasks), source.cities(), source.products(), by=by),
    }


def task_views(source: EventTables | VisitTables, tasks: DataFrame, kept: DataFrame) -> DataFrame:
    """(task_id, session, order, page) of the actions of every task's kept sessions."""
    return PF.page_views(TS.of_kept_sessions(source.actions(), kept, tasks), source.order, TS.BY)


def run_task_set(spark: SparkSession, data: Source, out_dir: str, tasks: DataFrame | None = None,
                 opts: SessionOptions = SessionOptions()) -> dict[str, str]:
    """All result tables of every task of a task table (default: the source's own)."""
    source = source_of(spark, data, opts)
    decoded = materialize(decode_task_params(source.tasks() if tasks is None else tasks), "tasks")
    kept = materialize(TS.task_sessions(source.actions(), source.users(), decoded), "task_sessions")
    views = materialize(task_views(source, decoded, kept), "task_views")
    try:
        return write_task_results(task_reports(source, decoded, kept, opts, views), out_dir, opts.sink_format, dict(opts.sink_options))
    finally:
        for df in (decoded, kept, views):
            discard(df)


def run_ad_batch(spark: SparkSession, lines: DataFrame, state_root: str, batch_id: int,
                 threshold: int = 100) -> bool:
    """Apply one batch of ad-log lines to the state tables (same path as the stream)."""
    return AdStateStore(spark, state_root).apply(parse_log(lines), batch_id, threshold)


JOBS = {"session": run_session_job, "page": run_page_job, "product": run_product_job}
