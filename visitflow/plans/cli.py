"""Command line: run one task of the derived task table (or given JSON parameters), or a stream.

  python -m visitflow.plans.cli session --data DIR --out DIR --task-id 19737
  python -m visitflow.plans.cli page --data DIR --out DIR --task-id 1 --params '{"targetPageFlow":["1,2,3"]}'
  python -m visitflow.plans.cli session --tables DIR --out DIR --task-id 19737
  python -m visitflow.plans.cli tasks --data DIR --out DIR
  python -m visitflow.plans.cli ad-stream --source DIR [--state DIR] [--threshold 100] [--once]
  python -m visitflow.plans.cli trend-stream --source DIR [--state DIR] [--delay "10 minutes"] [--once]
"""

from __future__ import annotations

import argparse
import sys

from ..session import build_session
from ..sources.tasks import TaskParams, load_task_params
from ..sources.visit_tables import EventTables, VisitTables
from .jobs import JOBS, SessionOptions, run_task_set


def stream_main(argv) -> None:
    from ..streaming import run_to_completion, start_ad_stream, start_trend_stream
    ap = argparse.ArgumentParser(prog="visitflow")
    ap.add_argument("stream", choices=("ad-stream", "trend-stream"))
    ap.add_argument("--source", required=True, help="folder of log text files (or Kafka with --kafka)")
    ap.add_argument("--kafka", help="bootstrap servers; --source is then the topic")
    ap.add_argument("--state", help="state folder; default under spark.checkpoint.dir")
    ap.add_argument("--threshold", type=int, default=100)
    ap.add_argument("--delay", default="10 minutes")
    ap.add_argument("--once", action="store_true", help="process what is there and stop (availableNow)")
    ap.add_argument("--master")
    a = ap.parse_args(argv)
    spark = build_session(a.master)
    fmt, opts = ("kafka", {"kafka.bootstrap.servers": a.kafka, "subscribe": a.source}) if a.kafka else ("text", {})
    trigger = {"availableNow": True} if a.once else None
    if a.stream == "ad-stream":
        q = start_ad_stream(spark, a.source, a.state, a.threshold, fmt=fmt, options=opts, trigger=trigger)
    else:
        q = start_trend_stream(spark, a.source, a.state, a.delay, fmt=fmt, options=opts, trigger=trigger)
    if a.once:
        run_to_completion(q)
    else:
        q.awaitTermination()


def main(argv=None) -> None:
    argv = list(sys.argv[1:] if argv is None else argv)
    if argv and argv[0] in ("ad-stream", "trend-stream"):
        return stream_main(argv)
    ap = argparse.ArgumentParser(prog="visitflow",
                                 epilog="streams: visitflow ad-stream --help, visitflow trend-stream --help")
    ap.add_argument("job", choices=[*sorted(JOBS), "tasks"], help="'tasks': every task of the task table at once")
    where = ap.add_mutually_exclusive_group(required=True)
    where.add_argument("--data", help="folder of the test tables")
    where.add_argument("--tables", help="folder of the stored visit tables (user_visit_action, user_info, ...)")
    where.add_argument("--database", help="catalog database that holds the stored visit tables")
    ap.add_argument("--out", required=True)
    ap.add_argument("--task-id", type=int, help="required but for the job 'tasks'")
    ap.add_argument("--params", help="task_param JSON (overrides the task table)")
    ap.add_argument("--tasks", help="parquet task table (task_id, task_param, ...); default: the source's own")
    ap.add_argument("--grain", default="day", choices=("day", "week", "month"))
    ap.add_argument("--clock", default="real", choices=("real", "value"))
    ap.add_argument("--as-of", help="seed session start/end with this time, like the reference's 'now'")
    ap.add_argument("--compat", action="store_true", help="reference's substring dedupe and null category 0")
    ap.add_argument("--extract-per-day", type=int, default=100)
    ap.add_argument("--seed", default="0")
    ap.add_argument("--format", default="parquet", help="result format: parquet, orc, json, csv or jdbc")
    ap.add_argument("--sink-option", action="append", default=[], metavar="KEY=VALUE",
                    help="writer option, e.g. url=jdbc:mysql://host/db (repeatable)")
    ap.add_argument("--master")
    a = ap.parse_args(argv)
    spark = build_session(a.master)
    opts = SessionOptions(grain=a.grain, clock=a.clock, as_of=a.as_of, compat_substring=a.compat,
                          compat_null_zero=a.compat, extract_per_day=a.extract_per_day, extract_seed=a.seed,
                          sink_format=a.format,
                          sink_options=tuple(tuple(o.split("=", 1)) for o in a.sink_option))
    source = EventTables(spark, a.data, a.grain, a.clock) if a.data else VisitTables(spark, a.tables, database=a.database)
    tasks = spark.read.parquet(a.tasks) if a.tasks else None
    if a.job == "tasks":
        paths = run_task_set(spark, source, a.out, tasks, opts)
    elif a.task_id is None:
        ap.error("--task-id is required")
    else:
        params = TaskParams.from_json(a.params) if a.params else load_task_params(source.tasks() if tasks is None else tasks, a.task_id)
        paths = JOBS[a.job](spark, source, a.task_id, params, a.out, opts)
    for name, path in paths.items():
        print(f"{name}\t{path}")


if __name__ == "__main__":
    main()
