"""Many tasks over one scan: every task of a task table meets the actions of its dates.

Actions are first aggregated per (session, date), once for all tasks. A task's
range becomes one row per date (an interval join as a plain equi-join), and
the daily rows of a session are merged per (task, session). The reports are
the operators of single tasks with ``by=("task_id",)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import TIME_FORMAT
from .area import product_clicks
from .categories import COUNTS, session_category_counts
from .sessions import attach_user_info

BY = ("task_id",)


def task_days(tasks: DataFrame, actions: DataFrame) -> DataFrame:
    """(task_id, date): one row for each date of a task, of decoded ``tasks``.

    A missing end is the actions' own first or last date; these are looked up
    (one row) only when a task lacks one. Tasks whose range is empty have no rows.
    """
    start, end = F.col("startDate").try_cast("date"), F.col("endDate").try_cast("date")
    if not tasks.where("startDate IS NULL OR endDate IS NULL").isEmpty():
        low, high = actions.agg(F.min("date"), F.max("date")).first()
        start = F.when(F.col("startDate").isNull(), F.lit(low).cast("date")).otherwise(start)
        end = F.when(F.col("endDate").isNull(), F.lit(high).cast("date")).otherwise(end)
    ranged = tasks.select("task_id", start.alias("start"), end.alias("end")).where(F.col("start") <= F.col("end"))
    return ranged.select("task_id", F.explode(F.transform(F.sequence("start", "end"), lambda d: d.cast("string"))).alias("date"))


def daily_sessions(actions: DataFrame) -> DataFrame:
    """One row per (session, date): the partial aggregate that all tasks share."""
    sec = F.unix_timestamp("action_ts")
    return actions.groupBy("session_id", "date").agg(
        F.max("user_id").alias("user_id"), F.min(sec).alias("start_sec"), F.max(sec).alias("end_sec"),
        F.count(F.lit(1)).alias("steps"),
        F.collect_set(F.when(F.col("search_keyword") != "", F.col("search_keyword"))).alias("kws"),
        F.collect_set("click_category_id").alias("cats"))


def _any_of(values: Column, wanted: str) -> Column:
    """Whether the array of texts meets the task's comma list; true without a list."""
    return F.col(wanted).isNull() | F.coalesce(F.arrays_overlap(values, F.split(wanted, ",")), F.lit(False))


def _one_of(value: str, wanted: str) -> Column:
    return F.col(wanted).isNull() | F.coalesce(F.array_contains(F.split(wanted, ","), F.col(value).cast("string")), F.lit(False))


def task_sessions(actions: DataFrame, users: DataFrame, tasks: DataFrame) -> DataFrame:
    """(task_id, session ...) of every session that passes its task's conditions, with its sets and user.

    Conditions on keywords and categories are tested on the daily rows and
    folded by ``bool_or``. The task table is small; Spark broadcasts it by its
    size, and otherwise splits a crowded date by AQE's skew join.
    """
    wanted = tasks.select("task_id", "keywords", "categoryIds").join(task_days(tasks, actions), "task_id")
    met = daily_sessions(actions).join(wanted, "date")
    flat = F.array_sort(F.array_distinct(F.flatten(F.collect_list("kws"))))
    merged = met.groupBy("task_id", "session_id").agg(
        F.max("user_id").alias("user_id"), F.min("start_sec").alias("start_sec"), F.max("end_sec").alias("end_sec"),
        F.sum("steps").alias("step_length"),
        F.bool_or(_any_of(F.col("kws"), "keywords")).alias("keyword_hit"),
        F.bool_or(_any_of(F.transform("cats", lambda c: c.cast("string")), "categoryIds")).alias("category_hit"),
        flat.alias("search_keywords"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("cats")))).alias("click_category_ids"))
    full = attach_user_info(merged.where("keyword_hit AND category_hit"), users)
    limits = tasks.select("task_id", "startAge", "endAge", "professionals", F.col("cities").alias("task_cities"),
                          F.col("sex").alias("task_sex"))
    full = full.join(limits, "task_id")
    passes = ((F.col("startAge").isNull() | F.col("endAge").isNull() | F.coalesce(F.col("age").between(F.col("startAge"), F.col("endAge")), F.lit(False)))
              & _one_of("professional", "professionals") & _one_of("city", "task_cities") & _one_of("sex", "task_sex"))
    return full.where(passes).select(
        "task_id", "session_id", "user_id", "search_keywords", "click_category_ids",
        F.timestamp_seconds("start_sec").alias("start_ts"), F.timestamp_seconds("end_sec").alias("end_ts"),
        (F.col("end_sec") - F.col("start_sec")).alias("visit_length"), "step_length",
        F.date_format(F.timestamp_seconds("start_sec"), TIME_FORMAT).alias("start_time"), "age", "professional", "city", "sex")


def _inside(tasks: DataFrame) -> Column:
    """Whether ``date`` lies in the range of the task beside it (``startDate``, ``endDate``, each optional)."""
    start, end = F.col("startDate"), F.col("endDate")
    return (start.isNull() | (F.col("date") >= start)) & (end.isNull() | (F.col("date") <= end))


def of_kept_sessions(rows: DataFrame, kept: DataFrame, tasks: DataFrame, session: str = "session_id") -> DataFrame:
    """(task_id, rows ...): rows with a session and a date, once for each task that keeps the session and spans the date."""
    wanted = kept.select("task_id", F.col("session_id").alias(session)).join(tasks.select("task_id", "startDate", "endDate"), "task_id")
    return rows.join(wanted, session).where(_inside(tasks)).select("task_id", *rows.columns)


def task_category_counts(actions: DataFrame, kept: DataFrame, tasks: DataFrame) -> DataFrame:
    """Per (task, category, session) the click, order and pay counts, from one table of daily counts."""
    daily = session_category_counts(actions, ("date",))
    met = of_kept_sessions(daily, kept, tasks, "sessionid")
    return (met.groupBy("task_id", "categoryid", "sessionid").agg(*[F.sum(c).alias(c) for c in COUNTS])
            .where("clickCount + orderCount + payCount > 0"))


def task_product_clicks(actions: DataFrame, tasks: DataFrame) -> DataFrame:
    """Per (task, city, product) the clicks in the task's dates, from one table of daily counts."""
    daily = product_clicks(actions, ("date",))
    met = daily.join(task_days(tasks, actions), "date")
    return met.groupBy("task_id", "city_id", "productid").agg(F.sum("clickCount").alias("clickCount")).where("clickCount > 0")


def for_every_task(report: DataFrame, tasks: DataFrame) -> DataFrame:
    """``report`` with a row of zeros for each task without any session."""
    return tasks.select("task_id").join(report, "task_id", "left").na.fill(0)
