"""Session aggregation (A1-A10) and the user join.

One ``groupBy(session_id)`` with partial (map-side) aggregation: min/max/count
run in HashAggregate, the keyword and category sets in ObjectHashAggregate.
A session holding a large share of all rows is pre-combined in every map task,
so the shuffle carries one partial row per session and task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import TIME_FORMAT
from ..sources.tasks import TaskParams

SESSION_COLUMNS = ("session_id", "user_id", "search_keywords", "click_category_ids",
                   "start_ts", "end_ts", "visit_length", "step_length", "start_time")
HIT_COLUMNS = ("keyword_hit", "category_hit")
USER_COLUMNS = ("age", "professional", "city", "sex")


def _order_key(actions: DataFrame) -> Column:
    """Order of actions inside a session: time, then the event id where the table has one.

    Without an id, values of one second are told apart by their text, so the
    order stays defined.
    """
    ids = [F.col("event_id").alias("e")] if "event_id" in actions.columns else []
    return F.struct(F.col("action_ts").alias("t"), *ids)


def _substring_fold(items: Column) -> Column:
    """Reference dedupe: append ``x,`` unless ``x`` already occurs as a substring.

    ``items`` must be sorted by first occurrence. Only first occurrences
    matter (the buffer only grows), so feeding the distinct values in order
    of first appearance reproduces the row-by-row result.
    """
    folded = F.aggregate(items, F.lit(""),
                         lambda acc, x: F.when(F.contains(acc, x), acc)
                         .otherwise(F.concat(acc, x, F.lit(","))))
    trimmed = F.regexp_replace(folded, r"^,|,$", "")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, ","))


def _first_seen(actions: DataFrame, value: Column, name: str) -> DataFrame:
    """Per (session, value): the order key of the value's first occurrence.

    Bounded by the number of distinct values per session, so the later
    per-session array never grows with the number of rows.
    """
    return (actions.where(value.isNotNull() & (value.cast("string") != ""))
            .groupBy("session_id", value.cast("string").alias(name))
            .agg(F.min(_order_key(actions)).alias("first")))


def aggregate_sessions(actions: DataFrame, as_of: str | dt.datetime | None = None,
                       compat_substring: bool = False,
                       compat_null_zero: bool = False, params: TaskParams | None = None, sets: bool = True) -> DataFrame:
    """One row per session: ids, keyword/category sets, start/end, lengths.

    With a task's ``params`` its conditions on keywords and categories are
    folded into the aggregate: ``keyword_hit`` and ``category_hit`` say
    whether any action meets them (one bit per session and task instead of a
    set). With ``sets=False`` there are no sets at all: ``session_sets`` adds
    them to the sessions that need them.

    Defaults use the fixed rules: exact sets (sorted), nulls ignored, start and
    end from the data. ``as_of`` seeds start/end like the reference's "now";
    ``compat_substring`` and ``compat_null_zero`` reproduce its substring
    dedupe and its null-category-as-0 reading.
    """
    click_cat = F.col("click_category_id")
    if compat_null_zero:
        click_cat = F.coalesce(click_cat, F.lit(0).cast("bigint"))
    sec = F.unix_timestamp(F.col("action_ts"))
    base = actions.groupBy("session_id").agg(
        F.max("user_id").alias("user_id"),
        F.min(sec).alias("start_sec"),
        F.max(sec).alias("end_sec"),
        F.count(F.lit(1)).alias("step_length"),
        *_hits(params, click_cat, compat_substring),
        *([] if compat_substring or not sets else [
            F.array_sort(F.collect_set(F.when(F.col("search_keyword") != "", F.col("search_keyword"))))
             .alias("search_keywords"),
            F.array_sort(F.collect_set(click_cat)).alias("click_category_ids"),
        ]))
    if compat_substring:
        kw = _first_seen(actions, F.col("search_keyword"), "v")
        cat = _first_seen(actions, click_cat, "v")
        folded = []
        for name, part in (("search_keywords", kw), ("click_category_ids", cat)):
            folded.append(part.groupBy("session_id").agg(
                _substring_fold(F.transform(F.array_sort(F.collect_list(F.struct("first", "v"))),
                                            lambda s: s["v"])).alias(name)))
        base = base.join(folded[0], "session_id", "left").join(folded[1], "session_id", "left")
        base = (base.withColumn("search_keywords", F.coalesce("search_keywords", F.array().cast("array<string>")))
                .withColumn("click_category_ids",
                            F.transform(F.coalesce("click_category_ids", F.array().cast("array<string>")),
                                        lambda x: x.cast("bigint"))))
    start, end = F.col("start_sec"), F.col("end_sec")
    if as_of is not None:
        text = as_of.strftime("%Y-%m-%d %H:%M:%S") if isinstance(as_of, dt.datetime) else str(as_of)
        as_of_sec = F.unix_timestamp(F.lit(text))     # parsed in the session time zone
        start, end = F.least(start, as_of_sec), F.greatest(end, as_of_sec)
    return base.select(
        "session_id", "user_id", *[c for c in ("search_keywords", "click_category_ids", *HIT_COLUMNS) if c in base.columns],
        F.timestamp_seconds(start).alias("start_ts"),
        F.timestamp_seconds(end).alias("end_ts"),
        (end - start).alias("visit_length"),
        "step_length",
        F.date_format(F.timestamp_seconds(start), TIME_FORMAT).alias("start_time"))


def _hits(params: TaskParams | None, click_cat: Column, compat_substring: bool) -> list[Column]:
    """The task's conditions on single actions, as aggregates; the substring rule needs its folded sets instead."""
    if params is None or compat_substring:
        return []
    found = []
    for name, value, wanted in zip(HIT_COLUMNS, (F.col("search_keyword"), click_cat.cast("string")),
                                   (params.keywords, params.category_ids)):
        if wanted:
            found.append(F.coalesce(F.bool_or((value != "") & value.isin([str(w) for w in wanted])), F.lit(False)).alias(name))
    return found


def session_sets(sessions: DataFrame, actions: DataFrame, compat_null_zero: bool = False) -> DataFrame:
    """``sessions`` with their keyword and category sets, collected for these sessions alone.

    Values are made distinct per session by a spillable aggregate first; only
    then is a session's list put together.
    """
    click_cat = F.col("click_category_id")
    if compat_null_zero:
        click_cat = F.coalesce(click_cat, F.lit(0).cast("bigint"))
    rows = actions.join(sessions.select("session_id"), "session_id", "left_semi")
    pairs = rows.select("session_id", F.inline(F.array(
        F.struct(F.when(F.col("search_keyword") != "", F.col("search_keyword")).alias("kw"), F.lit(None).cast("bigint").alias("cat")),
        F.struct(F.lit(None).cast("string").alias("kw"), click_cat.alias("cat")))))
    pairs = pairs.where("kw IS NOT NULL OR cat IS NOT NULL").groupBy("session_id", "kw", "cat").agg(F.count(F.lit(1)).alias("n"))
    lists = pairs.groupBy("session_id").agg(F.array_sort(F.collect_list("kw")).alias("search_keywords"),
                                            F.array_sort(F.collect_list("cat")).alias("click_category_ids"))
    found = sessions.drop("search_keywords", "click_category_ids").join(lists, "session_id", "left")
    return found.withColumns({"search_keywords": F.coalesce("search_keywords", F.array().cast("array<string>")),
                              "click_category_ids": F.coalesce("click_category_ids", F.array().cast("array<bigint>"))})


def attach_user_info(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Add age, professional, city, sex; sessions of unknown users disappear.

    No broadcast hint: the user table grows with the data, so Spark chooses
    from its size estimate (and AQE from the real size at runtime).
    """
    return sessions.join(users.select("user_id", *USER_COLUMNS), "user_id", "inner")


def session_full_info(actions: DataFrame, users: DataFrame, **kw) -> DataFrame:
    """A1-A10 + J1 in one call."""
    return attach_user_info(aggregate_sessions(actions, **kw), users)


def format_sets(sessions: DataFrame) -> DataFrame:
    """Sets as comma text (the reference's result-table form); one projection, columns in place."""
    text = {"search_keywords": "array_join(search_keywords, ',') AS search_keywords",
            "click_category_ids": "array_join(transform(click_category_ids, x -> CAST(x AS STRING)), ',') "
                                  "AS click_category_ids"}
    return sessions.selectExpr(*[text.get(c, f"`{c}`") for c in sessions.columns])
