"""Page one-step conversion (C4).

For a target flow p1, p2, ..., pn the rate of step ``pi -> pi+1`` is the
number of times a session's next action (by time, then the table's tie-break)
goes from pi to pi+1, divided by the page views of p1 for the first step and by
the previous step's count afterwards; 0.0 when the denominator is 0.

Every action is one move: from its page to the page of its session's next
action, or to none. Moves counted by (from, to) hold the pairs and the page
views, so the actions are windowed once.

No window spans a session. ``lead`` runs inside pieces of a session: 10-minute
chunks, and where a chunk is crowded, runs of whole seconds of about
``limit`` actions. A second that is crowded by itself splits by ranges of the tie-break
column. The last action of a piece finds its successor through the first
actions of the session's pieces, one row per piece. An action without a page
takes its place in the order but forms no pair.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import ratio
from ..session import small_frame

CHUNK_SECONDS = 600
PIECE_ROWS = 100_000
RATE_COLUMNS = ("step", "from_page", "to_page", "pair_count", "convert_rate")
PIECE = ("chunk", "part", "alone", "range")


def page_views(actions: DataFrame, order_cols: Sequence[str] = ("action_ts", "event_id"), by: Sequence[str] = ()) -> DataFrame:
    """The columns that page flows need, narrow enough to be stored."""
    return actions.select(*by, "session_id", *dict.fromkeys((*order_cols, "page_id")))


def crowded_seconds(rows: DataFrame, keys: Sequence[str], limit: int) -> DataFrame:
    """Seconds of crowded chunks: (keys, sec, part, alone, low, width), one row per second.

    An aggregate with partial combine; its windows hold a chunk's seconds, 600
    rows at most. Without a crowded chunk the table is empty.
    """
    seconds = rows.groupBy(*keys, "chunk", "sec").agg(F.count(F.lit(1)).alias("n"), F.min("tie").alias("low"), F.max("tie").alias("high"))
    chunk = Window.partitionBy(*keys, "chunk")
    upto = chunk.orderBy("sec").rowsBetween(Window.unboundedPreceding, -1)
    placed = seconds.select("*", F.sum("n").over(chunk).alias("total"), F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"))
    pieces = F.ceil(F.col("n") / limit)
    return placed.where(F.col("total") > limit).select(
        *keys, "sec", F.floor(F.col("before") / limit).alias("part"), (F.col("n") > limit).cast("int").alias("alone"),
        F.when(F.col("n") > limit, F.col("low")).alias("low"),
        F.ceil((F.col("high").cast("double") - F.col("low") + 1) / pieces).alias("width"))


def _in_pieces(actions: DataFrame, order_cols: Sequence[str], keys: Sequence[str], chunk_seconds: int, limit: int) -> DataFrame:
    sec = F.unix_timestamp(F.col(order_cols[0]))
    rows = actions.select(*keys, *order_cols, *[c for c in ("page_id",) if c not in order_cols], sec.alias("sec"),
                          F.floor(sec / chunk_seconds).alias("chunk"), F.col(order_cols[1]).cast("bigint").alias("tie"))
    crowd = crowded_seconds(rows, keys, limit)
    rows = rows.join(crowd, [*keys, "sec"], "left")
    # within a crowded second: ranges of the tie-break, nulls first
    inside = F.when(F.col("low").isNotNull(), F.coalesce(F.floor((F.col("tie") - F.col("low")) / F.col("width")), F.lit(-1)))
    return rows.select(*keys, "chunk", F.coalesce("part", F.lit(0)).alias("part"), F.coalesce("alone", F.lit(0)).alias("alone"),
                       F.coalesce(inside, F.lit(0)).alias("range"), *order_cols, *[c for c in ("page_id",) if c not in order_cols])


def page_moves(actions: DataFrame, order_cols: Sequence[str] = ("action_ts", "event_id"), by: Sequence[str] = (),
               chunk_seconds: int = CHUNK_SECONDS, limit: int = PIECE_ROWS) -> DataFrame:
    """(by, from_page, to_page, follows, n): every action once; ``follows`` is false for the last of a session."""
    keys = [*by, "session_id"]
    rows = _in_pieces(actions, order_cols, keys, chunk_seconds, limit)
    inside = Window.partitionBy(*keys, *PIECE).orderBy(*order_cols)
    # a struct tells "next action without a page" from "no next action"
    rows = rows.select(*keys, *PIECE, "page_id", F.lead(F.struct("page_id")).over(inside).alias("next"),
                       F.row_number().over(inside).alias("nr"))
    within = rows.where("next IS NOT NULL").select(*by, F.col("page_id").alias("from_page"), F.col("next.page_id").alias("to_page"),
                                                   F.lit(True).alias("follows"))
    ends = rows.where("nr = 1 OR next IS NULL").groupBy(*keys, *PIECE).agg(
        F.max(F.when(F.col("nr") == 1, F.col("page_id"))).alias("first"),
        F.max(F.when(F.col("next").isNull(), F.col("page_id"))).alias("last"))
    over = Window.partitionBy(*keys).orderBy(*PIECE)
    across = ends.select(*by, F.col("last").alias("from_page"), F.lead(F.struct("first")).over(over).alias("next")).select(
        *by, "from_page", F.col("next.first").alias("to_page"), F.col("next").isNotNull().alias("follows"))
    return within.unionByName(across).groupBy(*by, "from_page", "to_page", "follows").agg(F.count(F.lit(1)).alias("n"))


def page_pair_counts(actions: DataFrame, order_cols: Sequence[str] = ("action_ts", "event_id"),
                     chunk_seconds: int = CHUNK_SECONDS, limit: int = PIECE_ROWS) -> DataFrame:
    """(from_page, to_page, pair_count) over all sessions."""
    moves = page_moves(actions, order_cols, (), chunk_seconds, limit)
    return moves.where("follows AND from_page IS NOT NULL AND to_page IS NOT NULL").select(
        "from_page", "to_page", F.col("n").alias("pair_count"))


def flow_steps(spark, flow: Sequence[int]) -> DataFrame:
    """(step, from_page, to_page) of one flow, a local relation."""
    return small_frame(spark, [(i + 1, int(a), int(b)) for i, (a, b) in enumerate(zip(flow[:-1], flow[1:]))],
                       "step int, from_page bigint, to_page bigint")


def task_flow_steps(tasks: DataFrame) -> DataFrame:
    """(task_id, step, from_page, to_page) of every task's ``targetPageFlow`` (comma text) of two pages or more."""
    pages = F.transform(F.split("targetPageFlow", ","), lambda p: p.try_cast("bigint"))
    steps = tasks.select("task_id", pages.alias("pages")).where(F.size("pages") > 1)
    steps = steps.select("task_id", "pages", F.posexplode(F.slice("pages", F.lit(2), F.size("pages") - 1)).alias("at", "to_page"))
    return steps.select("task_id", (F.col("at") + 1).alias("step"), F.get("pages", F.col("at")).alias("from_page"), "to_page")


def rates_of_moves(moves: DataFrame, steps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per flow step (by, step, from_page, to_page, pair_count, convert_rate).

    The moves of each step's page are summed twice in one aggregate: those to
    the step's next page, and all of them (its views, the first step's
    denominator). Windows hold one flow's steps.
    """
    some = moves.select(*by, F.col("from_page").alias("page"), F.col("to_page").alias("next_page"), "follows", "n")
    same = [F.col("s.from_page") == F.col("m.page"), *[F.col(f"s.{c}") == F.col(f"m.{c}") for c in by]]
    found = steps.alias("s").join(some.alias("m"), same, "left")
    zero = F.lit(0).cast("bigint")
    counted = found.groupBy(*[F.col(f"s.{c}").alias(c) for c in (*by, "step", "from_page", "to_page")]).agg(
        F.coalesce(F.sum(F.when(F.col("follows") & (F.col("next_page") == F.col("s.to_page")), F.col("n"))), zero).alias("pair_count"),
        F.coalesce(F.sum("n"), zero).alias("views"))
    prev = F.lag("pair_count").over(Window.partitionBy(*by).orderBy("step"))
    return counted.withColumn("prev", F.when(F.col("step") == 1, F.col("views")).otherwise(prev)).select(
        *by, "step", "from_page", "to_page", "pair_count", ratio(F.col("pair_count"), F.col("prev")).alias("convert_rate"))


def convert_rates(actions: DataFrame, flow: Sequence[int], order_cols: Sequence[str] = ("action_ts", "event_id"),
                  limit: int = PIECE_ROWS) -> DataFrame:
    """C4, long form: one row per step of ``flow``. ``actions`` is read for the counts and for the moves: store it first."""
    return rates_of_moves(page_moves(actions, order_cols, limit=limit), flow_steps(actions.sparkSession, flow))


def convert_rate_text(rates: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``convertRate`` = ``a_b=rate|b_c=rate|...`` in step order, one row or one for each ``by``."""
    item = F.concat(F.col("from_page").cast("string"), F.lit("_"), F.col("to_page").cast("string"),
                    F.lit("="), F.col("convert_rate").cast("string"))
    ordered = F.array_sort(F.collect_list(F.struct(F.col("step"), item.alias("t"))))
    return rates.groupBy(*by).agg(F.array_join(F.transform(ordered, lambda s: s["t"]), "|").alias("convertRate"))
