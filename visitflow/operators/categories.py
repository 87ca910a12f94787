"""Top categories and their top sessions.

Both reports follow from one table of click, order and pay counts per
(category, session). It is one aggregate of the actions; Spark reads its
exchange twice instead of the actions (``ReusedExchange``). ``by`` columns, such
as a task id, give one report each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Result columns of top10_category and top10_category_session.
CATEGORY_COLUMNS = ("categoryid", "clickCount", "orderCount", "payCount")
SESSION_COLUMNS = ("categoryid", "sessionid", "clickCount")
COUNTS = CATEGORY_COLUMNS[1:]


def _items(text_col: str, kind: int):
    """(category, kind) structs of a comma id list (empty when the column is null)."""
    ids = F.coalesce(F.split(F.col(text_col), ","), F.array().cast("array<string>"))
    return F.transform(ids, lambda x: F.struct(x.try_cast("bigint").alias("c"), F.lit(kind).alias("kind")))


def session_category_counts(actions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, categoryid, sessionid, clickCount, orderCount, payCount) of every category a session met.

    One pass: every action yields its (category, kind) items through one
    ``inline``, then a single aggregate with partial combine. All three counts
    stay in every row, so that all readers share the aggregate's exchange.
    """
    click = F.col("click_category_id")
    items = F.concat(
        F.when(click.isNotNull(), F.array(F.struct(click.alias("c"), F.lit(0).alias("kind"))))
         .otherwise(F.array().cast("array<struct<c:bigint,kind:int>>")),
        _items("order_category_ids", 1), _items("pay_category_ids", 2))
    return (actions.select(*by, F.col("session_id").alias("sessionid"), F.inline(items))
            .where(F.col("c").isNotNull())
            .groupBy(*by, F.col("c").alias("categoryid"), "sessionid")
            .agg(*[F.count_if(F.col("kind") == n).alias(name) for n, name in enumerate(COUNTS)])
            .where("clickCount + orderCount + payCount > 0"))


def top_of_counts(counts: DataFrame, k: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """The k categories ordered by clicks, orders, pays (desc), then id.

    For the whole table ``orderBy().limit(k)`` plans as TakeOrderedAndProject:
    each task keeps k rows. For each ``by``, the row_number filter runs as a
    partial WindowGroupLimit.
    """
    totals = counts.groupBy(*by, "categoryid").agg(*[F.sum(c).alias(c) for c in COUNTS])
    order = [*[F.desc(c) for c in COUNTS], F.asc("categoryid")]
    if not by:
        return totals.orderBy(*order).limit(k).select(*CATEGORY_COLUMNS)
    rn = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return totals.withColumn("rn", rn).where(F.col("rn") <= k).select(*by, *CATEGORY_COLUMNS)


def top_sessions_of_counts(counts: DataFrame, top: DataFrame, k: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Per top category the k sessions with most clicks on it (ties: session id).

    Without ``by``, ``top`` comes from ``limit(k)``: at most k rows, a proven
    bound for the broadcast hint. With it Spark's size check decides.
    """
    top = top.select(*by, "categoryid")
    rows = counts.join(top if by else F.broadcast(top), [*by, "categoryid"], "left_semi").where("clickCount > 0")
    w = Window.partitionBy(*by, "categoryid").orderBy(F.desc("clickCount"), F.asc("sessionid"))
    return rows.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k).select(*by, *SESSION_COLUMNS)


def top_categories(actions: DataFrame, k: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """C2 from actions."""
    return top_of_counts(session_category_counts(actions, by), k, by)


def top_sessions_per_category(actions: DataFrame, top: DataFrame | None = None, k: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """C3 from actions; ``top`` defaults to their k top categories."""
    counts = session_category_counts(actions, by)
    return top_sessions_of_counts(counts, top_of_counts(counts, k, by) if top is None else top, k, by)
