"""Actions of kept sessions (J2) and the session_detail projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# session_detail result columns after taskid, in insert order.
DETAIL_COLUMNS = (
    ("user_id", "userid"), ("session_id", "sessionid"), ("page_id", "pageid"),
    ("action_time", "actionTime"), ("search_keyword", "searchKeyword"),
    ("click_category_id", "clickCategoryId"), ("click_product_id", "clickProductId"),
    ("order_category_ids", "orderCategoryIds"), ("order_product_ids", "orderProductIds"),
    ("pay_category_ids", "payCategoryIds"), ("pay_product_ids", "payProductIds"),
)


def kept_actions(actions: DataFrame, kept_sessions: DataFrame) -> DataFrame:
    """Actions whose session passed the filter.

    A left-semi join on session_id: each action appears once, as there is one
    aggregate row per session. Spark plans it from the sizes it knows (jobs
    store the kept sessions first): a small id list is broadcast, else both
    sides shuffle and AQE splits a hot session's partition.
    """
    return actions.join(kept_sessions.select("session_id"), "session_id", "left_semi")


def session_detail(actions: DataFrame, kept_sessions: DataFrame) -> DataFrame:
    """The 11 detail columns (taskid is added by the job that writes them)."""
    return kept_actions(actions, kept_sessions).select(
        *[F.col(src).alias(dst) for src, dst in DETAIL_COLUMNS])
