"""The stored visit tables: ``user_visit_action`` partitioned by date, ``user_info``, ``product_info``, ``task``.

``user_visit_action`` has the 13 columns below and no row id. Its times are
text whose hour may have one digit, so they are parsed, never compared as
text; its dates are padded text, so a task's range on them is a range of
partition folders. Actions of one second are ordered by page (see
``ACTION_ORDER``): rows that agree in it are alike to every report.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import parse_time
from . import adapters as A
from .tables import Tables

# Names and types of the stored tables.
ACTION_DDL = ("user_id BIGINT, session_id STRING, page_id BIGINT, action_time STRING, search_keyword STRING, "
              "click_category_id BIGINT, click_product_id BIGINT, order_category_ids STRING, order_product_ids STRING, "
              "pay_category_ids STRING, pay_product_ids STRING, city_id BIGINT, date STRING")
ACTION_COLUMNS = ("date", "user_id", "session_id", "page_id", "action_time", "search_keyword", "click_category_id",
                  "click_product_id", "order_category_ids", "order_product_ids", "pay_category_ids", "pay_product_ids", "city_id")
USER_DDL = ("user_id BIGINT, username STRING, name STRING, age INT, professional STRING, city STRING, sex STRING")
PRODUCT_DDL = "product_id BIGINT, product_name STRING, extend_info STRING"
TASK_DDL = ("task_id BIGINT, task_name STRING, create_time STRING, start_time STRING, finish_time STRING, task_type STRING, "
            "task_status STRING, task_param STRING")
CITY_DDL = "city_id BIGINT, city_name STRING, area STRING"                 # ours: the stored tables have no areas
DDL = {"user_visit_action": ACTION_DDL, "user_info": USER_DDL, "product_info": PRODUCT_DDL, "task": TASK_DDL, "city_info": CITY_DDL}
ACTION_ORDER = ("action_ts", "page_id")


def actions_in_dates(actions: DataFrame, start_date: str | None = None, end_date: str | None = None) -> DataFrame:
    """Rows of the dates, both ends inclusive and each optional, compared as text (a padded date sorts as text)."""
    if start_date:
        actions = actions.where(F.col("date") >= F.lit(start_date))
    if end_date:
        actions = actions.where(F.col("date") <= F.lit(end_date))
    return actions


class VisitTables:
    """Stored visit tables below one folder, or by their names in the session's catalog.

    ``root`` holds one folder per table in any file format Spark reads. With
    ``root=None`` the tables (``database.name`` or plain names) come from the
    catalog, Hive tables and temporary views included.
    """

    order = ACTION_ORDER

    def __init__(self, spark: SparkSession, root: str | None = None, fmt: str = "parquet", database: str | None = None):
        self.spark, self.root, self.fmt, self.database = spark, root and root.rstrip("/"), fmt, database

    def stored(self, name: str) -> DataFrame:
        if self.root is None:
            return self.spark.table(f"{self.database}.{name}" if self.database else name)
        # the declared types keep the partition column text
        return self.spark.read.schema(DDL[name]).format(self.fmt).load(f"{self.root}/{name}")

    def actions(self, start_date: str | None = None, end_date: str | None = None) -> DataFrame:
        """The 13 columns and ``action_ts``; an action whose time does not parse has none."""
        rows = actions_in_dates(self.stored("user_visit_action"), start_date, end_date)
        return rows.select(*ACTION_COLUMNS, parse_time("action_time").alias("action_ts"))

    def users(self) -> DataFrame:
        """R2."""
        return self.stored("user_info")

    def products(self) -> DataFrame:
        return self.stored("product_info")

    def cities(self) -> DataFrame:
        return self.stored("city_info")

    def tasks(self) -> DataFrame:
        """The task table."""
        return self.stored("task")

    def register(self) -> list[str]:
        """The tables as temporary views, for SQL texts written against them."""
        for name in DDL:
            self.stored(name).createOrReplaceTempView(name)
        return list(DDL)


class EventTables:
    """The same tables derived from the test data's events and dimensions; actions also have their event id."""

    order = ("action_ts", "event_id")

    def __init__(self, spark: SparkSession, data_dir: str, grain: str = "day", clock: str = "real"):
        self.spark, self.t, self.grain, self.clock = spark, Tables(spark, data_dir), grain, clock

    def actions(self, start_date: str | None = None, end_date: str | None = None) -> DataFrame:
        return A.user_visit_action(self.t.events, self.grain, self.clock, start_date, end_date)

    def users(self) -> DataFrame:
        return A.user_info(self.t.customer, self.t.nation)

    def products(self) -> DataFrame:
        return A.product_info(self.t.part)

    def cities(self) -> DataFrame:
        return A.city_info(self.t.nation, self.t.region)

    def tasks(self) -> DataFrame:
        from .tasks import derived_tasks
        return derived_tasks(self.t.events)


def unpadded_time(ts: str = "action_ts", date: str = "date"):
    """Time text as stored: hours below 10 have one digit, minutes and seconds two."""
    t = F.col(ts)
    return F.concat(F.col(date), F.lit(" "), F.hour(t).cast("string"), F.lit(":"), F.date_format(t, "mm"), F.lit(":"), F.date_format(t, "ss"))


def store_visit_tables(source: EventTables, root: str, fmt: str = "parquet") -> VisitTables:
    """Writes the tables of ``source`` below ``root`` in their stored form; actions partitioned by date.

    Rows are dealt to their date first, large dates over several files, so
    that a date's folder does not hold one small file of every task.
    """
    actions = source.actions().select(*[unpadded_time().alias(c) if c == "action_time" else F.col(c) for c in ACTION_COLUMNS])
    (actions.hint("rebalance", "date").write.mode("overwrite").partitionBy("date").format(fmt)
     .save(f"{root}/user_visit_action"))
    nothing = F.lit(None).cast("string")
    tasks = source.tasks().select("task_id", "task_name", nothing.alias("create_time"), nothing.alias("start_time"),
                                  nothing.alias("finish_time"), "task_type", nothing.alias("task_status"), "task_param")
    for name, df in (("user_info", source.users()), ("product_info", source.products()), ("city_info", source.cities()), ("task", tasks)):
        df.write.mode("overwrite").format(fmt).save(f"{root}/{name}")
    return VisitTables(source.spark, root, fmt)
