"""Views in the reference's input shapes, derived from the test tables.

The test tables hold an ``events`` stream and TPC-H dimensions. These adapters
map them onto ``user_visit_action``, ``user_info``, ``product_info``,
``city_info`` and the ad-log text line. Every column is a plain expression
over one scan, so projections and filters reach the parquet reader.

Sessions: ``session_id = user_id || '_' || period`` with a grain of day, week
(Monday start) or month. Clocks: ``real`` uses ``ts`` truncated to seconds;
``value`` places the action at midnight of its date plus ``floor(value)``
seconds (gives short visits that reach the small visit-length buckets).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import DATE_FORMAT, TIME_FORMAT

GRAINS = ("day", "week", "month")
CLOCKS = ("real", "value")


def sql_text(v: str) -> str:
    """A Spark SQL string literal."""
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


_K = "TRY_CAST(get_json_object(props, '$.k') AS BIGINT)"   # bad JSON or text: NULL, not an error


def _k(props: Column) -> Column:
    return F.get_json_object(props, "$.k").try_cast("bigint")


def _id_list_sql(k: str) -> str:
    """``k`` as text, or ``k,(k+1)%100`` when ``k % 3 = 0`` (two-element lists)."""
    return (f"CASE WHEN {k} % 3 = 0 THEN concat(CAST({k} AS STRING), ',', CAST(({k} + 1) % 100 AS STRING)) "
            f"ELSE CAST({k} AS STRING) END")


PERIOD_SQL = {
    "day": "date_format(ts, 'yyyy-MM-dd')",
    "week": "date_format(date_trunc('week', ts), 'yyyy-MM-dd')",
    "month": "date_format(ts, 'yyyy-MM')",
}
SECONDS_SQL = {
    "real": "unix_timestamp(ts)",
    "value": "unix_timestamp(date_trunc('day', ts)) + CAST(floor(value) AS BIGINT)",
}


def events_in_dates(events: DataFrame, start_date: str | None = None,
                    end_date: str | None = None) -> DataFrame:
    """Date range on the raw ``ts`` (both ends inclusive, each optional).

    Written as a half-open timestamp range so that it lands in the parquet
    scan's PushedFilters and prunes row groups.
    """
    cond = []
    if start_date:
        lo = dt.date.fromisoformat(start_date)
        cond.append(f"ts >= TIMESTAMP_NTZ '{lo.isoformat()} 00:00:00'")
    if end_date:
        hi = dt.date.fromisoformat(end_date) + dt.timedelta(days=1)
        cond.append(f"ts < TIMESTAMP_NTZ '{hi.isoformat()} 00:00:00'")
    return events.where(" AND ".join(cond)) if cond else events


def user_visit_action(events: DataFrame, grain: str = "day", clock: str = "real",
                      start_date: str | None = None, end_date: str | None = None) -> DataFrame:
    """``user_visit_action`` rows (13 reference columns + ``action_ts`` + ``event_id``).

    Stated as SQL expressions over one scan: one plan-building round trip,
    and every column is a projection Catalyst can prune.
    """
    if grain not in PERIOD_SQL:
        raise ValueError(f"grain must be one of {GRAINS}, got {grain!r}")
    if clock not in SECONDS_SQL:
        raise ValueError(f"clock must be one of {CLOCKS}, got {clock!r}")
    ev = events_in_dates(events, start_date, end_date)
    # k and the action second first, in their own projection: the JSON text is parsed
    # once per row instead of once per derived column (CASE branches are not shared).
    base = ev.selectExpr("event_id", "ts", "user_id", "event_type", f"{_K} AS k",
                         f"{SECONDS_SQL[clock]} AS action_sec")
    k, ts = "k", "timestamp_seconds(action_sec)"
    ids = _id_list_sql(k)
    return base.selectExpr(
        f"date_format(ts, '{DATE_FORMAT}') AS date",
        "user_id",
        f"concat(CAST(user_id AS STRING), '_', {PERIOD_SQL[grain]}) AS session_id",
        f"{k} % 10 AS page_id",
        f"date_format({ts}, '{TIME_FORMAT}') AS action_time",
        f"CASE WHEN event_type = 'view' THEN concat('kw', CAST({k} % 10 AS STRING)) END AS search_keyword",
        f"CASE WHEN event_type = 'click' THEN {k} END AS click_category_id",
        "CASE WHEN event_type = 'click' THEN event_id % 100 END AS click_product_id",
        f"CASE WHEN event_type = 'signup' THEN {ids} END AS order_category_ids",
        "CASE WHEN event_type = 'signup' THEN CAST(event_id % 100 AS STRING) END AS order_product_ids",
        f"CASE WHEN event_type = 'purchase' THEN {ids} END AS pay_category_ids",
        "CASE WHEN event_type = 'purchase' THEN CAST(event_id % 100 AS STRING) END AS pay_product_ids",
        "event_id % 25 AS city_id",
        f"{ts} AS action_ts",
        "event_id")


_USER_ATTRIBUTES = (
    "c_custkey AS user_id",
    "concat('user', CAST(c_custkey AS STRING)) AS username",
    "c_name AS name",
    "CAST(c_custkey % 60 AS INT) AS age",
    "concat('professional', CAST(c_custkey % 100 AS STRING)) AS professional",
    "CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex",
)


def user_attributes(customer: DataFrame) -> DataFrame:
    """``user_info`` without ``city``: every attribute that needs no other table."""
    return customer.selectExpr(*_USER_ATTRIBUTES)


def user_info(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """``user_info`` from customer and nation.

    No broadcast hints on dimensions: Spark broadcasts a side when its size
    estimate is under ``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks
    with runtime sizes) and sort-merge joins beyond it.
    """
    return (customer
            .join(nation.select("n_nationkey", "n_name"),
                  F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .selectExpr(*_USER_ATTRIBUTES[:5], "n_name AS city", _USER_ATTRIBUTES[5]))


def product_info(part: DataFrame) -> DataFrame:
    """``product_info`` with the JSON ``extend_info`` text of the reference."""
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.concat(F.lit('{"product_status": '), (F.col("p_partkey") % 2).cast("string"), F.lit("}"))
         .alias("extend_info"))


def city_info(nation: DataFrame, region: DataFrame) -> DataFrame:
    """city_id -> city_name, area (nations as cities, regions as areas)."""
    return (nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
            .select(F.col("n_nationkey").cast("bigint").alias("city_id"),
                    F.col("n_name").alias("city_name"),
                    F.col("r_name").alias("area")))


def ad_log_lines(events: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Ad-click log lines ``epochMillis province city userId adId`` (click events only).

    The user's city is the nation ``user_id % 25``; the province its region
    with spaces replaced by ``_``.
    """
    geo = (nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
           .select(F.col("n_nationkey").cast("bigint").alias("geo_key"),
                   F.regexp_replace("r_name", " ", "_").alias("province"),
                   F.col("n_name").alias("city")))
    clicks = events.where(F.col("event_type") == "click")
    return (clicks.join(geo, (F.col("user_id") % 25) == F.col("geo_key"))
            .select(F.concat_ws(" ",
                                F.unix_millis(F.col("ts").cast("timestamp")).cast("string"),
                                F.col("province"), F.col("city"),
                                F.col("user_id").cast("string"),
                                (_k(F.col("props")) % 10).cast("string")).alias("value")))


def register_views(tables, grain: str = "day", clock: str = "real") -> list[str]:
    """Temp views ``user_visit_action``, ``user_info``, ``product_info``, ``city_info``.

    Lets the reference's SQL (``select * from user_info``, the date-range
    query on ``user_visit_action``) run unchanged through ``spark.sql``.
    """
    views = {
        "user_visit_action": user_visit_action(tables.events, grain, clock),
        "user_info": user_info(tables.customer, tables.nation),
        "product_info": product_info(tables.part),
        "city_info": city_info(tables.nation, tables.region),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
