"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each text runs on the views ``events customer nation region part ...`` and
must return the same rows, column names and types as the Spark query of the
same name. The adapters are re-stated in SQL once and composed as CTEs.
"""

from __future__ import annotations

from ..constants import STEP_BUCKETS, STEP_RATIO_COLUMNS, VISIT_BUCKETS, VISIT_RATIO_COLUMNS
from ..sources.tasks import TaskParams
from . import catalog as CAT

TS_FMT = "'%Y-%m-%d %H:%M:%S'"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _ts_text(sec: str) -> str:
    return f"strftime(make_timestamp(({sec}) * 1000000), {TS_FMT})"


def uva(grain="day", clock="real", params: TaskParams | None = None) -> str:
    """user_visit_action (+ action_sec, event_id) from events."""
    p = params or TaskParams()
    period = {"day": "strftime(ts, '%Y-%m-%d')",
              "week": "strftime(date_trunc('week', ts), '%Y-%m-%d')",
              "month": "strftime(ts, '%Y-%m')"}[grain]
    sec = {"real": "epoch_us(ts) // 1000000",
           "value": "epoch_us(date_trunc('day', ts)) // 1000000 + CAST(floor(value) AS BIGINT)"}[clock]
    where = []
    if p.start_date:
        where.append(f"ts >= TIMESTAMP '{p.start_date} 00:00:00'")
    if p.end_date:
        where.append(f"ts < TIMESTAMP '{p.end_date} 00:00:00' + INTERVAL 1 DAY")
    wh = ("WHERE " + " AND ".join(where)) if where else ""
    ids = ("CASE WHEN k % 3 = 0 THEN CAST(k AS VARCHAR) || ',' || CAST((k + 1) % 100 AS VARCHAR) "
           "ELSE CAST(k AS VARCHAR) END")
    return f"""
    SELECT strftime(ts, '%Y-%m-%d') AS date, user_id,
           CAST(user_id AS VARCHAR) || '_' || {period} AS session_id,
           k % 10 AS page_id,
           {_ts_text('action_sec')} AS action_time,
           CASE WHEN event_type = 'view' THEN 'kw' || CAST(k % 10 AS VARCHAR) END AS search_keyword,
           CASE WHEN event_type = 'click' THEN k END AS click_category_id,
           CASE WHEN event_type = 'click' THEN event_id % 100 END AS click_product_id,
           CASE WHEN event_type = 'signup' THEN {ids} END AS order_category_ids,
           CASE WHEN event_type = 'signup' THEN CAST(event_id % 100 AS VARCHAR) END AS order_product_ids,
           CASE WHEN event_type = 'purchase' THEN {ids} END AS pay_category_ids,
           CASE WHEN event_type = 'purchase' THEN CAST(event_id % 100 AS VARCHAR) END AS pay_product_ids,
           event_id % 25 AS city_id,
           action_sec, event_id
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, {sec} AS action_sec
          FROM events {wh}) e"""


USERS = """
    SELECT c_custkey AS user_id, 'user' || CAST(c_custkey AS VARCHAR) AS username, c_name AS name,
           CAST(c_custkey % 60 AS INTEGER) AS age,
           'professional' || CAST(c_custkey % 100 AS VARCHAR) AS professional,
           n_name AS city, CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""

CITIES = """
    SELECT CAST(n_nationkey AS BIGINT) AS city_id, n_name AS city_name, r_name AS area
    FROM nation LEFT JOIN region ON n_regionkey = r_regionkey"""


def sessions(grain="day", clock="real", params: TaskParams | None = None, as_of: str | None = None,
             compat: bool = False, by_value: bool = False) -> str:
    """Session aggregate with list columns kw_list / cat_list and start/end seconds.

    ``by_value``: in the substring fold, values of one second come in their own order, not the event ids'.
    """
    start, end = "min(action_sec)", "max(action_sec)"
    if as_of:
        a = f"epoch_us(TIMESTAMP '{as_of}') // 1000000"
        start, end = f"least(min(action_sec), {a})", f"greatest(max(action_sec), {a})"
    if not compat:
        kw = ("list_sort(coalesce(list(DISTINCT search_keyword) FILTER "
              "(WHERE search_keyword IS NOT NULL AND search_keyword <> ''), []))")
        cat = ("list_sort(coalesce(list(DISTINCT click_category_id) FILTER "
               "(WHERE click_category_id IS NOT NULL), []))")
        return f"""
    SELECT session_id, max(user_id) AS user_id, {kw} AS kw_list, {cat} AS cat_list,
           {start} AS start_sec, {end} AS end_sec, count(*) AS step_length
    FROM ({uva(grain, clock, params)}) a GROUP BY session_id"""
    # compat: substring fold over values ordered by first occurrence
    def fold(col):
        fe = "v" if by_value else "arg_min(event_id, struct_pack(a := action_sec, b := event_id))"
        return f"""(SELECT session_id,
              list_reduce(list_prepend('', list(v ORDER BY fa, fe)),
                          lambda acc, x: CASE WHEN contains(acc, x) THEN acc ELSE acc || x || ',' END) AS folded
            FROM (SELECT session_id, v, min(action_sec) AS fa, {fe} AS fe
                  FROM (SELECT session_id, CAST({col} AS VARCHAR) AS v, action_sec, event_id
                        FROM ({uva(grain, clock, params)}) a0
                        WHERE {col} IS NOT NULL AND CAST({col} AS VARCHAR) <> '') a1
                  GROUP BY session_id, v) a2
            GROUP BY session_id)"""
    def to_list(alias, cast):
        trimmed = f"regexp_replace(regexp_replace(coalesce({alias}.folded, ''), '^,', ''), ',$', '')"
        return (f"CASE WHEN {trimmed} = '' THEN [] ELSE "
                f"list_transform(string_split({trimmed}, ','), lambda x: CAST(x AS {cast})) END")
    return f"""
    SELECT b.session_id, b.user_id, {to_list('fk', 'VARCHAR')} AS kw_list, {to_list('fc', 'BIGINT')} AS cat_list,
           b.start_sec, b.end_sec, b.step_length
    FROM (SELECT session_id, max(user_id) AS user_id, {start} AS start_sec, {end} AS end_sec,
                 count(*) AS step_length
          FROM ({uva(grain, clock, params)}) a GROUP BY session_id) b
    LEFT JOIN {fold('search_keyword')} fk ON fk.session_id = b.session_id
    LEFT JOIN {fold('coalesce(click_category_id, 0)')} fc ON fc.session_id = b.session_id"""


def full_sessions(grain="day", clock="real", params: TaskParams | None = None, **kw) -> str:
    return f"""
    SELECT s.*, u.age, u.professional, u.city, u.sex
    FROM ({sessions(grain, clock, params, **kw)}) s JOIN ({USERS}) u ON s.user_id = u.user_id"""


def _in_list(col, values):
    vals = "[" + ", ".join(_q(str(v)) for v in values) + "]"
    return f"coalesce(list_has_any(string_split(CAST({col} AS VARCHAR), ','), {vals}), false)"


def _any_list(col, values, cast=False):
    c = f"list_transform({col}, lambda x: CAST(x AS VARCHAR))" if cast else col
    vals = "[" + ", ".join(_q(str(v)) for v in values) + "]"
    return f"coalesce(list_has_any({c}, {vals}), false)"


def predicate(p: TaskParams) -> str:
    parts = ["true"]
    if p.start_age is not None and p.end_age is not None:
        parts.append(f"coalesce(age BETWEEN {p.start_age} AND {p.end_age}, false)")
    if p.professionals:
        parts.append(_in_list("professional", p.professionals))
    if p.cities:
        parts.append(_in_list("city", p.cities))
    if p.sex:
        parts.append(_in_list("sex", p.sex))
    if p.keywords:
        parts.append(_any_list("kw_list", p.keywords))
    if p.category_ids:
        parts.append(_any_list("cat_list", p.category_ids, cast=True))
    return " AND ".join(parts)


def kept(p: TaskParams, grain="day", clock="real") -> str:
    return f"SELECT * FROM ({full_sessions(grain, clock, p)}) fs WHERE {predicate(p)}"


# The parameters of the task of 2024-01-15, by the rule of the derived tasks.
TASK_15 = TaskParams(start_date="2024-01-15", end_date="2024-01-21", start_age=15, end_age=45, sex=("female",),
                     keywords=("kw5", "kw8"), target_page_flow=(1, 2, 3))


def task_result(src: str) -> str:
    return f"SELECT CAST({CAT.TASK_ID} AS BIGINT) AS taskid, x.* FROM ({src}) x"


def task_actions(p: TaskParams) -> str:
    return f"SELECT * FROM ({uva(params=p)}) a WHERE session_id IN (SELECT session_id FROM ({kept(p)}) k)"


def shared_sessions(p: TaskParams) -> str:
    """kept(p) over session ids that several users share."""
    acts = uva(params=p)
    return kept(p).replace(acts, f"SELECT * REPLACE (CAST(user_id % 25 AS VARCHAR) || '_' || date AS session_id) "
                                 f"FROM ({acts}) shared")


def format_double(x: str) -> str:
    y = f"CAST({x} AS DOUBLE)"
    return (f"CASE WHEN isnan({y}) THEN 0.0 WHEN abs({y}) * 100.0 >= 4503599627370496.0 THEN {y} "
            f"ELSE sign({y}) * floor(abs({y}) * 100.0 + 0.5) / 100.0 END")


def session_rows(src: str, extra: str = "") -> str:
    return f"""
    SELECT session_id, user_id, array_to_string(kw_list, ',') AS search_keywords,
           array_to_string(cat_list, ',') AS click_category_ids,
           end_sec - start_sec AS visit_length, step_length,
           {_ts_text('start_sec')} AS start_time{extra}
    FROM ({src}) x"""


USER_EXTRA = ", age, professional, city, sex"


def _bucket_case(col, buckets):
    whens = " ".join(
        f"WHEN {col} >= {lo} THEN '{label}'" if hi is None else
        f"WHEN {col} BETWEEN {lo} AND {hi} THEN '{label}'" for label, lo, hi in buckets)
    return f"CASE {whens} END"


def bucket_distribution(which, grain, clock):
    col, buckets = (("end_sec - start_sec", VISIT_BUCKETS) if which == "visit"
                    else ("step_length", STEP_BUCKETS))
    return f"""
    SELECT {_bucket_case(col, buckets)} AS bucket, count(*) AS session_count
    FROM ({sessions(grain, clock)}) s GROUP BY 1"""


def _ratio(part, whole):
    return (f"CASE WHEN {whole} = 0 THEN 0.0 ELSE "
            f"CAST(floor(CAST({part} AS DOUBLE) * 100.0 / CAST({whole} AS DOUBLE) + 0.5) AS DOUBLE) / 100.0 END")


def session_aggr_stat(src: str) -> str:
    cnt = ["count(*) AS session_count"]
    for label, lo, hi in VISIT_BUCKETS:
        cond = f"visit_length >= {lo}" if hi is None else f"visit_length BETWEEN {lo} AND {hi}"
        cnt.append(f"count(*) FILTER (WHERE {cond}) AS v_{label}")
    for label, lo, hi in STEP_BUCKETS:
        cond = f"step_length >= {lo}" if hi is None else f"step_length BETWEEN {lo} AND {hi}"
        cnt.append(f"count(*) FILTER (WHERE {cond}) AS s_{label}")
    cols = ["session_count"]
    cols += [f"{_ratio('v_' + label, 'session_count')} AS {name}"
             for (label, _, _), name in zip(VISIT_BUCKETS, VISIT_RATIO_COLUMNS)]
    cols += [f"{_ratio('s_' + label, 'session_count')} AS {name}"
             for (label, _, _), name in zip(STEP_BUCKETS, STEP_RATIO_COLUMNS)]
    return f"""
    SELECT {', '.join(cols)} FROM (
      SELECT {', '.join(cnt)}
      FROM (SELECT end_sec - start_sec AS visit_length, step_length FROM ({src}) k) s) c"""


def detail(p: TaskParams) -> str:
    return f"""
    SELECT user_id AS userid, session_id AS sessionid, page_id AS pageid, action_time AS actionTime,
           search_keyword AS searchKeyword, click_category_id AS clickCategoryId,
           click_product_id AS clickProductId, order_category_ids AS orderCategoryIds,
           order_product_ids AS orderProductIds, pay_category_ids AS payCategoryIds,
           pay_product_ids AS payProductIds
    FROM ({uva(params=p)}) a
    WHERE session_id IN (SELECT session_id FROM ({kept(p)}) k)"""


def _tasks() -> str:
    return """
    SELECT CAST(date_diff('day', DATE '1970-01-01', d) AS BIGINT) AS task_id,
           'session_' || CAST(d AS VARCHAR) AS task_name, 'session' AS task_type,
           '{"startDate":["' || CAST(d AS VARCHAR) || '"],"endDate":["' || CAST(d + INTERVAL 6 DAY AS DATE)
           || '"],"startAge":["' || CAST(dom % 20 AS VARCHAR) || '"],"endAge":["' || CAST(dom % 20 + 30 AS VARCHAR)
           || '"],"sex":["' || CASE WHEN dom % 2 = 0 THEN 'male' ELSE 'female' END
           || '"],"keywords":["kw' || CAST(dom % 10 AS VARCHAR) || ',kw' || CAST((dom + 3) % 10 AS VARCHAR)
           || '"],"categoryIds":["' || CASE WHEN dom % 3 = 0 THEN '' ELSE CAST(dom * 3 AS VARCHAR) END
           || '"],"targetPageFlow":["1,2,3"]}' AS task_param
    FROM (SELECT DISTINCT CAST(ts AS DATE) AS d, dayofmonth(CAST(ts AS DATE)) AS dom FROM events) x"""


def _task_params() -> str:
    from ..constants import TASK_PARAM_NAMES
    cols = []
    for n in TASK_PARAM_NAMES:
        v = f"nullif(json_extract_string(task_param, '$.{n}[0]'), '')"
        if n in ("startAge", "endAge"):
            v = f"TRY_CAST({v} AS INTEGER)"
        cols.append(f"{v} AS {n}")
    return f"SELECT task_id, {', '.join(cols)} FROM ({_tasks()}) t"


def clicks(start: str | None = None, end: str | None = None) -> str:
    """Parsed ad clicks, derived straight from events (no text round trip)."""
    where = ["event_type = 'click'"]
    if start:
        where.append(f"ts >= TIMESTAMP '{start}'")
    if end:
        where.append(f"ts < TIMESTAMP '{end}'")
    return f"""
    SELECT epoch_us(ts) // 1000 AS ms, strftime(ts, '%Y-%m-%d') AS date,
           replace(r_name, ' ', '_') AS province, n_name AS city, user_id,
           CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS ad_id,
           strftime(ts, '%H') AS hour, strftime(ts, '%M') AS minute
    FROM events JOIN nation ON user_id % 25 = n_nationkey JOIN region ON n_regionkey = r_regionkey
    WHERE {' AND '.join(where)}"""


def _count(src, keys):
    return f"SELECT {keys}, count(*) AS click_count FROM ({src}) c GROUP BY {keys}"


USER_KEYS, STAT_KEYS = "date, user_id, ad_id", "date, province, city, ad_id"
TREND_KEYS, PROVINCE_KEYS = "date, hour, minute, ad_id", "date, province"


def top3(stat_src):
    return f"""
    SELECT date, province, ad_id, click_count FROM (
      SELECT date, province, ad_id, CAST(sum(click_count) AS BIGINT) AS click_count,
             row_number() OVER (PARTITION BY date, province
                                ORDER BY sum(click_count) DESC, ad_id ASC) AS rn
      FROM ({stat_src}) s GROUP BY date, province, ad_id) r WHERE rn <= 3"""


def blacklist(src, threshold):
    return f"SELECT DISTINCT user_id FROM ({_count(src, USER_KEYS)}) c WHERE click_count >= {threshold}"


def _on(keys, a="t", b="u"):
    return " AND ".join(f"{a}.{k.strip()} = {b}.{k.strip()}" for k in keys.split(","))


def merge_increment(tgt, upd, keys):
    return f"""SELECT {keys}, CAST(sum(click_count) AS BIGINT) AS click_count
    FROM (SELECT {keys}, click_count FROM ({tgt}) a UNION ALL SELECT {keys}, click_count FROM ({upd}) b) x
    GROUP BY {keys}"""


def merge_replace(tgt, upd, keys):
    return f"""
    SELECT {keys}, click_count FROM ({tgt}) t
    WHERE NOT EXISTS (SELECT 1 FROM ({upd}) u WHERE {_on(keys)})
    UNION ALL SELECT {keys}, max(click_count) AS click_count FROM ({upd}) u GROUP BY {keys}"""


def merge_replace_group(tgt, upd, group_keys, cols):
    return f"""
    SELECT {cols} FROM ({tgt}) t
    WHERE NOT EXISTS (SELECT 1 FROM ({upd}) u WHERE {_on(group_keys)})
    UNION ALL SELECT {cols} FROM ({upd}) u"""


def time_keys() -> str:
    t = "make_timestamp(action_sec * 1000000)"
    mock = (f"date || ' ' || CAST(hour({t}) AS VARCHAR) || ':' || strftime({t}, '%M') || ':' "
            f"|| strftime({t}, '%S')")
    return f"""
    SELECT event_id, {mock} AS mock_time, strftime({t}, '%Y%m%d') AS date_key,
           strftime({t}, '%Y%m%d%H%M') AS minute_key, strftime({t}, '%Y-%m-%d_%H') AS date_hour,
           date || '_' || CAST(hour({t}) AS VARCHAR) AS date_hour_text, date AS day,
           strftime({t}, {TS_FMT}) AS time_text,
           {t} < TIMESTAMP '2024-01-15 12:00:00' AS before_noon,
           {t} > TIMESTAMP '2024-01-15 12:00:00' AS after_noon,
           CAST(hour({t}) * 3600 + minute({t}) * 60 + second({t}) AS BIGINT) AS sec_of_day,
           CAST(CAST({t} AS DATE) AS VARCHAR) AS date_from_key,
           strftime(CAST(date AS DATE) - INTERVAL 1 DAY, '%Y-%m-%d') AS yesterday
    FROM ({uva()}) a"""


def _record(parts_sep="|", visit="CAST(visit_length AS VARCHAR)", tail="|"):
    return ("'sessionid=' || session_id || '|searchKeywords=' || search_keywords || "
            "'|clickCategoryIds=' || click_category_ids || '|visitLength=' || " + visit +
            " || '|stepLength=' || CAST(step_length AS VARCHAR) || '|startTime=' || start_time || '" + tail + "'")


def kv_parse() -> str:
    return f"""
    SELECT session_id, {_record()} AS record, session_id AS f_sessionid,
           nullif(search_keywords, '') AS f_searchKeywords, nullif(click_category_ids, '') AS f_clickCategoryIds,
           CAST(visit_length AS VARCHAR) AS f_visitLength, CAST(step_length AS VARCHAR) AS f_stepLength,
           start_time AS f_startTime, CAST(NULL AS VARCHAR) AS f_age
    FROM ({session_rows(sessions(grain='week'))}) s"""


def kv_set() -> str:
    return f"""
    SELECT session_id, {_record(visit="CAST(step_length * 10 AS VARCHAR)", tail="")} AS set_visit,
           {_record(tail="")} AS set_unknown
    FROM ({session_rows(sessions(grain='week'))}) s"""


def string_cleanup() -> str:
    def fill(x):
        return f"CASE WHEN length({x}) = 2 THEN {x} ELSE '0' || {x} END"
    return f"""
    SELECT session_id, search_keywords AS trim1, ',' || search_keywords || ',' AS trim2,
           {fill('CAST(step_length AS VARCHAR)')} AS step_text,
           {fill('CAST(visit_length AS VARCHAR)')} AS visit_text,
           search_keywords IS NULL OR search_keywords = '' AS kw_empty,
           NOT (click_category_ids IS NULL OR click_category_ids = '') AS cat_present
    FROM ({session_rows(sessions(grain='month'))}) s"""


def job_actions(params: TaskParams | None = None) -> str:
    jp = params or CAT.WHOLE_PARAMS
    return f"SELECT * FROM ({uva(params=jp)}) a WHERE session_id IN (SELECT session_id FROM ({kept(jp)}) k)"


def category_counts(acts: str) -> str:
    return f"""
    SELECT c AS categoryid, count(*) FILTER (WHERE kind = 0) AS clickCount,
           count(*) FILTER (WHERE kind = 1) AS orderCount, count(*) FILTER (WHERE kind = 2) AS payCount
    FROM (SELECT click_category_id AS c, 0 AS kind FROM ({acts}) a WHERE click_category_id IS NOT NULL
          UNION ALL SELECT TRY_CAST(unnest(string_split(order_category_ids, ',')) AS BIGINT), 1
                    FROM ({acts}) a WHERE order_category_ids IS NOT NULL
          UNION ALL SELECT TRY_CAST(unnest(string_split(pay_category_ids, ',')) AS BIGINT), 2
                    FROM ({acts}) a WHERE pay_category_ids IS NOT NULL) u
    WHERE c IS NOT NULL GROUP BY c"""


def top10_category(acts: str) -> str:
    return (f"SELECT * FROM ({category_counts(acts)}) c "
            "ORDER BY clickCount DESC, orderCount DESC, payCount DESC, categoryid ASC LIMIT 10")


def top10_session(acts: str) -> str:
    return f"""
    SELECT categoryid, sessionid, clickCount FROM (
      SELECT click_category_id AS categoryid, session_id AS sessionid, count(*) AS clickCount,
             row_number() OVER (PARTITION BY click_category_id ORDER BY count(*) DESC, session_id ASC) AS rn
      FROM ({acts}) a WHERE click_category_id IN (SELECT categoryid FROM ({top10_category(acts)}) t)
      GROUP BY click_category_id, session_id) r WHERE rn <= 10"""


def random_extract(params: TaskParams | None = None) -> str:
    src = session_rows(kept(params or CAT.WHOLE_PARAMS))
    n, seed = CAT.EXTRACT_PER_DAY, CAT.EXTRACT_SEED
    return f"""
    WITH s AS (SELECT *, substr(start_time, 1, 10) AS date, substr(start_time, 12, 2) AS hour,
                      md5('{seed}' || session_id) AS h FROM ({src}) x),
         c AS (SELECT date, hour, count(*) AS n_hour FROM s GROUP BY date, hour),
         q AS (SELECT date, hour, least(n_hour, greatest(1, CAST(floor(CAST({n} AS DOUBLE) * n_hour /
                      CAST(sum(n_hour) OVER (PARTITION BY date) AS DOUBLE)) AS BIGINT))) AS quota FROM c),
         r AS (SELECT s.*, row_number() OVER (PARTITION BY date, hour ORDER BY h, session_id) AS rn FROM s)
    SELECT session_id AS sessionid, start_time AS startTime, search_keywords AS searchKeywords,
           click_category_ids AS clickCategoryIds
    FROM r JOIN q USING (date, hour) WHERE rn <= quota"""


def page_rates(params: TaskParams | None = None, acts: str | None = None, order: str = "action_sec, event_id") -> str:
    flow = (params or CAT.WHOLE_PARAMS).target_page_flow
    steps = ", ".join(f"({i + 1}, CAST({a} AS BIGINT), CAST({b} AS BIGINT))"
                      for i, (a, b) in enumerate(zip(flow[:-1], flow[1:])))
    acts = acts or job_actions(params)
    return f"""
    WITH a AS ({acts}),
         p AS (SELECT page_id AS f, lead(page_id) OVER (PARTITION BY session_id ORDER BY {order}) AS t
               FROM a),
         pc AS (SELECT f, t, count(*) AS n FROM p WHERE t IS NOT NULL GROUP BY f, t),
         st AS (SELECT * FROM (VALUES {steps}) v(step, from_page, to_page)),
         c AS (SELECT step, from_page, to_page, coalesce(pc.n, 0) AS pair_count
               FROM st LEFT JOIN pc ON pc.f = st.from_page AND pc.t = st.to_page),
         u AS (SELECT 0 AS step, CAST(NULL AS BIGINT) AS from_page, CAST(NULL AS BIGINT) AS to_page,
                      count(*) AS pair_count FROM a WHERE page_id = {flow[0]}
               UNION ALL SELECT * FROM c),
         l AS (SELECT *, lag(pair_count) OVER (ORDER BY step) AS prev FROM u)
    SELECT step, from_page, to_page, pair_count, {_ratio('pair_count', 'prev')} AS convert_rate
    FROM l WHERE step >= 1"""


def page_rate_text(params: TaskParams | None = None) -> str:
    return f"""
    SELECT string_agg(CAST(from_page AS VARCHAR) || '_' || CAST(to_page AS VARCHAR) || '=' ||
                      CAST(convert_rate AS VARCHAR), '|' ORDER BY step) AS convertRate
    FROM ({page_rates(params)}) r"""


def area_top3(params: TaskParams | None = None) -> str:
    from ..operators.area import DEFAULT_AREA_LEVELS, DEFAULT_LEVEL, DEFAULT_STATUS_NAMES
    levels = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in DEFAULT_AREA_LEVELS.items())
    status = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in DEFAULT_STATUS_NAMES.items())
    return f"""
    WITH g AS (SELECT area, click_product_id AS productid, count(*) AS clickCount,
                      array_to_string(list_sort(list(DISTINCT CAST(a.city_id AS VARCHAR) || ':' || city_name)), ',')
                        AS cityInfos
               FROM ({uva(params=params or CAT.WHOLE_PARAMS)}) a JOIN ({CITIES}) c ON a.city_id = c.city_id
               WHERE click_product_id IS NOT NULL GROUP BY area, click_product_id),
         r AS (SELECT *, row_number() OVER (PARTITION BY area ORDER BY clickCount DESC, productid ASC) AS rn FROM g)
    SELECT area, CASE area {levels} ELSE '{DEFAULT_LEVEL}' END AS areaLevel, productid, cityInfos, clickCount,
           p_name AS productName,
           CASE json_extract_string('{{"product_status": ' || CAST(p_partkey % 2 AS VARCHAR) || '}}',
                                    '$.product_status') {status} END AS productStatus
    FROM r LEFT JOIN part ON p_partkey = productid WHERE rn <= 3"""


# --- every task of the task table ---------------------------------------------------

def task_sessions() -> str:
    """(task_id, session ...) of every task's kept sessions, and the task's range."""
    p = f"({_task_params()})"
    return f"""
    SELECT s.*, u.age, u.professional, u.city, u.sex
    FROM (SELECT p.task_id, p.startAge, p.endAge, p.sex AS task_sex, p.keywords AS task_keywords, p.categoryIds AS task_cats,
                 a.session_id, max(a.user_id) AS user_id, min(action_sec) AS start_sec, max(action_sec) AS end_sec,
                 count(*) AS step_length,
                 list_sort(coalesce(list(DISTINCT search_keyword) FILTER (WHERE search_keyword <> ''), [])) AS kw_list,
                 list_sort(coalesce(list(DISTINCT click_category_id) FILTER (WHERE click_category_id IS NOT NULL), [])) AS cat_list
          FROM {p} p JOIN ({uva()}) a ON a.date BETWEEN p.startDate AND p.endDate GROUP BY ALL) s
    JOIN ({USERS}) u ON s.user_id = u.user_id
    WHERE u.age BETWEEN startAge AND endAge AND (task_sex IS NULL OR u.sex = task_sex)
      AND (task_keywords IS NULL OR list_has_any(kw_list, string_split(task_keywords, ',')))
      AND (task_cats IS NULL OR list_has_any(list_transform(cat_list, lambda x: CAST(x AS VARCHAR)), string_split(task_cats, ',')))"""


def task_set_actions() -> str:
    return f"""
    SELECT k.task_id, a.* FROM ({task_sessions()}) k JOIN ({_task_params()}) p ON p.task_id = k.task_id
    JOIN ({uva()}) a ON a.session_id = k.session_id AND a.date BETWEEN p.startDate AND p.endDate"""


def _every_task_stat() -> str:
    cnt = []
    for label, lo, hi in VISIT_BUCKETS:
        cond = f"visit_length >= {lo}" if hi is None else f"visit_length BETWEEN {lo} AND {hi}"
        cnt.append(f"count(*) FILTER (WHERE {cond}) AS v_{label}")
    for label, lo, hi in STEP_BUCKETS:
        cond = f"step_length >= {lo}" if hi is None else f"step_length BETWEEN {lo} AND {hi}"
        cnt.append(f"count(*) FILTER (WHERE {cond}) AS s_{label}")
    names = [("v_" + label, name) for (label, _, _), name in zip(VISIT_BUCKETS, VISIT_RATIO_COLUMNS)]
    names += [("s_" + label, name) for (label, _, _), name in zip(STEP_BUCKETS, STEP_RATIO_COLUMNS)]
    ratios = ", ".join(f"{_ratio(c, 'session_count')} AS {name}" for c, name in names)
    return f"""
    SELECT task_id, session_count, {ratios} FROM (
      SELECT t.task_id, count(k.session_id) AS session_count, {", ".join(cnt)}
      FROM ({_tasks()}) t LEFT JOIN (SELECT *, end_sec - start_sec AS visit_length FROM ({task_sessions()}) k0) k ON k.task_id = t.task_id
      GROUP BY t.task_id) c"""


def task_set_sql() -> dict[str, str]:
    from ..operators.area import DEFAULT_AREA_LEVELS, DEFAULT_LEVEL, DEFAULT_STATUS_NAMES
    acts, n, seed = task_set_actions(), CAT.EXTRACT_PER_DAY, CAT.EXTRACT_SEED
    counts = f"""
    SELECT task_id, c AS categoryid, session_id AS sessionid, count(*) FILTER (WHERE kind = 0) AS clickCount,
           count(*) FILTER (WHERE kind = 1) AS orderCount, count(*) FILTER (WHERE kind = 2) AS payCount
    FROM (SELECT task_id, session_id, click_category_id AS c, 0 AS kind FROM ({acts}) a WHERE click_category_id IS NOT NULL
          UNION ALL SELECT task_id, session_id, TRY_CAST(unnest(string_split(order_category_ids, ',')) AS BIGINT), 1
                    FROM ({acts}) a WHERE order_category_ids IS NOT NULL
          UNION ALL SELECT task_id, session_id, TRY_CAST(unnest(string_split(pay_category_ids, ',')) AS BIGINT), 2
                    FROM ({acts}) a WHERE pay_category_ids IS NOT NULL) u
    WHERE c IS NOT NULL GROUP BY task_id, c, session_id"""
    top = f"""
    SELECT task_id, categoryid, CAST(sum(clickCount) AS BIGINT) AS clickCount, CAST(sum(orderCount) AS BIGINT) AS orderCount,
           CAST(sum(payCount) AS BIGINT) AS payCount
    FROM ({counts}) c GROUP BY task_id, categoryid
    QUALIFY row_number() OVER (PARTITION BY task_id ORDER BY sum(clickCount) DESC, sum(orderCount) DESC, sum(payCount) DESC, categoryid) <= 10"""
    steps = f"""
    WITH a AS ({acts}),
         p AS (SELECT task_id, page_id AS f, lead(page_id) OVER (PARTITION BY task_id, session_id ORDER BY action_sec, event_id) AS t FROM a),
         st AS (SELECT t.task_id, v.* FROM ({_tasks()}) t, (VALUES (1, 1::BIGINT, 2::BIGINT), (2, 2::BIGINT, 3::BIGINT)) v(step, from_page, to_page)),
         c AS (SELECT st.*, (SELECT count(*) FROM p WHERE p.task_id = st.task_id AND f = from_page AND t = to_page) AS pair_count,
                      (SELECT count(*) FROM a WHERE a.task_id = st.task_id AND page_id = from_page) AS views FROM st),
         l AS (SELECT *, CASE WHEN step = 1 THEN views ELSE lag(pair_count) OVER (PARTITION BY task_id ORDER BY step) END AS prev FROM c)
    SELECT task_id, step, from_page, to_page, pair_count, {_ratio('pair_count', 'prev')} AS convert_rate FROM l"""
    levels = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in DEFAULT_AREA_LEVELS.items())
    status = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in DEFAULT_STATUS_NAMES.items())
    return {
        "tasks_session_aggr_stat": _every_task_stat(),
        "tasks_session_detail": f"""
    SELECT task_id, user_id AS userid, session_id AS sessionid, page_id AS pageid, action_time AS actionTime,
           search_keyword AS searchKeyword, click_category_id AS clickCategoryId, click_product_id AS clickProductId,
           order_category_ids AS orderCategoryIds, order_product_ids AS orderProductIds,
           pay_category_ids AS payCategoryIds, pay_product_ids AS payProductIds FROM ({acts}) a""",
        "tasks_session_random_extract": f"""
    WITH s AS (SELECT task_id, session_id, {_ts_text('start_sec')} AS start_time, kw_list, cat_list,
                      md5('{seed}' || session_id) AS h FROM ({task_sessions()}) x),
         d AS (SELECT *, substr(start_time, 1, 10) AS date, substr(start_time, 12, 2) AS hour FROM s),
         c AS (SELECT task_id, date, hour, count(*) AS n_hour FROM d GROUP BY ALL),
         q AS (SELECT *, least(n_hour, greatest(1, CAST(floor(CAST({n} AS DOUBLE) * n_hour /
                      CAST(sum(n_hour) OVER (PARTITION BY task_id, date) AS DOUBLE)) AS BIGINT))) AS quota FROM c),
         r AS (SELECT *, row_number() OVER (PARTITION BY task_id, date, hour ORDER BY h, session_id) AS rn FROM d)
    SELECT task_id, session_id AS sessionid, start_time AS startTime, array_to_string(kw_list, ',') AS searchKeywords,
           array_to_string(cat_list, ',') AS clickCategoryIds
    FROM r JOIN q USING (task_id, date, hour) WHERE rn <= quota""",
        "tasks_top10_category": top,
        "tasks_top10_category_session": f"""
    SELECT c.task_id, c.categoryid, c.sessionid, c.clickCount
    FROM ({counts}) c JOIN ({top}) t ON t.task_id = c.task_id AND t.categoryid = c.categoryid
    WHERE c.clickCount > 0
    QUALIFY row_number() OVER (PARTITION BY c.task_id, c.categoryid ORDER BY c.clickCount DESC, c.sessionid) <= 10""",
        "tasks_page_split_convert_steps": steps,
        "tasks_page_split_convert_rate": f"""
    SELECT task_id, string_agg(CAST(from_page AS VARCHAR) || '_' || CAST(to_page AS VARCHAR) || '=' ||
                               CAST(convert_rate AS VARCHAR), '|' ORDER BY step) AS convertRate
    FROM ({steps}) r GROUP BY task_id""",
        "tasks_area_top3_product": f"""
    WITH g AS (SELECT task_id, area, click_product_id AS productid, count(*) AS clickCount,
                      array_to_string(list_sort(list(DISTINCT CAST(a.city_id AS VARCHAR) || ':' || city_name)), ',') AS cityInfos
               FROM ({_task_params()}) p JOIN ({uva()}) a ON a.date BETWEEN p.startDate AND p.endDate
               JOIN ({CITIES}) c ON a.city_id = c.city_id
               WHERE click_product_id IS NOT NULL GROUP BY task_id, area, click_product_id),
         r AS (SELECT *, row_number() OVER (PARTITION BY task_id, area ORDER BY clickCount DESC, productid ASC) AS rn FROM g)
    SELECT task_id, area, CASE area {levels} ELSE '{DEFAULT_LEVEL}' END AS areaLevel, productid, cityInfos, clickCount,
           p_name AS productName,
           CASE json_extract_string('{{"product_status": ' || CAST(p_partkey % 2 AS VARCHAR) || '}}',
                                    '$.product_status') {status} END AS productStatus
    FROM r LEFT JOIN part ON p_partkey = productid WHERE rn <= 3""",
    }


# --- the stored visit tables ---------------------------------------------------------

def stored_table_sql() -> dict[str, str]:
    """The same rows as from the events, with the time as unpadded text and no event id to order by."""
    t = "make_timestamp(action_sec * 1000000)"
    text = (f"date || ' ' || CAST(hour({t}) AS VARCHAR) || ':' || strftime({t}, '%M') || ':' || strftime({t}, '%S')")
    return {
        "table_actions_by_date_range": f"SELECT * EXCLUDE (event_id) REPLACE ({text} AS action_time) FROM ("
                                       + uva(params=TaskParams(start_date="2024-01-10", end_date="2024-01-12")) + ") a",
        "table_session_full_info": session_rows(full_sessions(), USER_EXTRA),
        "table_session_compat": session_rows(sessions(compat=True, by_value=True)),
        "table_page_convert_rate": page_rates(acts=uva(), order="action_sec, page_id NULLS FIRST"),
        "table_view_sql": f"""
            SELECT u.user_id, u.name, u.age, u.professional, u.city, u.sex, count(*) AS actions, count(DISTINCT a.session_id) AS sessions
            FROM ({uva(params=TaskParams(start_date="2024-01-08", end_date="2024-01-20"))}) a JOIN ({USERS}) u ON a.user_id = u.user_id
            GROUP BY u.user_id, u.name, u.age, u.professional, u.city, u.sex""",
    }


def oracle_sql() -> dict[str, str]:
    jp, fp = CAT.WHOLE_PARAMS, CAT.FILTER_PARAMS
    out = {
        "actions_by_date_range":
            "SELECT * EXCLUDE (action_sec) FROM ("
            + uva(params=TaskParams(start_date="2024-01-10", end_date="2024-01-12")) + ") a",
        "task_params": _task_params(),
        "task_by_id": f"SELECT * FROM ({_tasks()}) t WHERE task_id = 19737",
        "session_aggregate": session_rows(sessions()),
        "session_full_info": session_rows(full_sessions(), USER_EXTRA),
        "session_as_of": session_rows(sessions(as_of=CAT.AS_OF)),
        "session_compat": session_rows(sessions(grain="week", compat=True)),
    }
    for name, p in fp.items():
        out[name] = session_rows(kept(p), USER_EXTRA)
    out["filter_shared_sessions"] = session_rows(shared_sessions(fp["filter_age"]), USER_EXTRA)
    out["task_session_aggr_stat"] = task_result(session_aggr_stat(kept(TASK_15)))
    out["task_session_detail"] = task_result(detail(TASK_15))
    out["task_session_random_extract"] = task_result(random_extract(TASK_15))
    out["task_page_split_convert_rate"] = task_result(page_rate_text(TASK_15))
    out["task_page_split_convert_steps"] = task_result(page_rates(TASK_15))
    out["task_area_top3_product"] = task_result(area_top3(TASK_15))
    for name in ("session_aggr_stat", "session_random_extract", "area_top3_product"):
        out[f"table_{name}"] = out[f"task_{name}"]
    out |= task_set_sql() | stored_table_sql()
    out["task_top10_category"] = task_result(top10_category(task_actions(TASK_15)))
    out["task_top10_category_session"] = task_result(top10_session(task_actions(TASK_15)))
    out["format_double"] = f"""
        SELECT event_id, {format_double('value')} AS rounded, {format_double('-value')} AS negated,
               {format_double('value * 1e18')} AS large, {format_double('(event_id - 500) / 8.0')} AS ties
        FROM events"""
    out["filter_equal"] = session_rows(
        f"SELECT * FROM ({full_sessions()}) fs WHERE coalesce(CAST(sex AS VARCHAR) = 'female', false)", USER_EXTRA)
    out.update({
        "visit_buckets_real": bucket_distribution("visit", "day", "real"),
        "visit_buckets_value": bucket_distribution("visit", "day", "value"),
        "step_buckets_week": bucket_distribution("step", "week", "real"),
        "step_buckets_month": bucket_distribution("step", "month", "real"),
        "session_aggr_stat": session_aggr_stat(kept(jp, grain="week", clock="value")),
        "session_aggr_stat_empty": session_aggr_stat(kept(CAT.EMPTY_PARAMS)),
        "session_detail": detail(fp["filter_all"]),
    })
    out.update({
        "time_keys": time_keys(),
        "kv_text_parse": kv_parse(),
        "kv_text_set": kv_set(),
        "string_cleanup": string_cleanup(),
        "top10_category": top10_category(job_actions()),
        "top10_category_session": top10_session(job_actions()),
        "session_random_extract": random_extract(),
        "page_convert_rate": page_rates(),
        "page_convert_rate_text": page_rate_text(),
        "area_top3_product": area_top3(),
    })
    wp = CAT.WHOLE_PARAMS
    out.update({
        "whole_session_aggr_stat": session_aggr_stat(kept(wp, grain="week", clock="value")),
        "whole_top10_category": top10_category(job_actions(wp)),
        "whole_top10_category_session": top10_session(job_actions(wp)),
        "whole_session_random_extract": random_extract(wp),
        "whole_page_convert_rate": page_rates(wp),
        "whole_page_convert_rate_text": page_rate_text(wp),
        "whole_area_top3_product": area_top3(wp),
    })
    te, us, th = CAT.MERGE_TARGET_END, CAT.MERGE_UPDATE_START, CAT.BLACKLIST_THRESHOLD
    ct, cu, call = clicks(end=te), clicks(start=us), clicks()
    black = blacklist(call, th)
    out.update({
        "ad_log_parse": f"SELECT ms, date, province, city, user_id, ad_id FROM ({call}) c",
        "merge_increment": merge_increment(_count(ct, USER_KEYS), _count(cu, USER_KEYS), USER_KEYS),
        "merge_replace": merge_replace(_count(ct, STAT_KEYS), _count(cu, STAT_KEYS), STAT_KEYS),
        "merge_replace_minute": merge_replace(_count(ct, TREND_KEYS), _count(cu, TREND_KEYS), TREND_KEYS),
        "merge_replace_group": merge_replace_group(top3(_count(ct, STAT_KEYS)), top3(_count(cu, STAT_KEYS)),
                                                   PROVINCE_KEYS, "date, province, ad_id, click_count"),
        "merge_existence": f"""
            SELECT u.date, u.user_id, u.ad_id, u.click_count,
                   EXISTS (SELECT 1 FROM ({_count(ct, USER_KEYS)}) t WHERE {_on(USER_KEYS)}) AS "exists"
            FROM ({_count(cu, USER_KEYS)}) u""",
        "blacklist_append": f"SELECT user_id FROM ({blacklist(ct, th)}) a UNION "
                            f"SELECT user_id FROM ({blacklist(cu, th)}) b",
        "click_count_lookup": f"""
            SELECT k.date, k.user_id, k.ad_id, coalesce(t.click_count, 0) AS click_count
            FROM (SELECT DISTINCT date, user_id, ad_id FROM ({cu}) c) k
            LEFT JOIN ({_count(ct, USER_KEYS)}) t ON {_on(USER_KEYS, 'k', 't')}""",
        "ad_user_click_count": _count(call, USER_KEYS),
        "ad_blacklist": black,
        "ad_stat": _count(call, STAT_KEYS),
        "ad_province_top3": top3(_count(call, STAT_KEYS)),
        "ad_click_trend": _count(call, TREND_KEYS),
    })
    for name in CAT.BUCKETED_MERGES:                     # the same rows, merged where they are stored
        out[name] = out[name.replace("bucketed_", "")]
    # two micro-batches: b1 = clicks before the cut, b2 = the rest minus b1's blacklist
    b1, b2raw = clicks(end=CAT.STREAM_CUT), clicks(start=CAT.STREAM_CUT)
    black1 = blacklist(b1, th)
    b2 = f"SELECT * FROM ({b2raw}) c WHERE user_id NOT IN ({black1})"
    counts2 = merge_increment(_count(b1, USER_KEYS), _count(b2, USER_KEYS), USER_KEYS)
    stat2 = merge_increment(_count(b1, STAT_KEYS), _count(b2, STAT_KEYS), STAT_KEYS)
    out.update({
        "ad_two_batch_counts": counts2,
        "ad_two_batch_blacklist": f"SELECT user_id FROM ({black1}) a UNION ALL "
                                  f"SELECT DISTINCT user_id FROM ({counts2}) c WHERE click_count >= {th} "
                                  f"AND user_id NOT IN ({black1})",
        "ad_two_batch_stat": stat2,
        "ad_two_batch_top3": top3(stat2),
        "ad_stream_stat": _count(call, STAT_KEYS),
        "ad_stream_trend": _count(call, TREND_KEYS),
    })
    for field in ("counts", "blacklist", "top3"):
        out[f"ad_stream_{field}"] = out[f"ad_two_batch_{field}"]
    return out
