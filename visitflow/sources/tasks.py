"""Task parameters: the JSON ``task_param`` text of a task row.

Rule: every parameter is a JSON array of which only element 0 counts; absent,
empty array or empty text means "no condition"; list parameters are comma
lists inside that element.
"""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C

# Typed layout of the decoded parameter columns (bulk decode, R5).
_LIST_PARAMS = (C.PARAM_PROFESSIONALS, C.PARAM_CITIES, C.PARAM_SEX, C.PARAM_KEYWORDS,
                C.PARAM_CATEGORY_IDS, C.PARAM_TARGET_PAGE_FLOW)
TASK_PARAM_SCHEMA = "struct<" + ",".join(f"{n}:array<string>" for n in C.TASK_PARAM_NAMES) + ">"


def _split(value: str | None) -> tuple[str, ...] | None:
    if value is None or value == "":
        return None
    return tuple(value.split(","))


@dataclass(frozen=True)
class TaskParams:
    """Decoded filter and flow parameters of one task (driver-side, a few values)."""

    start_date: str | None = None
    end_date: str | None = None
    start_age: int | None = None
    end_age: int | None = None
    professionals: tuple[str, ...] | None = None
    cities: tuple[str, ...] | None = None
    sex: tuple[str, ...] | None = None
    keywords: tuple[str, ...] | None = None
    category_ids: tuple[str, ...] | None = None
    target_page_flow: tuple[int, ...] | None = None
    extra: dict = field(default_factory=dict, compare=False)

    @classmethod
    def from_json(cls, text: str | None) -> "TaskParams":
        obj = json.loads(text) if text else {}

        def first(name: str) -> str | None:
            arr = obj.get(name)
            if isinstance(arr, list) and arr:
                v = arr[0]
                if v is None:
                    return None
                v = v if isinstance(v, str) else json.dumps(v)
                return v or None
            return None

        for d in (C.PARAM_START_DATE, C.PARAM_END_DATE):
            if first(d) is not None:
                dt.date.fromisoformat(first(d))       # dates must be yyyy-MM-dd
        flow = _split(first(C.PARAM_TARGET_PAGE_FLOW))
        age = {n: first(n) for n in (C.PARAM_START_AGE, C.PARAM_END_AGE)}
        return cls(
            start_date=first(C.PARAM_START_DATE),
            end_date=first(C.PARAM_END_DATE),
            start_age=int(age[C.PARAM_START_AGE]) if age[C.PARAM_START_AGE] is not None else None,
            end_age=int(age[C.PARAM_END_AGE]) if age[C.PARAM_END_AGE] is not None else None,
            professionals=_split(first(C.PARAM_PROFESSIONALS)),
            cities=_split(first(C.PARAM_CITIES)),
            sex=_split(first(C.PARAM_SEX)),
            keywords=_split(first(C.PARAM_KEYWORDS)),
            category_ids=_split(first(C.PARAM_CATEGORY_IDS)),
            target_page_flow=tuple(int(x) for x in flow) if flow else None,
        )

    def to_json(self) -> str:
        out: dict[str, list[str]] = {}

        def put(name, value):
            if value is None:
                return
            if isinstance(value, tuple):
                value = ",".join(str(v) for v in value)
            out[name] = [str(value)]

        put(C.PARAM_START_DATE, self.start_date)
        put(C.PARAM_END_DATE, self.end_date)
        put(C.PARAM_START_AGE, self.start_age)
        put(C.PARAM_END_AGE, self.end_age)
        put(C.PARAM_PROFESSIONALS, self.professionals)
        put(C.PARAM_CITIES, self.cities)
        put(C.PARAM_SEX, self.sex)
        put(C.PARAM_KEYWORDS, self.keywords)
        put(C.PARAM_CATEGORY_IDS, self.category_ids)
        put(C.PARAM_TARGET_PAGE_FLOW, self.target_page_flow)
        return json.dumps(out)

    def with_(self, **kw) -> "TaskParams":
        return replace(self, **kw)

    @property
    def has_user_conditions(self) -> bool:
        ages = self.start_age is not None and self.end_age is not None
        return bool(ages or self.professionals or self.cities or self.sex)


def decode_task_params(tasks: DataFrame) -> DataFrame:
    """Bulk decode of ``task_param`` into one typed column per parameter.

    Ages become int, list parameters stay comma text (split on use).
    """
    parsed = F.from_json(F.col("task_param"), TASK_PARAM_SCHEMA)
    cols = [F.col("task_id")]
    for name in C.TASK_PARAM_NAMES:
        v = F.nullif(F.try_element_at(parsed[name], F.lit(1)), F.lit(""))
        if name in (C.PARAM_START_AGE, C.PARAM_END_AGE):
            v = v.try_cast("int")
        cols.append(v.alias(name))
    return tasks.select(*cols)


def find_task(tasks: DataFrame, task_id: int) -> DataFrame:
    """Point lookup of one task row."""
    return tasks.where(F.col("task_id") == F.lit(task_id)).limit(1)


def load_task_params(tasks: DataFrame, task_id: int) -> TaskParams:
    """Driver-side parameters of one task: a single-row collect, never more."""
    rows = find_task(tasks, task_id).select("task_param").collect()
    if not rows:
        raise LookupError(f"task {task_id} not found")
    return TaskParams.from_json(rows[0]["task_param"])


def derived_tasks(events: DataFrame) -> DataFrame:
    """One task per event date, its parameters derived from that date.

    Columns: task_id (days since 1970-01-01), task_name, task_type, task_param.
    The JSON text is assembled by string concatenation so any SQL engine can
    build the identical text.
    """
    d = F.to_date(F.col("ts"))
    days = events.select(d.alias("d")).distinct()
    dom = F.dayofmonth("d")
    end = F.date_add("d", 6)
    text = F.concat(
        F.lit('{"startDate":["'), F.col("d").cast("string"),
        F.lit('"],"endDate":["'), end.cast("string"),
        F.lit('"],"startAge":["'), (dom % 20).cast("string"),
        F.lit('"],"endAge":["'), (dom % 20 + 30).cast("string"),
        F.lit('"],"sex":["'), F.when(dom % 2 == 0, "male").otherwise("female"),
        F.lit('"],"keywords":["kw'), (dom % 10).cast("string"), F.lit(",kw"), ((dom + 3) % 10).cast("string"),
        F.lit('"],"categoryIds":["'), F.when(dom % 3 == 0, "").otherwise((dom * 3).cast("string")),
        F.lit('"],"targetPageFlow":["1,2,3"]}'))
    return days.select(
        F.datediff(F.col("d"), F.lit("1970-01-01").cast("date")).cast("bigint").alias("task_id"),
        F.concat(F.lit("session_"), F.col("d").cast("string")).alias("task_name"),
        F.lit("session").alias("task_type"),
        text.alias("task_param"))
