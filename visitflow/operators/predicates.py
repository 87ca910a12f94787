"""Session filter predicates.

Null rules of the reference: a missing parameter means *no condition*; a
missing data value never matches. The predicates are used in ``where``, which
drops NULL like false, so conditions on stored columns stay plain comparisons
and reach the parquet scan.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.adapters import sql_text
from ..sources.tasks import TaskParams


def range_predicate(c, lo, hi) -> Column | None:
    """Lo <= c <= hi, applied only when both ends are given."""
    if lo is None or hi is None:
        return None
    c = F.col(c) if isinstance(c, str) else c
    return c.between(F.lit(lo), F.lit(hi))


def any_of_predicate(c, values: Iterable[str] | None, is_array: bool = False) -> Column | None:
    """Any data value equals any parameter value (compared as text); a text is one value."""
    if not values:
        return None
    vals = [str(v) for v in values]
    if not is_array:
        c = F.col(c) if isinstance(c, str) else c
        return c.cast("string").isin(vals)
    if isinstance(c, str):
        # one expression text: a single plan-building round trip however long the list
        wanted = "array(" + ", ".join(sql_text(v) for v in vals) + ")"
        return F.expr(f"arrays_overlap(filter(transform(`{c}`, x -> CAST(x AS STRING)), x -> x IS NOT NULL), {wanted})")
    as_text = F.transform(c, lambda x: x.cast("string"))
    return F.arrays_overlap(F.filter(as_text, lambda x: x.isNotNull()), F.array(*[F.lit(v) for v in vals]))


def equal_predicate(c, value) -> Column | None:
    """C equals the parameter (as text)."""
    if value is None:
        return None
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("string") == F.lit(str(value))


def user_predicate(params: TaskParams) -> Column:
    """The conditions on user attributes only (age, professional, city, sex)."""
    parts = [range_predicate("age", params.start_age, params.end_age),
             any_of_predicate("professional", params.professionals),
             any_of_predicate("city", params.cities),
             any_of_predicate("sex", params.sex)]
    return _and(parts)


def session_predicate(params: TaskParams, columns: Iterable[str] = ()) -> Column:
    """Conjunction of all session conditions of a task.

    Where ``columns`` hold the task's folded conditions (``keyword_hit``,
    ``category_hit``), these decide; else the sets do.
    """
    def either(hit: str, sets: str, wanted) -> Column | None:
        if wanted and hit in columns:
            return F.col(hit)
        return any_of_predicate(sets, wanted, is_array=True)
    parts = [user_predicate(params), either("keyword_hit", "search_keywords", params.keywords),
             either("category_hit", "click_category_ids", params.category_ids)]
    return _and(parts)


def filter_sessions(full_sessions: DataFrame, params: TaskParams) -> DataFrame:
    """Sessions (with user attributes) passing every condition of the task."""
    return full_sessions.where(session_predicate(params, full_sessions.columns))


def _and(parts: list[Column | None]) -> Column:
    out = F.lit(True)
    for p in parts:
        if p is not None:
            out = out & p
    return out
