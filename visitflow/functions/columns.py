"""Text, time, number and ``k=v|k=v`` helpers as Spark column expressions.

Each function takes and returns ``Column`` so that it runs inside whole-stage
codegen over a whole table. Rules follow the reference's utility methods;
where the obvious Spark builtin differs (``lpad``, ``trim``, ``round``) the
expression spells the reference's rule out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import (DATE_FORMAT, DATE_KEY_FORMAT, MINUTE_KEY_FORMAT, RATIO_SCALE,
                         TIME_FORMAT, TIME_PARSE_FORMAT)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- text ------------------------------------------------------------------

def is_empty(c) -> Column:
    """null or ''."""
    c = _c(c)
    return c.isNull() | (c == F.lit(""))


def is_not_empty(c) -> Column:
    """neither null nor ''."""
    return ~is_empty(c)


def trim_one_comma(c) -> Column:
    """strip at most one leading and one trailing comma (``,,a,,`` -> ``,a,``)."""
    return F.regexp_replace(_c(c), r"^,|,$", "")


def fill_two_digits(c) -> Column:
    """keep a 2-character text, otherwise prefix one ``0`` (``123`` -> ``0123``)."""
    c = _c(c)
    return F.when(F.length(c) == 2, c).otherwise(F.concat(F.lit("0"), c))


# --- time ------------------------------------------------------------------

def parse_time(c) -> Column:
    """``yyyy-MM-dd H:mm:ss`` text -> timestamp; NULL on bad input.

    The hour pattern ``H`` accepts one- and two-digit hours.
    """
    return F.try_to_timestamp(_c(c), F.lit(TIME_PARSE_FORMAT))


def parse_date_key(c) -> Column:
    """``yyyyMMdd`` text -> date; NULL on bad input."""
    return F.to_date(F.try_to_timestamp(_c(c), F.lit(DATE_KEY_FORMAT)))


def before(a, b) -> Column:
    """time text a < b; false when either does not parse."""
    return F.coalesce(parse_time(a) < parse_time(b), F.lit(False))


def after(a, b) -> Column:
    """time text a > b; false when either does not parse."""
    return F.coalesce(parse_time(a) > parse_time(b), F.lit(False))


def seconds_between(a, b) -> Column:
    """whole seconds a - b of two time texts; 0 when either does not parse."""
    return F.coalesce(F.unix_timestamp(parse_time(a)) - F.unix_timestamp(parse_time(b)),
                      F.lit(0).cast("bigint"))


def date_hour_text(c) -> Column:
    """``date_hour`` of a time text by splitting (an unpadded hour stays unpadded)."""
    c = _c(c)
    date_part = F.split_part(c, F.lit(" "), F.lit(1))
    hour_part = F.split_part(F.split_part(c, F.lit(" "), F.lit(2)), F.lit(":"), F.lit(1))
    return F.concat(date_part, F.lit("_"), hour_part)


def date_hour(ts) -> Column:
    """F6 on a timestamp: ``yyyy-MM-dd_HH``."""
    return F.date_format(_c(ts), "yyyy-MM-dd_HH")


def run_date(day: str) -> Column:
    """the job's date, always an explicit parameter (never the wall clock)."""
    return F.lit(day).cast("date")


def day_before(d) -> Column:
    """yesterday of a date column, as ``yyyy-MM-dd``."""
    return F.date_format(F.date_sub(_c(d).cast("date"), 1), DATE_FORMAT)


def format_date(ts) -> Column:
    """F8: ``yyyy-MM-dd``."""
    return F.date_format(_c(ts), DATE_FORMAT)


def format_time(ts) -> Column:
    """F8: ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(_c(ts), TIME_FORMAT)


def date_key(ts) -> Column:
    """F8: ``yyyyMMdd``."""
    return F.date_format(_c(ts), DATE_KEY_FORMAT)


def minute_key(ts) -> Column:
    """F8: ``yyyyMMddHHmm``."""
    return F.date_format(_c(ts), MINUTE_KEY_FORMAT)


# --- numbers ---------------------------------------------------------------

def round_half_up(x, scale: int = RATIO_SCALE) -> Column:
    """half-up rounding (away from zero) of a double at ``scale`` places, computed in double.

    ``sign(x) * floor(|x| * 10^s + 0.5) / 10^s`` — the same arithmetic in any
    SQL engine (Spark's ``round`` rounds the decimal text instead). NaN gives
    0. From 2^52 on a double has no places left to round: such values, the
    infinities among them, stay as they are.
    """
    x, p = _c(x).cast("double"), float(10 ** scale)
    rounded = F.signum(x) * F.floor(F.abs(x) * F.lit(p) + F.lit(0.5)).cast("double") / F.lit(p)
    return F.when(F.isnan(x), F.lit(0.0)).when(F.abs(x) * F.lit(p) >= F.lit(float(1 << 52)), x).otherwise(rounded)


def ratio_sql(part: str, whole: str, scale: int = RATIO_SCALE) -> str:
    """A14 as SQL text over two column names (one JVM round trip to build)."""
    p = f"{float(10 ** scale)}D"
    return (f"CASE WHEN CAST({whole} AS DOUBLE) = 0.0D THEN 0.0D ELSE "
            f"CAST(FLOOR(CAST({part} AS DOUBLE) * {p} / CAST({whole} AS DOUBLE) + 0.5D) AS DOUBLE) / {p} END")


def ratio(part, whole, scale: int = RATIO_SCALE) -> Column:
    """Part / whole rounded half-up; 0.0 when whole is 0 (no sessions)."""
    if isinstance(part, str) and isinstance(whole, str):
        return F.expr(ratio_sql(part, whole, scale))
    part, whole = _c(part).cast("double"), _c(whole).cast("double")
    p = float(10 ** scale)
    raw = F.floor(part * F.lit(p) / whole + F.lit(0.5)).cast("double") / F.lit(p)
    return F.when(whole == F.lit(0.0), F.lit(0.0)).otherwise(raw)


# --- JSON ------------------------------------------------------------------

def json_array_first(c, name: str) -> Column:
    """element 0 of the JSON array under ``name`` as text; NULL if absent/empty."""
    return F.get_json_object(_c(c), f"$.{name}[0]")


def json_field(c, name: str) -> Column:
    """one field of a JSON object text."""
    return F.get_json_object(_c(c), f"$.{name}")


# --- k=v|k=v text ----------------------------------------------------------

def kv_get(c, key: str, delimiter: str = "|") -> Column:
    """Value of ``key`` in ``k=v|k=v`` text; the first matching entry wins.

    An entry counts only when it splits on ``=`` into exactly two parts after
    trailing ``=`` are dropped (the reference splits with Java's
    ``String.split``, which drops trailing empty parts), so ``b=`` and
    ``c=x=y`` read as NULL while ``d=2=`` reads as ``2``.
    """
    entries = _entries(c, delimiter)
    parts = lambda e: F.split(F.regexp_replace(e, "=+$", ""), "=")
    match = F.filter(entries, lambda e: (F.size(parts(e)) == 2)
                     & (F.try_element_at(parts(e), F.lit(1)) == F.lit(key)))
    hit = F.try_element_at(match, F.lit(1))
    return F.try_element_at(F.split(F.regexp_replace(hit, "=+$", ""), "="), F.lit(2))


def kv_set(c, key: str, value, delimiter: str = "|") -> Column:
    """Replace the first entry whose name is ``key``; order kept, unknown key unchanged."""
    value = value if isinstance(value, Column) else F.lit(str(value))
    entries = _entries(c, delimiter)
    name = lambda e: F.split_part(e, F.lit("="), F.lit(1))
    first_pos = F.array_position(F.transform(entries, name), F.lit(key))
    updated = F.transform(entries, lambda e, i: F.when((i + 1) == first_pos,
                                                       F.concat(F.lit(key), F.lit("="), value))
                          .otherwise(e))
    return F.array_join(updated, delimiter)


def _entries(c, delimiter: str) -> Column:
    """Split like Java's ``String.split``: trailing empty entries are dropped."""
    q = _regex_quote(delimiter)
    return F.split(F.regexp_replace(_c(c), f"({q})+$", ""), q)


def _regex_quote(s: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?{}[]\|()" else ch for ch in s)
