"""Session statistics: counts, length buckets and ratios."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import STEP_BUCKETS, STEP_RATIO_COLUMNS, VISIT_BUCKETS, VISIT_RATIO_COLUMNS
from ..functions.columns import ratio_sql


def _in_bucket(c: Column, lo: int, hi: int | None) -> Column:
    return (c >= lo) if hi is None else c.between(lo, hi)


def bucket_label(c, buckets) -> Column:
    """Label of the bucket holding ``c``; NULL when none (0-second visits)."""
    c = F.col(c) if isinstance(c, str) else c
    expr = None
    for label, lo, hi in buckets:
        cond = _in_bucket(c, lo, hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def visit_bucket(c="visit_length") -> Column:
    return bucket_label(c, VISIT_BUCKETS)


def step_bucket(c="step_length") -> Column:
    return bucket_label(c, STEP_BUCKETS)


def _bucket_sql(col: str, lo: int, hi: int | None) -> str:
    return f"{col} >= {lo}" if hi is None else f"{col} BETWEEN {lo} AND {hi}"


def bucket_counts(sessions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """session_count and the 15 bucket counts, one row or one row for each ``by``.

    Every task emits one partial row (for each ``by``), the final step
    merges them, so there is no skew and no driver-side accumulator.
    """
    aggs = ["count(1) AS session_count"]
    aggs += [f"count_if({_bucket_sql('visit_length', lo, hi)}) AS visit_length_{label}"
             for label, lo, hi in VISIT_BUCKETS]
    aggs += [f"count_if({_bucket_sql('step_length', lo, hi)}) AS step_length_{label}"
             for label, lo, hi in STEP_BUCKETS]
    return sessions.groupBy(*by).agg(*[F.expr(a) for a in aggs])


def session_aggr_stat(sessions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """session_count and 15 ratios rounded half-up to 2 places (0.0 if no sessions)."""
    cols = [*by, "session_count"]
    cols += [f"{ratio_sql(f'visit_length_{label}', 'session_count')} AS {name}"
             for (label, _, _), name in zip(VISIT_BUCKETS, VISIT_RATIO_COLUMNS)]
    cols += [f"{ratio_sql(f'step_length_{label}', 'session_count')} AS {name}"
             for (label, _, _), name in zip(STEP_BUCKETS, STEP_RATIO_COLUMNS)]
    return bucket_counts(sessions, by).selectExpr(*cols)


def bucket_distribution(sessions: DataFrame, which: str = "visit") -> DataFrame:
    """Sessions per bucket label (visit or step), labels without sessions omitted."""
    label = visit_bucket() if which == "visit" else step_bucket()
    return (sessions.select(label.alias("bucket"))
            .groupBy("bucket").agg(F.count(F.lit(1)).alias("session_count")))
