"""Row expansion and calendar sequences (H ops): ``explode`` over
``sequence`` / literal arrays, so expansion happens inside each task."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def repeat_by_count(df: DataFrame, count: Column | str, out: str = "rep") -> DataFrame:
    """Each row ``count`` times with ``out`` = 1..count (H2)."""
    k = F.col(count) if isinstance(count, str) else count
    return df.withColumn(out, F.explode(F.sequence(F.lit(1), k.cast("int"))))


def month_series(start: _dt.date | Column, months: int, forward: bool = True) -> Column:
    """First-of-month dates from the month of ``start`` (H3)."""
    s = F.trunc(F.lit(start) if not isinstance(start, Column) else start, "month")
    step = 1 if forward else -1
    end = F.add_months(s, step * (months - 1))
    return F.sequence(s, end, F.expr(f"INTERVAL {step} MONTH"))


def week_series(start: Column, end: Column) -> Column:
    """Mondays from the week of ``start`` to ``end`` (H4)."""
    return F.sequence(F.date_trunc("week", start).cast("date"), end.cast("date"), F.expr("INTERVAL 7 DAYS"))


def spread_offsets(n: Column, total_days: Column, jitter: Column) -> Column:
    """``n`` offsets spaced evenly over [0, total_days], each moved by
    ``jitter(i)`` (a function of the position), clipped, with the first
    pinned to 0 and the last to total_days, sorted (H6)."""
    def off(i):
        base = F.when(n > 1, (i * total_days / (n - 1)).cast("int")).otherwise(F.lit(0))
        moved = F.least(F.greatest(base + jitter(i), F.lit(0)), total_days)
        return F.when(i == 0, F.lit(0)).when(i == n - 1, total_days).otherwise(moved)

    return F.array_sort(F.transform(F.sequence(F.lit(0), n - 1), off))
