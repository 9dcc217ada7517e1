"""Date and time expressions that do not depend on the session time zone."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def lenient_timestamp(col) -> Column:
    """Text to timestamp without zone; what does not parse becomes null."""
    return F.col(col).try_cast("timestamp_ntz")


def whole_days_between(end, start) -> Column:
    """Days from ``start`` to ``end``, rounded towards minus infinity."""
    gap = f"(`{end}` - `{start}`)"
    days = F.expr(f"extract(DAY FROM {gap})").cast("bigint")
    short = F.expr(f"{gap} < make_dt_interval(extract(DAY FROM {gap}))")
    return days - F.when(short, 1).otherwise(0)


def age_in_years(at, born) -> Column:
    """Whole 365-day years; no leap days, null if either side is null."""
    return F.floor(whole_days_between(at, born) / 365)


def age_by_year(at, born) -> Column:
    return (F.year(at) - F.year(born)).cast("bigint")


def calendar_parts(ts) -> dict[str, Column]:
    """Hour, day of month, weekday (Monday is 0) and month."""
    return {"hour": F.hour(ts), "day": F.dayofmonth(ts), "weekday": F.weekday(ts), "month": F.month(ts)}


def is_weekend(weekday) -> Column:
    return F.when(F.col(weekday).isin(5, 6), 1).otherwise(0)


def cycle(col, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a value on a cycle of the given length."""
    angle = F.lit(2 * math.pi) * F.col(col) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)
