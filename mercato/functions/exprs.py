"""Scalar expressions with the exact semantics the plans rely on."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(value: datetime | Column) -> Column:
    """A zone-less timestamp literal; as text, so the driver's own time zone plays no part."""
    column = F.lit(value.isoformat(sep=" ")) if isinstance(value, datetime) else value
    return column.cast("timestamp_ntz")


def flag(condition: Column) -> Column:
    """A condition that is never NULL: unknown counts as false."""
    return F.coalesce(condition, F.lit(False))


def whole_hours(start: str, end: str) -> Column:
    """Full hours from ``start`` to ``end``, truncated towards zero."""
    return F.timestamp_diff("HOUR", F.col(start), F.col(end))


def day_span(start: str | Column, end: str | Column) -> Column:
    """Calendar days between the dates of two timestamps."""
    return F.datediff(F.to_date(end), F.to_date(start))


def month_of(day: str | Column) -> Column:
    return F.trunc(day, "month")


def stamp(ts: str) -> Column:
    """Timestamp as fixed-pattern text."""
    return F.date_format(F.col(ts), "yyyy-MM-dd HH:mm:ss")


def percent(part: str, whole: str, digits: int = 2) -> str:
    """SQL for ``part`` of ``whole`` in percent, 0 where the whole is 0."""
    return f"round(CASE WHEN {whole} > 0 THEN {part} * 100.0D / {whole} ELSE 0.0D END, {digits})"


def rate(condition: Column) -> Column:
    """Share of rows where ``condition`` holds, as an aggregate."""
    return F.avg(condition.cast("double"))


def digest(columns: list[Column]) -> list[Column]:
    """128 bits of a row. A hash skips a NULL, so where they stand is hashed too."""
    parts = [*columns, *(c.isNull() for c in columns)]
    return [F.xxhash64(*parts).alias("_d1"), F.xxhash64(F.lit(1), *parts).alias("_d2")]


def in_box(lat: str, lng: str, box: dict[str, tuple[float, float]]) -> Column:
    """Inclusive bounding box; NaN and NULL are not inside."""
    return F.col(lat).between(*box["lat"]) & F.col(lng).between(*box["lng"])


def outside_box(lat: str, lng: str, box: dict[str, tuple[float, float]]) -> Column:
    """Strictly outside on either axis; NaN and NULL are not outside either."""
    def beyond(name: str, low: float, high: float) -> Column:
        value = F.nanvl(F.col(name), F.lit(None).cast("double"))
        return flag((value < low) | (value > high))

    return beyond(lat, *box["lat"]) | beyond(lng, *box["lng"])
