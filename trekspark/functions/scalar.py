"""Column functions on text, time and numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FEET = 0.3048


def tolerant_double(text: Column) -> Column:
    """The number a text holds, null if it holds none or NaN."""
    return F.nanvl(F.trim(text).try_cast("double"), F.lit(None).cast("double"))


def serial_day(days: Column) -> Column:
    """Timestamp (UTC) of a day number counted from 1899-12-30."""
    return F.timestamp_micros((F.round(days * 86_400e6) - F.lit(2_209_161_600_000_000)).cast("long"))


def seconds_between(earlier: Column, later: Column) -> Column:
    return (F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))) / 1e6


def day_part(hour: Column) -> Column:
    """night 22-6, morning 6-10, midday 10-17, evening 17-22, unknown without an hour."""
    return F.when(hour.isNull(), "unknown").when((hour >= 22) | (hour < 6), "night").when(hour < 10, "morning").when(hour < 17, "midday").otherwise("evening")


def mode_of_speed(kmh: Column, missing: str | None = "") -> Column:
    """walk up to 6 km/h, bike up to 20, bus up to 40, else car; `missing` for no speed."""
    chain = F.when(kmh <= 6, "walk").when(kmh <= 20, "bike").when(kmh <= 40, "bus").when(kmh > 40, "car")
    return F.coalesce(chain, F.lit(missing)) if missing is not None else chain


def speed_kmh(distance_m: Column, seconds: Column) -> Column:
    return F.when(seconds > 0, distance_m / seconds * 3.6)


def calendar(ts: Column) -> dict[str, Column]:
    """year, month, day, weekday (Monday 0), hour, is_weekend, time_of_day."""
    ts = ts.cast("timestamp")
    return {"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts), "weekday": F.weekday(ts), "hour": F.hour(ts), "is_weekend": F.weekday(ts) >= 5, "time_of_day": day_part(F.hour(ts))}
