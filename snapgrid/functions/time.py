"""Time expressions. Instants are UTC timestamps, arithmetic is on whole microseconds."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

MINUTE_US = 60_000_000
HOUR_US = 60 * MINUTE_US
DAY_US = 24 * HOUR_US


def floor_to(ts: Column, minutes: int) -> Column:
    """Floor an instant to a multiple of ``minutes``.

    Done on UTC microseconds, so the repeated local hour in autumn needs no special case.
    """
    step = minutes * MINUTE_US
    us = F.unix_micros(ts)
    return F.timestamp_micros(us - F.pmod(us, F.lit(step)))


def parse_instant(text: Column) -> Column:
    """Tolerant ISO-8601 parse, row by row; text that is no instant becomes null."""
    return F.try_to_timestamp(text.cast("string"))


def minutes_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(float(MINUTE_US))


def minutes_of_day(text: Column) -> Column:
    """``H:MM`` to minutes since midnight; ``24:00`` is 1440; anything else is null."""
    clean = F.trim(text.cast("string"))
    shape = r"^([0-9]{1,2}):([0-9]{1,2})$"
    hour = F.regexp_extract(clean, shape, 1).try_cast("int")
    minute = F.regexp_extract(clean, shape, 2).try_cast("int")
    in_day = (hour < 24) & (minute < 60)
    return F.when(clean == "24:00", F.lit(1440)).when(in_day, hour * 60 + minute)


def clock_features(ts: Column, zone: str, digits: int | None = None) -> dict[str, Column]:
    """Hour and weekday (Monday = 0) on the local clock of ``zone``, and their cyclic forms, on request rounded.

    The cyclic forms are looked up: there are as many as hours and weekdays.
    """
    local = F.unix_micros(F.from_utc_timestamp(ts, zone))
    hour = F.floor(F.pmod(local, F.lit(DAY_US)) / F.lit(HOUR_US)).cast("int")
    # The first day of 1970 was a Thursday.
    dow = F.floor(F.pmod(local + F.lit(3 * DAY_US), F.lit(7 * DAY_US)) / F.lit(DAY_US)).cast("int")

    def cyclic(form, place: Column, period: int) -> Column:
        values = [form(F.lit(2 * math.pi) * F.lit(i) / F.lit(float(period))) for i in range(period)]
        return F.get(F.array(*[v if digits is None else F.round(v, digits) for v in values]), place)

    return {
        "hour": hour,
        "dayofweek": dow,
        "sin_hour": cyclic(F.sin, hour, 24),
        "cos_hour": cyclic(F.cos, hour, 24),
        "sin_dow": cyclic(F.sin, dow, 7),
        "cos_dow": cyclic(F.cos, dow, 7),
    }


def month_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def iso_text(ts: Column) -> Column:
    """ISO-8601 rendering for text exports."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")


def grid_steps(horizon_minutes: int, grid_minutes: int) -> tuple[int, int]:
    """Grid rows ahead that cover a horizon, and the horizon they amount to."""
    steps = math.ceil(horizon_minutes / grid_minutes)
    return steps, steps * grid_minutes


def int_list(text: str) -> list[int]:
    """``"5, 10,30"`` to a list of ints; empty text to an empty list."""
    return [int(part) for part in text.split(",") if part.strip()]
