"""Column expressions shared by the operators: boxes, buckets, labels, calendar features, scalar validators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetspan.settings import BOXES, Box


def in_box(lat: Column, lon: Column, box: Box = BOXES["strict"]) -> Column:
    return lat.between(box[0], box[1]) & lon.between(box[2], box[3])


def banded(x: Column, bands: list[tuple[float, str]], rest: str, inclusive: bool = False) -> Column:
    """Label of the first band whose upper bound is above ``x`` (or equal, if inclusive); ``rest`` also for null."""
    out = None
    for bound, label in bands:
        test = x <= bound if inclusive else x < bound
        out = F.when(test, label) if out is None else out.when(test, label)
    return out.otherwise(rest)


def congestion_index(kmh: Column, null_index: int | None = 10) -> Column:
    """0 to 100 from the average speed; an unknown speed has ``null_index``."""
    index = F.when(kmh < 10, 80).when(kmh < 15, 50).when(kmh < 20, 30).when(kmh.isNotNull(), 10)
    return index if null_index is None else F.coalesce(index, F.lit(null_index))


def congestion_level(kmh: Column) -> Column:
    return banded(kmh, [(10, "Critical"), (15, "High"), (20, "Medium")], "Low")


def headway_quality(minutes: Column) -> Column:
    return banded(minutes, [(5, "excellent"), (10, "good"), (15, "fair")], "poor", inclusive=True)


def is_moving(speed: Column, above: float = 5.0) -> Column:
    """False for an unknown speed."""
    return F.coalesce(speed > above, F.lit(False))


def calendar(ts: Column) -> dict[str, Column]:
    """Calendar features; days count from Sunday = 1, the rush is 7 to 9 and 17 to 19 on working days, ends included."""
    hour, day = F.hour(ts), F.dayofweek(ts)
    weekend = day.isin(1, 7)
    period = F.when(hour.between(6, 11), "morning").when(hour.between(12, 17), "afternoon").when(hour.between(18, 21), "evening").otherwise("night")
    return {
        "date": F.to_date(ts), "hour_of_day": hour, "minute": F.minute(ts), "day_of_week": day, "day_name": F.date_format(ts, "EEEE"), "is_weekend": weekend, "time_period": F.when(hour.isNotNull(), period),
        "is_rush_hour": (hour.between(7, 9) | hour.between(17, 19)) & ~weekend, "week_of_year": F.weekofyear(ts), "month": F.month(ts), "month_name": F.date_format(ts, "MMMM"), "quarter": F.quarter(ts),
    }


def clock_hour(text: Column) -> Column:
    """Hour of a timetable time, which may run beyond 24; null if it is none."""
    return F.pmod(F.get(F.split(text, ":"), F.lit(0)).try_cast("int"), F.lit(24))


def truncated(text: Column, most: int, suffix: str = "...") -> Column:
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most - len(suffix)), F.lit(suffix))).otherwise(text)


def valid_place(lat: Column, lon: Column, box: Box = BOXES["global"]) -> Column:
    """Both known, inside the box, and not the null island."""
    return F.coalesce(in_box(lat, lon, box) & ~((lat == 0) & (lon == 0)), F.lit(False))


def valid_speed(speed: Column, limit: float = 120.0) -> Column:
    return F.coalesce(speed.between(0, limit), F.lit(False))


def valid_time(ts: Column, now: Column, past_hours: float = 24, ahead_hours: float = 1) -> Column:
    gap = F.unix_micros(now) - F.unix_micros(ts)
    return F.coalesce(gap.between(-int(ahead_hours * 3.6e9), int(past_hours * 3.6e9)), F.lit(False))


def valid_vehicle(vehicle: Column) -> Column:
    return F.coalesce(F.length(F.trim(vehicle)).between(1, 50), F.lit(False))


def valid_email(text: Column) -> Column:
    return F.coalesce(text.rlike(r"^[\w.%+-]+@[\w-]+(\.[\w-]+)*\.[A-Za-z]{2,}$"), F.lit(False))


def valid_phone(text: Column) -> Column:
    """Ten or eleven digits once all else is taken away."""
    return F.coalesce(F.length(F.regexp_replace(text, r"\D", "")).between(10, 11), F.lit(False))


def service_quality(on_time: Column, occupancy: Column, kmh: Column, full_kmh: float = 50.0) -> Column:
    """0 to 100 from the shares on time (40) and occupied (30) and the speed (30 at ``full_kmh``); null if one is unknown."""
    score = on_time * 40 + occupancy * 30 + kmh / full_kmh * 30
    return F.when(score.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(100.0), score)))


def days_between(start: Column, end: Column) -> Column:
    """Array of the times from ``start``, a day apart, up to ``end``; empty if ``end`` is earlier, null if one is unknown. ``explode`` gives a row each."""
    return F.when(start <= end, F.sequence(start, end, F.expr("interval 1 day"))).when(start > end, F.array().cast("array<timestamp>"))


def partition_path(ts: Column, parts: tuple[str, ...] = ("year", "month", "day")) -> Column:
    """``year=2024/month=01/day=15``, and ``hour`` if asked for; all but the year with two digits. Null for an unknown time."""
    pattern = {"year": "y", "month": "MM", "day": "dd", "hour": "HH"}
    return F.concat(*(F.concat(F.lit(("/" if k else "") + f"{p}="), F.date_format(ts, pattern[p])) for k, p in enumerate(parts)))


def speed_label(kmh: Column, limit: float = 120.0) -> Column:
    """VALID from 0 to the limit, else INVALID, also for an unknown speed."""
    return F.when(valid_speed(kmh, limit), "VALID").otherwise("INVALID")


def is_peak_load(load: Column, above: float = 40.0) -> Column:
    """Whether the load of an hour is above the bound; false for an unknown one."""
    return F.coalesce(load > above, F.lit(False))
