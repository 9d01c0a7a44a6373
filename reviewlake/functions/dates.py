"""Calendar columns of a timestamp."""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewlake.functions.expr import flag, whole_days


def day_of_week(ts: Column) -> Column:
    """Monday = 0."""
    return F.weekday(ts)


def calendar(ts: Column) -> dict[str, Column]:
    """Year to quarter, plus sine / cosine positions of month and weekday."""
    month, weekday = F.month(ts), day_of_week(ts)
    turn = 2 * math.pi
    return {
        "year": F.year(ts), "month": month, "day": F.dayofmonth(ts), "day_of_week": weekday,
        "day_of_year": F.dayofyear(ts), "week_of_year": F.weekofyear(ts), "quarter": F.quarter(ts),
        "month_sin": F.sin(turn * month / 12), "month_cos": F.cos(turn * month / 12),
        "day_of_week_sin": F.sin(turn * weekday / 7), "day_of_week_cos": F.cos(turn * weekday / 7),
    }


def age(ts: Column, latest: Column) -> dict[str, Column]:
    """Distance to the latest instant in days, weeks and months."""
    days = whole_days(latest, ts)
    return {"days_since_latest": days, "weeks_since_latest": days / 7, "months_since_latest": days / 30.44}


def is_weekend(ts: Column) -> Column:
    return day_of_week(ts).isin(5, 6)


def seasons(ts: Column) -> dict[str, Column]:
    """0 / 1 flags of weekend, holiday season and summer."""
    return {"is_weekend": flag(is_weekend(ts)),
            "is_holiday_season": flag(F.month(ts).isin(11, 12)),
            "is_summer": flag(F.month(ts).isin(6, 7, 8))}
