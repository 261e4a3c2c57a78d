"""Scalar columns of the model frame."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

def cyclical(value: Column, period: int) -> tuple[Column, Column]:
    angle = value * F.lit(2 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def time_columns(instant: str) -> dict[str, Column]:
    """UTC hour, minute and weekday (Monday "0"), and their cycles."""
    hour, day = F.hour(instant), F.weekday(instant)
    hour_sin, hour_cos = cyclical(hour, 24)
    dow_sin, dow_cos = cyclical(day, 7)
    return {"hour": hour, "minute": F.minute(instant), "day_of_week": day.cast("string"), "hour_sin": hour_sin, "hour_cos": hour_cos, "dow_sin": dow_sin, "dow_cos": dow_cos}


def log_columns() -> dict[str, Column]:
    return {"log_volume": F.log1p("total_volume"), "log_close": F.log("close")}
