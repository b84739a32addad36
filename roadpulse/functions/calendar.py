"""Calendar features, one definition for training and serving."""

import math

from pyspark.sql import Column, functions as F


def calendar_features(ts: Column) -> dict[str, Column]:
    """Cyclic hour (fractional, 24 h period) and weekday (0 = Monday), in the session zone."""
    return _encode(F.hour(ts) + F.minute(ts) / F.lit(60.0), F.weekday(ts))


def legacy_calendar_features(ts: Column, zone: str = "Asia/Ho_Chi_Minh") -> dict[str, Column]:
    """As first deployed: a second shift to `zone`, whole hours, and 1 = Sunday."""
    local = F.from_utc_timestamp(ts, zone)
    return _encode(F.hour(local).cast("double"), F.dayofweek(local))


def _encode(hour: Column, day: Column) -> dict[str, Column]:
    angle = hour * F.lit(2 * math.pi / 24)
    return {"hour_sin": F.sin(angle), "hour_cos": F.cos(angle), "dayofweek": day}
