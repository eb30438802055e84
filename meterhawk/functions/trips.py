"""Column expressions over one trip. Everything here stays inside whole-stage codegen."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterhawk import schema as S

ColumnLike = Column | str


def _col(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def nan_to_null(value: ColumnLike) -> Column:
    """NaN sorts above every number in Spark; as null it fails every comparison instead."""
    return F.nanvl(_col(value), F.lit(None).cast("double"))


def parse_time(value: ColumnLike) -> Column:
    """Timestamp of a datetime text; null for anything unreadable ('NaT' included)."""
    return F.try_to_timestamp(_col(value))


def trip_duration(pickup: ColumnLike, dropoff: ColumnLike) -> Column:
    """Whole seconds between two timestamps."""
    return F.unix_timestamp(_col(dropoff)) - F.unix_timestamp(_col(pickup))


def trip_duration_exact(pickup: ColumnLike, dropoff: ColumnLike) -> Column:
    """Seconds between two timestamps with their fraction kept."""
    return F.timestamp_diff("MICROSECOND", _col(pickup), _col(dropoff)) / F.lit(1e6)


def pickup_hour(pickup: ColumnLike) -> Column:
    return F.hour(_col(pickup))


def avg_speed(distance: ColumnLike, duration: ColumnLike, eps: float = 0.0) -> Column:
    """Kilometres per hour from miles and seconds."""
    hours = (_col(duration) + F.lit(eps) if eps else _col(duration)) / F.lit(3600.0)
    return F.try_divide(_col(distance) * F.lit(S.KM_PER_MILE), hours)


def fare_per_mile(fare: ColumnLike, distance: ColumnLike, eps: float = 0.0) -> Column:
    return F.try_divide(_col(fare), _col(distance) + F.lit(eps) if eps else _col(distance))


def fare_distance_ratio(fare: ColumnLike, distance: ColumnLike) -> Column:
    return fare_per_mile(fare, distance, S.RATIO_OFFSET_MILES)


def hour_angle(hour: ColumnLike) -> Column:
    return F.lit(2 * math.pi) * _col(hour) / F.lit(24.0)


def hour_sin(hour: ColumnLike) -> Column:
    return F.sin(hour_angle(hour))


def hour_cos(hour: ColumnLike) -> Column:
    return F.cos(hour_angle(hour))


def log_feature(value: ColumnLike, clamp: bool = False) -> Column:
    """``log1p``; with ``clamp`` negative values count as 0 (null stays null)."""
    value = _col(value)
    return F.log1p(F.when(value < 0, F.lit(0.0)).otherwise(value) if clamp else value)


def speed_x_duration(speed: ColumnLike, duration: ColumnLike) -> Column:
    return _col(speed) * _col(duration) / F.lit(3600.0)


def _hour_flag(hour: ColumnLike, hours: list[int]) -> Column:
    return F.coalesce(_col(hour).isin(hours), F.lit(False)).cast("int")


def rush_hour(hour: ColumnLike) -> Column:
    return _hour_flag(hour, S.RUSH_HOURS)


def night(hour: ColumnLike) -> Column:
    return _hour_flag(hour, S.NIGHT_HOURS)


def safe_int(value: ColumnLike, fallback: int = 0) -> Column:
    """Truncating integer cast; ``fallback`` for null, NaN, overflow and text that is no number."""
    number = nan_to_null(_col(value).try_cast("double"))
    return F.coalesce(number.try_cast("int"), F.lit(fallback))


def cents(value: ColumnLike) -> Column:
    """Two decimals, ties to even on the scaled double; NaN counts as missing."""
    return F.rint(nan_to_null(value) * F.lit(100.0)) / F.lit(100.0)


def valid_trip() -> Column:
    """Physically possible trips. NaN distance and fare pass here; ``complete`` removes them."""
    return (
        (F.col("trip_duration_sec") > S.MIN_DURATION_SEC)
        & (F.col("trip_distance") > S.MIN_DISTANCE)
        & (F.col("fare_amount") > S.MIN_FARE)
        & F.col("passenger_count").between(S.MIN_PASSENGERS, S.MAX_PASSENGERS)
    )


def complete(columns: list[str], floats: set[str]) -> Column:
    """True when no named column is null or (for floating columns) NaN."""
    test = F.lit(True)
    for name in columns:
        test = test & F.col(name).isNotNull()
        if name in floats:
            test = test & ~F.isnan(name)
    return test


def fixed(value: ColumnLike, places: int) -> Column:
    """Fixed-point text, ties to even on the exact binary value (as C and Python print it)."""
    return F.call_function("format_number", _col(value), F.lit("0." + "0" * places if places else "0"))
