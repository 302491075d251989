"""Column expressions on readings and on the fields of a violation."""

from pyspark.sql import Column, functions as F

from spanwatch.schema import SPEED


def real_number(value: Column) -> Column:
    """NaN compares greater than every limit, so it must not stay in a reading."""
    return F.when(~F.isnan(value), value)


def plate_or_null(plate: Column) -> Column:
    """A plate that was missing at the producer arrives as the text of a NaN, which the
    JSON reader hands on with quotes if it stood there without."""
    return F.when(~plate.isin("NaN", "nan", '"NaN"'), plate)


def km_per_hour(km: Column, seconds: Column) -> Column:
    """Null, not an error, where no whole second passed."""
    return F.try_divide(km, seconds / F.lit(3600.0))


def arrival_time(kind: Column, details: str) -> Column:
    """When the vehicle was first seen: at its only camera, or at the entry camera."""
    return F.when(kind == SPEED, F.col(f"{details}.timestamp")).otherwise(
        F.col(f"{details}.timestamp_start")
    )


def speed_value(kind: Column, details: str) -> Column:
    return F.when(kind == SPEED, F.col(f"{details}.speed")).otherwise(F.col(f"{details}.avg_speed"))


def event_time(details: str) -> Column:
    """The time a violation is dated by: its only reading, or the exit reading."""
    return F.coalesce(F.col(f"{details}.timestamp"), F.col(f"{details}.timestamp_end"))
