"""Column expressions on event time."""

from pyspark.sql import Column, functions as F


def parse_time(text: Column) -> Column:
    """Text to timestamp; unreadable text gives null instead of failing the job."""
    return F.try_to_timestamp(text)


def whole_seconds(ts: Column) -> Column:
    """Epoch seconds with the fraction cut off. The cast form is the one from which
    Spark derives how long a stream join must keep a row."""
    return ts.cast("long")


def day_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def minute_of(ts: Column) -> Column:
    return F.date_trunc("minute", ts)


def minute_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm")
