"""The series behind the charts. Input is `timeline` rows."""

from pyspark.sql import DataFrame, functions as F

from spanwatch.functions.times import minute_of
from spanwatch.schema import AVERAGE_SPEED, SPEED


def counts_by_minute(timeline: DataFrame) -> DataFrame:
    """Violations per minute of arrival, in no order."""
    return timeline.groupBy(minute_of(F.col("arrival_time")).alias("minute")).agg(
        F.count(F.lit(1)).alias("count")
    )


def per_minute(timeline: DataFrame) -> DataFrame:
    """Violations per minute of arrival, in time order. What is sorted has one row per
    minute, however many violations there were."""
    return counts_by_minute(timeline).orderBy("minute")


def peak_minute(timeline: DataFrame) -> DataFrame:
    """The busiest minute, the earliest of equals; no row for no violations."""
    earliest = F.struct(F.col("count"), -F.unix_seconds("minute"))
    return (
        counts_by_minute(timeline)
        .agg(F.max_by(F.struct("minute", "count"), earliest).alias("peak"))
        .filter(F.col("peak").isNotNull())
        .select("peak.*")
    )


def speed_series(timeline: DataFrame) -> DataFrame:
    """Points of the two speed series."""
    return timeline.filter(F.col("violation_type").isin(SPEED, AVERAGE_SPEED)).select(
        "violation_type", "arrival_time", "speed_val"
    )


def limit_lines(cameras: DataFrame) -> DataFrame:
    """The limits to draw across the speed chart."""
    return cameras.select(F.col("speed_limit").cast("double").alias("speed_limit")).distinct()
