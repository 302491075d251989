"""The two detection rules and their union."""

from pyspark.sql import DataFrame, functions as F

from spanwatch.functions.times import day_text, whole_seconds
from spanwatch.functions.values import km_per_hour
from spanwatch.operators.segments import segment_pairs
from spanwatch.params import Params
from spanwatch.schema import AVERAGE_SPEED, SPEED, VIOLATION


def instant_violations(enriched: DataFrame) -> DataFrame:
    """Readings above the limit of their camera; equal to the limit is allowed."""
    details = F.struct("camera_id", "timestamp", F.col("speed_reading").alias("speed"))
    return enriched.filter(F.col("speed_reading") > F.col("speed_limit")).select(
        "car_plate",
        day_text(F.col("timestamp")).alias("violation_date"),
        F.lit(SPEED).alias("violation_type"),
        "speed_limit",
        details.alias("event_details"),
    )


def average_violations(pairs: DataFrame) -> DataFrame:
    """Pairs covered faster than the end camera allows. Dated by the exit time."""
    seconds = whole_seconds(F.col("timestamp_end")) - whole_seconds(F.col("timestamp_start"))
    judged = pairs.withColumn("avg_speed", km_per_hour(F.col("distance_km"), seconds))
    details = F.struct(
        "camera_id_start", "camera_id_end", "timestamp_start", "timestamp_end", "avg_speed"
    )
    return judged.filter(F.col("avg_speed") > F.col("speed_limit_end")).select(
        "car_plate",
        day_text(F.col("timestamp_end")).alias("violation_date"),
        F.lit(AVERAGE_SPEED).alias("violation_type"),
        F.col("speed_limit_end").alias("speed_limit"),
        details.alias("event_details"),
    )


def violations(
    enriched: DataFrame, params: Params = Params(), hot_plates: tuple[str, ...] = ()
) -> DataFrame:
    """Both kinds in one table; the details struct carries the fields of either."""
    both = instant_violations(enriched).unionByName(
        average_violations(segment_pairs(enriched, params, hot_plates)), allowMissingColumns=True
    )
    return both.select(*VIOLATION.fieldNames())
