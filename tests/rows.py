"""Small hand-made passages."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from spanwatch.operators.enrich import with_limits
from spanwatch.params import Params
from spanwatch.sources.dimensions import cameras

DAY = "2024-03-01"
EVENT = (
    "event_id string, batch_id long, car_plate string, camera_id int, time string,"
    " speed_reading double, producer_id string"
)


def passages(spark: SparkSession, rows) -> DataFrame:
    """Rows of (plate, camera, time of day or full time, speed)."""
    data = [
        (str(n), n // 10, plate, camera, time if "-" in time else f"{DAY} {time}", speed, "p")
        for n, (plate, camera, time, speed) in enumerate(rows)
    ]
    return spark.createDataFrame(data, EVENT).select(
        "event_id",
        "batch_id",
        "car_plate",
        "camera_id",
        F.col("time").cast("timestamp").alias("timestamp"),
        "speed_reading",
        "producer_id",
    )


def enriched(spark: SparkSession, rows, params: Params = Params(), dim=None) -> DataFrame:
    return with_limits(passages(spark, rows), dim or cameras(spark), params)


def bag(frame: DataFrame) -> list:
    """All rows in an order that does not depend on the plan."""
    names = sorted(frame.columns)
    return sorted((tuple(row) for row in frame.select(*names).collect()), key=repr)
