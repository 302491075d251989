"""Speed limit and place on the road for every passage."""

from pyspark.sql import DataFrame, Window, functions as F

from spanwatch.operators.dimension import join_dimension, measured
from spanwatch.params import BROADCAST_ROWS, Params

ROAD = ["road_km", "road_first", "road_last", "road_rank", "road_ranks"]


def with_limits(
    events: DataFrame,
    cameras: DataFrame,
    params: Params = Params(),
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Adds speed_limit and the place on the road. A passage at an unknown camera
    stays, with a null limit.

    road_km is where the camera stands; road_first and road_last say that no camera
    stands before or after it; road_rank counts the cameras before it, out of
    road_ranks. A plan that does not use the ranks drops their computation.
    """
    extent = measured(
        cameras,
        F.min("position").alias("first"),
        F.max("position").alias("last"),
        max_rows=broadcast_rows,
    )
    limit = F.col("speed_limit").cast("long").alias("speed_limit")
    if params.road_axis == "camera_id":
        joined = join_dimension(
            events, cameras.select("camera_id", limit), "camera_id", extent is not None
        )
        # Ids are 32-bit; shifted to be non-negative they serve as ranks.
        return joined.withColumns(
            {
                "road_km": F.col("camera_id").cast("double"),
                "road_first": F.lit(False),
                "road_last": F.lit(False),
                "road_rank": F.col("camera_id").cast("long") + F.lit(2**31),
                "road_ranks": F.lit(2**32),
            }
        )

    def stands_at(end: str):
        if extent is None or extent[end] is None:
            return F.lit(False)
        return F.col("position") == F.lit(extent[end])

    # These windows have no partition: they run over the camera dimension alone.
    rank = F.dense_rank().over(Window.orderBy("position")).cast("long") - 1
    placed = cameras.select(
        "camera_id",
        limit,
        F.col("position").alias("road_km"),
        stands_at("first").alias("road_first"),
        stands_at("last").alias("road_last"),
        rank.alias("road_rank"),
    ).withColumn("road_ranks", F.max("road_rank").over(Window.partitionBy()) + 1)
    return join_dimension(events, placed, "camera_id", extent is not None)
