"""Camera and vehicle dimensions."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from spanwatch.schema import CAMERA, CAMERAS, VEHICLE, VEHICLE_TYPES


def cameras(spark: SparkSession, rows=CAMERAS) -> DataFrame:
    """The camera dimension from literal rows, known to the planner in full."""
    values = ", ".join(
        f"({int(cid)}, {float(lat)!r}D, {float(lon)!r}D, {float(km)!r}D, {int(limit)})"
        for cid, lat, lon, km, limit in rows
    )
    names = ", ".join(CAMERA.fieldNames())
    return spark.sql(f"SELECT * FROM VALUES {values} AS c({names})")


def cameras_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CAMERA).csv(path, header=True, enforceSchema=False)


def vehicles_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(VEHICLE).csv(path, header=True, enforceSchema=False)


def store_vehicles(vehicles: DataFrame, path: str) -> None:
    """The registry spread evenly by plate, in plate order within each file, so that a
    lookup of one plate skips row groups."""
    spread = vehicles.repartition("car_plate").sortWithinPartitions("car_plate")
    spread.write.mode("overwrite").parquet(path)


def stored_vehicles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(VEHICLE).parquet(path)


def vehicle_issues(vehicles: DataFrame) -> DataFrame:
    """One row per (plate, issue, rows): a type outside the closed set, or a plate that
    occurs more than once. One grouping on the plate; copies fold before the shuffle."""
    unknown = ~F.coalesce(F.col("vehicle_type").isin(*VEHICLE_TYPES), F.lit(False))
    per_plate = vehicles.groupBy("car_plate").agg(
        F.count(F.lit(1)).alias("registered"),
        F.count_if(unknown).alias("untyped"),
    )
    found = F.array(
        F.struct(
            F.lit("duplicate_plate").alias("issue"),
            F.when(F.col("registered") > 1, F.col("registered")).alias("n_rows"),
        ),
        F.struct(
            F.lit("unknown_type").alias("issue"),
            F.when(F.col("untyped") > 0, F.col("untyped")).alias("n_rows"),
        ),
    )
    return per_plate.select("car_plate", F.inline(found)).filter(F.col("n_rows").isNotNull())
