"""Camera passages and vehicles as views over the driver's test tables."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from spanwatch.schema import CAMERAS, PRODUCER_PREFIX, VEHICLE_TYPES

# The same cameras spread over 600 km: test passages of one plate are hours apart,
# so only a long corridor yields average speeds to judge.
LONG_CORRIDOR = tuple(
    (cid, lat, lon, 300.0 * n, limit) for n, (cid, lat, lon, _, limit) in enumerate(CAMERAS)
)
LONG_TOLERANCE_S = 21_600

# The columns used of the test tables. Declared, so that no job is spent on looking.
EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, value DOUBLE, props STRING"
CUSTOMER = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_mktsegment STRING"
NATION = "n_nationkey INT, n_name STRING"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = {"events": EVENTS, "customer": CUSTOMER, "nation": NATION}[name]
    return spark.read.schema(schema).parquet(f"{sf_dir}/{name}.parquet")


def plate(number: Column) -> Column:
    """The plate of a number, padded to five digits. Longer numbers stay whole; a plain
    `lpad` would cut them, and vehicles would share a plate."""
    digits = number.cast("string")
    width = F.greatest(F.lit(5), F.length(digits))
    return F.concat(F.lit("P"), F.lpad(digits, width, F.lit("0")))


def camera_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as passages: the user is the vehicle, the id picks one of three cameras."""
    camera = (F.col("event_id") % 3 + 1).cast("int")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.expr("event_id DIV 100").alias("batch_id"),
        plate(F.col("user_id")).alias("car_plate"),
        camera.alias("camera_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("value").alias("speed_reading"),
        F.concat(F.lit(PRODUCER_PREFIX), F.substr(F.lit("abc"), camera, F.lit(1))).alias(
            "producer_id"
        ),
    )


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`customer` as vehicles, `nation` as their addresses."""
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    kinds = F.array(*[F.lit(kind) for kind in VEHICLE_TYPES])
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        plate(F.col("c_custkey")).alias("car_plate"),
        F.col("c_name").alias("owner_name"),
        F.col("n_name").alias("owner_addr"),
        F.element_at(kinds, (F.col("c_custkey") % len(VEHICLE_TYPES) + 1).cast("int")).alias(
            "vehicle_type"
        ),
        F.date_add(F.lit("2000-01-01").cast("date"), (F.col("c_custkey") % 7300).cast("int"))
        .cast("timestamp")
        .alias("registration_date"),
    )
