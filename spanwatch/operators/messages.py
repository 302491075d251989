"""Passages to messages and back, and the quality gate behind the decoder."""

from pyspark.sql import Column, DataFrame, functions as F

from spanwatch.functions.times import parse_time
from spanwatch.functions.values import plate_or_null, real_number
from spanwatch.schema import CAMERA_TOPIC_PREFIX, WIRE_EVENT


def encode(events: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """One (key, value, topic) message per passage. The plate is the key, so one
    vehicle's messages stay in order; a passage without a plate has no key and may go
    to any partition. `ingested_at` is a timestamp, the current one if not given."""
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    value = F.struct(
        "event_id",
        "batch_id",
        "car_plate",
        "camera_id",
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"),
        "speed_reading",
        "producer_id",
        F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("ingestion_timestamp"),
    )
    return events.select(
        F.nullif(F.col("car_plate").cast("string"), F.lit("")).alias("key"),
        F.to_json(value, {"ignoreNullFields": "false"}).alias("value"),
        F.concat(F.lit(CAMERA_TOPIC_PREFIX), F.col("camera_id").cast("string")).alias("topic"),
    )


def decode(messages: DataFrame) -> DataFrame:
    """Typed passages from messages. Whatever cannot be read becomes null.

    The struct is unfolded by a generator of one row: filters on its fields stay above
    it. Pushed below a plain projection, each would read the JSON once more.
    """
    parsed = messages.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.inline_outer(F.array(F.from_json(F.col("value").cast("string"), WIRE_EVENT))),
    )
    return parsed.withColumns(
        {
            "car_plate": plate_or_null(F.col("car_plate")),
            "timestamp": parse_time(F.col("timestamp")),
            "ingestion_timestamp": parse_time(F.col("ingestion_timestamp")),
            "speed_reading": real_number(F.col("speed_reading")),
        }
    )


# The fields that a usable passage has, in the order in which they are looked for.
MISSING = ("car_plate", "camera_id", "timestamp")


def quality_filter(events: DataFrame) -> DataFrame:
    """Only passages that say which vehicle, which camera and when."""
    return events.dropna(subset=list(MISSING))


def missing_field() -> Column:
    """The first field that a passage lacks; null for a usable one."""
    first, *others = MISSING
    reason = F.when(F.col(first).isNull(), first)
    for name in others:
        reason = reason.when(F.col(name).isNull(), name)
    return reason


def rejected(events: DataFrame) -> DataFrame:
    """How many passages the quality filter drops, by the first field found missing."""
    return (
        events.select(missing_field().alias("missing"))
        .filter(F.col("missing").isNotNull())
        .groupBy("missing")
        .agg(F.count(F.lit(1)).alias("n_events"))
    )
