"""Where camera passages come from: CSV files, Kafka topics, or files of messages."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from spanwatch.functions.times import parse_time
from spanwatch.functions.values import plate_or_null, real_number
from spanwatch.params import Params
from spanwatch.schema import (
    CAMERA_TOPIC_PREFIX,
    CSV_EVENT,
    MESSAGE,
    PASSAGE,
    PRODUCER_PREFIX,
)

# ---- fixed values: connector options --------------------------------------
KAFKA_READER = {"startingOffsets": "latest", "failOnDataLoss": "false"}
KAFKA_WRITER = {
    "kafka.acks": "all",
    "kafka.retries": "3",
    "kafka.retry.backoff.ms": "100",
    "kafka.compression.type": "gzip",
}
# ---------------------------------------------------------------------------


def csv_events(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All camera CSV files in one scan. Files named camera_event_<letter>.csv (a file
    or a folder of parts) are stamped with the producer of that letter."""
    letter = F.lower(F.regexp_extract("_metadata.file_path", r"camera_event_([A-Za-z])\.csv", 1))
    return (
        spark.read.schema(CSV_EVENT)
        .csv(paths, header=True, enforceSchema=False)
        .select(
            "event_id",
            "batch_id",
            plate_or_null(F.col("car_plate")).alias("car_plate"),
            "camera_id",
            parse_time(F.col("timestamp")).alias("timestamp"),
            real_number(F.col("speed_reading")).alias("speed_reading"),
            F.concat(F.lit(PRODUCER_PREFIX), F.nullif(letter, F.lit(""))).alias("producer_id"),
        )
    )


def topics(camera_ids) -> list[str]:
    return [f"{CAMERA_TOPIC_PREFIX}{camera_id}" for camera_id in camera_ids]


def kafka_options(servers: str, camera_ids, params: Params = Params()) -> dict[str, str]:
    """Reader options: the topics of the cameras only, and a bounded intake."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics(camera_ids)),
        "maxOffsetsPerTrigger": str(params.max_offsets_per_trigger),
        **KAFKA_READER,
    }


def kafka_messages(
    spark: SparkSession, servers: str, camera_ids, params: Params = Params()
) -> DataFrame:
    """Streaming messages from Kafka. Needs the connector package on the cluster."""
    raw = spark.readStream.format("kafka").options(**kafka_options(servers, camera_ids, params))
    return raw.load().select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic",
    )


def publish_options(servers: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, **KAFKA_WRITER}


def publishable(messages: DataFrame) -> DataFrame:
    """Messages that name a topic. A passage without a camera has none, and one such message
    would fail the whole write."""
    return messages.filter(F.col("topic").isNotNull())


def publish_counts(messages: DataFrame) -> DataFrame:
    """(topic, sent, refused): what `publish` writes to each topic, and under no topic what
    it leaves out."""
    return messages.groupBy("topic").agg(
        F.count_if(F.col("topic").isNotNull()).alias("sent"),
        F.count_if(F.col("topic").isNull()).alias("refused"),
    )


def publish(messages: DataFrame, servers: str) -> DataFrame:
    """Writes messages to the topics they name and returns `publish_counts`. Needs the
    connector package."""
    publishable(messages).write.format("kafka").options(**publish_options(servers)).save()
    return publish_counts(messages)


def _file_stream(spark: SparkSession, schema, path: str, max_files: int | None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def file_messages(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same message shape streamed from Parquet files as they land in a folder."""
    return _file_stream(spark, MESSAGE, path, max_files)


def stored_passages(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Passages streamed from the table that a decoding stream writes."""
    return _file_stream(spark, PASSAGE, path, max_files)
