"""Counts over incoming events."""

from pyspark.sql import DataFrame, functions as F


def ingest_totals(events: DataFrame) -> DataFrame:
    """Events, batches and the last batch."""
    return events.agg(
        F.count(F.lit(1)).alias("n_events"),
        F.countDistinct("batch_id").alias("n_batches"),
        F.max("batch_id").alias("last_batch"),
    )


def by_producer(events: DataFrame, producer_id: str | None = None) -> DataFrame:
    """Events, times and top speed per producer, or of one producer."""
    if producer_id is not None:
        events = events.filter(F.col("producer_id") == producer_id)
    return events.groupBy("producer_id").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.min("timestamp").alias("first_seen"),
        F.max("timestamp").alias("last_seen"),
        F.max("speed_reading").alias("top_speed"),
    )
