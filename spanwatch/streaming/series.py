"""Violations per minute, counted as they arrive.

Each delivery appends how many violations it inserted into each minute; a chart reads these few
rows and no violation. A delivery that is repeated counts anew what it has inserted in all its
attempts, which is no less than before, so of several counts the largest holds.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from spanwatch.operators.documents import timeline
from spanwatch.operators.timeseries import counts_by_minute
from spanwatch.schema import MINUTE_COUNT, VIOLATION
from spanwatch.sources.facts import create_table
from spanwatch.streaming.daily import span_of
from spanwatch.streaming.sink import delivered

FOLDER = ("day",)


def append_counts(
    spark: SparkSession,
    facts_path: str,
    series_path: str,
    slices: list[tuple[str, int]],
    run_id: str,
    epoch: int,
) -> None:
    """Appends the minutes of what a delivery inserted into the given (day, hour) slices."""
    create_table(spark, series_path, MINUTE_COUNT, FOLDER)
    if not slices:
        return
    new = delivered(spark, facts_path, [span_of(*touched) for touched in slices], run_id, epoch)
    (
        counts_by_minute(timeline(new.select(*VIOLATION.fieldNames())))
        .withColumns(
            {
                "run_id": F.lit(run_id),
                "epoch": F.lit(epoch).cast("long"),
                "day": F.date_format("minute", "yyyy-MM-dd"),
            }
        )
        .select(*MINUTE_COUNT.fieldNames())
        .hint("rebalance", *FOLDER)
        .write.mode("append")
        .partitionBy(*FOLDER)
        .parquet(series_path)
    )


def minute_counts(spark: SparkSession, series_path: str) -> DataFrame:
    """(minute, count) of all that has been stored, as `timeseries.per_minute` of all facts gives.
    A filter on the day reads its folder only."""
    kept = spark.read.schema(MINUTE_COUNT).parquet(series_path)
    return (
        kept.groupBy("day", "minute", "run_id", "epoch")
        .agg(F.max("count").alias("count"))
        .groupBy("day", "minute")
        .agg(F.sum("count").alias("count"))
    )


def compact_series(spark: SparkSession, series_path: str, target: str) -> None:
    """The series with one row per minute and delivery in few files at a new path, to be done while
    the writer is stopped."""
    kept = spark.read.schema(MINUTE_COUNT).parquet(series_path)
    (
        kept.groupBy("minute", "run_id", "epoch", "day")
        .agg(F.max("count").alias("count"))
        .select(*MINUTE_COUNT.fieldNames())
        .hint("rebalance", *FOLDER)
        .write.mode("errorifexists")
        .partitionBy(*FOLDER)
        .parquet(target)
    )
