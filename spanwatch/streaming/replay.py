"""Stored events released as a stream, in the order of their batches.

The batches are released in waves: one Spark job writes the messages of a range of
batches, then the stream takes in what has landed and stops. Rows of one wave may come
in any order, since the watermark moves only between micro-batches; waves come one
after another, each resuming from the checkpoint of the one before.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from spanwatch.operators.messages import encode
from spanwatch.schema import MESSAGE

# ---- fixed value: replayed messages all carry this ingestion time ----------
REPLAY_TIME = "2024-01-01 00:00:00"


def create_landing(spark: SparkSession, landing: str) -> None:
    """The folder that the waves land in; a file stream needs it to exist."""
    spark.createDataFrame([], MESSAGE).write.mode("ignore").parquet(landing)


def wave_of(events: DataFrame, waves: int, order: str = "batch_id") -> Column:
    """Number of the wave that a row belongs to, by equal ranges of the batch number."""
    span = events.agg(F.min(order).alias("low"), F.max(order).alias("high")).first()
    if span["low"] is None:
        return F.lit(0).cast("long")
    width = span["high"] - span["low"] + 1
    return F.floor((F.col(order) - F.lit(span["low"])) * waves / F.lit(width))


def release(
    events: DataFrame,
    landing: str,
    wave: Column,
    waves: int,
    resume: Callable[[], StreamingQuery],
    spoil: Callable[[DataFrame], DataFrame] = lambda encoded: encoded,
) -> list[StreamingQuery]:
    """Writes waves 0 to `waves` - 1 one after another. A wave is a range of batches, which may
    lie in one piece of the table: its rows are spread first, so that all cores encode and
    decode them. `resume` starts the stream on
    what is available now, always with the same checkpoint; it returns the query. `spoil`
    damages the messages on their way."""
    stamp = F.lit(REPLAY_TIME).cast("timestamp")
    finished = []
    for number in range(waves):
        spread = events.filter(wave == number).repartition("event_id", "timestamp")
        spoil(encode(spread, stamp)).write.mode("append").parquet(landing)
        query = resume()
        query.awaitTermination()
        finished.append(query)
    return finished
