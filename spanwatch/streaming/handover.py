"""A job that goes on with other hot plates: what waits in its state moves to a new checkpoint.

State lies where the routing of plates put it, so rows that wait would not be found under
another routing. They are read out of the stopped job's checkpoint instead and stored beside the
new one, which takes them in with its first batch: as passages, by plate, camera and time, without
a reading, since that has been judged. Pairs that both jobs find are stored once by the sink.

The new job's source must go on where the old one stood: `resume_options` has the offsets for
Kafka. A file stream reads its folder anew, which the sink makes harmless, or is given another.
"""

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

ROUTING = "hot_plates ARRAY<STRING>, hot_salts INT, took_over STRING"
WAITING = "car_plate STRING, camera_id INT, timestamp TIMESTAMP"


def _beside(checkpoint: str, what: str) -> str:
    return f"{checkpoint.rstrip('/')}-{what}"


def _stored_routing(spark: SparkSession, checkpoint: str) -> Row | None:
    try:
        return spark.read.schema(ROUTING).parquet(_beside(checkpoint, "routing")).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def waiting_passages(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The passages that wait in the segment join of a stopped job, as of its last finished
    batch. A passage may wait on both sides, and in every salt of a hot plate: it counts once."""
    sides = [
        spark.read.format("statestore").option("joinSide", side).load(checkpoint)
        for side in ("left", "right")
    ]
    found = [side.select("value.car_plate", "value.camera_id", "value.timestamp") for side in sides]
    return found[0].unionByName(found[1]).distinct()


def last_batch(spark: SparkSession, checkpoint: str) -> int | None:
    """The last batch that a checkpoint counts as done."""
    try:
        commits = spark.read.format("binaryFile").load(f"{checkpoint}/commits/[0-9]*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    number = F.regexp_extract("path", "([0-9]+)$", 1).cast("int")
    return commits.agg(F.max(number).alias("last")).first()["last"]


def end_offsets(spark: SparkSession, checkpoint: str) -> list[dict]:
    """Where each source stood after the last finished batch, as the source writes it."""
    last = last_batch(spark, checkpoint)
    if last is None:
        return []
    log = spark.read.text(f"{checkpoint}/offsets/{last}", wholetext=True).first()["value"]
    # A version, the batch's settings, then a line for each source; "-" has not begun.
    return [json.loads(line) for line in log.splitlines()[2:] if line != "-"]


def resume_options(spark: SparkSession, checkpoint: str) -> dict[str, str]:
    """Kafka reader options for a new checkpoint that goes on where another one stood: the
    least offset of each partition over the branches that read the topics."""
    starts: dict[str, dict[str, int]] = {}
    for source in end_offsets(spark, checkpoint):
        for topic, partitions in source.items():
            if not isinstance(partitions, dict):
                raise ValueError(f"{checkpoint} does not read Kafka: {source}")
            mine = starts.setdefault(topic, {})
            for partition, offset in partitions.items():
                mine[partition] = min(offset, mine.get(partition, offset))
    return {"startingOffsets": json.dumps(starts)} if starts else {}


def settle_routing(
    spark: SparkSession,
    checkpoint: str,
    hot_plates: tuple[str, ...],
    hot_salts: int,
    taking_over: str | None = None,
) -> str | None:
    """Keeps a checkpoint to the routing it was started with, and returns the folder of rows
    that it has taken over, if any.

    The routing is stored beside the checkpoint, last of all: a hand-over that breaks off is done
    again. A restart with another routing is refused; it needs a new checkpoint that takes over.
    """
    wanted = sorted(set(hot_plates)), hot_salts
    kept = _stored_routing(spark, checkpoint)
    waiting = _beside(checkpoint, "waiting")
    if kept is None:
        if taking_over:
            waiting_passages(spark, taking_over).write.mode("overwrite").parquet(waiting)
        row = spark.createDataFrame([(*wanted, taking_over)], ROUTING)
        row.coalesce(1).write.mode("overwrite").parquet(_beside(checkpoint, "routing"))
        return waiting if taking_over else None
    if (list(kept["hot_plates"]), kept["hot_salts"]) != wanted:
        raise ValueError(
            f"{checkpoint} was started with hot plates {list(kept['hot_plates'])} and"
            f" {kept['hot_salts']} salts; start with these, or with a new checkpoint that takes"
            " over from this one"
        )
    if taking_over and kept["took_over"] != taking_over:
        raise ValueError(f"{checkpoint} took over from {kept['took_over']}, not {taking_over}")
    return waiting if kept["took_over"] else None


def with_waiting(events: DataFrame, folder: str | None) -> DataFrame:
    """A stream of passages and, in its first batch, those that waited elsewhere."""
    if folder is None:
        return events
    waited = events.sparkSession.readStream.schema(WAITING).parquet(folder)
    return events.unionByName(waited, allowMissingColumns=True)
