"""Storing violations once, however often they are delivered.

`write_violations` is the body of a foreachBatch. It inserts what the table lacks and
leaves what it has, including its speed limit. That alone makes a repeated delivery
harmless: after a failure half-way, the files that became visible hold whole rows, which
the next attempt finds and skips. One writer per table: two at a time could both miss
what the other is writing.
"""

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from spanwatch.functions.values import event_time
from spanwatch.operators.documents import with_slice
from spanwatch.schema import DELIVERY_METRICS, STORED_VIOLATION, VIOLATION_KEY
from spanwatch.sources.facts import DAY, PLATE_FILTER, create_table, stored_violations, stored_within

# Up to so many rows a batch is broadcast to the stored table, whose rows then need no
# shuffle.
BROADCAST_BATCH_ROWS = 200_000


def _same(left: str, right: str):
    matched = F.lit(True)
    for name in VIOLATION_KEY:
        matched &= F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return matched


def _per_slice(prepared: DataFrame) -> DataFrame:
    """Rows and time span per hour of the batch."""
    return with_slice(prepared).groupBy(DAY, "slice").agg(
        F.count(F.lit(1)).alias("prepared"),
        F.sum("copies").alias("received"),
        F.min("event_us").alias("first"),
        F.max("event_us").alias("last"),
    )


def _spans(per_slice: list) -> list[tuple[str, int, int]]:
    """The stretch of time that a batch is about on each of its days."""
    days: dict[str, tuple[int, int]] = {}
    for row in per_slice:
        first, last = days.get(row[DAY], (row["first"], row["last"]))
        days[row[DAY]] = min(first, row["first"]), max(last, row["last"])
    return [(day, *span) for day, span in days.items()]


def _not_stored(prepared: DataFrame, path: str, per_slice: list) -> DataFrame:
    """Rows of the batch that the table lacks. Only the stretches of time that the batch is
    about are read, however many days they lie in."""
    stored = stored_within(prepared.sparkSession, path, _spans(per_slice))
    if sum(row["prepared"] for row in per_slice) <= BROADCAST_BATCH_ROWS:
        keys = F.broadcast(prepared.select(*VIOLATION_KEY).alias("b"))
        stored = stored.alias("t").join(keys, _same("t", "b"), "left_semi")
    return prepared.alias("b").join(
        stored.select(*VIOLATION_KEY).alias("t"), _same("b", "t"), "left_anti"
    )


def write_violations(
    batch: DataFrame, path: str, run_id: str, epoch: int, metrics_path: str | None = None
) -> list[tuple[str, int]]:
    """Inserts the violations of a batch that are not stored yet and returns the (day, hour)
    slices that the batch is about, stored before or not. An empty batch writes nothing.

    What comes to the driver is a row per day or slice of the batch, so no more rows than
    the intake limit lets into one batch."""
    spark = batch.sparkSession
    create_table(spark, path, STORED_VIOLATION)
    prepared = (
        batch.groupBy(*VIOLATION_KEY)
        .agg(F.min("speed_limit").alias("speed_limit"), F.count(F.lit(1)).alias("copies"))
        .withColumn("event_us", F.unix_micros(event_time("event_details")))
        .persist()
    )
    try:
        per_slice = _per_slice(prepared).collect()
        if not per_slice:
            return []
        # Counted in the tasks that write, whose results count once however often they run.
        seen = Observation()
        (
            _not_stored(prepared, path, per_slice)
            .withColumns({"run_id": F.lit(run_id), "epoch": F.lit(epoch).cast("long")})
            .select(*STORED_VIOLATION.fieldNames())
            .hint("rebalance", DAY)
            .sortWithinPartitions(DAY, "car_plate", "event_us")
            .observe(seen, F.count(F.lit(1)).alias("inserted"))
            .write.mode("append")
            .options(**PLATE_FILTER)
            .partitionBy(DAY)
            .parquet(path)
        )
        if metrics_path:
            received, n_prepared = (
                sum(row[name] for row in per_slice) for name in ("received", "prepared")
            )
            inserted = seen.get["inserted"]
            if inserted < n_prepared:
                # Some were there: from other deliveries, or from this one, broken off before.
                inserted = delivered(spark, path, _spans(per_slice), run_id, epoch).count()
            row = (run_id, epoch, received, n_prepared, inserted)
            _append_metrics(spark, metrics_path, row)
        return sorted((row[DAY], row["slice"]) for row in per_slice)
    finally:
        prepared.unpersist()


def delivered(
    spark: SparkSession, path: str, spans: list[tuple[str, int, int]], run_id: str, epoch: int
) -> DataFrame:
    """What one delivery has inserted, in all its attempts."""
    return stored_within(spark, path, spans).filter(
        (F.col("run_id") == run_id) & (F.col("epoch") == epoch)
    )


def _append_metrics(spark: SparkSession, path: str, row: tuple) -> None:
    spark.createDataFrame([row], DELIVERY_METRICS).coalesce(1).write.mode("append").parquet(path)


def delivery_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Received, prepared, inserted and already stored counts per delivery. A delivery
    that was repeated has several lines; each count can only have grown."""
    return (
        spark.read.schema(DELIVERY_METRICS)
        .parquet(path)
        .groupBy("run_id", "epoch")
        .agg(*[F.max(name).alias(name) for name in ("received", "prepared", "inserted")])
        .withColumn("already_stored", F.col("prepared") - F.col("inserted"))
    )


def compact(spark: SparkSession, path: str, target: str, days: list[str] | None = None) -> None:
    """The table, or some of its days, rewritten to a new path with few files a day in
    plate order. Run it while the writer is stopped, then point the writer at the new
    path; what has been compacted counts as stored."""
    (
        stored_violations(spark, path, days)
        .hint("rebalance", DAY)
        .sortWithinPartitions(DAY, "car_plate", "event_us")
        .write.mode("errorifexists")
        .options(**PLATE_FILTER)
        .partitionBy(DAY)
        .parquet(target)
    )
