"""The streaming job: passages in, violations stored once, documents refreshed.

The plan is the batch plan; only the source, the watermarked join and the sink differ.
Three branches use the source: readings, entries and exits. They read one exchange
(`shared`), so that messages are read and decoded once in a batch.

The number of state partitions is fixed by the first run of a checkpoint, so it has to be
named: as many as the busiest hour needs.
"""

import warnings
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from spanwatch.operators.detect import violations
from spanwatch.operators.enrich import with_limits
from spanwatch.operators.messages import decode, quality_filter
from spanwatch.operators.report import longest_violation_s
from spanwatch.params import Params
from spanwatch.streaming.daily import OpenHours, append_slices, fold_slices
from spanwatch.streaming.handover import settle_routing, with_waiting
from spanwatch.streaming.ledger import counted
from spanwatch.streaming.series import append_counts
from spanwatch.streaming.sink import write_violations
from spanwatch.workspace import check_utc

# Join state may outgrow executor memory: RocksDB keeps it on the executor's disk and
# uploads changes only; join format 3 commits one store per partition instead of four.
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.join.stateFormatVersion": "3",
}
# A run over what is available ends after a few large batches. The next one would replay all
# their changes, most of which undo each other; it loads the state as it is instead.
AVAILABLE_NOW_SETTINGS = STREAM_SETTINGS | {
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "false",
}


# What the two rules need of a passage; the salts of hot plates need its id too.
JUDGED = ("car_plate", "camera_id", "timestamp", "speed_reading")


@contextmanager
def stream_settings(
    spark: SparkSession, state_partitions: int | None, available_now: bool = False
) -> Iterator[None]:
    """STREAM_SETTINGS, or those of a run over what is available, and the number of state
    partitions for queries started inside; a query keeps the settings it was started with. What
    the session sets itself stays, but for the number of partitions, which belongs to the query."""
    named = AVAILABLE_NOW_SETTINGS if available_now else STREAM_SETTINGS
    mine = {key: value for key, value in named.items() if spark.conf.get(key, None) is None}
    if state_partitions:
        mine["spark.sql.shuffle.partitions"] = str(state_partitions)
    before = {key: spark.conf.get(key, None) for key in mine}
    for key, value in mine.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def passages(messages: DataFrame) -> DataFrame:
    """Usable passages from a stream or table of messages. A stream counts what it decodes and
    refuses; a `Ledger` stores the counts."""
    decoded = decode(messages)
    return quality_filter(counted(decoded) if messages.isStreaming else decoded)


def shared(stream: DataFrame) -> DataFrame:
    """`stream` behind an exchange that all branches of a query read, spread by plate and time.

    Rows pass it whole and are unfolded by a generator of one row: what a branch filters or
    leaves out stays above, so the branches are the same plan up to the exchange and Spark runs
    that once."""
    row = F.struct(*stream.columns).alias("_row")
    spread = stream.select(row).repartition(F.col("_row.car_plate"), F.col("_row.timestamp"))
    return spread.select(F.inline(F.array("_row")))


def detected(
    events: DataFrame,
    cameras: DataFrame,
    params: Params = Params(),
    hot_plates: tuple[str, ...] = (),
) -> DataFrame:
    """Violations from passages, batch or stream."""
    return violations(with_limits(events, cameras, params), params, hot_plates)


def warn_if_blind(cameras: DataFrame, params: Params) -> None:
    """A pair that is too fast but takes longer than the tolerance is never seen."""
    needed = longest_violation_s(cameras, params.road_axis).first()["seconds"]
    if needed is not None and needed > params.tolerance_s:
        warnings.warn(
            f"tolerance of {params.tolerance_s} s misses violations that take up to {needed:.0f} s",
            stacklevel=2,
        )


def start(
    events: DataFrame,
    cameras: DataFrame,
    facts_path: str,
    checkpoint: str,
    params: Params = Params(),
    metrics_path: str | None = None,
    daily_path: str | None = None,
    series_path: str | None = None,
    hot_plates: tuple[str, ...] = (),
    available_now: bool = False,
    *,
    state_partitions: int,
    taking_over: str | None = None,
) -> StreamingQuery:
    """Starts the job. With a daily path, each batch appends its share of the documents before it
    counts as done: a batch that stops half-way comes again whole, so documents are complete
    whenever the job stands still. Hours that are over are folded in between. With a series path,
    it appends its counts per minute too.

    A checkpoint keeps its hot plates and its number of state partitions. To change either, stop
    the job and start it on a new checkpoint with `taking_over` the old one (see `handover`)."""
    spark = events.sparkSession
    check_utc(spark)
    warn_if_blind(cameras, params)
    waiting = settle_routing(spark, checkpoint, hot_plates, params.hot_salts, taking_over)
    needed = (*JUDGED, "event_id") if hot_plates else JUDGED
    events = shared(with_waiting(events, waiting).select(*needed))

    hours = OpenHours()

    def deliver(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        run_id = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        touched = write_violations(batch, facts_path, run_id, epoch, metrics_path)
        if daily_path:
            append_slices(session, facts_path, daily_path, touched, run_id, epoch)
            fold_slices(session, daily_path, hours.over(touched))
        if series_path:
            append_counts(session, facts_path, series_path, touched, run_id, epoch)

    writer = (
        detected(events, cameras, params, hot_plates)
        .writeStream.foreachBatch(deliver)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    return _started(writer, spark, params, state_partitions, available_now)


def _started(
    writer: DataStreamWriter,
    spark: SparkSession,
    params: Params,
    state_partitions: int | None,
    available_now: bool,
) -> StreamingQuery:
    trigger = {"availableNow": True} if available_now else {"processingTime": params.trigger}
    with stream_settings(spark, state_partitions, available_now):
        return writer.trigger(**trigger).start()


def append_table(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    state_partitions: int | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Writes a stream to a Parquet table as it is, each row once. A stream that keeps state
    names its partitions."""
    writer = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return _started(writer, stream.sparkSession, Params(), state_partitions, available_now)


def late_rows(query: StreamingQuery) -> int:
    """Rows the join has dropped as late in the batches that the query remembers, once for each
    join side. `ledger` has all of them."""
    return sum(
        operator.numRowsDroppedByWatermark
        for progress in query.recentProgress
        for operator in progress.stateOperators
    )


def state_rows(query: StreamingQuery) -> list[int]:
    """Rows held by the join after each micro-batch."""
    return [
        sum(operator.numRowsTotal for operator in progress.stateOperators)
        for progress in query.recentProgress
    ]
