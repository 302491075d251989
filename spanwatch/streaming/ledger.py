"""What a stream has taken in, refused and dropped as late, kept for every epoch.

Counts are made inside the running plan (`counted`), reported with the epoch's progress and
stored by a listener as one row per epoch, so they outlast the query and the 100 batches that
it remembers. An epoch that is run again after a failure reports again; `stream_epochs` counts
it once, as it was last. What the sink received and inserted is stored by the sink itself, before
the epoch counts as done; `stream_counts` puts both side by side.

The listener hears of an epoch after its checkpoint is written. A driver that is lost in between
leaves a gap in the numbers of the epochs (`missing_epochs`), never a wrong row.
"""

import threading

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from spanwatch.operators.messages import MISSING, missing_field
from spanwatch.schema import STREAM_EPOCH
from spanwatch.streaming.sink import delivery_metrics

METRIC = "spanwatch_decoded"
KEYS = ("query_id", "epoch")


def counted(decoded: DataFrame) -> DataFrame:
    """`decoded` unchanged. Running it counts its rows, and those that the quality filter will
    refuse, by the first field found missing."""
    reason = missing_field()
    return decoded.observe(
        METRIC,
        F.count(F.lit(1)).alias("decoded"),
        *[F.count_if(reason == name).alias(f"no_{name}") for name in MISSING],
    )


def _row(progress) -> tuple:
    """One row of STREAM_EPOCH from the progress of an epoch."""
    seen = progress.observedMetrics.get(METRIC)
    counts = seen.asDict() if seen is not None else {}
    names = ("decoded", *[f"no_{name}" for name in MISSING])
    operators = progress.stateOperators
    return (
        str(progress.id),
        progress.batchId,
        str(progress.runId),
        progress.timestamp,
        progress.numInputRows,
        *[int(counts.get(name) or 0) for name in names],
        sum(operator.numRowsDroppedByWatermark for operator in operators),
        sum(operator.numRowsTotal for operator in operators),
        (progress.eventTime or {}).get("watermark"),
    )


class Ledger(StreamingQueryListener):
    """Stores a row for every epoch of the queries that it follows.

    Add it to the session before the query starts (`spark.streams.addListener`); it follows all
    queries, or those named. `settled` waits until everything of a finished query is stored.
    """

    def __init__(self, spark: SparkSession, path: str, names: tuple[str, ...] = ()):
        self.spark, self.path, self.names = spark, path, names
        self._ended: dict[str, threading.Event] = {}
        self._failed: Exception | None = None

    def _end_of(self, run_id) -> threading.Event:
        return self._ended.setdefault(str(run_id), threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end_of(event.runId)

    def onQueryProgress(self, event) -> None:
        if self.names and event.progress.name not in self.names:
            return
        try:
            store(self.spark, self.path, [_row(event.progress)])
        except Exception as error:  # noqa: BLE001 - a listener cannot stop a query; `settled` tells
            self._failed = error

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end_of(event.runId).set()

    def settled(self, query: StreamingQuery, timeout_s: float = 60) -> None:
        """Waits for the last epoch of a query that has ended. Raises what went wrong."""
        if not self._end_of(query.runId).wait(timeout_s):
            raise TimeoutError(f"the end of query {query.runId} was not heard of")
        if self._failed:
            raise RuntimeError(f"epochs could not be stored in {self.path}") from self._failed


def store(spark: SparkSession, path: str, rows: list[tuple]) -> None:
    spark.createDataFrame(rows, STREAM_EPOCH).coalesce(1).write.mode("append").parquet(path)


def stream_epochs(spark: SparkSession, path: str) -> DataFrame:
    """One row per query and epoch; of an epoch reported more than once, the last report."""
    rows = spark.read.schema(STREAM_EPOCH).parquet(path)
    others = [name for name in rows.columns if name not in KEYS]
    last = F.max_by(F.struct(*others), F.struct("reported", "run_id")).alias("_last")
    return rows.groupBy(*KEYS).agg(last).select(*KEYS, "_last.*")


def missing_epochs(spark: SparkSession, path: str) -> DataFrame:
    """(query_id, epochs, missing): epochs up to the last that no report was stored of."""
    return (
        stream_epochs(spark, path)
        .groupBy("query_id")
        .agg(
            F.count(F.lit(1)).alias("epochs"),
            (F.max("epoch") + 1 - F.count(F.lit(1))).alias("missing"),
        )
    )


def stream_counts(spark: SparkSession, path: str, metrics_path: str) -> DataFrame:
    """Per query and epoch: messages decoded, refused by reason, late to the join (once for each
    side that missed them), violations received, prepared, inserted and already stored. An epoch
    that delivered nothing has zeros."""
    delivered = delivery_metrics(spark, metrics_path).withColumnRenamed("run_id", "query_id")
    names = [name for name in delivered.columns if name not in KEYS]
    return stream_epochs(spark, path).join(delivered, list(KEYS), "left").na.fill(0, names)


def compact_ledger(spark: SparkSession, path: str, target: str) -> None:
    """The ledger with one row per epoch in few files at a new path."""
    stream_epochs(spark, path).repartitionByRange(*KEYS).sortWithinPartitions(*KEYS).write.mode(
        "errorifexists"
    ).parquet(target)
