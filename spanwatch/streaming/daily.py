"""Daily documents kept up to date from the stored violations.

A document grows while its hour lasts. Each delivery appends what it inserted as slices of
documents (`append_slices`), `daily_documents` puts the slices of a document together, and hours
that are over are folded into whole documents (`fold_slices`). So every violation is written
once when it arrives and once when its hour is folded, however many deliveries an hour has.

The facts are the truth: `refresh_stale` rebuilds what differs from them.
"""

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from spanwatch.operators.documents import SLICE_S, daily_merge, with_slice
from spanwatch.schema import DAILY_DOCUMENT, VIOLATION
from spanwatch.sources.facts import (
    DAY,
    PLATE_FILTER,
    create_table,
    daily_documents,
    daily_slices,
    merged_slices,
    stored_within,
    violation_facts,
)
from spanwatch.streaming.sink import delivered

FOLDERS = (DAY, "slice")


def span_of(day: str, hour: int) -> tuple[str, int, int]:
    """Event times of an hour, in microseconds."""
    start = datetime.fromisoformat(day).replace(tzinfo=timezone.utc).timestamp()
    first = (int(start) + hour * SLICE_S) * 1_000_000
    return day, first, first + SLICE_S * 1_000_000 - 1


def _written(documents: DataFrame, daily_path: str, mode: str) -> None:
    (
        documents.withColumn("n_violations", F.size("violations").cast("long"))
        .select(*DAILY_DOCUMENT.fieldNames())
        .hint("rebalance", *FOLDERS)
        .sortWithinPartitions(*FOLDERS, "car_plate")
        .write.mode(mode)
        .options(**PLATE_FILTER)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*FOLDERS)
        .parquet(daily_path)
    )


def append_slices(
    spark: SparkSession,
    facts_path: str,
    daily_path: str,
    slices: list[tuple[str, int]],
    run_id: str,
    epoch: int,
) -> None:
    """Appends the documents of what a delivery inserted into the given (day, hour) slices. A
    delivery that is repeated appends the same again, which reading folds."""
    create_table(spark, daily_path, DAILY_DOCUMENT, FOLDERS)
    if not slices:
        return
    new = delivered(spark, facts_path, [span_of(*touched) for touched in slices], run_id, epoch)
    _written(daily_merge(new.select(*VIOLATION.fieldNames()), distinct=True), daily_path, "append")


def fold_slices(spark: SparkSession, daily_path: str, slices: list[tuple[str, int]]) -> None:
    """Rewrites the given hours with one row per document. Only the writer of the table may do
    so, between its deliveries: what is appended meanwhile would be lost."""
    if not slices:
        return
    hours = spark.createDataFrame(slices, "_day STRING, _hour INT")
    stored = daily_slices(spark, daily_path, sorted({day for day, _ in slices}))
    chosen = stored.join(
        F.broadcast(hours), (F.col(DAY) == F.col("_day")) & (F.col("slice") == F.col("_hour")), "left_semi"
    )
    _written(merged_slices(chosen), daily_path, "overwrite")


class OpenHours:
    """The hours that a job has appended to, and how often.

    An hour is over for the job once it has seen one `hours` later; a violation that comes later
    still opens it again. An hour that one delivery brought whole needs no folding. Hours that a
    stopped job leaves open are read as well as folded ones.
    """

    def __init__(self, hours: int = 2):
        self.hours = hours
        self.open: dict[tuple[str, int], int] = {}

    def over(self, touched: list[tuple[str, int]]) -> list[tuple[str, int]]:
        """The hours to fold now that a delivery has touched some."""
        for each in touched:
            self.open[each] = self.open.get(each, 0) + 1
        starts = {each: span_of(*each)[1] for each in self.open}
        past = max(starts.values(), default=0) - self.hours * SLICE_S * 1_000_000
        done = sorted(each for each, start in starts.items() if start <= past)
        return [each for each in done if self.open.pop(each) > 1]


def refresh_slices(
    spark: SparkSession, facts_path: str, daily_path: str, slices: list[tuple[str, int]]
) -> None:
    """Rebuilds the documents of the given (day, hour) slices."""
    create_table(spark, daily_path, DAILY_DOCUMENT, FOLDERS)
    if not slices:
        return
    facts = stored_within(spark, facts_path, [span_of(*touched) for touched in slices])
    documents = daily_merge(facts.select(*VIOLATION.fieldNames()), distinct=True)
    _written(documents, daily_path, "overwrite")


def stale_slices(spark: SparkSession, facts_path: str, daily_path: str) -> DataFrame:
    """Slices whose documents hold another number of violations than the facts do. Facts
    are only ever added, so equal numbers mean the slice is up to date. Reads both tables:
    for repairs, and for the day on which documents are first kept."""
    create_table(spark, daily_path, DAILY_DOCUMENT, FOLDERS)
    in_facts = (
        with_slice(violation_facts(spark, facts_path))
        .groupBy(*FOLDERS)
        .agg(F.count(F.lit(1)).alias("n_facts"))
    )
    in_documents = (
        daily_documents(spark, daily_path)
        .groupBy(*FOLDERS)
        .agg(F.sum("n_violations").alias("n_documents"))
    )
    return in_facts.join(in_documents, list(FOLDERS), "left").filter(
        ~F.col("n_facts").eqNullSafe(F.col("n_documents"))
    )


def refresh_stale(spark: SparkSession, facts_path: str, daily_path: str) -> list[tuple[str, int]]:
    stale = stale_slices(spark, facts_path, daily_path).select(*FOLDERS)
    slices = sorted((row[DAY], row["slice"]) for row in stale.collect())
    refresh_slices(spark, facts_path, daily_path, slices)
    return slices
