"""Rows gathered into lists: daily documents per vehicle, and events per batch.

A list lives in one row of one task, so each holds one hour: a document is what a plate did
in an hour of a day, a piece of a batch is its events of an hour. The grain is the same for
every size of input, and no row is ever dropped.
"""

from pyspark.sql import Column, DataFrame, functions as F

from spanwatch.functions.times import whole_seconds
from spanwatch.functions.values import arrival_time, event_time, speed_value
from spanwatch.schema import DAILY_ITEM

SLICE_S = 3_600


def gather(
    rows: DataFrame, keys: list[str], item: Column, into: str, distinct: bool = False
) -> DataFrame:
    """(keys, <into>: sorted array of items). Equal items are kept; they travel as one row
    with a count, so a crowd of copies folds before the shuffle. Callers whose rows cannot
    repeat pass `distinct` and save that grouping."""
    if distinct:
        lists = F.collect_list("_item")
        gathered = rows.select(*keys, item.alias("_item"))
    else:
        lists = F.flatten(F.collect_list(F.array_repeat("_item", F.col("_copies").cast("int"))))
        gathered = rows.groupBy(*keys, item.alias("_item")).agg(
            F.count(F.lit(1)).alias("_copies")
        )
    return gathered.groupBy(*keys).agg(F.array_sort(lists).alias(into))


def with_slice(violations: DataFrame) -> DataFrame:
    """Adds the hour of the day in which a violation was completed, by which it is dated too."""
    return violations.withColumn("slice", F.hour(event_time("event_details")))


def daily_merge(violations: DataFrame, distinct: bool = False) -> DataFrame:
    """All violations of a plate in an hour of a day as one document (car_plate,
    violation_date, slice, violations)."""
    item = F.struct(*[F.col(name) for name in DAILY_ITEM.fieldNames()])
    keys = ["car_plate", "violation_date", "slice"]
    return gather(with_slice(violations), keys, item, "violations", distinct)


def flatten_documents(documents: DataFrame) -> DataFrame:
    """Daily documents back to one row per violation, in the shape of `timeline`."""
    return timeline(
        documents.select("car_plate", "violation_date", F.explode("violations").alias("_v")).select(
            "car_plate", "violation_date", "_v.*"
        )
    )


def timeline(violations: DataFrame) -> DataFrame:
    """One row per violation with its details as columns, when it arrived and how fast
    it was; violations without an arrival time are left out. Takes the stored rows as
    they are: a chart needs no detour over documents."""
    kind = F.col("violation_type")
    return violations.select(
        "violation_type",
        "speed_limit",
        "event_details.*",
        "car_plate",
        F.to_date("violation_date").alias("violation_date"),
        arrival_time(kind, "event_details").alias("arrival_time"),
        speed_value(kind, "event_details").alias("speed_val"),
    ).filter(F.col("arrival_time").isNotNull())


def batches(events: DataFrame) -> DataFrame:
    """Events of each batch as lists, one per hour (batch_id, slice, events). The slice counts
    hours since 1970. Events without a batch belong to none."""
    columns = [name for name in events.columns if name != "batch_id"]
    hour = F.floor(whole_seconds(F.col("timestamp")) / SLICE_S)
    sliced = events.filter(F.col("batch_id").isNotNull()).withColumn("slice", hour)
    return gather(sliced, ["batch_id", "slice"], F.struct(*columns), "events")
