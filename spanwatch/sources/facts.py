"""The stored tables: violations and daily documents, a folder per day."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from spanwatch.schema import DAILY_DOCUMENT, STORED_VIOLATION, VIOLATION

DAY = "violation_date"


# A plate is looked for in many files and is in few. Files are in order of plates, so their least
# and greatest plate seldom exclude one; a bloom filter of each row group does. At 1 % of false
# finds it takes 10 bits a plate, so a row group of 100 000 plates costs 120 KB.
PLATE_FILTER = {
    "parquet.bloom.filter.enabled#car_plate": "true",
    "parquet.bloom.filter.expected.ndv#car_plate": "100000",
    "parquet.bloom.filter.adaptive.enabled": "true",
}

# Up to so many days are named as folders, whose files alone are then listed.
NAMED_DAYS = 1_000
SPANS = f"{DAY} STRING, _first BIGINT, _last BIGINT"


def create_table(
    spark: SparkSession, path: str, schema: T.StructType, folders: tuple[str, ...] = (DAY,)
) -> None:
    """An empty table, unless there is one already."""
    spark.createDataFrame([], schema).write.mode("ignore").partitionBy(*folders).parquet(path)


def stored_violations(spark: SparkSession, path: str, days: list[str] | None = None) -> DataFrame:
    """With the technical columns; of the given days only, whose folders alone are then
    listed. The schema is declared: the days would otherwise be guessed to be dates."""
    reader = spark.read.schema(STORED_VIOLATION).option("basePath", path)
    if days is None:
        return reader.parquet(path)
    try:
        return reader.parquet(f"{path}/{DAY}={{{','.join(days)}}}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], STORED_VIOLATION)


def stored_within(
    spark: SparkSession, path: str, spans: list[tuple[str, int, int]]
) -> DataFrame:
    """Stored violations within stretches of event time: (day, first, last) microseconds.

    The days choose folders, by name if they are few and by dynamic pruning if they are
    many; the stretch as a whole chooses row groups; each day's own stretch chooses rows.
    """
    days = sorted({day for day, _, _ in spans})
    stored = stored_violations(spark, path, days if len(days) <= NAMED_DAYS else None)
    if not spans:
        return stored.filter(F.lit(False))
    known = spark.createDataFrame(spans, SPANS).filter("_first <= _last")
    low, high = min(s[1] for s in spans), max(s[2] for s in spans)
    inside = (stored[DAY] == known[DAY]) & F.col("event_us").between(
        F.col("_first"), F.col("_last")
    )
    return stored.filter(F.col("event_us").between(low, high)).join(
        F.broadcast(known), inside, "left_semi"
    )


def plate_violations(spark: SparkSession, path: str, plates: list[str]) -> DataFrame:
    """All violations of some plates, of any day: what a file's filter excludes is not read."""
    return violation_facts(spark, path).filter(F.col("car_plate").isin(plates))


def violation_facts(spark: SparkSession, path: str, days: list[str] | None = None) -> DataFrame:
    """Violations as detected, without the technical columns."""
    return stored_violations(spark, path, days).select(*VIOLATION.fieldNames())


def daily_slices(spark: SparkSession, path: str, days: list[str] | None = None) -> DataFrame:
    """The slices of daily documents as they were appended or folded."""
    stored = spark.read.schema(DAILY_DOCUMENT).parquet(path)
    return stored if days is None else stored.filter(F.col(DAY).isin(days))


def merged_slices(slices: DataFrame) -> DataFrame:
    """One row per document: the violations of all its slices, each once, in order. Filters on
    the plate, the day and the hour reach the files."""
    each = F.array_sort(F.array_distinct(F.flatten(F.collect_list("violations"))))
    return (
        slices.groupBy("car_plate", DAY, "slice")
        .agg(each.alias("violations"))
        .withColumn("n_violations", F.size("violations").cast("long"))
        .select(*DAILY_DOCUMENT.fieldNames())
    )


def daily_documents(spark: SparkSession, path: str) -> DataFrame:
    return merged_slices(daily_slices(spark, path))
