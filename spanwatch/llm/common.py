"""What the operators of this folder share: tables, folds, stored intermediate results."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from spanwatch.workspace import fresh_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`. A missing id belongs to fold 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % parts, F.lit(0))


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """`df` written to the shared folder and read back, which cuts its lineage.

    Every executor can read the files, so a lost executor costs a rerun of its own tasks only.
    """
    path = fresh_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_row(df: DataFrame, *without: str) -> Column:
    """All columns of `df` but some, as one struct `_row`.

    Next to it an operator may name its own columns as it likes: `_row.*` gives back the others.
    """
    left_out = {c.lower() for c in without}
    return F.struct(
        *[F.col(f"`{c}`") for c in df.columns if c.lower() not in left_out]
    ).alias("_row")
