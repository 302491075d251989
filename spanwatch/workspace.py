"""Session settings and the shared folder that jobs write intermediate tables to."""

import re
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


def use_utc(spark: SparkSession) -> SparkSession:
    """Dates and zone-less timestamps are read in UTC, whatever zone the machine is in."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@lru_cache(maxsize=1)
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="spanwatch-")


def check_utc(spark: SparkSession) -> None:
    """Days and minutes are cut in the session's zone and stored: it must be UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "+00:00", "GMT"):
        raise ValueError(
            f"spark.sql.session.timeZone is {zone}: stored days would depend on it; set it to UTC"
        )


def shared_root(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. A temporary one stands in for it only where driver
    and executors are one process, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not re.match(r"local(\[|$)", master):
        raise ValueError(
            f"spark.checkpoint.dir is not set: {master} needs a folder that all executors share"
        )
    return _local_root()


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A path under the shared folder that no other run uses. Not created."""
    return f"{shared_root(spark)}/spanwatch/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """`df` as a table in the shared folder: computed once, the same to all that read it."""
    path = fresh_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
