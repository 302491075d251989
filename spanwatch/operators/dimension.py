"""Left join to a dimension that is expected, but not assumed, to be small."""

from pyspark.sql import Column, DataFrame, Row, functions as F

from spanwatch.params import BROADCAST_ROWS

SHUFFLE_SALTS = 16


def measured(dim: DataFrame, *aggregates: Column, max_rows: int = BROADCAST_ROWS) -> Row | None:
    """The aggregates over a small dimension, or None if it has more than `max_rows`.
    Looks at one row past the limit at most."""
    head = dim.limit(max_rows + 1)
    row = head.agg(F.count(F.lit(1)).alias("_rows"), *aggregates).first()
    return row if row["_rows"] <= max_rows else None


def join_dimension(facts: DataFrame, dim: DataFrame, key: str, small: bool) -> DataFrame:
    """A broadcast join for a dimension measured as small. Otherwise a shuffle join in
    which each key is spread over several salts, so that one busy key does not end up
    in one task."""
    if small:
        return facts.join(F.broadcast(dim), key, "left")
    spread = F.pmod(F.xxhash64(*facts.columns), F.lit(SHUFFLE_SALTS)).cast("int")
    copies = F.sequence(F.lit(0), F.lit(SHUFFLE_SALTS - 1))
    salted = dim.withColumn("_salt", F.explode(copies))
    return facts.withColumn("_salt", spread).join(salted, [key, "_salt"], "left").drop("_salt")
