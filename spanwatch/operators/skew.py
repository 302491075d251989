"""Keys that hold so many rows that they must be split."""

from pyspark.sql import DataFrame, functions as F


def heavy_keys(rows: DataFrame, keys: list[str], above: int, slices: str) -> DataFrame:
    """(keys, <slices>): how many slices of `above` rows each heavy key makes. Counts are
    exact, and no heavy key is left out."""
    return (
        rows.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > above)
        .select(*keys, F.ceil(F.col("_n") / above).alias(slices))
    )


def heaviest(rows: DataFrame, key: str, above: int) -> tuple:
    """The values of a key with more than `above` rows, the largest first: the plates to name
    to a stream, from a table of past passages. There are at most rows / above of them."""
    heavy = heavy_keys(rows, [key], above, "_slices").orderBy(F.desc("_slices"), key)
    return tuple(row[key] for row in heavy.select(key).collect())
