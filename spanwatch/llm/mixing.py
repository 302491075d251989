"""Mixing sources to target weights by balanced sampling with the cube method.

A source whose target is r times its size takes every document floor(r) times, and the rest as
a sample with inclusion probability r - floor(r). The probabilities move through the null space
of the balancing constraints, the number of documents and their words, until all but two
documents of a bucket and a few held back, of all sizes, are decided and both totals are exactly
what they were. What is left of the buckets of a source is treated alike, level by level, until
the source has one bucket; the landing tries every rounding of what this leaves and takes the
one nearest to both totals. A source lands as soon as it has one bucket, whatever others need.
"""

import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from spanwatch.llm.common import stored, whole_row

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
# Documents of one bucket; two of them, and those held back, stay open until the next level.
BUCKET = 4_000
# Rows below 200 bytes each.
BROADCAST_SOURCES = 50_000
NEAR = 1e-9
# Documents of a source that the landing may round, besides the two that the flight leaves.
HELD = 14


def size_of(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def targets(
    sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS
) -> DataFrame:
    """(source, source_size, target) of every source of `sized` (columns source and size).

    Sources in order of code points, null last, have the weights in turn. A target is the
    lesser of `most` times the source's size and its weight times one level for all; the level
    makes the targets add up to all sizes. That is what resharing the excess again and again
    leads to. Only one row per source is looked at together.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("_ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    nth = (F.row_number().over(in_order) - 1) % len(weights)
    sources = (
        sized.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("_weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), nth))
        .withColumn("_cap", F.lit(float(most)) * F.col("source_size"))
        .withColumn("_ratio", F.col("_cap") / F.col("_weight"))
        .withColumn("_rest", F.sum("source_size").over(everything)
                    - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
        .withColumn("_left", F.sum("_weight").over(everything)
                    - F.coalesce(F.sum("_weight").over(before), F.lit(0.0)))
    )
    # Past the first source below its cap the quotients only fall, so it has the largest.
    level = F.max(
        F.when(F.col("_rest") <= F.col("_ratio") * F.col("_left"), F.col("_rest") / F.col("_left"))
    ).over(everything)
    return sources.withColumn("_level", level).select(
        "source",
        "source_size",
        F.least(
            F.col("_cap"), F.coalesce(F.col("_level") * F.col("_weight"), F.col("_cap"))
        ).alias("target"),
    )


class Flight:
    """Moves probabilities while three documents are undecided; two constraints leave a line.

    The random choices follow a seed, so that equal input gives equal decisions.
    """

    def __init__(self, seed: str):
        self.rng = random.Random(seed)
        self.open: list[list] = []  # [probability, size, document]

    def add(self, probability: float, size: int, document) -> list[tuple[object, float]]:
        """Takes one more document; returns those decided by it, with 0.0 or 1.0."""
        if probability <= NEAR or probability >= 1 - NEAR:
            return [(document, float(round(probability)))]
        self.open.append([probability, size, document])
        decided = []
        while len(self.open) == 3:
            (_, a, _), (_, b, _), (_, c, _) = self.open
            u = (c - b, a - c, b - a) if not a == b == c else (1, -1, 0)
            up = min((1 - x[0]) / d if d > 0 else x[0] / -d for x, d in zip(self.open, u) if d)
            down = min(x[0] / d if d > 0 else (1 - x[0]) / -d for x, d in zip(self.open, u) if d)
            # The mean of the step is zero, so inclusion probabilities are kept.
            step = up if self.rng.random() * (up + down) < down else -down
            for x, d in zip(self.open, u):
                x[0] += step * d
            still = []
            for x in self.open:
                if x[0] <= NEAR or x[0] >= 1 - NEAR:
                    decided.append((x[2], float(round(x[0]))))
                else:
                    still.append(x)
            self.open = still
        return decided


def land(left: list[list]) -> list[float]:
    """Roundings of all [probability, size, document] together: the nearest to both totals.

    The words count in documents of mean size. Ties go to the first in order.
    """
    p = np.array([x[0] for x in left], float)
    sizes = np.array([x[1] for x in left], float)
    codes = np.arange(2 ** len(left))[:, None] >> np.arange(len(left)) & 1
    off = codes - p
    words = np.abs(off @ sizes) / max(float(sizes.mean()) if len(left) else 1.0, 1.0)
    best = int(np.argmin(np.round(words + 0.1 * np.abs(off.sum(axis=1)), 9)))
    return [float(c) for c in codes[best]]


def fly(rows: list[list], seed: str, last: bool, held: int = HELD) -> list[tuple[object, float]]:
    """Decides documents [probability, size, document] of one bucket, in their order.

    `held` of them, spread over the sizes, wait: in the last bucket of a source for the landing,
    in others for the next level. There they are a quarter of the bucket at most, so that every
    level leaves fewer documents.
    """
    waiting: list[list] = []
    if not last:
        held = min(held, len(rows) // 4)
    if held:
        by_size = sorted(range(len(rows)), key=lambda i: (rows[i][1], i))
        step = max(1, len(rows) // held)
        chosen = set(by_size[step // 2 :: step][:held])
        waiting = [rows[i] for i in sorted(chosen)]
        rows = [x for i, x in enumerate(rows) if i not in chosen]
    flight, done = Flight(seed), []
    for p, size, document in rows:
        done += flight.add(p, size, document)
    left = flight.open + waiting
    if not last:
        return done + [(x[2], x[0]) for x in left]
    return done + [(x[2], r) for x, r in zip(left, land(left), strict=True)]


def _round(units: DataFrame, level: int) -> DataFrame:
    """One level: `units` (source_no, bucket, last, unit, size, p) with new probabilities."""

    def decide_buckets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, last, waiting = None, False, []

        def finish() -> list[tuple]:
            seed = f"{level}/{at[0]}/{at[1]}" if at else ""
            return [(at[0], *x[0], x[1]) for x in fly(waiting, seed, last)] if at else []

        for batch in batches:
            done = []
            names = ("source_no", "bucket", "last", "unit", "size", "p")
            for source, bucket, only, unit, size, p in zip(*(batch[n].tolist() for n in names)):
                if at != (source, bucket):
                    done += finish()
                    at, last, waiting = (source, bucket), only, []
                waiting.append([p, size, (unit, size)])
            yield _decided(done)
        yield _decided(finish())

    return (
        units.repartition("source_no", "bucket")
        .sortWithinPartitions("source_no", "bucket", "unit", "size")
        .mapInPandas(decide_buckets, "source_no long, unit string, size long, p double")
    )


def _decided(found: list[tuple]) -> pd.DataFrame:
    columns = list(zip(*found)) if found else [[], [], [], []]
    return pd.DataFrame(
        {
            "source_no": np.array(columns[0], np.int64),
            "unit": np.array(columns[1], object),
            "size": np.array(columns[2], np.int64),
            "p": np.array(columns[3], float),
        }
    )


def _bucketed(units: DataFrame) -> tuple[DataFrame, bool]:
    """Units with buckets of about `BUCKET` and whether it is the `last`, the only one, of their
    source; and whether every source has only one."""
    counts = units.groupBy("source_no").agg(F.count("*").alias("_n"))
    counts = stored(counts, "mix-counts")
    most = counts.agg(F.max("_n")).first()[0] or 0
    small = counts.count() <= BROADCAST_SOURCES
    joined = units.join(F.broadcast(counts) if small else counts, "source_no")
    buckets = F.ceil(F.col("_n") / BUCKET).cast("long")
    joined = joined.withColumn("bucket", F.pmod(F.xxhash64("unit"), buckets))
    return joined.withColumn("last", F.col("_n") <= BUCKET).drop("_n"), most <= BUCKET


def decide(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_REPEATS,
) -> DataFrame:
    """How often each document is taken, one row for all rows equal in source, key and text:

    source, key, text_hash, size, source_size, target, n (equal rows), whole (times each of
    them is taken at least) and extra (how many of them are taken once more).

    Null and empty texts have size 0. A missing source is a source; a missing key is a key.
    Reruns over the same rows decide alike, however the rows are partitioned.
    """
    sized = stored(
        documents.select(
            F.col(source).alias("source"),
            F.col(key).alias("key"),
            F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"),
            size_of(F.col(text)).alias("size"),
        )
        .groupBy("source", "key", "text_hash", "size")
        .agg(F.count("*").alias("n")),
        "sizes",
    )
    wanted = targets(
        sized.select("source", (F.col("size") * F.col("n")).alias("size")), weights, most
    )
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    rate = F.when(
        F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))
    ).otherwise(F.lit(0.0))
    wanted = stored(
        wanted.withColumn("source_no", F.row_number().over(in_order).cast("long")).withColumn(
            "rate", rate
        ),
        "targets",
    )
    small = wanted.count() <= BROADCAST_SOURCES
    named = wanted.withColumnRenamed("source", "_source")
    units = sized.join(
        F.broadcast(named) if small else named, F.col("source").eqNullSafe(F.col("_source"))
    ).drop("_source")
    whole = F.floor(F.col("rate") + NEAR).cast("long")
    part = F.greatest(F.col("rate") - whole, F.lit(0.0))
    # Of n equal rows, as many as the probability makes certain are taken outright.
    sure = F.floor(F.col("n") * part + NEAR).cast("long")
    units = stored(
        units.withColumn("whole", whole)
        .withColumn("sure", sure)
        .withColumn("p", F.greatest(F.col("n") * part - sure, F.lit(0.0)))
        # The hash leads, so that the order within a bucket is a random one.
        .withColumn(
            "unit",
            F.concat_ws(
                "/", F.hex(F.xxhash64("key", "text_hash", F.lit("mix"))),
                F.hex("text_hash"), F.coalesce(F.col("key").cast("string"), F.lit("")),
            ),
        ),
        "units",
    )
    open_units = units.filter(F.col("p") > NEAR).select("source_no", "unit", "size", "p")
    decided, level = None, 0
    while True:
        bucketed, last = _bucketed(open_units)
        moved = stored(_round(bucketed, level), "flight")
        done = moved.filter((F.col("p") == 0) | (F.col("p") == 1))
        decided = done if decided is None else decided.unionAll(done)
        if last:
            break
        open_units, level = moved.filter((F.col("p") > 0) & (F.col("p") < 1)), level + 1
    taken = decided.filter(F.col("p") == 1).select("source_no", "unit", F.lit(1).alias("_one"))
    return units.join(taken, ["source_no", "unit"], "left").select(
        "source",
        "key",
        "text_hash",
        "size",
        "source_size",
        "target",
        "n",
        "whole",
        (F.col("sure") + F.coalesce("_one", F.lit(0))).alias("extra"),
    )


def rows(decided: DataFrame) -> DataFrame:
    """One row for each document again: key, size, source_size, target, times, taken."""
    each = decided.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    times = F.col("whole") + (F.col("_copy") <= F.col("extra")).cast("long")
    return each.withColumn("times", times).select(
        "key", "size", "source_size", "target", "times", (F.col("times") * F.col("size")).alias("taken")
    )


def mixed(
    documents: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **more
) -> DataFrame:
    """The documents as the mix takes them: left out, once, or repeated. All columns stay."""
    decided = decide(documents, key, text, source, **more)
    names = ["_known", "_source", "_keyed", "_key", "_hash"]

    def identity(s: Column, k: Column, h: Column) -> list[Column]:
        return [
            s.isNotNull().alias("_known"),
            F.coalesce(s, F.lit("")).alias("_source"),
            k.isNotNull().alias("_keyed"),
            F.coalesce(k.cast("string"), F.lit("")).alias("_key"),
            h.alias("_hash"),
        ]

    plan = decided.filter((F.col("whole") > 0) | (F.col("extra") > 0)).select(
        *identity(F.col("source"), F.col("key"), F.col("text_hash")), "whole", "extra"
    )
    own = documents.select(
        whole_row(documents),
        *identity(
            F.col(source), F.col(key), F.xxhash64(F.coalesce(F.col(text), F.lit("")))
        ),
    )
    nth = F.row_number().over(Window.partitionBy(*names).orderBy(F.lit(0)))
    times = F.col("whole") + (F.col("_nth") <= F.col("extra")).cast("long")
    return (
        own.join(plan, names)
        .withColumn("_nth", nth)
        .withColumn("_times", times.cast("int"))
        .filter("_times > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times"))))
        .select("_row.*")
    )
