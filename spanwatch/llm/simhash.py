"""SimHash near-duplicates by the generalised pigeonhole principle.

The 64 bits are split into partitions, correlated bits together, and each partition i gets a
threshold t_i so that the sum of (t_i + 1) exceeds the allowed distance. Two fingerprints
within that distance then differ in at most t_i bits of at least one partition i. Partitions
and thresholds are those for which dynamic programming expects the least work, judged by a
bounded sample. Fingerprints meet in buckets of equal partition values, probes with up to t_i
bits flipped; every meeting is verified on all 64 bits.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from spanwatch.llm.common import stored, whole_row
from spanwatch.llm.components import components

SHINGLE = 4
DISTANCE = 4
SEED = 42
BITS = 64
# Fingerprints from which partitions and thresholds are derived.
PLAN_SAMPLE = 4_096
# A probe is shuffled and sorted; a candidate is one comparison of two numbers.
PROBE_COST, CANDIDATE_COST = 1.0, 0.01
# Larger buckets are compared in pairs of chunks of this size.
CHUNK = 20_000
SHORT_RUN = 12


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned; zero if the text has no word. Fewer words than a shingle are one shingle."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(len(words) - shingle + 1, 1)
    begins = np.concatenate([[0], ends[: n - 1] + 1]).tolist()
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(begins, stops, strict=True)), np.uint64, n
    )
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(texts: Column, shingle: int = SHINGLE) -> Column:
    """As a signed long; `hex_text` writes it unsigned."""

    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(
                np.array([fingerprint(t, shingle) for t in batch], np.uint64).view(np.int64)
            )

    return F.pandas_udf(of, "long")(texts)


def hex_text(number: Column) -> Column:
    return F.lpad(F.lower(F.hex(number)), 16, "0")


@dataclass(frozen=True)
class Plan:
    """Bit masks of the partitions and their thresholds; -1 leaves a partition out."""

    masks: tuple[int, ...]
    thresholds: tuple[int, ...]


def _groups(sample: np.ndarray, parts: int) -> list[list[int]]:
    """The bits in `parts` groups of even size, each grown by the most correlated bit left."""
    bits = np.unpackbits(sample.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    centred = bits - bits.mean(axis=0)
    spread = np.sqrt((centred**2).sum(axis=0)) + 1e-9
    related = np.abs(centred.T @ centred) / np.outer(spread, spread)
    np.fill_diagonal(related, 0)
    left, groups = list(range(BITS)), []
    for part in range(parts):
        size = BITS // parts + (part < BITS % parts)
        own = [max(left, key=lambda b: (related[b, left].sum(), -b))]
        left.remove(own[0])
        while len(own) < size:
            best = max(left, key=lambda b: (related[b, own].mean(), -b))
            own.append(best)
            left.remove(best)
        groups.append(sorted(own))
    return groups


def _mask(group: list[int]) -> int:
    return sum(1 << b for b in group)


def allocate(costs: list[list[float]], needed: int) -> tuple[float, tuple[int, ...]]:
    """Thresholds, one per partition, whose (t + 1) add up to `needed` at the least cost.

    costs[i][t + 1] is the cost of threshold t in partition i. By dynamic programming.
    """
    best: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
    for options in costs:
        step: dict[int, tuple[float, tuple[int, ...]]] = {}
        for spent, (cost, chosen) in best.items():
            for extra, more in enumerate(options):
                if spent + extra <= needed:
                    now = cost + more, (*chosen, extra - 1)
                    if spent + extra not in step or now < step[spent + extra]:
                        step[spent + extra] = now
        best = step
    return best[needed]


def plan(sample: np.ndarray, total: int, distance: int = DISTANCE) -> Plan:
    """The cheapest plan for `total` fingerprints like those of the sample.

    The work of a threshold is its probes and the pairs they are expected to meet, which is
    the share of sample pairs that are as close in that partition.
    """
    choices = []
    others = np.roll(sample, 1) if len(sample) > 1 else sample
    shifts = [np.roll(sample, k) for k in range(1, min(len(sample), 512))] or [others]
    for parts in range(2, distance + 2):
        groups, costs = _groups(sample, parts), []
        for group in groups:
            mask, near = np.uint64(_mask(group)), np.zeros(distance + 1)
            for shifted in shifts:
                d = np.bitwise_count((sample ^ shifted) & mask)
                near += np.bincount(np.minimum(d, distance + 1), minlength=distance + 2)[:-1]
            share = np.cumsum(near + 1e-3) / (len(shifts) * max(len(sample), 1))
            options, probes = [0.0], 0
            for t in range(min(distance, 2) + 1):
                probes += comb(len(group), t)
                options.append(
                    PROBE_COST * total * (probes + (t > 0))
                    + CANDIDATE_COST * total * total * float(share[t]) / 2
                )
            costs.append(options)
        reachable = parts * (min(distance, 2) + 1) >= distance + 1
        if reachable:
            cost, thresholds = allocate(costs, distance + 1)
            choices.append((cost, parts, thresholds, tuple(map(_mask, groups))))
    _, _, thresholds, masks = min(choices)
    return Plan(masks, thresholds)


def _mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def probes(prints: np.ndarray, how: Plan) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, whether it is a flipped probe) of all prints, one pair of arrays per flip."""
    for part, (mask, threshold) in enumerate(zip(how.masks, how.thresholds, strict=True)):
        bits = [b for b in range(BITS) if mask >> b & 1]
        for flips in range(threshold + 1):
            for chosen in combinations(bits, flips):
                value = (prints & np.uint64(mask)) ^ np.uint64(_mask(list(chosen)))
                bucket = _mix(value ^ np.uint64(0x9E3779B97F4A7C15 * (part + 1) % 2**64))
                yield bucket, np.full(len(prints), flips > 0)


def _forest(prints: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what is connected within one bucket: a forest, not all pairs."""
    edges, left = [], prints.copy()
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            node = front.pop()
            near = np.bitwise_count(left ^ node) <= distance
            if near.any():
                hits, left = left[near], left[~near]
                edges.append((np.full(len(hits), node), hits))
                front += list(hits)
    return edges


def _links(
    buckets: np.ndarray, prints: np.ndarray, flipped: np.ndarray, distance: int
) -> tuple[np.ndarray, np.ndarray]:
    """Verified links within runs of equal buckets."""
    starts = np.flatnonzero(np.diff(buckets, prepend=buckets[0] ^ np.uint64(1)))
    sizes = np.diff(starts, append=len(buckets))
    short = np.repeat(sizes <= SHORT_RUN, sizes)
    edges = []
    for k in range(1, min(SHORT_RUN, len(buckets))):
        a, b = slice(None, -k), slice(k, None)
        near = (buckets[a] == buckets[b]) & short[a] & ~(flipped[a] & flipped[b])
        at = np.flatnonzero(near)
        at = at[np.bitwise_count(prints[at] ^ prints[at + k]) <= distance]
        edges.append((prints[at], prints[at + k]))
    for at, size in zip(starts[sizes > SHORT_RUN], sizes[sizes > SHORT_RUN], strict=True):
        edges += _forest(prints[at : at + size], distance)
    if not edges:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate([e[0] for e in edges]), np.concatenate([e[1] for e in edges])


def links(prints: DataFrame, distance: int = DISTANCE, chunk: int = CHUNK) -> DataFrame:
    """(a, b): links among the different values of `fp`, enough to connect all within reach.

    Every pair within `distance` is connected by links that are within it too. Links inside
    one bucket form a forest, so a cluster of any density gives no more links than members.
    """
    total = prints.count()
    some = prints.orderBy(F.xxhash64("fp", F.lit("plan")), "fp").limit(PLAN_SAMPLE).collect()
    sample = np.array([r["fp"] for r in some], np.int64).view(np.uint64)
    how = plan(sample if len(sample) else np.zeros(1, np.uint64), max(total, 1), distance)

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = batch["fp"].to_numpy().view(np.uint64)
            for at in range(0, len(own), 5_000):
                part = own[at : at + 5_000]
                for bucket, flipped in probes(part, how):
                    yield pd.DataFrame(
                        {
                            "bucket": bucket.view(np.int64),
                            "fp": part.view(np.int64),
                            "flipped": flipped,
                        }
                    )

    entries = prints.select("fp").mapInPandas(spread, "bucket long, fp long, flipped boolean")
    entries = stored(entries, "probes")
    large = stored(
        entries.groupBy("bucket").agg(F.count("*").alias("n")).filter(F.col("n") > chunk), "large"
    )
    if not large.isEmpty():
        # A chunk meets itself and every other chunk of its bucket.
        chunks = F.ceil(F.col("n") / chunk).cast("int")
        cut = entries.join(large, "bucket", "left").withColumn(
            "_mine", F.when(F.col("n").isNotNull(), F.pmod(F.xxhash64("fp"), chunks))
        )
        meets = F.when(F.col("n").isNull(), F.array(F.lit(0))).otherwise(
            F.sequence(F.lit(0), chunks - 1)
        )
        cut = cut.withColumn("_other", F.explode(meets))
        pair = F.xxhash64("bucket", F.least("_mine", "_other"), F.greatest("_mine", "_other"))
        entries = cut.select(
            F.when(F.col("n").isNull(), F.col("bucket")).otherwise(pair).alias("bucket"),
            "fp",
            "flipped",
        )

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None
        for batch in batches:
            now = [
                batch["bucket"].to_numpy().view(np.uint64),
                batch["fp"].to_numpy().view(np.uint64),
                batch["flipped"].to_numpy(bool),
            ]
            if kept is not None:
                now = [np.concatenate(x) for x in zip(kept, now, strict=True)]
            if not len(now[0]):
                continue
            # The last run may go on in the next batch.
            last = np.flatnonzero(now[0] != now[0][-1])
            cut_at = last[-1] + 1 if len(last) else 0
            kept = [x[cut_at:] for x in now]
            if cut_at:
                yield _frame(_links(*(x[:cut_at] for x in now), distance))
        if kept is not None:
            yield _frame(_links(*kept, distance))

    return (
        entries.repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInPandas(join, "a long, b long")
    )


def _frame(edges: tuple[np.ndarray, np.ndarray]) -> pd.DataFrame:
    return pd.DataFrame({"a": edges[0].view(np.int64), "b": edges[1].view(np.int64)})


def groups(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
) -> DataFrame:
    """One row per document: key, text_hash, fp, component_id (the least key of its group) and
    component, which names the group by one of its fingerprints.

    Groups are the connected components under the distance. Texts without words, null ones
    included, share the fingerprint zero. Documents without a key belong to groups, but do not
    name them. Repeated rows stay as many rows.
    """
    own = stored(
        documents.select(
            F.col(key).alias("_key"),
            F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"),
            fingerprints(F.col(text), shingle).alias("fp"),
        ),
        "fingerprints",
    )
    prints = stored(own.groupBy("fp").agg(F.min("_key").alias("least_key")), "distinct-prints")
    found = components(links(prints, distance))
    named = prints.join(found, prints["fp"] == found["node"], "left").select(
        "fp", "least_key", F.coalesce("component", "fp").alias("component")
    )
    named = stored(named, "components")
    heads = named.groupBy("component").agg(F.min("least_key").alias("component_id"))
    labels = named.join(heads, "component").select(
        F.col("fp").alias("_fp"), "component_id", "component"
    )
    return own.join(labels, F.col("fp") == F.col("_fp")).select(
        F.col("_key").alias(key), "text_hash", "fp", "component_id", "component"
    )


def one_of_each(
    documents: DataFrame, key: str = "doc_id", text: str = "text", **settings
) -> DataFrame:
    """The documents, one of each group: the one with the least key, and the least hash of
    its text where keys are equal or missing. All columns stay."""
    found = groups(documents, key, text, **settings)
    order = F.struct(
        F.col(key).isNull().alias("last"), F.col(key).alias("k"), F.col("text_hash").alias("h")
    )
    kept = (
        found.groupBy("component")
        .agg(F.min(order).alias("_first"))
        .select(*_identity(F.col("_first.k"), F.col("_first.h")))
        .distinct()
    )
    names = ["_known", "_key", "_hash"]
    own = documents.select(
        whole_row(documents),
        *_identity(F.col(key), F.xxhash64(F.coalesce(F.col(text), F.lit("")))),
    )
    # Rows that repeat both key and text are one document too.
    again = F.row_number().over(Window.partitionBy(*names).orderBy(F.lit(0)))
    return (
        own.join(kept, names, "left_semi")
        .withColumn("_again", again)
        .filter(F.col("_again") == 1)
        .select("_row.*")
    )


def _identity(key: Column, text_hash: Column) -> list[Column]:
    """Columns without nulls that tell documents apart, for joins and windows alike."""
    return [
        key.isNotNull().alias("_known"),
        F.coalesce(key.cast("string"), F.lit("")).alias("_key"),
        text_hash.alias("_hash"),
    ]
