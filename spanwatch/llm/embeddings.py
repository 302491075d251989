"""Near-duplicate vectors by counting collisions of one-dimensional projections.

Unit vectors are projected on random directions. On one direction two vectors of cosine c are
normally sqrt((2 - 2c) / D) apart, so a window around a query's value holds its neighbours with
a known probability. Tables of sorted projections, each cut at its median, form cells: a vector
lies in one cell and asks in every cell that its windows reach. Where a query meets a vector,
collisions over further projections are counted; pairs that reach a count which neighbours
miss with a known, small probability are verified by their cosine in double precision.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from spanwatch.llm.common import stored
from spanwatch.llm.components import components

COSINE = 0.95
TABLES = 2
# Half-widths of the windows in standard deviations of the distance of neighbours.
CELL_WINDOW, COUNT_WINDOW = 1.5, 2.0
COUNTED = 24
COUNTED_FIRST = 8
# A pair at the threshold fails either count with at most this probability.
MISSED = 0.001
CELL_VECTORS = 1_500
CHUNK = 4_096
PLAN_SAMPLE = 4_096
BROADCAST_CELLS = 200_000
SEED = 17


def least_count(of: int, chance: float, missed: float = MISSED) -> int:
    """The largest count that a binomial variable misses with probability `missed` at most."""
    below, c = 0.0, 0
    while c < of:
        below += math.comb(of, c) * chance**c * (1 - chance) ** (of - c)
        if below > missed:
            break
        c += 1
    return c


@dataclass(frozen=True)
class Plan:
    """Directions depend on the dimension and the seed alone; cuts come from a sample."""

    bits: int
    cosine: float
    cuts: dict[int, np.ndarray]

    def directions(self, dim: int) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng([SEED, dim])
        drawn = rng.normal(size=(dim, TABLES * self.bits + COUNTED))
        drawn /= np.linalg.norm(drawn, axis=0)
        return drawn[:, : TABLES * self.bits], drawn[:, TABLES * self.bits :]

    def apart(self, dim: int) -> float:
        return math.sqrt((2 - 2 * self.cosine) / dim)

    def cells(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(vectors, tables): the bits of each vector's cell, and those its windows cross."""
        dim = unit.shape[1]
        cut = self.cuts.get(dim, np.zeros(TABLES * self.bits))
        value = (unit @ self.directions(dim)[0] - cut).reshape(len(unit), TABLES, self.bits)
        power = np.int64(1) << np.arange(self.bits, dtype=np.int64)
        near = np.abs(value) <= CELL_WINDOW * self.apart(dim)
        return (value > 0) @ power, near @ power


def _units(raw: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), np.float32).reshape(len(raw), -1).astype(float)
    # The largest component first, so that no square overflows or vanishes.
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _asked(cell: np.ndarray, crossed: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(vector, cell) for every cell that a vector asks in, its own included."""
    who, where = np.arange(len(cell)), cell
    for bit in range(bits):
        more = (crossed[who] >> bit & 1) == 1
        who, where = (
            np.concatenate([who, who[more]]),
            np.concatenate([where, where[more] ^ (np.int64(1) << np.int64(bit))]),
        )
    return who, where


def _reached(plan: Plan, a: tuple, b: tuple, table: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether the first of each pair asks in the second's cell of a table, and the reverse."""
    differ = a[0][:, table] ^ b[0][:, table]
    return (differ & ~a[1][:, table]) == 0, (differ & ~b[1][:, table]) == 0


def meet(
    plan: Plan, table: int, q_ids: np.ndarray, q: np.ndarray, o_ids: np.ndarray, o: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Verified pairs of queries and vectors that meet in one cell, each pair once overall.

    A pair that also meets in an earlier table, or in this one with the roles reversed and the
    smaller number asking, is left to that meeting.
    """
    dim = q.shape[1]
    window = COUNT_WINDOW * plan.apart(dim)
    chance = math.erf(COUNT_WINDOW / math.sqrt(2))
    first, every = least_count(COUNTED_FIRST, chance), least_count(COUNTED, chance)
    counted = plan.directions(dim)[1]
    pq, po = (q @ counted).astype(np.float32), (o @ counted).astype(np.float32)
    q_cells, o_cells = plan.cells(q), plan.cells(o)
    found = []
    for at in range(0, len(q), 256):
        part = pq[at : at + 256]
        count = np.zeros((len(part), len(o)), np.int8)
        for k in range(COUNTED_FIRST):
            count += np.abs(part[:, k, None] - po[None, :, k]) <= window
        i, j = np.nonzero(count >= first)
        some = count[i, j]
        i = i + at
        rest = np.abs(pq[i, COUNTED_FIRST:] - po[j, COUNTED_FIRST:]) <= window
        good = (some + rest.sum(axis=1) >= every) & (q_ids[i] != o_ids[j])
        i, j = i[good], j[good]
        own = q_cells[0][i], q_cells[1][i]
        other = o_cells[0][j], o_cells[1][j]
        here, back = _reached(plan, own, other, table)
        mine = here & (~back | (q_ids[i] < o_ids[j]))
        for earlier in range(table):
            there, back = _reached(plan, own, other, earlier)
            mine &= ~(there | back)
        i, j = i[mine], j[mine]
        close = np.einsum("nd,nd->n", q[i], o[j]) >= plan.cosine
        found.append((q_ids[i[close]], o_ids[j[close]]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _valid(vector: str) -> Column:
    x = F.col(vector)
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(fine & F.exists(x, lambda v: v != 0), F.lit(False))


def pairs(classes: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(a, b): the numbers (`node`) of different vectors (`raw`, 32-bit floats as binary) whose
    cosine is at least `cosine`, each pair once."""
    total = classes.count()
    bits = max(0, round(math.log2(max(total, 1) / CELL_VECTORS)))
    drawn = classes.orderBy(F.xxhash64("raw"), "node").limit(PLAN_SAMPLE).select("raw").collect()
    by_length: dict[int, list[bytes]] = {}
    for row in drawn:
        by_length.setdefault(len(row["raw"]), []).append(bytes(row["raw"]))
    uncut, cuts = Plan(bits, cosine, {}), {}
    for raw in by_length.values():
        unit = _units(raw)
        dim = unit.shape[1]
        cuts[dim] = np.median(unit @ uncut.directions(dim)[0], axis=0)
    plan = Plan(bits, cosine, cuts)

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lengths = batch["raw"].map(len)
            for length, same in batch.groupby(lengths):
                cell, crossed = plan.cells(_units(same["raw"].tolist()))
                nodes, raw = same["node"].to_numpy(), same["raw"].to_numpy()
                for table in range(TABLES if bits else 1):
                    who, where = _asked(cell[:, table], crossed[:, table], bits)
                    own = np.arange(len(nodes))
                    for rows, cells, asks in ((own, cell[:, table], False), (who, where, True)):
                        yield pd.DataFrame(
                            {
                                "dim": length // 4,
                                "place": table,
                                "cell": cells,
                                "asks": asks,
                                "node": nodes[rows],
                                "raw": raw[rows],
                            }
                        )

    schema = "dim int, place int, cell long, asks boolean, node long, raw binary"
    entries = classes.select("node", "raw").mapInPandas(spread, schema)
    cells = ["dim", "place", "cell"]
    sizes = stored(
        classes.select("node", "raw")
        .mapInPandas(spread, schema)
        .groupBy(*cells)
        .agg(F.count_if("asks").alias("_askers"), F.count_if(~F.col("asks")).alias("_held")),
        "cells",
    )
    few = sizes.count() <= BROADCAST_CELLS
    joined = entries.join(F.broadcast(sizes) if few else sizes, cells)
    # A large cell is met chunk by chunk: every chunk of askers sees every chunk of vectors.
    mine = F.when(F.col("asks"), F.col("_askers")).otherwise(F.col("_held"))
    others = F.when(F.col("asks"), F.col("_held")).otherwise(F.col("_askers"))
    chunks = lambda n: F.greatest(F.ceil(n / CHUNK), F.lit(1)).cast("int")
    cut = (
        joined.filter((F.col("_askers") > 0) & (F.col("_held") > 0))
        .withColumn("_mine", F.pmod(F.xxhash64("node"), chunks(mine)).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), chunks(others) - 1)))
        .withColumn("_a", F.when(F.col("asks"), F.col("_mine")).otherwise(F.col("_other")))
        .withColumn("_h", F.when(F.col("asks"), F.col("_other")).otherwise(F.col("_mine")))
    )
    keys = [*cells, "_a", "_h"]

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, waiting = None, []

        def finish() -> pd.DataFrame:
            group = pd.concat(waiting, ignore_index=True)
            asks = group["asks"].to_numpy(bool)
            unit, ids = _units(group["raw"].tolist()), group["node"].to_numpy()
            a, b = meet(plan, at[1], ids[asks], unit[asks], ids[~asks], unit[~asks])
            return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

        for batch in batches:
            for key, group in batch.groupby(keys, sort=False):
                if at is not None and key != at:
                    if _both(waiting):
                        yield finish()
                    waiting = []
                at = key
                waiting.append(group)
        if waiting and _both(waiting):
            yield finish()

    return (
        cut.select(*keys, "asks", "node", "raw")
        .repartition(*keys)
        .sortWithinPartitions(*keys)
        .mapInPandas(join, "a long, b long")
    )


def _both(waiting: list[pd.DataFrame]) -> bool:
    asks = [g["asks"] for g in waiting]
    return any(x.any() for x in asks) and any((~x).any() for x in asks)


def near_duplicates(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE
) -> DataFrame:
    """One row per vector: key, n_links, component_id, kept.

    Vectors link if their cosine, in double precision, is at least `cosine`. Null, empty and zero
    vectors and those with a null or non-finite component link with nothing, nor do vectors of
    different lengths. Equal vectors are compared once and count as often as they occur. A
    vector without key has links, but names no component. Repeated rows stay as many rows.
    """
    rows = vectors.select(
        F.col(key).alias("_key"), F.col(vector).cast("array<float>").alias("_vector")
    ).withColumn("_valid", _valid("_vector"))
    good = rows.filter("_valid").select("_key", "_vector")

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raw = [np.asarray(v, np.float32).tobytes() for v in batch["_vector"]]
            yield pd.DataFrame({"_key": batch["_key"], "raw": raw})

    key_type = dict(rows.dtypes)["_key"]
    own = stored(good.mapInPandas(packed, f"_key {key_type}, raw binary"), "vectors")
    # The numbers are fixed by being written down.
    classes = stored(
        own.groupBy("raw")
        .agg(F.min("_key").alias("least_key"), F.count("*").alias("n"))
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    linked = stored(pairs(classes, cosine), "pairs")
    sizes = classes.select(F.col("node").alias("_other"), F.col("n").alias("_n"))
    both = linked.unionAll(linked.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = (
        both.join(sizes, F.col("b") == F.col("_other"))
        .groupBy(F.col("a").alias("_node"))
        .agg(F.sum("_n").alias("_links"))
    )
    found = components(linked).withColumnRenamed("node", "_member")
    named = (
        classes.join(found, F.col("node") == F.col("_member"), "left")
        .join(others, F.col("node") == F.col("_node"), "left")
        .select(
            "raw",
            "least_key",
            (F.coalesce("_links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component"),
        )
    )
    named = stored(named, "named")
    heads = named.groupBy("component").agg(F.min("least_key").alias("component_id"))
    labels = named.join(heads, "component").select(
        F.col("raw").alias("_raw"), "n_links", "component_id"
    )
    result = own.join(labels, F.col("raw") == F.col("_raw")).select(
        "_key", "n_links", "component_id"
    )
    alone = rows.filter(~F.col("_valid")).select(
        "_key", F.lit(0).cast("long").alias("n_links"), F.col("_key").alias("component_id")
    )
    return result.unionAll(alone).select(
        F.col("_key").alias(key),
        "n_links",
        "component_id",
        F.col("_key").eqNullSafe(F.col("component_id")).alias("kept"),
    )
