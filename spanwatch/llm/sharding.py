"""Resharding by a minimum-cost flow from old shard sizes to new capacities.

Documents of one text are a group, and groups lie in an old shard by the hash of their text.
Within its shard every group has a place on a line of bytes. The flow says how many bytes go
from which old shard to which new one so that the fewest bytes move; each transfer is a block,
a stretch of the old shard's line. A new shard so gets its capacity up to half a unit at
each end of a block. Units are whole groups, or parts of groups too large to move whole.
"""

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from spanwatch.llm.common import stored, whole_row

SHARDS = 16
OLD_SHARDS = 12
# A group beyond this share of all rows or bytes is split, so at most twice as many are.
PARTS = 1_000
LEAST_UNIT_ROWS = 64
STRETCHES = 64
STRETCH_ROWS = 1_000_000
# What a task writes at least. Each file costs its executor several processes (Hadoop sets the
# permissions by chmod), and until such a one starts it holds the executor's memory once more.
FILE_ROWS = 10_000
FILE_BYTES = 16_000_000
# Of the files of shards, which hold whole texts.
CODEC = "zstd"


def min_cost_flow(
    supplies: list[int], capacities: list[int], cost
) -> dict[tuple[int, int], int]:
    """Amounts (from, to) that send all supplies within the capacities at the least total cost.

    cost(i, j) is the price of one unit, at least 0. Successive shortest paths with potentials.
    The capacities must add up to the supplies at least.
    """
    if sum(capacities) < sum(supplies):
        raise ValueError("the capacities do not hold the supplies")
    n, m = len(supplies), len(capacities)
    source, sink = n + m, n + m + 1
    graph: list[list[list[int]]] = [[] for _ in range(n + m + 2)]  # [to, left, price, back]

    def arc(a: int, b: int, left: int, price: int) -> None:
        graph[a].append([b, left, price, len(graph[b])])
        graph[b].append([a, 0, -price, len(graph[a]) - 1])

    for i, amount in enumerate(supplies):
        arc(source, i, amount, 0)
        for j in range(m):
            arc(i, n + j, amount, cost(i, j))
    for j, amount in enumerate(capacities):
        arc(n + j, sink, amount, 0)
    potential = [0] * len(graph)
    while True:
        far: list[float] = [float("inf")] * len(graph)
        far[source], came, heap = 0, {}, [(0, source)]
        while heap:
            d, a = heapq.heappop(heap)
            if d > far[a]:
                continue
            for at, (b, left, price, _) in enumerate(graph[a]):
                step = d + price + potential[a] - potential[b]
                if left > 0 and step < far[b]:
                    far[b], came[b] = step, (a, at)
                    heapq.heappush(heap, (step, b))
        if far[sink] == float("inf"):
            break
        potential = [p + f if f < float("inf") else p for p, f in zip(potential, far)]
        path, b = [], sink
        while b != source:
            path.append(came[b])
            b = came[b][0]
        amount = min(graph[a][at][1] for a, at in path)
        for a, at in path:
            graph[a][at][1] -= amount
            graph[graph[a][at][0]][graph[a][at][3]][1] += amount
    return {
        (i, b - n): graph[b][back][1]
        for i in range(n)
        for b, _, _, back in graph[i]
        if n <= b < n + m and graph[b][back][1] > 0
    }


def even(total: int, shards: int) -> list[int]:
    """Capacities that differ by one at most and add up to `total`."""
    return [total // shards + (j < total % shards) for j in range(shards)]


def size_of(text: Column) -> Column:
    """Bytes of the text and one for its end."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def group_of(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def old_shard(group: Column, shards: int = OLD_SHARDS) -> Column:
    """The layout that documents are moved from: by the hash of the text."""
    return F.pmod(group, F.lit(shards)).cast("int")


def in_files(df: DataFrame, rows: int, size: int = 0) -> DataFrame:
    """`df` in as many partitions as that many rows and bytes fill, or as it has if fewer."""
    return df.coalesce(max(1, -(-rows // FILE_ROWS), -(-size // FILE_BYTES)))


def place(
    rows: DataFrame,
    key: str,
    size: str,
    group: str,
    old: str,
    capacities=lambda total: even(total, SHARDS),
    in_order: bool = False,
) -> tuple[DataFrame, dict[tuple[int, int], int]]:
    """`rows` with `shard` and `slot`, and the transfers (old, new) -> bytes.

    Columns of `rows` name each document's key, its size in bytes, the hash of its text and the
    shard it lies in; there may be others. All rows of a group must lie in one old shard.
    `capacities` makes the new capacities from the sum of all sizes. Slots count from 0 in
    every shard without a gap. Groups that hold more than a thousandth of all rows or bytes
    are cut by the hash of the key; parts of a group lie next to each other. No rows give
    no transfers. The partitions of the result follow its rows and bytes, up to the session's
    shuffle partitions.

    With `in_order` the same rows come in ranges of (shard, slot), one to a partition, by the only
    shuffle of whole rows: for `rewrite`.
    """
    narrow = stored(
        rows.select(
            F.col(group).alias("_group"),
            F.col(old).alias("_old"),
            F.xxhash64(key).alias("_of_key"),
            F.col(size).alias("_size"),
        ),
        "shard-sizes",
    )
    shards = narrow.groupBy("_old").agg(F.sum("_size").alias("b"), F.count("*").alias("n"))
    held = {r["_old"]: (r["b"], r["n"]) for r in shards.collect()}
    total, count = sum(b for b, _ in held.values()), sum(n for _, n in held.values())
    order = sorted(held)
    wanted = capacities(total)
    flow = min_cost_flow(
        [held[o][0] for o in order], wanted, lambda i, j: 0 if order[i] == j else 1
    )
    most_rows, most_bytes = max(LEAST_UNIT_ROWS, count // PARTS), max(1, total // PARTS)
    cuts = F.ceil(
        F.greatest(F.col("n") / F.lit(most_rows), F.col("b") / F.lit(most_bytes))
    ).cast("int")
    # At most 2 * PARTS rows: so many groups can hold more than their share.
    large = (
        narrow.groupBy("_group")
        .agg(F.count("*").alias("n"), F.sum("_size").alias("b"))
        .filter(((F.col("n") > most_rows) | (F.col("b") > most_bytes)) & (F.col("n") > 1))
        .select(F.col("_group").alias("_large"), cuts.alias("_cuts"))
    )
    large = F.broadcast(stored(in_files(large, count), "large-groups"))

    def stretch(own: str) -> Column:
        return F.pmod(F.xxhash64(own, F.lit("line")), F.lit(stretches))

    def parts(df: DataFrame, own: str, of_key: Column) -> DataFrame:
        joined = df.join(large, F.col(own) == F.col("_large"), "left")
        part = F.coalesce(F.pmod(of_key, F.col("_cuts")).cast("int"), F.lit(0))
        return joined.withColumn("_part", part).drop("_large", "_cuts")

    stretches = STRETCHES
    while stretches * max(len(order), 1) * STRETCH_ROWS < count:
        stretches *= 2
    units = (
        parts(narrow, "_group", F.col("_of_key"))
        .groupBy("_old", "_group", "_part")
        .agg(F.sum("_size").alias("b"), F.count("*").alias("n"))
        .withColumn("_stretch", stretch("_group"))
    )
    units = stored(in_files(units, count), "units")

    def running(df: DataFrame, value: str, shard: str) -> DataFrame:
        """The sum of `value` over all units before, along the line of `shard`."""
        line = ["_old", "_stretch"]
        sums = df.groupBy(shard, *dict.fromkeys(x for x in line if x != shard)).agg(
            F.sum(value).alias("_sum")
        )
        along = Window.partitionBy(shard).orderBy(*[x for x in line if x != shard])
        before = along.rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("_base", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop(
            "_sum"
        )
        inner = Window.partitionBy(shard, *[x for x in line if x != shard]).orderBy(
            "_group", "_part"
        )
        own = F.coalesce(
            F.sum(value).over(inner.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        )
        names = [shard, *[x for x in line if x != shard]]
        return df.withColumn("_own", own).join(sums, names).withColumn(
            "_start", F.col("_own") + F.col("_base")
        ).drop("_own", "_base")

    blocks = []
    for i, o in enumerate(order):
        at = 0
        # What stays comes first on the line.
        for j, amount in sorted(
            ((j, a) for (x, j), a in flow.items() if x == i), key=lambda t: (t[0] != o, t[0])
        ):
            blocks.append((o, at, at + amount, j))
            at += amount
    spark = rows.sparkSession
    where = spark.createDataFrame(blocks, "_from int, _low long, _high long, shard int")
    middle = F.col("_start") + F.col("b") / 2
    moved = running(units, "b", "_old").join(
        F.broadcast(where),
        (F.col("_old") == F.col("_from"))
        & (middle >= F.col("_low"))
        & (middle < F.col("_high")),
    )
    moved = moved.select("_old", "_group", "_part", "_stretch", "n", "shard")
    moved = stored(in_files(moved, count), "moved")
    lines = running(moved, "n", "shard")
    own = rows.select(
        whole_row(rows, "shard", "slot"),
        F.col(group).alias("_group"),
        F.col(key).alias("_key"),
        F.xxhash64(key).alias("_of_key"),
        F.col(old).alias("_from"),
    )
    cut = parts(own, "_group", F.col("_of_key"))
    transfers = {(order[i], j): a for (i, j), a in flow.items()}
    if in_order:
        # Where a shard's next piece of a stretch begins. A stretch has few, so that whole rows
        # find theirs in a broadcast list, before they are moved.
        piece = F.floor(F.col("_start") / max(FILE_ROWS, count // (100 * PARTS)))
        pieces = (
            lines.groupBy("_old", "_stretch", "shard", piece)
            .agg(F.min(F.struct("_group", "_part")).alias("_low"), F.min("_start").alias("_base"))
            .groupBy("_old", "_stretch")
            .agg(F.array_sort(F.collect_list(F.struct("_low", "shard", "_base"))).alias("_pieces"))
        )
        before = F.filter("_pieces", lambda p: p["_low"] <= F.struct("_group", "_part"))
        nth = F.row_number().over(
            Window.partitionBy("shard", "_base").orderBy(
                "_group", "_part", F.col("_key").asc_nulls_last()
            )
        )
        files = max(1, -(-count // FILE_ROWS), -(-total // FILE_BYTES))
        placed = (
            cut.withColumn("_stretch", stretch("_group"))
            .join(
                F.broadcast(pieces.withColumnRenamed("_stretch", "_at")),
                (F.col("_from") == F.col("_old")) & (F.col("_stretch") == F.col("_at")),
            )
            .withColumn("_piece", F.element_at(before, -1))
            .select("_row", "_group", "_part", "_key", "_piece.shard", "_piece._base")
            .repartitionByRange(files, "shard", "_base")
            .withColumn("slot", (F.col("_base") + nth - 1).cast("long"))
            .select("_row.*", "shard", "slot")
        )
        return in_files(placed, count, total), transfers
    slots = lines.select(
        F.col("_group").alias("_unit"), F.col("_part").alias("_unit_part"), "shard",
        F.col("_start").alias("_first"),
    )
    nth = F.row_number().over(
        Window.partitionBy("_group", "_part").orderBy(F.col("_key").asc_nulls_last())
    )
    placed = (
        cut.join(
            slots, (F.col("_group") == F.col("_unit")) & (F.col("_part") == F.col("_unit_part"))
        )
        .withColumn("slot", (F.col("_first") + nth - 1).cast("long"))
        .select("_row.*", "shard", "slot")
    )
    return in_files(placed, count, total), transfers


def lay_out(
    docs: DataFrame, shard: Column, size: Column, root: str, shards: int = OLD_SHARDS
) -> dict[int, str]:
    """Writes `docs` below `root`, one folder for each shard from 0; returns the folders.

    Each task writes to all folders, so a task takes as many rows and bytes as fill a file in
    each. A shard without rows has no folder on disk.
    """
    held = docs.agg(F.count("*").alias("n"), F.sum(size).alias("b")).first()
    filled = in_files(docs, -(-held["n"] // shards), -(-(held["b"] or 0) // shards))
    filled.withColumn("_folder", shard).write.partitionBy("_folder").option(
        "compression", CODEC
    ).parquet(root)
    return {s: f"{root}/_folder={s}" for s in range(shards)}


def laid_out(spark: SparkSession, root: str, schema: StructType, shard: str) -> DataFrame:
    """The rows of all shards below `root`, with the shard that holds them as column `shard`."""
    fields = StructType([*schema.fields, StructField("_folder", IntegerType())])
    return spark.read.schema(fields).parquet(root).withColumnRenamed("_folder", shard)


def rewrite(
    spark: SparkSession,
    placed: DataFrame,
    old: str,
    files: dict[int, str],
    root: str,
    in_order: bool = False,
) -> dict[int, str]:
    """Writes the shards that change below `root`; returns the folder of every shard.

    `files` has the folder of every old shard, whose rows are those of `placed` with that value
    in `old`. A shard that neither loses nor gets rows keeps its folder. Old folders are left
    as they are, so that a run that fails can be repeated under another root. `in_order` says
    that the partitions of `placed` are ranges of (shard, slot) already.
    """
    pairs = [(r[0], r[1]) for r in placed.select(old, "shard").distinct().collect()]
    present = {new for _, new in pairs}
    affected = {s for was, new in pairs if was is not None and was != new for s in (was, new)}
    affected |= present - set(files)
    if affected:
        rows = placed.filter(F.col("shard").isin(sorted(affected)))
        if not in_order:
            # Many tasks for one shard.
            rows = rows.repartitionByRange("shard", "slot")
        (
            rows.withColumn("_folder", F.col("shard"))
            # Rows stay in slot order within each file; the writer sorts by `_folder` only.
            .sortWithinPartitions("_folder", "slot")
            .write.partitionBy("_folder")
            .option("compression", CODEC)
            .parquet(root)
        )
    kept = {s: path for s, path in files.items() if s not in affected and s in present}
    return kept | {s: f"{root}/_folder={s}" for s in affected & present}


def sharded(
    documents: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS
) -> DataFrame:
    """`documents` with size, shard and slot; see `place`. Null and empty texts are one group."""
    sized = documents.select(
        whole_row(documents, "size", "shard", "slot"),
        F.col(key).alias("key"),
        size_of(F.col(text)).alias("size"),
        group_of(F.col(text)).alias("text_group"),
        old_shard(group_of(F.col(text))).alias("old_shard"),
    )
    placed, _ = place(
        sized, "key", "size", "text_group", "old_shard", lambda total: even(total, shards)
    )
    return placed.select("_row.*", "size", "shard", "slot")
