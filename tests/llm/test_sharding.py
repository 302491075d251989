import random

import pytest
from awkward_rows import awkward, empty
from pyspark.sql import functions as F
from spanwatch.llm import sharding
from spanwatch.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_flow_moves_the_fewest_bytes():
    rng = random.Random(6)
    for _ in range(60):
        old, new = rng.randint(1, 5), rng.randint(1, 6)
        supplies = [rng.randint(0, 30) for _ in range(old)]
        capacities = sharding.even(sum(supplies), new)
        flow = sharding.min_cost_flow(supplies, capacities, lambda i, j: int(i != j))
        for i, amount in enumerate(supplies):
            assert sum(a for (x, _), a in flow.items() if x == i) == amount
        for j, room in enumerate(capacities):
            assert sum(a for (_, y), a in flow.items() if y == j) == room
        stay = sum(min(supplies[k], capacities[k]) for k in range(min(old, new)))
        assert sum(a for (i, j), a in flow.items() if i != j) == sum(supplies) - stay
    prices = [[4, 1], [2, 3]]
    flow = sharding.min_cost_flow([5, 5], [6, 4], lambda i, j: prices[i][j])
    assert sum(prices[i][j] * a for (i, j), a in flow.items()) == 4 * 1 + 1 * 4 + 5 * 2
    with pytest.raises(ValueError, match="capacities"):
        sharding.min_cost_flow([5], [4], lambda i, j: 0)


def check(rows, shards=16):
    slots, sizes = {}, [0] * shards
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
        sizes[r["shard"]] += r["size"]
    for numbers in slots.values():
        assert sorted(numbers) == list(range(len(numbers)))
    return sizes


def test_shards_hold_near_equal_bytes(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op8_sharding"](spark, SF).collect()
    assert {r["doc_id"] for r in rows} == set(docs)
    sizes, largest = check(rows), max(r["size"] for r in rows)
    assert max(sizes) - min(sizes) <= largest
    by_text = {}
    for r in rows:
        assert r["size"] == len((docs[r["doc_id"]] or "").encode()) + 1
        by_text.setdefault(docs[r["doc_id"]], set()).add(r["shard"])
    assert all(len(s) == 1 for s in by_text.values())


def test_a_group_that_is_most_of_the_rows_is_split(spark):
    docs = spark.range(3_000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") < 2_000, F.lit("the same text")).otherwise(
            F.concat(F.lit("text "), "id")
        ).alias("text"),
    )
    sizes = check(sharding.sharded(docs).collect())
    assert max(sizes) - min(sizes) <= 2 * sharding.LEAST_UNIT_ROWS * 14


def test_few_rows_are_written_in_few_files(spark, monkeypatch):
    docs = spark.range(3_000).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("text "), F.when(F.col("id") >= 500, F.col("id"))).alias("text"),
    )
    before = sorted(sharding.sharded(docs).collect())
    plain, files = sharding.stored, {}

    def counted(df, purpose):
        table = plain(df, purpose)
        files[purpose] = len(table.inputFiles())
        return table

    monkeypatch.setattr(sharding, "stored", counted)
    held = {
        "spark.sql.shuffle.partitions": "40",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    was = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        placed = sharding.sharded(docs)
        assert (files["large-groups"], files["units"], files["moved"]) == (1, 1, 1)
        assert placed.rdd.getNumPartitions() == 1
        assert sorted(placed.collect()) == before
        # More rows or bytes take more of them.
        monkeypatch.setattr(sharding, "FILE_ROWS", 400)
        placed = sharding.sharded(docs)
        assert files["units"] == files["moved"] == placed.rdd.getNumPartitions() == 8
        assert sorted(placed.collect()) == before
        monkeypatch.setattr(sharding, "FILE_ROWS", 10_000)
        monkeypatch.setattr(sharding, "FILE_BYTES", 1_000)
        filled = -(-sum(r["size"] for r in before) // 1_000)
        assert sharding.sharded(docs).rdd.getNumPartitions() == min(filled, 40)
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def test_only_shards_that_change_are_rewritten(spark, tmp_path):
    docs = spark.range(400).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text")
    )
    group = sharding.group_of(F.col("text"))
    rows = docs.select(
        "doc_id", "text", sharding.size_of(F.col("text")).alias("size"), group.alias("g"),
        sharding.old_shard(group, 4).alias("old"),
    )
    first, _ = sharding.place(rows, "doc_id", "size", "g", "old", lambda t: sharding.even(t, 4))
    files = sharding.rewrite(spark, first, "old", {}, f"{tmp_path}/1")
    placed = spark.read.parquet(*files.values()).select(*rows.columns, "shard", "slot")
    assert sorted(r["doc_id"] for r in placed.collect()) == list(range(400))
    # Shards 0 to 2 keep what they hold, shard 3 is shared with a new one.
    again = placed.drop("old", "slot").withColumnRenamed("shard", "old")
    held = {r["old"]: r["b"] for r in again.groupBy("old").agg(F.sum("size").alias("b")).collect()}
    wanted = [held[0], held[1], held[2], held[3] // 2, held[3] - held[3] // 2]
    grown, moves = sharding.place(again, "doc_id", "size", "g", "old", lambda _: wanted)
    assert {k for k in moves if k[0] != k[1]} == {(3, 4)}
    after = sharding.rewrite(spark, grown, "old", files, f"{tmp_path}/2")
    assert {s for s in after if after[s] == files.get(s)} == {0, 1, 2}
    assert sorted(r["doc_id"] for r in spark.read.parquet(*after.values()).collect()) == list(
        range(400)
    )


def sized(docs, shards=12):
    group = sharding.group_of(F.col("text"))
    return docs.select(
        "*", sharding.size_of(F.col("text")).alias("size"), group.alias("g"),
        sharding.old_shard(group, shards).alias("old"),
    )


def test_rows_in_order_are_the_same_rows(spark, monkeypatch):
    """A group that is cut, equal rows, null keys and texts, and more than one piece a shard."""
    monkeypatch.setattr(sharding, "FILE_ROWS", 100)
    docs = spark.range(3_000).select(
        F.when(F.col("id") % 50 > 0, F.col("id")).alias("doc_id"),
        F.when(F.col("id") < 1_500, F.lit("the same text"))
        .when(F.col("id") < 2_900, F.concat(F.lit("text "), F.col("id") % 900))
        .alias("text"),
    )
    names = ("doc_id", "size", "g", "old")
    plain, moves = sharding.place(sized(docs), *names)
    placed, same_moves = sharding.place(sized(docs), *names, in_order=True)
    assert moves == same_moves and placed.columns == plain.columns
    rows = [tuple(map(repr, r)) for r in plain.collect()]
    assert len(rows) == 3_000
    assert sorted(rows) == sorted(tuple(map(repr, r)) for r in placed.collect())
    parts = placed.rdd.map(lambda r: (r["shard"], r["slot"])).glom().collect()
    assert len(parts) == 30 and sum(map(bool, parts)) > 15
    assert all(part == sorted(part) for part in parts)
    ranges = sorted((part[0], part[-1]) for part in parts if part)
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


@pytest.mark.parametrize("most", [0, 3, 2_000])
def test_the_query_rewrites_stored_shards(spark, tmp_path, monkeypatch, most):
    """Rows are those of files that hold the whole documents; two shards of three stay."""
    docs = spark.range(most).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("text "), F.col("id") % 1_500)).alias("text"),
        F.lit("en").alias("lang"),
        F.col("id").alias("n_chars"),
    )
    if most == 3:
        # Two short texts fit where they are; a long one goes to a shard of its own.
        texts = spark.range(500).select(F.repeat(F.lit("x"), F.col("id").cast("int")).alias("text"))
        by_shard = {r["old"]: r["text"] for r in sized(texts).orderBy(F.desc("size")).collect()}
        long = next(
            r["text"]
            for r in sized(texts).filter("size > 400").orderBy("size").collect()
            if r["old"] not in (1, 5)
        )
        docs = spark.createDataFrame(
            [(i, t, "en", 2) for i, t in enumerate((by_shard[1], by_shard[5], long))], docs.schema
        )
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    ran, plain = [], sharding.rewrite

    def watched(spark, placed, old, files, root, **options):
        ran.append((files, root, plain(spark, placed, old, files, root, **options)))
        return ran[-1][2]

    monkeypatch.setattr(sharding, "rewrite", watched)
    rows = QUERIES["op8_sharding"](spark, str(tmp_path)).collect()
    check(rows)
    [(files, root, folders)] = ran
    was = {tuple(r) for r in docs.collect()}
    held, kept = [], []
    for shard, folder in folders.items():
        if folder == files.get(shard):
            kept.append(shard)
        for file in spark.read.parquet(folder).inputFiles():
            found = spark.read.parquet(file).coalesce(1)
            held += [(shard, r) for r in found.select(docs.columns).collect()]
            if shard not in kept:
                assert folder.startswith(root)
                slots = [r["slot"] for r in found.collect()]
                assert slots == sorted(slots)
    assert {tuple(r) for _, r in held} == was and len(held) == len(rows) == most
    assert sorted((s, r["doc_id"]) for s, r in held) == sorted(
        (r["shard"], r["doc_id"]) for r in rows
    )
    old = [
        (s, r["doc_id"])
        for s in {r["old"] for r in sized(docs).collect()}
        for r in spark.read.parquet(files[s]).collect()
    ]
    assert sorted(old) == sorted((r["old"], r["doc_id"]) for r in sized(docs).collect())
    assert sorted(kept) == ([1, 5] if most == 3 else [])


def test_awkward_rows_and_no_rows(spark):
    docs = awkward(spark)
    placed = sharding.sharded(docs)
    rows = placed.collect()
    assert len(rows) == docs.count()
    assert placed.columns[: len(docs.columns) - 3] == [
        c for c in docs.columns if c not in ("size", "shard", "slot")
    ]
    check(rows)
    assert sharding.sharded(empty(spark)).collect() == []
