import random
import re

import numpy as np
import pytest
from awkward_rows import awkward, empty
from pyspark.sql import functions as F
from spanwatch.llm import mixing

SF = "/root/testdata/sf0.01"


def reshared(sizes):
    """Targets by resharing the excess until none is above its cap."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s])
    order += [None] if None in sizes else []
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    capped, total = {}, float(sum(sizes.values()))
    while True:
        free = [s for s in order if s not in capped]
        rest, shares = total - sum(capped.values()), sum(weight[s] for s in free)
        target = capped | {s: rest * weight[s] / shares for s in free}
        over = [s for s in free if target[s] > 3 * sizes[s] + 1e-9]
        if not over:
            return target
        capped |= {s: 3.0 * sizes[s] for s in over}


@pytest.mark.parametrize("bucket", [4_000, 12])
def test_targets_are_met(spark, monkeypatch, bucket):
    monkeypatch.setattr(mixing, "BUCKET", bucket)
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn(
        "source", F.when(F.col("source") != "src3", F.col("source"))
    )
    # One source too small for its share, so that there is something to reshare.
    docs = docs.filter((F.col("source") != "src11") | (F.col("doc_id") < 40) | F.col("source").isNull())
    got = [r.asDict() for r in mixing.rows(mixing.decide(docs)).collect()]
    text = {r["doc_id"]: r for r in docs.collect()}
    sizes, taken, target = {}, {}, {}
    for r in got:
        doc = text[r["key"]]
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", doc["text"] or ""))
        assert r["taken"] == r["times"] * r["size"] and 0 <= r["times"] <= 3
        s = doc["source"]
        sizes[s] = sizes.get(s, 0) + r["size"]
        taken[s] = taken.get(s, 0) + r["taken"]
        target[s] = r["target"]
    want = reshared(sizes)
    assert sum(target.values()) == pytest.approx(sum(sizes.values()))
    assert any(t == 3 * sizes[s] for s, t in want.items())
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - target[s]) <= max(30, 0.004 * target[s])
    again = mixing.rows(mixing.decide(docs.repartition(7, "text"))).collect()
    key = lambda r: (r["key"], r["taken"])
    assert sorted(map(key, again)) == sorted(map(key, got))


def test_flights_keep_totals_and_probabilities():
    rng, drawn = random.Random(5), np.zeros(40)
    sizes = [rng.randint(1, 50) for _ in range(40)]
    for seed in range(400):
        flight, done = mixing.Flight(str(seed)), []
        for i, size in enumerate(sizes):
            done += flight.add(0.3, size, i)
        left = [(x[2], x[0]) for x in flight.open]
        assert len(left) <= 2 and len(done) + len(left) == 40
        final = dict(done + left)
        assert sum(final.values()) == pytest.approx(12)
        assert sum(sizes[i] * p for i, p in final.items()) == pytest.approx(0.3 * sum(sizes))
        drawn += [final[i] for i in range(40)]
    assert abs(drawn / 400 - 0.3).max() < 0.12


def test_a_small_source_lands_by_itself_beside_a_large_one(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET", 50)
    rng = random.Random(9)
    # The two long documents stay open longest; only other roundings make up for them.
    sizes = [rng.randint(5, 90) for _ in range(208)] + [900, 700]
    docs = [(i, "w " * n, "a" if i < 200 else "b") for i, n in enumerate(sizes)]
    docs = spark.createDataFrame(docs, "doc_id long, text string, source string")
    got = mixing.rows(mixing.decide(docs, weights=(12, 1))).collect()
    small = [r for r in got if r["key"] >= 200]
    rate = small[0]["target"] / small[0]["source_size"]
    assert len(small) == 10 and 0.1 < rate < 0.9
    units = [[rate, r["size"], r["key"]] for r in small]
    best = sum(c * u[1] for c, u in zip(mixing.land(units), units))
    assert abs(sum(r["taken"] for r in small) - small[0]["target"]) == pytest.approx(
        abs(best - small[0]["target"])
    )
    large = [r for r in got if r["key"] < 200]
    assert abs(sum(r["taken"] for r in large) - large[0]["target"]) <= 2


def test_every_level_holds_documents_of_all_sizes_back():
    rows = [[0.3, size, size] for size in range(1, 401)]
    left = [(d, p) for d, p in mixing.fly(rows, "0", False) if 0 < p < 1]
    assert mixing.HELD <= len(left) <= mixing.HELD + 2
    assert min(d for d, _ in left) < 50 and max(d for d, _ in left) > 350


def test_landing_is_the_nearest_rounding():
    left = [[0.5, 10, 0], [0.5, 7, 1], [0.25, 3, 2], [0.75, 1, 3]]
    assert sum(r * x[1] for r, x in zip(mixing.land(left), left)) == 10
    assert mixing.land([]) == []


def test_awkward_rows_and_no_rows(spark):
    docs = awkward(spark)
    rows = mixing.rows(mixing.decide(docs)).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r["times"] for r in rows)
    assert mixing.rows(mixing.decide(empty(spark))).collect() == []
    assert mixing.mixed(empty(spark)).count() == 0
    wordless = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert {r["taken"] for r in mixing.rows(mixing.decide(wordless)).collect()} == {0}
