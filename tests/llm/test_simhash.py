import numpy as np
import pytest
import xxhash
from awkward_rows import awkward, empty, plain
from spanwatch.llm import simhash
from spanwatch.llm.components import components

SF = "/root/testdata/sf0.01"


def slow_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def connected(pairs, nodes=()):
    parent = {n: n for n in nodes}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in parent}


def near(prints, distance=4):
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(prints[i + 1 :] ^ prints[i]) <= distance):
            yield i, i + 1 + int(j)


def clusters():
    """Dense clusters of values, some linked only through others."""
    rng, values = np.random.default_rng(1), []
    for centre in rng.integers(0, 2**63, 40, dtype=np.uint64):
        for _ in range(40):
            value = int(centre)
            for bit in rng.choice(64, rng.integers(0, 6), replace=False):
                value ^= 1 << int(bit)
            values.append(value)
    return np.unique(np.array(values, np.uint64))


def test_groups_of_whole_documents_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: r for r in simhash.groups(docs).collect()}
    rows = docs.select("doc_id", "text").orderBy("doc_id").collect()
    ids = [r["doc_id"] for r in rows]
    prints = np.array([slow_print(r["text"]) for r in rows], np.uint64)
    assert [got[i]["fp"] % 2**64 for i in ids] == prints.tolist()
    want = connected(((ids[i], ids[j]) for i, j in near(prints)), ids)
    assert {i: got[i]["component_id"] for i in ids} == want
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == sorted(
        set(want.values())
    )


@pytest.mark.parametrize(
    "parts, thresholds",
    [(None, None), (2, (2, 1)), (3, (1, 1, 0)), (4, (1, 0, 0, 0)), (3, (2, -1, 1))],
)
def test_any_plan_connects_what_is_near(spark, monkeypatch, parts, thresholds):
    values = clusters()
    if parts:
        masks = [simhash._mask(g) for g in simhash._groups(values, parts)]
        plan = simhash.Plan(tuple(masks), thresholds)
        monkeypatch.setattr(simhash, "plan", lambda *_: plan)
    signed = values.view(np.int64).tolist()
    frame = spark.createDataFrame([(v,) for v in signed], "fp long")
    want = connected((signed[i], signed[j]) for i, j in near(values))
    for chunk in (20_000, 25) if not parts else (20_000,):
        links = simhash.links(frame, chunk=chunk)
        found = [(r["a"], r["b"]) for r in links.collect()]
        assert connected(found) == want
        for a, b in found:
            assert ((a ^ b) % 2**64).bit_count() <= 4
    if not parts:
        assert {r["node"]: r["component"] for r in components(links).collect()} == want


def test_allocation_is_the_cheapest():
    from itertools import product

    rng = np.random.default_rng(2)
    for _ in range(30):
        costs = [[0.0, *rng.uniform(0, 9, 3)] for _ in range(rng.integers(2, 5))]
        every = (
            sum(c[k] for c, k in zip(costs, ks))
            for ks in product(range(4), repeat=len(costs))
            if sum(ks) == 5
        )
        cost, thresholds = simhash.allocate(costs, 5)
        assert cost == pytest.approx(min(every))
        assert sum(t + 1 for t in thresholds) == 5


def test_larger_inputs_get_fewer_partitions():
    sample = clusters()
    sizes = [len(simhash.plan(sample, n).masks) for n in (10**3, 10**7, 10**10)]
    assert sizes == sorted(sizes, reverse=True) and sizes[0] > sizes[-1]


def test_a_chain_and_a_star_settle(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)]
    found = components(spark.createDataFrame(edges + edges[:9], "a long, b long"))
    assert {r["node"]: r["component"] for r in found.collect()} == connected(edges)


def test_awkward_rows_and_no_rows(spark):
    docs = awkward(spark)
    rows = simhash.groups(docs).collect()
    assert len(rows) == docs.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[3]["fp"] == by_id[4]["fp"] == by_id[5]["fp"] == 0
    assert by_id[1]["component_id"] == by_id[2]["component_id"] == 1
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    got = sorted(str(r["doc_id"]) for r in kept.collect())
    assert got == sorted({str(c) for c in connected_ids(rows)})
    assert simhash.groups(empty(spark)).collect() == []
    assert simhash.one_of_each(empty(spark)).count() == 0
    unnamed = plain(spark).selectExpr("cast(null as long) doc_id", "text")
    assert simhash.one_of_each(unnamed).count() == len({r["component"] for r in rows})


def connected_ids(rows):
    return [r["component_id"] for r in rows]
