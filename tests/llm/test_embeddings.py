import numpy as np
import pytest
from spanwatch.llm import embeddings
from test_simhash import connected


def brute(rows):
    """(links, component) of every row by comparing each with each."""
    units = {}
    for i, (_, v) in enumerate(rows):
        x = None if v is None or None in v else np.array(v, np.float32).astype(float)
        if x is not None and len(x) and np.isfinite(x).all() and x.any():
            units[i] = x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max())
    near = [
        (i, j)
        for i in units
        for j in units
        if i != j and len(units[i]) == len(units[j]) and units[i] @ units[j] >= 0.95
    ]
    groups = connected(near, range(len(rows)))
    least = {}
    for i, g in groups.items():
        if rows[i][0] is not None:
            least[g] = min(least.get(g, rows[i][0]), rows[i][0])
    return [(rows[i][0], sum(a == i for a, _ in near), least.get(groups[i])) for i in range(len(rows))]


def near_copies(n, dim, rng):
    rows = []
    for c in rng.normal(size=(n // 10, dim)):
        for _ in range(10):
            rows.append((c + rng.normal(size=dim) * rng.uniform(0, 0.4)).astype(np.float32).tolist())
    return rows


@pytest.mark.parametrize("cell, chunk", [(1_500, 4_096), (20, 4_096), (60, 7)])
def test_links_equal_brute_force(spark, monkeypatch, cell, chunk):
    monkeypatch.setattr(embeddings, "CELL_VECTORS", cell)
    monkeypatch.setattr(embeddings, "CHUNK", chunk)
    rng = np.random.default_rng(3)
    rows = [(i, v) for i, v in enumerate(near_copies(500, 24, rng))]
    rows += [(1_000 + i, rows[i][1]) for i in range(30)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {r["vec_id"]: r for r in embeddings.near_duplicates(frame).collect()}
    want = brute(rows)
    assert len(got) == len(want)
    links, found = sum(w[1] for w in want), sum(r["n_links"] for r in got.values())
    assert 0.98 * links <= found <= links
    wrong = sum(got[i]["n_links"] != n or got[i]["component_id"] != c for i, n, c in want)
    assert wrong <= 0.02 * len(want) if cell < 100 else wrong == 0
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_the_count_is_calibrated():
    rng = np.random.default_rng(4)
    for of, chance in ((24, 0.95), (8, 0.95), (30, 0.5)):
        c = embeddings.least_count(of, chance)
        assert (rng.binomial(of, chance, 200_000) < c).mean() <= embeddings.MISSED * 1.3
        assert (rng.binomial(of, chance, 200_000) < c + 1).mean() > embeddings.MISSED * 0.7


def test_awkward_vectors(spark):
    one, other = [1.0, 2.0, 3.0], [3.0, -1.0, 0.5]
    rows = [
        (1, one), (2, one), (2, one), (3, [2.0, 4.0, 6.0]), (4, None), (5, []), (6, [0.0, 0.0, 0.0]),
        (7, [1.0, None, 3.0]), (8, [float("nan"), 2.0, 3.0]), (9, [float("inf"), 2.0, 3.0]),
        (10, [1.0, 2.0]), (None, one), (None, other), (11, other), (12, [1e-38, 2e-38, 3e-38]),
        (13, [1e38, 2e38, 3e38]), (None, None), (14, [-1.0, -2.0, -3.0]),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = embeddings.near_duplicates(frame).collect()
    assert sorted(map(str, ((r["vec_id"], r["n_links"], r["component_id"]) for r in got))) == sorted(
        map(str, brute(rows))
    )
    nothing = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embeddings.near_duplicates(nothing).collect() == []
