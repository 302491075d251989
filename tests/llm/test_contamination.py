import random
import re

import pytest
from awkward_rows import LONG, awkward, empty
from spanwatch.llm import contamination


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(text, items):
    own, hit, found = words(text), set(), set()
    for item, body in items:
        theirs = words(body)
        n = min(10, len(theirs))
        windows = {tuple(theirs[i : i + n]) for i in range(len(theirs) - n + 1)} if n else set()
        for at in range(len(own) - n + 1):
            if tuple(own[at : at + n]) in windows:
                hit |= set(range(at, at + n))
                found.add(str(item) if item is not None else "")
    return len(own), len(hit), sorted(found)


@pytest.mark.parametrize("broadcast", [50_000, 0])
def test_equals_every_window_looked_for_everywhere(spark, monkeypatch, broadcast):
    monkeypatch.setattr(contamination, "BROADCAST_ANCHORS", broadcast)
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(12)] + ["É", "é", "K", "K", "İ", "3", "ab-cd", "straße"]
    def draw(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    items = [(i, draw(rng.choice([0, 1, 3, 9, 10, 11, 30]))) for i in range(25)]
    items += [(7, items[6][1]), (None, draw(12)), (50, None), (51, items[6][1])]
    texts = []
    for _ in range(80):
        parts = []
        for _ in range(rng.randint(0, 4)):
            own = (rng.choice(items)[1] or "").split(" ")
            begin = rng.randrange(len(own))
            parts.append(" ".join(own[begin : begin + rng.randint(1, 40)]).upper()[:])
            parts.append(draw(rng.randint(0, 6)))
        texts.append(rng.choice([" ", ". ", "\n"]).join(parts))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: r for r in contamination.scan(docs, bench).collect()}
    for i, text in enumerate(texts):
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["items"]) == brute(text, items), text
    clean = contamination.clean(docs, bench)
    assert {r["doc_id"] for r in clean.collect()} == {i for i in got if not got[i]["n_hit"]}


def test_awkward_rows_and_no_rows(spark):
    docs = awkward(spark)
    items = [(1, "quick brown fox jumps over a lazy dog while seven pale"), (2, None), (3, LONG[:3000])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = contamination.scan(docs, bench).collect()
    want = [(r["doc_id"], *brute(r["text"], items)) for r in docs.select("doc_id", "text").collect()]
    got = [(r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in rows]
    assert sorted(map(str, got)) == sorted(map(str, want))
    clean = contamination.clean(docs, bench)
    assert clean.columns == docs.columns
    assert clean.count() == sum(not w[2] for w in want)
    none = spark.createDataFrame([], "item_id long, text string")
    assert contamination.clean(docs, none).count() == docs.count()
    assert contamination.scan(empty(spark), bench).collect() == []
