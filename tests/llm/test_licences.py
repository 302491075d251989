import random

from awkward_rows import awkward, empty
from spanwatch.llm import licences


def brute(text):
    import re
    from collections import Counter

    found = []
    units = dict.fromkeys((text or "").split("\n") + re.split(r"\n[ \t]*\n", text or ""))
    for unit in units:
        words = re.findall(r"[^\W_]+", unit.lower())
        grams = Counter(zip(words, words[1:]))
        best = None
        for licence, template in licences.TEMPLATES:
            others = Counter(tuple(g.split(" ")) for g in licences.template_bigrams(template))
            total = sum(grams.values()) + sum(others.values())
            dice = 2 * sum((grams & others).values()) / total
            if best is None or (-dice, licence) < best:
                best = (-dice, licence)
        if best[0] <= -licences.THRESHOLD:
            found.append((best[0], best[1], unit))
    return sorted(found)


def test_equals_every_template_compared_with_every_unit(spark):
    rng = random.Random(3)
    texts = []
    for _ in range(60):
        lines = []
        for _ in range(rng.randint(1, 5)):
            words = rng.choice(licences.TEMPLATES)[1].split(" ")
            for _ in range(rng.randint(0, 3)):
                words.insert(rng.randrange(len(words) + 1), rng.choice(["the", "new", "License"]))
            if rng.random() < 0.4:
                words = words[rng.randrange(len(words)) :]
            lines.append(" ".join(words))
        texts.append(rng.choice(["\n", "\n\n"]).join(lines))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in licences.scan(docs).collect():
        got = [(round(-n["dice"], 9), n["licence"], n["unit"]) for n in row["notices"]]
        assert got == [(round(d, 9), *rest) for d, *rest in brute(texts[row["doc_id"]])]


def test_awkward_rows_and_no_rows(spark):
    docs = awkward(spark)
    rows = licences.scan(docs).collect()
    assert len(rows) == docs.count()
    assert all(r["notices"] == [] for r in rows)
    assert licences.scan(empty(spark)).collect() == []


def test_bounds_leave_out_no_template_that_could_match():
    for size in range(1, 200):
        low, high = licences.size_bounds(size, 0.75)
        for own in range(1, 600):
            reachable = 2 * min(own, size) / (own + size) >= 0.75
            assert reachable == (low <= own <= high)
