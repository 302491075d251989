"""Phrases against counts of every word list, whatever the size of blocks and stripes."""

import random
import re
from collections import Counter

import pytest

from awkward_rows import DOCS, awkward, empty
from pyspark.sql import functions as F
from spanwatch.llm import collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plainly(rows, least, percent, most):
    """(lang, rank, phrase, a, l, r, n, score) by counting all lists of words."""
    f = {}
    for text, lang in rows:
        mine = f.setdefault(lang or "und", Counter())
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            mine.update(tuple(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1))
    found = []
    for lang, counts in f.items():
        n = sum(c for g, c in counts.items() if len(g) == 1)
        kept = []
        for g, a in counts.items():
            if len(g) < 2 or a < least:
                continue
            longer = [b for h, b in counts.items() if len(h) == 3 > len(g) and g in (h[:2], h[1:]) and b >= least]
            if any(100 * b >= percent * a for b in longer):
                continue
            cuts = [(10**6 * a * a // (counts[g[:k]] * counts[g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(g).encode(), counts[g[:k]], counts[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:most], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(found)


def some_rows():
    rng = random.Random(11)
    words = ["the", "of", "Éa", "éa", "\x1c", "x\x00", "new", "york", "City", "a", "b"]
    gaps = [" ", "  ", "\t", ", ", ".", "\n", "\x0b", " ! "]
    for i in range(300):
        text = "".join(
            rng.choice(words) + rng.choices(gaps, [40, 2, 2, 3, 1, 1, 1, 1])[0] for _ in range(rng.randrange(40))
        )
        yield text + "New York city " * (i % 4), rng.choice(["en", "en", "en", "fr", None, "und"])
    yield "same " * 500, "en"
    yield from ((None, "en"), ("", None), (" .,\t", "de"))


@pytest.mark.parametrize("broadcast, parts", [(4_000_000, 64), (0, 1)])
def test_phrases_are_those_of_the_counts(spark, monkeypatch, broadcast, parts):
    monkeypatch.setattr(collocations, "RANK_PARTS", parts)
    monkeypatch.setattr(collocations, "BROADCAST_PAIRS", broadcast)
    rows = list(some_rows())
    docs = spark.createDataFrame([(i, t, g, "s", 1) for i, (t, g) in enumerate(rows)], DOCS)
    found = collocations.top(collocations.phrases(docs.repartition(3), least=4), 25)
    got = found.select("grp", "rank", "phrase", "a", "l", "r", "n", "score").collect()
    assert sorted(map(tuple, got)) == plainly(rows, 4, 50, 25)


def test_many_likely_pairs_do_not_shuffle_stripes(spark, monkeypatch):
    monkeypatch.setattr(collocations, "BROADCAST_PAIRS", 0)
    plain, plans = collocations.stored, {}

    def watched(df, purpose):
        plans[purpose] = df._jdf.queryExecution().executedPlan().toString()
        return plain(df, purpose)

    monkeypatch.setattr(collocations, "stored", watched)
    rows = list(some_rows())
    docs = spark.createDataFrame([(i, t, g, "s", 1) for i, (t, g) in enumerate(rows)], DOCS)
    name = "spark.sql.autoBroadcastJoinThreshold"
    was = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        collocations.phrases(docs, least=4)
    finally:
        spark.conf.set(name, was)
    for purpose, joins in (("pairs", 1), ("triples", 2)):
        assert plans[purpose].count("BroadcastHashJoin") == joins
        assert "SortMergeJoin" not in plans[purpose] and "ShuffledHash" not in plans[purpose]


@pytest.mark.parametrize("most, others", [(1 << 29, 100), (1 << 16, 2_000)])
def test_the_sieve_keeps_all_it_was_made_of(spark, monkeypatch, most, others):
    """At its greatest size, of 6 bits a hash here, it lets more of the others through."""
    monkeypatch.setattr(collocations, "MOST_BITS", most)
    hashes = spark.range(30_000).select(F.xxhash64("id").alias("_pair"), "id")
    cells, blocks = collocations._sieve(hashes.filter("id < 10000").select("_pair"), 10_000)
    assert blocks * collocations.BLOCK_BITS <= max(most, 2 * collocations.BLOCK_BITS)
    kept = collocations._passing(hashes, cells, blocks)
    ids = {r["id"] for r in kept.collect()}
    assert ids >= set(range(10_000)) and len(ids) < 10_000 + others


def test_steps_are_stored_without_their_shuffles(spark, monkeypatch):
    """Spark deletes them with each write, and the session's own setting comes back."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    plain, seen, was = collocations.stored, {}, spark.conf.get(name)

    def watched(df, purpose):
        seen[purpose] = spark.conf.get(name)
        if purpose == "triples":
            raise OSError("disk")
        return plain(df, purpose)

    monkeypatch.setattr(collocations, "stored", watched)
    monkeypatch.setattr(collocations, "BROADCAST_PAIRS", 0)
    with pytest.raises(OSError):
        collocations.phrases(awkward(spark), least=2)
    steps = ["stripes", "words", "likely-pairs", "likely-bits", "pairs", "triples"]
    assert seen == dict.fromkeys(steps, "true")
    assert spark.conf.get(name) == was


@pytest.mark.parametrize("entries", [1, 2, 10_000])
def test_stripes_add_up(monkeypatch, entries):
    monkeypatch.setattr(collocations, "STRIPE_ENTRIES", entries)
    monkeypatch.setattr(collocations, "ROWS", 3)
    text = "a b c a b d. a b c, a"
    rows = [r for batch in collocations._stripes("g", [text.encode(), b"a b"]) for r in batch.to_pylist()]
    counts = Counter()
    for row in rows:
        assert len(row["next"]) <= entries and row["total"] == sum(row["n"])
        for word, n in zip(row["next"], row["n"]):
            counts[row["w1"], row["w2"], word] += n
    assert counts == {
        ("a", "b", "c"): 2, ("a", "b", "d"): 1, ("a", "b", None): 1, ("b", "c", "a"): 1, ("b", "c", None): 1,
        ("c", "a", "b"): 1, ("b", "d", None): 1, ("d", None, None): 1, ("c", None, None): 1, ("a", None, None): 1,
        ("b", None, None): 1,
    }


def test_long_counts_are_exact(spark):
    """Products of counts beyond 64 bits."""
    big = 3_000_000_019
    a, part, rest = big, big + 2, big + 1
    row = spark.range(1).select(
        collocations._score(*(collocations.F.lit(v).cast("long") for v in (a, part, rest)))
    ).first()
    assert row[0] == 10**6 * a * a // (part * rest)


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = [(r["text"], r["lang"]) for r in docs.select("text", "lang").collect()]
    found = collocations.top(collocations.phrases(docs, least=2), 2_000)
    got = found.select("grp", "rank", "phrase", "a", "l", "r", "n", "score").collect()
    assert sorted(map(tuple, got)) == plainly(rows, 2, 50, 2_000)
    assert collocations.phrases(empty(spark)).count() == 0
