"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Every word of a text has a weight: (1 + log of its count) times its rarity over all documents.
Words that go with a label, by a likelihood ratio that chance would give none of them, weigh
STRENGTH times as much; word beginnings of that kind are terms beside the words.

The examples are postings of an inverted index, ordered by term and example. Lists with an eighth
of the examples or more lie flat, one place for each. A query adds its flat lists up, reads the
postings of its other terms once and takes the k highest sums: the result is exact. Neighbours vote
by squared cosine, and the votes are mapped to probabilities fitted on the examples themselves.
Where a class has more labelled rows than examples, each example counts for its share of them.
"""

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from spanwatch.llm.common import stored, whole_row

# At most so many labelled rows of each class are examples, with at most so many terms of theirs
# together (each counted once a row): this bounds what the driver and a broadcast hold.
EXAMPLES_PER_CLASS = 4_000
MOST_POSTINGS = 6_000_000
# These two have the least leave-one-out loss on examples.
NEIGHBOURS = 25
STRENGTH = 2.0
FLAT_SHARE = 1 / 8
TOGETHER = 64
STEMS = (4, 6)
# A term goes with a label if chance gives none of all terms seen a likelihood ratio as high as
# its own, at this level, and if it is in at least so many examples.
LEVEL = 0.05
LEAST_EXAMPLES = 3
REMEMBERED_WORDS = 500_000
REMEMBERED_TEXTS = 20_000
PUNCTUATION = ".,;:!?()[]{}<>\"'*%&$#|-_/\\=+~`"


def terms_of(word: str) -> tuple[str, ...]:
    """The word without punctuation around it, and its beginnings marked by `^`."""
    word = word.strip(PUNCTUATION)
    # A mark of its own cannot be mistaken for a beginning.
    return (" " + word, *("^" + word[:n] for n in STEMS if len(word) > n)) if word else ()


def all_terms(text: str | None) -> Counter:
    """How often each word and each beginning is in a text."""
    found: Counter = Counter()
    for word, n in Counter((text or "").lower().split()).items():
        for term in terms_of(word):
            found[term] += n
    return found


class Terms(dict):
    """Words as they stand in a text, and the numbers of their terms: from 0 on those of the
    index, -1 for signs alone, below it a number for each word that no example has."""

    def __init__(self, vocabulary: dict[str, int]):
        super().__init__()
        self.vocabulary = vocabulary
        self.others: dict[str, int] = {}
        self.begins: dict[str, list[int]] = {}

    def __missing__(self, word: str) -> int:
        terms = terms_of(word)
        begins = [self.vocabulary[t] for t in terms[1:] if t in self.vocabulary]
        if begins:
            self.begins[word] = begins
        number = -1
        if terms:
            number = self.vocabulary.get(terms[0])
            if number is None:
                number = self.others.setdefault(terms[0], -2 - len(self.others))
        self[word] = number
        return number

    def counts(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the terms of a text, ascending, and how often each occurs."""
        if len(self) > REMEMBERED_WORDS:
            self.clear()
            self.others.clear()
            self.begins.clear()
        words = Counter((text or "").lower().split())
        at = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        n = np.fromiter(words.values(), float, len(words))
        begun = [(t, words[w]) for w in words.keys() & self.begins.keys() for t in self.begins[w]]
        if begun:
            at = np.concatenate([at, [t for t, _ in begun]])
            n = np.concatenate([n, [c for _, c in begun]])
        at, of = np.unique(at, return_inverse=True)
        real = at != -1
        return at[real], np.bincount(of, n, len(at))[real]


@dataclass
class Examples:
    """Labelled texts as their terms: one entry per text and term."""

    keys: list
    labels: np.ndarray
    terms: list[str]
    row: np.ndarray
    term: np.ndarray
    count: np.ndarray

    @staticmethod
    def of(table: pa.Table) -> "Examples":
        """From columns `_key`, `_label`, `terms`, `counts`."""
        terms = table["terms"].combine_chunks()
        coded = terms.flatten().dictionary_encode()
        return Examples(
            table["_key"].to_pylist(),
            table["_label"].to_numpy().astype(float),
            coded.dictionary.to_pylist(),
            np.repeat(np.arange(len(table), dtype=np.int32), terms.value_lengths().to_numpy()),
            coded.indices.to_numpy(),
            table["counts"].combine_chunks().flatten().to_numpy(),
        )


def _stretches(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All positions from each start to its end, and how many each stretch has."""
    lengths = ends - starts
    before = np.cumsum(lengths) - lengths
    return np.arange(lengths.sum()) + np.repeat(starts - before, lengths), lengths


@dataclass
class Index:
    """Postings of the examples' unit vectors, by term."""

    vocabulary: dict[str, int]
    weights: np.ndarray
    # Weight of a word that no example has: as if it were in one document only.
    rare: float
    keys: list
    labels: np.ndarray
    # Postings of term t: from term_at[t] to term_at[t + 1].
    term_at: np.ndarray = field(repr=False)
    example: np.ndarray = field(repr=False)
    value: np.ndarray = field(repr=False)
    # Row of a term among the flat lists, -1 if it has none; these have no postings.
    flat_at: np.ndarray = field(repr=False)
    flat: np.ndarray = field(repr=False)
    # Labelled rows that each example stands for, in units of their mean.
    stands_for: np.ndarray = field(default_factory=lambda: np.zeros(0), repr=False)
    empty_rate: float = 0.0
    cuts: np.ndarray = field(default_factory=lambda: np.zeros(0))
    rates: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def weigh(self, at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Terms and weights of a text's unit vector; words of no example lengthen it only."""
        weight = (1 + np.log(n)) * np.where(at >= 0, self.weights[np.maximum(at, 0)], self.rare)
        weight /= max(np.sqrt(weight @ weight), 1e-12)
        return at[at >= 0], weight[at >= 0]

    def search(
        self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int, leave_out: int | None = None
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The nearest examples of each vector; the flat lists of TOGETHER vectors are added up at
        once. With `leave_out`, vector i is example leave_out + i and does not find itself."""
        for begin in range(0, len(vectors), TOGETHER):
            group = vectors[begin : begin + TOGETHER]
            flat = np.zeros((len(group), len(self.flat)))
            for i, (at, weight) in enumerate(group):
                row = self.flat_at[at]
                flat[i, row[row >= 0]] = weight[row >= 0]
            for i, base in enumerate(flat @ self.flat):
                own = -1 if leave_out is None else leave_out + begin + i
                yield self.nearest(*group[i], base, k, own)

    def nearest(
        self, at: np.ndarray, weight: np.ndarray, base: np.ndarray, k: int, leave_out: int = -1
    ) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of the highest cosine above 0, ties by position; exact. `base` is what
        the flat lists give to each example."""
        if not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0)
        posts, lengths = _stretches(self.term_at[at], self.term_at[at + 1])
        add = self.value[posts] * np.repeat(weight, lengths)
        sim = base + np.bincount(self.example[posts], add, len(base))
        if leave_out >= 0:
            sim[leave_out] = 0
        found = np.flatnonzero(sim > 0)
        near = np.round(sim[found], 9)
        if len(found) > k:
            best = near >= np.partition(near, -k)[-k]
            found, near = found[best], near[best]
        found = found[np.lexsort((found, -near))[:k]]
        return found, sim[found]

    def vote(self, found: np.ndarray, sims: np.ndarray) -> float:
        """Share of label 1 among the neighbours, each weighted by its squared cosine and by
        the labelled rows it stands for."""
        if not len(found):
            return self.empty_rate
        weight = sims * sims * self.stands_for[found]
        return float(weight @ self.labels[found] / weight.sum())

    def calibrated(self, vote: float) -> float:
        if not len(self.cuts):
            return vote
        return float(np.interp(round(vote, 9), self.cuts, self.rates))


def _isotonic(
    votes: np.ndarray, labels: np.ndarray, weights: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Rates that rise with the vote, by pooling adjacent violators; equal votes are one."""
    cuts, at = np.unique(np.round(votes, 9), return_inverse=True)
    sizes = np.bincount(at, weights)
    ones = np.bincount(at, weights * labels)
    pools: list[list[float]] = []  # sums of weighted labels, weights, weighted votes
    for v, y, w in zip(cuts, ones, sizes, strict=True):
        pools.append([float(y), float(w), float(v * w)])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    return (
        np.array([p[2] / p[1] for p in pools]),
        np.array([p[0] / p[1] for p in pools]),
    )


def _telling(examples: DataFrame, sampled: dict[int, int]) -> list[str]:
    """The terms of `examples` that go with one of the labels."""
    n, ones = sum(sampled.values()), sampled.get(1, 0)
    if not 0 < ones < n:
        return []
    seen = stored(
        examples.select("_label", F.explode("terms").alias("term"))
        .groupBy("term")
        .agg(F.count("_label").cast("double").alias("df"), F.sum("_label").alias("a")),
        "toxicity-terms",
    )
    df, a = F.col("df"), F.col("a")

    def part(observed: Column, expected: Column) -> Column:
        return F.when(observed > 0, 2 * observed * F.log(observed * n / expected)).otherwise(0.0)

    ratio = (
        part(a, df * ones)
        + part(df - a, df * (n - ones))
        + part(ones - a, (n - df) * ones)
        + part(n - df - ones + a, (n - df) * (n - ones))
    )
    least = 2 * np.log(max(seen.count(), 1) / LEVEL)
    telling = seen.filter((df >= LEAST_EXAMPLES) & (df < n) & (ratio >= float(least)))
    return sorted(r["term"] for r in telling.select("term").collect())


def sample(
    docs: DataFrame, labels: DataFrame, text: str, label: str, key: str, per_class: int
) -> tuple[Examples, list[str], dict[int, int]]:
    """At most `per_class` labelled documents of either class, chosen by hash, as their terms,
    the terms that go with a label, and how many labelled documents of each class there are.

    Tasks read the whole texts and choose; the driver gets words, telling beginnings and counts. Examples are taken in the order
    of the hash while they have MOST_POSTINGS terms together; one text with more is none.
    """
    known = stored(
        labels.filter(F.col(label).isin(0, 1))
        .groupBy(F.col(key).alias("_key"))
        .agg(F.max(label).alias("_label"))
        .join(docs.select(F.col(key).alias("_key")).distinct(), "_key"),
        "toxicity-labels",
    )
    counted = {int(r["_label"]): r["count"] for r in known.groupBy("_label").count().collect()}
    mixed = F.xxhash64("_key", F.lit("toxicity"))
    parts = [
        known.filter(F.col("_label") == kind).orderBy(mixed, "_key").limit(per_class)
        for kind in (0, 1)
    ]

    @F.pandas_udf("terms array<string>, counts array<int>")
    def split(texts: pd.Series) -> pd.DataFrame:
        found = [all_terms(body) for body in texts]
        return pd.DataFrame({"terms": [[*f] for f in found], "counts": [[*f.values()] for f in found]})

    texts = (
        docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
        .join(F.broadcast(parts[0].unionAll(parts[1])), "_key")
        .groupBy("_key", "_label")
        .agg(F.min("_text").alias("_text"))
    )
    examples = stored(
        texts.select("_key", "_label", split("_text").alias("_f")).select("_key", "_label", "_f.*"),
        "toxicity-examples",
    )
    # At most 2 x per_class narrow rows.
    size = F.size("terms")
    so_far = F.sum("size").over(Window.orderBy(mixed, "_key"))
    kept = (
        examples.select("_key", size.alias("size"))
        .filter(F.col("size") <= MOST_POSTINGS)
        .select("_key", so_far.alias("total"))
        .filter(F.col("total") <= MOST_POSTINGS)
    )
    taken = examples.join(F.broadcast(kept.select("_key")), "_key", "left_semi").withColumn(
        "_label", F.col("_label").cast("double")
    )
    sampled = {int(r["_label"]): r["count"] for r in taken.groupBy("_label").count().collect()}
    telling = _telling(taken, sampled)
    begins = [t for t in telling if t[0] == "^"]
    pairs = F.filter(
        F.arrays_zip("terms", "counts"),
        lambda p: ~p["terms"].startswith("^") | p["terms"].isin(begins),
    )
    table = taken.select("_key", "_label", pairs.alias("p")).select(
        "_key", "_label", "p.terms", "p.counts"
    )
    return Examples.of(table.orderBy("_key").toArrow()), telling, counted


def fit(
    docs: DataFrame,
    corpus: DataFrame,
    labels: DataFrame,
    text: str = "text",
    label: str = "toxic",
    key: str = "doc_id",
    per_class: int = EXAMPLES_PER_CLASS,
    neighbours: int = NEIGHBOURS,
) -> Index | None:
    """Builds the index from labelled `docs`; term rarity is counted over all of `corpus`.

    The examples are bounded by `per_class` and MOST_POSTINGS; all their words are in the index.
    Of rows that repeat a key the least text counts, of its labels the largest. Null texts have
    no terms. None if nothing is labelled or there are no rows.
    """
    examples, telling, counted = sample(docs, labels, text, label, key, per_class)
    if not examples.keys:
        return None
    vocabulary = {t: i for i, t in enumerate(examples.terms)}
    strong = np.zeros(len(vocabulary), bool)
    strong[[vocabulary[t] for t in telling]] = True
    # A worker keeps what it learns of words from task to task: the broadcast is one object there.
    known = corpus.sparkSession.sparkContext.broadcast(Terms(vocabulary))

    def containing(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms, rows = known.value, 0
        total = np.zeros(len(terms.vocabulary), np.int64)
        for batch in batches:
            for body in batch[text]:
                at, _ = terms.counts(body)
                total[at[at >= 0]] += 1
            rows += len(batch)
        hit = np.flatnonzero(total)
        yield pd.DataFrame({"term": [*hit, -1], "docs": [*total[hit], rows]})

    containing_docs = (
        corpus.select(text)
        .mapInPandas(containing, "term long, docs long")
        .groupBy("term")
        .agg(F.sum("docs").alias("docs"))
        .toArrow()
    )
    known.destroy()
    term, n = (containing_docs[c].to_numpy() for c in ("term", "docs"))
    df = np.zeros(len(vocabulary))
    df[term[term >= 0]] = n[term >= 0]
    return build(examples, df, int(n[term < 0].sum()), strong, neighbours, counted)


def build(
    examples: Examples,
    df: np.ndarray,
    n_docs: int,
    strong: np.ndarray,
    neighbours: int = NEIGHBOURS,
    counted: dict[int, int] | None = None,
) -> Index:
    """Lays examples out, like beside like, and calibrates.

    `df` are the documents, of `n_docs`, that have each term. `counted` has the labelled rows of
    each class that the examples were taken from; without it, the examples are all there are.
    """
    sampled = Counter(int(y) for y in examples.labels)
    share = {y: (counted or sampled).get(y, n) / n for y, n in sampled.items()}
    standing = np.array([share[int(y)] for y in examples.labels])
    weights = (np.log((1 + n_docs) / (1 + df)) + 1) * np.where(strong, STRENGTH, 1.0)
    raw = (1 + np.log(examples.count)) * weights[examples.term]
    n = len(examples.keys)
    length = np.sqrt(np.bincount(examples.row, raw * raw, minlength=n))
    value = raw / length[examples.row]

    # Examples with the same strong term lie together, then those with the same common one.
    first_strong, commonest = np.full(n, -1), np.full(n, -1)
    up = np.argsort(df[examples.term], kind="stable")
    commonest[examples.row[up]] = examples.term[up]
    marked = up[strong[examples.term[up]]]
    first_strong[examples.row[marked]] = examples.term[marked]
    full = np.flatnonzero(length > 0)
    place = full[np.lexsort((full, commonest[full], first_strong[full]))]
    position = np.full(n, -1, np.int32)
    position[place] = np.arange(len(place))

    at = position[examples.row]
    order = np.lexsort((at, examples.term))
    term, at, value = examples.term[order], at[order], value[order]
    # A text and its votes are put together again from the postings by example.
    own = np.argsort(at, kind="stable")
    ends = np.searchsorted(at[own], np.arange(len(place) + 1))
    size = np.bincount(term, minlength=len(weights))
    lists = np.flatnonzero(size >= max(len(place) * FLAT_SHARE, 1))
    flat_at = np.full(len(weights), -1, np.int32)
    flat_at[lists] = np.arange(len(lists))
    flat = np.zeros((len(lists), len(place)))
    lying = flat_at[term] >= 0
    flat[flat_at[term[lying]], at[lying]] = value[lying]
    short_term, short_at, short_value = term[~lying], at[~lying], value[~lying]
    index = Index(
        {t: i for i, t in enumerate(examples.terms)},
        weights,
        float(np.log((1 + n_docs) / 2) + 1),
        [examples.keys[i] for i in place],
        examples.labels[place],
        np.searchsorted(short_term, np.arange(len(weights) + 1)),
        short_at.astype(np.int64),
        short_value,
        flat_at,
        flat,
    )
    index.stands_for = standing[place] / standing[place].mean() if len(place) else standing[place]
    empty = np.flatnonzero(length == 0)
    ones = (standing[empty] * examples.labels[empty]).sum()
    index.empty_rate = float(
        (ones + 0.5 * (index.labels.sum() > 0)) / (standing[empty].sum() + 20)
    )
    votes = np.zeros(len(place))
    for begin in range(0, len(place), TOGETHER):
        rows = range(begin, min(begin + TOGETHER, len(place)))
        mine = [own[ends[i] : ends[i + 1]] for i in rows]
        near = index.search([(term[m], value[m]) for m in mine], neighbours, begin)
        votes[rows.start : rows.stop] = [index.vote(*n) for n in near]
    if len(votes) > 1 and 0 < index.labels.sum() < len(votes):
        index.cuts, index.rates = _isotonic(votes, index.labels, index.stands_for)
    return index


def score(
    docs: DataFrame,
    index: Index | None,
    text: str = "text",
    threshold: float = 0.7,
    neighbours: int = NEIGHBOURS,
    evidence: int = 3,
) -> DataFrame:
    """`docs` with `score`, `predicted` (1 from `threshold` on) and `evidence`, replaced if there.

    Evidence is up to `evidence` nearest examples as (key as text, cosine, label); of equally near
    ones the first of the index. A text that shares no term with any example, a null and an empty
    one have none and get the rate of term-free examples. Whole texts are read, however long;
    repeated rows are scored alike. With no index every score is 0. An empty table stays empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast(
        (index, Terms(index.vocabulary if index else {}))
    )

    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model, terms = shared.value
        # Copies share one search; a digest stands for the text.
        known: dict[bytes, tuple[float, list]] = {}

        def judge(found: np.ndarray, sims: np.ndarray) -> tuple[float, list]:
            proof = [
                {"key": str(model.keys[i]), "cosine": float(s), "label": int(model.labels[i])}
                for i, s in zip(found[:evidence], sims[:evidence], strict=True)
            ]
            rate = model.calibrated(model.vote(found, sims)) if len(found) else model.empty_rate
            return min(1.0, max(0.0, rate)), proof

        for texts in batches:
            bodies = ["" if body is None else body for body in texts]
            marks = [blake2b(b.encode("utf-8", "replace"), digest_size=16).digest() for b in bodies]
            if len(known) > REMEMBERED_TEXTS:
                known.clear()
            new = {m: b for m, b in zip(marks, bodies, strict=True) if m not in known}
            if model is None:
                known |= dict.fromkeys(new, (0.0, []))
            else:
                vectors = [model.weigh(*terms.counts(body)) for body in new.values()]
                near = model.search(vectors, neighbours)
                known |= {m: judge(*n) for m, n in zip(new, near, strict=True)}
            results = [known[m] for m in marks]
            yield pd.DataFrame(
                {"score": [r[0] for r in results], "evidence": [r[1] for r in results]}
            )

    shape = "score double, evidence array<struct<key: string, cosine: double, label: int>>"
    scored = F.pandas_udf(apply, shape)
    row = whole_row(docs, "score", "predicted", "evidence")
    return docs.select(row, scored(F.col(text)).alias("_found")).select(
        "_row.*",
        "_found.score",
        (F.col("_found.score") >= threshold).cast("int").alias("predicted"),
        "_found.evidence",
    )
