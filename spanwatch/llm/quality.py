"""Quality scores by a factorisation machine.

Features are hashed words, statistics of the text's structure and its recorded length. The
pairwise interactions have low rank, so a score costs time linear in the features:
the sum over pairs of <v_i, v_j> x_i x_j is half of (sum v_i x_i)^2 - sum (v_i x_i)^2.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from spanwatch.llm.common import whole_row

WORD_BUCKETS = 1 << 15
RANK = 6
# At most so many labelled rows of each class are learned from.
ROWS_PER_CLASS = 3_000
REMEMBERED_WORDS = 500_000
STATISTICS = (
    "length", "recorded_length", "mean_word", "distinct_words", "upper", "digits", "symbols",
    "space", "longest_run", "repeated_lines", "mean_line", "empty",
)
FEATURES = WORD_BUCKETS + len(STATISTICS)


class _Buckets(dict):
    """Words and the buckets they hash to."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED_WORDS:
            self.clear()
        self[word] = bucket = crc32(word) % WORD_BUCKETS
        return bucket


def _statistics(
    body: bytes, hashed: np.ndarray, distinct: int, recorded: float | None
) -> list[float]:
    """`hashed` has the buckets of the words in their order; equal neighbours make a run."""
    n, count = max(len(body), 1), max(len(hashed), 1)
    of_byte = np.bincount(np.frombuffer(body, np.uint8), minlength=256)
    digits, upper = of_byte[48:58].sum(), of_byte[65:91].sum()
    lower, space = of_byte[97:123].sum(), of_byte[9:14].sum() + of_byte[32]
    symbols = of_byte[:128].sum() - digits - upper - lower - space - of_byte[[44, 46]].sum()
    lines = body.split(b"\n")
    changes = np.flatnonzero(np.diff(hashed, prepend=-1, append=-1))
    longest = np.diff(changes).max(initial=0)
    return [
        np.log1p(len(body)) / 12,
        np.log1p(max(recorded or 0, 0)) / 12 if recorded == recorded else 0.0,
        min(n / count, 30) / 30,
        distinct / count,
        upper / n,
        digits / n,
        symbols / n,
        space / n,
        np.log1p(longest) / 5,
        1 - len(set(lines)) / len(lines),
        np.log1p(n / len(lines)) / 12,
        float(not len(hashed)),
    ]


def features(
    texts: list[str | None], recorded: list[float | None], buckets: dict[bytes, int]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Indices and values of the features of all texts, one after another, and their starts.

    Words weigh 1 + log(count), scaled to unit length; statistics follow them.
    """
    index, value, starts, at = [], [], [], 0
    tail = np.arange(WORD_BUCKETS, FEATURES)
    for text, length in zip(texts, recorded, strict=True):
        body = (text or "").encode()
        words = body.lower().split()
        hashed = np.fromiter(map(buckets.__getitem__, words), np.int64, len(words))
        some, counts = np.unique(hashed, return_counts=True)
        weight = 1 + np.log(counts)
        if len(some):
            weight /= np.sqrt((weight * weight).sum())
        index += [some, tail]
        value += [weight, np.array(_statistics(body, hashed, len(some), length))]
        starts.append(at)
        at += len(some) + len(tail)
    return np.concatenate(index), np.concatenate(value), np.array(starts)


@dataclass
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def raw(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray) -> np.ndarray:
        each = self.factors[index] * value[:, None]
        sums = np.add.reduceat(each, starts)
        squares = np.add.reduceat((each * each).sum(axis=1), starts)
        first = np.add.reduceat(self.linear[index] * value, starts)
        return self.bias + first + 0.5 * ((sums * sums).sum(axis=1) - squares)

    def score(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(index, value, starts), -30, 30)))


def train(
    rows: list[tuple[np.ndarray, np.ndarray, int]],
    base_rate: float,
    epochs: int = 12,
    seed: int = 11,
) -> Machine:
    """Fits a machine to (indices, values, label) by AdaGrad on the logistic loss.

    Both classes weigh the same while the factors are fitted; at the end the bias is moved so
    that scores are probabilities under `base_rate`, the share of label 1.
    """
    rng = np.random.default_rng(seed)
    machine = Machine(
        0.0, np.zeros(FEATURES), rng.normal(0, 0.05, (FEATURES, RANK))
    )
    g_linear, g_factors, g_bias = np.full(FEATURES, 1e-6), np.full((FEATURES, RANK), 1e-6), 1e-6
    labels = np.array([r[2] for r in rows], float)
    ones = max(labels.sum(), 1.0)
    weight = np.where(labels == 1, 0.5 * len(rows) / ones, 0.5 * len(rows) / max(len(rows) - ones, 1))
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for begin in range(0, len(rows), 32):
            some = order[begin : begin + 32]
            sizes = np.array([len(rows[i][0]) for i in some])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            index = np.concatenate([rows[i][0] for i in some])
            value = np.concatenate([rows[i][1] for i in some])
            d = (machine.score(index, value, starts) - labels[some]) * weight[some] / len(some)
            each = machine.factors[index] * value[:, None]
            sums = np.repeat(np.add.reduceat(each, starts), sizes, axis=0)
            d_each = np.repeat(d, sizes) * value
            used, back = np.unique(index, return_inverse=True)
            d_linear = np.bincount(back, d_each) + 1e-5 * machine.linear[used]
            d_factors = np.stack(
                [np.bincount(back, (d_each * (sums - each).T[k])) for k in range(RANK)], axis=1
            ) + 1e-4 * machine.factors[used]
            g_linear[used] += d_linear**2
            g_factors[used] += d_factors**2
            g_bias += d.sum() ** 2
            machine.linear[used] -= 0.2 * d_linear / np.sqrt(g_linear[used])
            machine.factors[used] -= 0.05 * d_factors / np.sqrt(g_factors[used])
            machine.bias -= 0.2 * d.sum() / np.sqrt(g_bias)
    rate = min(max(base_rate, 1e-3), 1 - 1e-3)
    machine.bias += np.log(rate / (1 - rate))
    return machine


def fit(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    label: str = "quality",
    key: str = "doc_id",
    recorded_length: str | None = "n_chars",
    rows_per_class: int = ROWS_PER_CLASS,
) -> Machine | None:
    """Learns from at most `rows_per_class` labelled documents of either class, chosen by hash.

    Labels other than 0 and 1 and labels without a document are left out. Several labels of one
    document count as the largest. None if no labelled document is left.
    """
    known = (
        labels.filter(F.col(label).isin(0, 1))
        .groupBy(F.col(key).alias("_key"))
        .agg(F.max(label).alias("_label"))
        .join(docs.select(F.col(key).alias("_key")).distinct(), "_key")
    )
    counts = {r["_label"]: r["count"] for r in known.groupBy("_label").count().collect()}
    if not counts:
        return None
    mixed = F.xxhash64("_key", F.lit("quality"))
    chosen = None
    for kind in (0, 1):
        part = known.filter(F.col("_label") == kind).orderBy(mixed, "_key").limit(rows_per_class)
        chosen = part if chosen is None else chosen.unionAll(part)
    length = F.col(recorded_length).cast("double") if recorded_length else F.lit(None).cast("double")
    picked = (
        docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), length.alias("_length"))
        .join(F.broadcast(chosen), "_key")
        .groupBy("_key", "_label")
        .agg(F.min(F.struct("_text", "_length")).alias("_row"))
        .select("_key", "_label", "_row._text", "_row._length")
    )

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        buckets = _Buckets()
        for batch in batches:
            rows = []
            for body, recorded in zip(batch["_text"], batch["_length"], strict=True):
                index, value, _ = features([body], [recorded], buckets)
                rows.append((index.astype(np.int32), value.astype(np.float32)))
            yield pd.DataFrame(
                {
                    "key": batch["_key"],
                    "label": batch["_label"],
                    "index": [r[0] for r in rows],
                    "value": [r[1] for r in rows],
                }
            )

    key_type = dict(picked.dtypes)["_key"]
    schema = f"key {key_type}, label int, index array<int>, value array<float>"
    sample = picked.mapInPandas(measured, schema).toPandas().sort_values(["key", "label"])
    rows = [
        (np.asarray(i), np.asarray(v, float), int(y))
        for i, v, y in zip(sample["index"], sample["value"], sample["label"], strict=True)
    ]
    return train(rows, counts.get(1, 0) / sum(counts.values()))


_BUCKETS = _Buckets()


def score(
    docs: DataFrame,
    machine: Machine | None,
    text: str = "text",
    recorded_length: str | None = "n_chars",
    threshold: float = 0.3,
) -> DataFrame:
    """`docs` with `score` and `predicted` (1 if the score reaches `threshold`), replaced if there.

    Whole texts are read. A null text is scored as an empty one. With no machine (nothing was
    labelled) every score is 0.5. An empty table stays empty.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(machine)

    def apply(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        fitted = model.value
        for texts, lengths in batches:
            out = []
            for at in range(0, len(texts), 128):
                part, sizes = texts.iloc[at : at + 128], lengths.iloc[at : at + 128]
                if fitted is None:
                    out.append(np.full(len(part), 0.5))
                else:
                    out.append(fitted.score(*features(part.tolist(), sizes.tolist(), _BUCKETS)))
            yield pd.Series(np.concatenate(out) if out else np.zeros(0))

    length = F.col(recorded_length).cast("double") if recorded_length else F.lit(None).cast("double")
    scored = F.pandas_udf(apply, "double")
    found = docs.select(
        whole_row(docs, "score", "predicted"), scored(F.col(text), length).alias("_score")
    )
    predicted = (F.col("_score") >= threshold).cast("int")
    return found.select("_row.*", F.col("_score").alias("score"), predicted.alias("predicted"))
