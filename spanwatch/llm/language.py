"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the UTF-8 bytes of each run of letters forwards and backwards and labels
every byte with a language; the state starts afresh at each run, so equal runs have equal
labels and are computed once. A document's probabilities are the mean over its positions.
The weights are fitted in numpy by backpropagation through time, on a bounded sample.
"""

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from spanwatch.llm.common import whole_row

UNDETERMINED = "und"
LETTERS = re.compile(r"[^\W\d_]+")
# A longer run of letters is cut between characters into windows of at most this many bytes, each
# read by itself.
WINDOW_BYTES = 32
DOCS_PER_LANGUAGE = 400
RUNS_PER_DOC = 40
# Words whose labels a worker remembers; beyond it, it forgets them all and starts again.
REMEMBERED_WORDS = 500_000


def letter_runs(text: str) -> list[str]:
    """The runs of letters in a text. The pattern also takes signs such as a raised two, which
    are numbers; runs with one are cut at it."""
    found = LETTERS.findall(text)
    if all(map(str.isalpha, found)):
        return found
    return ["".join(run) for word in found for is_letter, run in groupby(word, str.isalpha) if is_letter]


def windows(run: bytes) -> list[bytes]:
    found, at = [], 0
    while at < len(run):
        end = min(at + WINDOW_BYTES, len(run))
        while end < len(run) and run[end] & 0xC0 == 0x80:
            end -= 1
        found.append(run[at:end])
        at = end
    return found


def _padded(items: list[bytes]) -> np.ndarray:
    """One row of byte values for each item; all items have the same length."""
    return np.frombuffer(b"".join(items), dtype=np.uint8).reshape(len(items), -1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


@dataclass
class Network:
    """Two GRUs, one for each direction, and a softmax over both their states."""

    languages: list[str]
    weights: dict[str, np.ndarray]

    @classmethod
    def start(cls, languages: list[str], hidden: int, seed: int) -> "Network":
        rng = np.random.default_rng(seed)
        draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        weights = {"out": draw(2 * hidden, len(languages), scale=0.3)}
        weights["bias"] = np.zeros(len(languages), np.float32)
        for way in "fb":
            # The input is a byte, so its product with the weights is a row of a table.
            weights[f"{way}_in"] = draw(256, 3 * hidden, scale=0.3)
            weights[f"{way}_gate"] = draw(hidden, 2 * hidden, scale=hidden**-0.5)
            weights[f"{way}_new"] = draw(hidden, hidden, scale=hidden**-0.5)
        return cls(languages, weights)

    def _read(self, way: str, data: np.ndarray) -> tuple[np.ndarray, list]:
        """States after each byte, (bytes, rows, hidden), and what the way back needs."""
        table, gate, new = (self.weights[f"{way}_{n}"] for n in ("in", "gate", "new"))
        hidden = new.shape[0]
        h = np.zeros((len(data), hidden), np.float32)
        states, trace = np.empty((data.shape[1], len(data), hidden), np.float32), []
        steps = range(data.shape[1]) if way == "f" else range(data.shape[1] - 1, -1, -1)
        for t in steps:
            x = table[data[:, t]]
            zr = _sigmoid(x[:, : 2 * hidden] + h @ gate)
            z, r = zr[:, :hidden], zr[:, hidden:]
            n = np.tanh(x[:, 2 * hidden :] + (r * h) @ new)
            trace.append((t, h, z, r, n))
            h = (1 - z) * n + z * h
            states[t] = h
        return states, trace

    def label(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
        """Probabilities (bytes, rows, languages) at every position."""
        (f, f_trace), (b, b_trace) = self._read("f", data), self._read("b", data)
        both = np.concatenate([f, b], axis=2)
        logits = both @ self.weights["out"] + self.weights["bias"]
        p = np.exp(logits - logits.max(axis=2, keepdims=True))
        return p / p.sum(axis=2, keepdims=True), both, [("f", f_trace), ("b", b_trace)]

    def gradients(self, data: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy over all positions, by backpropagation through time."""
        p, both, traces = self.label(data)
        d_logits = p.copy()
        d_logits[:, np.arange(len(data)), target] -= 1
        d_logits /= data.size
        grads = {
            "out": np.einsum("tnh,tnk->hk", both, d_logits),
            "bias": d_logits.sum(axis=(0, 1)),
        }
        d_both = d_logits @ self.weights["out"].T
        hidden = d_both.shape[2] // 2
        for way, trace in traces:
            gate, new = self.weights[f"{way}_gate"], self.weights[f"{way}_new"]
            d_states = d_both[:, :, :hidden] if way == "f" else d_both[:, :, hidden:]
            g_in = np.zeros((256, 3 * hidden), np.float32)
            g_gate, g_new = np.zeros_like(gate), np.zeros_like(new)
            dh = np.zeros((len(data), hidden), np.float32)
            for t, before, z, r, n in reversed(trace):
                dh = dh + d_states[t]
                dn = dh * (1 - z) * (1 - n * n)
                g_new += (r * before).T @ dn
                d_rh = dn @ new.T
                dz = dh * (before - n) * z * (1 - z)
                dr = d_rh * before * r * (1 - r)
                d_zr = np.concatenate([dz, dr], axis=1)
                g_gate += before.T @ d_zr
                np.add.at(g_in, data[:, t], np.concatenate([d_zr, dn], axis=1))
                dh = dh * z + d_rh * r + d_zr @ gate.T
            grads |= {f"{way}_in": g_in, f"{way}_gate": g_gate, f"{way}_new": g_new}
        return grads


def train(
    runs: list[str], languages: list[str], hidden: int = 12, epochs: int = 6, seed: int = 7
) -> Network:
    """Fits a network to runs of letters and the language of each, with Adam.

    The order of the rows does not matter: they are sorted first, then shuffled by the seed.
    """
    known = sorted(set(languages))
    net = Network.start(known, hidden, seed)
    rows = sorted(
        (piece, known.index(lang))
        for run, lang in zip(runs, languages, strict=True)
        for piece in windows(run.lower().encode())
    )
    rng = np.random.default_rng(seed)
    by_length: dict[int, list[tuple[bytes, int]]] = {}
    for row in rows:
        by_length.setdefault(len(row[0]), []).append(row)
    batches = []
    for group in by_length.values():
        order = rng.permutation(len(group))
        for at in range(0, len(group), 128):
            chosen = [group[i] for i in order[at : at + 128]]
            batches.append((_padded([c[0] for c in chosen]), np.array([c[1] for c in chosen])))
    first = {k: np.zeros_like(w) for k, w in net.weights.items()}
    second = {k: np.zeros_like(w) for k, w in net.weights.items()}
    step, total = 0, epochs * len(batches)
    for _ in range(epochs):
        for at in rng.permutation(len(batches)):
            step += 1
            rate = 0.02 * (1 - step / (total + 1))
            for k, g in net.gradients(*batches[at]).items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                moved = first[k] / (1 - 0.9**step)
                net.weights[k] -= (
                    rate * moved / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                ).astype(np.float32)
    return net


class _Rows(dict):
    """Numbers words as they are met; the new ones wait in `pending`."""

    def __init__(self):
        super().__init__()
        self.pending: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.pending.append(word)
        return number


class Reader:
    """Pools the labels of whole texts, remembering the words it has seen.

    A word is what stands between white space; its runs of letters are what the network reads.
    """

    def __init__(self, net: Network, remember: int = REMEMBERED_WORDS):
        self.net, self.remember = net, remember
        self._forget()

    def _forget(self) -> None:
        self.rows, self.used = _Rows(), 0
        self.sums = np.zeros((4096, len(self.net.languages) + 1), np.float32)

    def _learn(self) -> None:
        """Stores, for each new word, its labels summed over positions and their number."""
        new, self.rows.pending = self.rows.pending, []
        sums = np.zeros((len(new), self.sums.shape[1]))
        pieces: dict[int, tuple[list[int], list[bytes]]] = {}
        for at, word in enumerate(new):
            for run in letter_runs(word):
                for piece in windows(run.encode()):
                    where, what = pieces.setdefault(len(piece), ([], []))
                    where.append(at)
                    what.append(piece)
        for length, (where, what) in pieces.items():
            for begin in range(0, len(what), 2048):
                at = np.array(where[begin : begin + 2048])
                p, _, _ = self.net.label(_padded(what[begin : begin + 2048]))
                for k, column in enumerate(p.sum(axis=0).T):
                    sums[:, k] += np.bincount(at, column, len(new))
                sums[:, -1] += length * np.bincount(at, minlength=len(new))
        while self.used + len(new) > len(self.sums):
            self.sums = np.concatenate([self.sums, np.zeros_like(self.sums)])
        self.sums[self.used : self.used + len(new)] = sums
        self.used += len(new)

    def pool(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        if len(self.rows) > self.remember:
            self._forget()
        found = []
        for text in texts:
            words = text.lower().split() if text else []
            found.append(np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words)))
        if self.rows.pending:
            self._learn()
        langs, scores = [], []
        for rows in found:
            total = self.sums[rows].sum(axis=0, dtype=np.float64)
            if total[-1] == 0:
                langs.append(UNDETERMINED)
                scores.append(0.0)
                continue
            mean = total[:-1] / total[-1]
            best = int(mean.argmax())
            langs.append(self.net.languages[best])
            scores.append(float(min(1.0, mean[best])))
        return langs, scores


_READERS: dict[str, Reader] = {}


def _reader(net: Network, mark: str) -> Reader:
    """A Python worker keeps the reader of the latest network for its next tasks."""
    if mark not in _READERS:
        _READERS.clear()
        _READERS[mark] = Reader(net)
    return _READERS[mark]


def fit(
    labelled: DataFrame,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    docs_per_language: int = DOCS_PER_LANGUAGE,
    runs_per_doc: int = RUNS_PER_DOC,
) -> Network | None:
    """Trains on at most `docs_per_language` documents of each language, `runs_per_doc` runs
    of letters of each; the sample is bounded by these two and by the number of languages.

    Documents are chosen by a hash of their key, runs by a hash spread over the whole text.
    Returns None if no row has both a language and a letter.
    """
    rows = labelled.select(
        F.col(key).alias("_key"), F.col(lang).alias("_lang"), F.col(text).alias("_text")
    ).filter(F.col("_lang").isNotNull() & F.col("_text").rlike(r"\p{L}"))
    draw = F.pmod(F.xxhash64("_key", F.lit("language")), F.lit(1 << 30))
    keys = rows.select("_key", "_lang").distinct().withColumn("_draw", draw)
    # A share of each language first, of about four times what is wanted, so that ranking it
    # takes no more rows however many there are.
    sizes = keys.groupBy("_lang").agg(F.count("*").alias("_n"))
    few = F.col("_draw") < F.lit(float(1 << 30)) * 4 * (docs_per_language + 25) / F.col("_n")
    ranked = Window.partitionBy("_lang").orderBy("_draw", "_key")
    chosen = (
        keys.join(sizes, "_lang")
        .filter(few)
        .withColumn("_rank", F.row_number().over(ranked))
        .filter(F.col("_rank") <= docs_per_language)
        .select(F.col("_key").alias("_chosen"), F.col("_lang").alias("_its"))
    )
    # One text per key, the least if a key is repeated, so that the bound holds for rows too.
    picked = (
        rows.join(
            F.broadcast(chosen),
            F.col("_key").eqNullSafe(F.col("_chosen")) & (F.col("_lang") == F.col("_its")),
        )
        .groupBy("_key", "_lang")
        .agg(F.min("_text").alias("text"))
        .select("text", F.col("_lang").alias("lang"))
    )

    def some(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for body, name in zip(batch["text"], batch["lang"], strict=True):
                runs = letter_runs(body)
                step = max(1, len(runs) // runs_per_doc)
                out += [(run, name) for run in runs[step // 2 :: step][:runs_per_doc]]
            yield pd.DataFrame(out, columns=["run", "lang"])

    sample = picked.mapInPandas(some, "run string, lang string").toPandas()
    if sample.empty:
        return None
    return train(sample["run"].tolist(), sample["lang"].tolist())


def predict(docs: DataFrame, net: Network | None, text: str = "text") -> DataFrame:
    """`docs` with `lang_pred` and `score`, both replaced if they exist.

    A text that is null or has no letter is `und` with score 0, as is every text if there was
    nothing to learn from. Whole texts are read, however long. An empty table stays empty.
    """
    mark = uuid.uuid4().hex

    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        reader = _reader(net, mark) if net else None
        for texts in batches:
            langs, scores = [], []
            for at in range(0, len(texts), 256):
                part = texts.iloc[at : at + 256].tolist()
                nothing = [UNDETERMINED] * len(part), [0.0] * len(part)
                more = reader.pool(part) if reader else nothing
                langs += more[0]
                scores += more[1]
            yield pd.DataFrame({"lang_pred": langs, "score": scores})

    labelled = F.pandas_udf(label, "lang_pred string, score double")
    found = docs.select(
        whole_row(docs, "lang_pred", "score"), labelled(F.col(text)).alias("_found")
    )
    return found.select("_row.*", "_found.lang_pred", "_found.score")
