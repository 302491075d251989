"""Language, quality and toxicity: gradients, exact search, held-out accuracy, awkward rows."""

from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from awkward_rows import awkward, empty, plain
from pyspark.sql import functions as F
from spanwatch.llm import language, quality, toxicity
from spanwatch.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def test_gradients_of_the_network_are_those_of_its_loss():
    net = language.Network.start(["a", "b", "c"], 4, 1)
    net.weights = {k: w.astype(float) for k, w in net.weights.items()}
    data = np.frombuffer(b"abcdefbcaefd", np.uint8).reshape(3, 4)
    target = np.array([0, 2, 1])

    def loss():
        p, _, _ = net.label(data)
        return -np.log(p[:, np.arange(3), target]).mean()

    grads, rng = net.gradients(data, target), np.random.default_rng(0)
    for name, w in net.weights.items():
        for _ in range(5):
            used = data.ravel() if name.endswith("_in") else np.arange(len(w))
            at = (rng.choice(used), *(rng.integers(n) for n in w.shape[1:]))
            kept = w[at]
            w[at] = kept + 1e-4
            up = loss()
            w[at] = kept - 1e-4
            down = loss()
            w[at] = kept
            assert grads[name][at] == pytest.approx((up - down) / 2e-4, rel=0.05, abs=2e-4)


def test_pooling_whole_texts_equals_reading_them_run_by_run():
    net = language.Network.start(["a", "b"], 4, 2)
    text = "One two, three... vier! " * 50 + "x" * 100
    sums, n = np.zeros(2), 0
    for run in language.LETTERS.findall(text.lower()):
        for piece in language.windows(run.encode()):
            p, _, _ = net.label(np.frombuffer(piece, np.uint8)[None])
            sums, n = sums + p.sum(axis=(0, 1)), n + len(piece)
    langs, scores = language.Reader(net, remember=3).pool([text, None, "", "12 !"])
    assert scores[0] == pytest.approx((sums / n).max(), rel=1e-4)
    assert langs[1:] == ["und"] * 3 and scores[1:] == [0.0] * 3


def test_the_machine_adds_all_pairs():
    rng = np.random.default_rng(1)
    n = quality.FEATURES
    machine = quality.Machine(0.3, rng.normal(size=n), rng.normal(size=(n, quality.RANK)))
    index, value, starts = quality.features(["a b b c", "", "d"], [7, None, 1], quality._Buckets())
    got = machine.raw(index, value, starts)
    ends = [*starts[1:], len(index)]
    for k, (b, e) in enumerate(zip(starts, ends, strict=True)):
        i, x = index[b:e], value[b:e]
        pairs = sum(
            machine.factors[i[p]] @ machine.factors[i[q]] * x[p] * x[q]
            for p in range(len(i))
            for q in range(p)
        )
        assert got[k] == pytest.approx(0.3 + machine.linear[i] @ x + pairs)


def tf_idf(texts, examples, strong):
    """Cosines of texts with examples, word by word; `texts` are the corpus."""
    def words(text):
        parts = [w.strip(toxicity.PUNCTUATION) for w in text.lower().split()]
        return {w: parts.count(w) for w in parts if w}

    docs = [words(t) for t in texts]
    seen = {w for t in examples for w in words(t)}

    def unit(counts):
        def weight(w, n):
            df = sum(w in d for d in docs) if w in seen else 1
            return (1 + np.log(n)) * (np.log((1 + len(docs)) / (1 + df)) + 1) * (1 + (w in strong))

        made = {w: weight(w, n) for w, n in counts.items()}
        length = np.sqrt(sum(x * x for x in made.values()))
        return {w: x / length for w, x in made.items()}

    others = [unit(words(t)) for t in examples]
    return np.array([[sum(x * o.get(w, 0) for w, x in unit(d).items()) for o in others] for d in docs])


def gathered(examples):
    found = [
        {t: n for t, n in toxicity.all_terms(text).items() if t[0] != "^"} for _, text, _ in examples
    ]
    table = pa.table(
        {
            "_key": [e[0] for e in examples],
            "_label": [float(e[2]) for e in examples],
            "terms": [[*f] for f in found],
            "counts": [[*f.values()] for f in found],
        }
    )
    return toxicity.Examples.of(table)


def test_neighbours_are_those_of_tf_idf_over_whole_texts():
    rng = np.random.default_rng(4)
    words = [f"w{i}" + ("", ".", "!")[i % 3] for i in range(60)] + ["...", "Bad", "bad,"]
    draw = lambda pool, n: " ".join(rng.choice(pool, rng.integers(1, n)))
    examples = [(i, draw(words, 12), int(rng.random() < 0.4)) for i in range(300)]
    texts = [e[1] for e in examples] + [draw([*words, "x1", "x2"], 30) for _ in range(40)]
    kept = gathered(examples)
    strong = np.array([t == " bad" for t in kept.terms])
    docs = [toxicity.all_terms(t) for t in texts]
    df = np.array([sum(t in d for d in docs) for t in kept.terms], float)
    index = toxicity.build(kept, df, len(texts), strong)
    every = tf_idf(texts, [e[1] for e in examples], {"bad"})
    terms = toxicity.Terms(index.vocabulary)
    near = index.search([index.weigh(*terms.counts(text)) for text in texts], 15)
    for row, (found, sims) in enumerate(near):
        cosines = every[row][index.keys]
        want = np.lexsort((np.arange(len(cosines)), -np.round(cosines, 9)))[:15]
        want = want[np.round(cosines[want], 9) > 0]
        assert found.tolist() == want.tolist()
        assert sims == pytest.approx(cosines[want])


def test_a_query_reads_its_postings_once(monkeypatch):
    examples = [(i, f"w{i % 7} w{i % 11} u{i}", i % 2) for i in range(400)]
    kept = gathered(examples)
    ones = np.ones(len(kept.terms))
    index = toxicity.build(kept, ones, 400, ones > 1)
    terms = toxicity.Terms(index.vocabulary)
    vector = index.weigh(*terms.counts("w1 w3 u5"))
    reads = []
    gather = toxicity._stretches
    monkeypatch.setattr(toxicity, "_stretches", lambda *at: reads.append(at) or gather(*at))
    assert len(list(index.search([vector] * 3, 15))) == 3
    assert len(reads) == 3


def test_a_near_copy_of_an_example_without_telling_words_finds_it_first(spark):
    rng = np.random.default_rng(7)
    texts = [" ".join(rng.choice([f"v{i}" for i in range(3000)], 80)) for _ in range(60)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(100 + i, t + " more") for i, t in enumerate(texts)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 6 == 0)) for i in range(60)], "doc_id long, toxic int")
    index = toxicity.fit(frame.filter("doc_id < 100"), frame, labels)
    near = toxicity.score(frame.filter("doc_id >= 100"), index).collect()
    assert len(near) == 60
    for r in near:
        assert r["evidence"][0]["key"] == str(r["doc_id"] - 100) and r["evidence"][0]["cosine"] > 0.95


def test_toxicity_scores_do_not_depend_on_how_many_labels_are_sampled(spark):
    # Of 600 grim documents 120 are toxic, of 600 calm ones 12, of 300 empty ones 3.
    rows = [(i, ("grim word", "calm word")[i % 2], int(i % (10, 100)[i % 2] < 2)) for i in range(1200)]
    rows += [(1200 + i, "", int(i < 3)) for i in range(300)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    got = []
    for per_class in (4_000, 100):
        index = toxicity.fit(docs, docs, labels, per_class=per_class)
        scored = toxicity.score(docs, index).select("text", "score", "predicted").distinct().collect()
        got.append({r["text"]: r["score"] for r in scored})
        assert not any(r["predicted"] for r in scored)
    assert got[0]["grim word"] == pytest.approx(0.2, abs=0.03)
    for text in got[0]:
        assert got[1][text] == pytest.approx(got[0][text], abs=0.06)


@pytest.mark.parametrize(
    "name, label, fold, rest, least",
    [("op5_quality", "quality", 5, 0, 0.95), ("op10_toxicity", "toxic", 3, 1, 0.95)],
)
def test_held_out_accuracy(spark, name, label, fold, rest, least):
    rows = QUERIES[name](spark, SF).drop("evidence").collect()
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {
        r["doc_id"] for r in rows if crc32(str(r["doc_id"]).encode()) % fold == rest
    }
    known = [(r["predicted"], labels[r["doc_id"]]) for r in held if r["doc_id"] in labels]
    assert sum(p == y for p, y in known) / len(known) >= least


def test_held_out_languages(spark):
    docs = {
        r["doc_id"]: r["lang"]
        for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()
    }
    rows = QUERIES["op3_language_id"](spark, SF).filter("held_out").collect()
    known = [r for r in rows if docs[r["doc_id"]] is not None]
    assert sum(docs[r["doc_id"]] == r["lang_pred"] for r in known) / len(known) >= 0.98


def test_awkward_rows_and_no_rows(spark):
    docs, few = awkward(spark), plain(spark)
    labels = spark.createDataFrame(
        [(1, 1, 0), (2, 0, 1), (2, 1, 1), (7, 1, 0), (99, 0, 0), (None, 1, 1), (4, None, 3)],
        "doc_id long, quality int, toxic int",
    )
    net = language.fit(few)
    named = {r["doc_id"]: r for r in language.predict(docs, net).collect()}
    assert named[3]["lang_pred"] == named[4]["lang_pred"] == named[6]["lang_pred"] == "und"
    assert named[1]["lang_pred"] in ("de", "en") and named[1]["size"] == "x"
    machine = quality.fit(few, labels)
    index = toxicity.fit(few, few, labels)
    for scored in (quality.score(docs, machine), toxicity.score(docs, index)):
        rows = scored.collect()
        assert len(rows) == docs.count()
        assert all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in rows)
        assert all(r["lang_pred"] == "x" for r in rows)
    none, no_labels = empty(spark), labels.filter(F.lit(False))
    assert language.fit(none) is None
    assert quality.fit(few, no_labels) is None
    assert toxicity.fit(few, few, no_labels) is None
    assert {r["lang_pred"] for r in language.predict(few, None).collect()} == {"und"}
    assert {r["score"] for r in quality.score(few, None).collect()} == {0.5}
    assert {r["score"] for r in toxicity.score(few, None).collect()} == {0.0}
    assert language.predict(none, net).count() == 0
    assert quality.score(none, machine).count() == 0
    assert toxicity.score(none, index).count() == 0
