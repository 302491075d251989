"""The pipeline's stages, each against a plain version of what it decides, on small tables."""

import numpy as np
import pytest
from awkward_rows import awkward, empty
from pyspark.sql import functions as F
from test_contamination import brute
from test_simhash import connected, near, slow_print

import corpus_pipeline
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What went into each stage and what came out of it, over whole documents."""
    docs, seen = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF).cache()
        seen[name] = docs, out
        docs = out
    return seen


def ids(frame):
    return sorted(r["doc_id"] for r in frame.select("doc_id").collect())


def test_the_stages_and_their_order():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near_duplicates", "decontamination", "mixing", "sharding"]


def test_all_but_the_last_return_documents(stages):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for name, (_, out) in stages.items():
        assert out.columns[:5] == columns
        assert name == "sharding" or out.columns == columns


def test_language_lets_texts_with_letters_pass(stages):
    before, after = stages["language"]
    lettered = before.filter(F.col("text").rlike(r"\p{L}"))
    assert ids(after) == ids(lettered)


def test_one_of_each_near_duplicate_group_stays(stages):
    before, after = stages["near_duplicates"]
    rows = before.select("doc_id", "text").orderBy("doc_id").collect()
    prints = np.array([slow_print(r["text"]) for r in rows], np.uint64)
    names = [r["doc_id"] for r in rows]
    groups = connected(((names[i], names[j]) for i, j in near(prints)), names)
    assert ids(after) == sorted(set(groups.values()))


def test_documents_with_benchmark_passages_go(spark, stages):
    before, after = stages["decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = [r["doc_id"] for r in before.collect() if not brute(r["text"], items)[1]]
    assert ids(after) == sorted(clean)


def test_the_mix_is_near_its_targets(stages):
    from test_mixing import reshared

    def words(frame):
        counted = frame.groupBy("source").agg(
            F.sum(F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))).alias("n")
        )
        return {r["source"]: r["n"] for r in counted.collect()}

    before, after = stages["mixing"]
    had, got = words(before), words(after)
    for source, target in reshared(had).items():
        assert abs(got.get(source, 0) - target) <= 0.1 * target + 50
    assert after.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3


def test_shards_hold_what_the_mix_took(stages):
    before, after = stages["sharding"]
    assert ids(after) == ids(before)
    rows = after.select("shard", "slot").collect()
    for shard in {r["shard"] for r in rows}:
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_awkward_rows_and_no_rows(spark, tmp_path, monkeypatch):
    for name, docs in (("awkward", awkward(spark)), ("empty", empty(spark))):
        folder = f"{tmp_path}/{name}"
        docs.write.parquet(f"{folder}/documents.parquet")
        spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
        out = corpus_pipeline.run(spark, folder)
        left = {r["doc_id"] for r in out.collect()}
        assert left <= {1, 7, 8, None} and (name == "empty") == (not left)
        assert set(docs.columns) <= set(out.columns)
