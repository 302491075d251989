"""Files of token ids against the tokenizer itself, and read back exactly."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from awkward_rows import DOCS, awkward, empty
from spanwatch.llm import byte_runs, token_files
from spanwatch.llm.queries import QUERIES
from spanwatch.workspace import fresh_folder

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def plainly(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("block", [64, 8 << 20])
def test_ids_are_those_of_the_tokenizer(tokenizer, monkeypatch, block):
    monkeypatch.setattr(byte_runs, "BLOCK_BYTES", block)
    monkeypatch.setattr(token_files, "KNOWN_PIECES", 500)
    rng = random.Random(2)
    letters = list("abcXYZsdt  \n\t\r'',.!?-012<|>éÉßÿİſ«»\x1c\x0b\x85\xa0́中Σ\U0001f600ªµ×\x00")
    words = ["it's", "l'été", "<|endoftext|>", "<|STARTOFTEXT|>", "don't!'s", "we'll", "''s", "J̌"]
    near = list("abcXYZsdt  \n\t''',.!?-012<|éÉßÿſ")
    texts = [None, "", " ", "a" * 3_000, "<|startoftext|>" * 3]
    texts += ["".join(rng.choice(letters + words) for _ in range(rng.randrange(40))) for _ in range(3_000)]
    texts += ["".join(rng.choice(near) for _ in range(rng.randrange(30))) for _ in range(5_000)]
    encoder = token_files.Encoder(tokenizer.to_str(), 2, True)
    for text, ids in zip(texts, encoder.encode(texts)):
        assert ids.tolist() == plainly(tokenizer, text), text


def test_query_is_the_plain_encoding(spark, tokenizer):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id")
    start = 0
    got = QUERIES["op13_token_files"](spark, SF).orderBy("doc_id").collect()
    for (doc_id, text), row in zip(rows.collect(), got, strict=True):
        ids = np.array(plainly(tokenizer, text), "<u4")
        assert tuple(row) == (doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


@pytest.mark.parametrize("by_words", [True, False])
def test_awkward_rows(spark, tokenizer, by_words):
    folder = fresh_folder(spark, "token-files")
    docs = awkward(spark)
    token_files.write(docs, folder, PATH, 2, by_words=by_words)
    rows = sorted(token_files.read(spark, folder).collect(), key=lambda r: r["start"])
    want = [plainly(tokenizer, r["text"]) for r in docs.collect()]
    got = [np.frombuffer(r["ids"], "<u4").tolist() for r in rows]
    assert sorted(got) == sorted(want)
    keys = [r["key"] for r in rows]
    assert keys == sorted(keys, key=lambda k: (k is not None, k))
    assert [r["start"] for r in rows] == [0, *np.cumsum([len(ids) for ids in got])[:-1]]


def test_empty_table(spark):
    folder = fresh_folder(spark, "token-files")
    token_files.write(empty(spark), folder, PATH, 2)
    found = token_files.read(spark, folder)
    assert found.columns == ["key", "start", "ids"] and found.count() == 0


def test_text_keys_and_equal_rows(spark, monkeypatch):
    """A crowd of equal rows is cut into several files; bases are prefix sums over these."""
    folder = fresh_folder(spark, "token-files")
    docs = spark.range(400).select(
        F.when(F.col("id") < 300, "k").otherwise(F.concat(F.lit("p"), "id")).alias("name"),
        F.when(F.col("id") < 300, "same text").otherwise(F.col("id").cast("string")).alias("body"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        token_files.write(docs, folder, PATH, 49_999, key="name", text="body")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spark.read.parquet(f"{folder}/parts").filter("docs < 300").count() >= 3
    rows = sorted(token_files.read(spark, folder).collect(), key=lambda r: r["start"])
    assert [r["key"] for r in rows[:300]] == ["k"] * 300
    lengths = [len(r["ids"]) // 4 for r in rows]
    assert [r["start"] for r in rows] == [0, *np.cumsum(lengths)[:-1]]
    assert all(np.frombuffer(r["ids"], "<u4")[-1] == 49_999 for r in rows)


def test_ids_beyond_16_bits(spark):
    folder = fresh_folder(spark, "token-files")
    docs = spark.createDataFrame([(1, "two words", "en", "a", 9)], DOCS)
    token_files.write(docs, folder, PATH, 70_000)
    assert spark.read.parquet(f"{folder}/parts").first()["unit"] == "<u4"
    assert np.frombuffer(token_files.read(spark, folder).first()["ids"], "<u4")[-1] == 70_000
