"""Phrases of two and three words that stand together more often than their parts would.

Stripes: in every task, a prefix of two words keys the counts of the words that follow it, and
one of the followers is "the piece ends here" (null); a word that ends a piece keys the prefix
(word, null). So the sum of a stripe is how often its prefix occurs, the sum over the stripes of
a first word is how often that word occurs, and the merged entries are the phrases of three
words. A task counts some BLOCK_BYTES of text of a language at once and hands on stripes, not
words. Stripes are merged elementwise in two steps: first their sums; then, of those whose prefix
is frequent enough for any extension to be, the entries.

Nulls: text counts as empty, a missing group is its own under the name `missing`. Repeated rows
all count. Empty tables and texts give no rows. Of a text of any length all words count; what a
task holds is bounded by BLOCK_BYTES or the longest text. Ties in rank go by count, then by the
phrase, so that ranks are the same in every run. Other columns of the input are not looked at.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from spanwatch.llm import byte_runs
from spanwatch.llm.common import stored

BLOCK_BYTES = 16 << 20
# A longer stripe goes on in further rows.
STRIPE_ENTRIES = 10_000
STRIPE = "grp string, w1 string, w2 string, total long, next array<string>, n array<long>"
ROWS = 50_000

# So many hashes of frequent prefixes are broadcast (about 70 bytes each in Spark's relation). More
# set three bits each in a blocked Bloom filter of up to MOST_BITS (64 MB), so that stripes are
# never shuffled to be sifted.
BROADCAST_PAIRS = 100_000
PAIR_BITS = 16
BLOCK_BITS = 1 << 12
MOST_BITS = 1 << 29

# Of the session: a write's shuffles leave the disk when it is done, not when the driver next
# collects its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Rows of a group are ranked in so many parts first, the best of which are ranked together.
RANK_PARTS = 64

WORD, BREAK = 1, 2
KINDS = byte_runs.kinds(WORD, k0=" \t", k2=".,;:!?\n\x0b\x0c\r")
LOWER = bytes(range(256)).lower()


def _stripes(group: str, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
    """The stripes of some texts of one group. Texts are joined by a break."""
    data = b"\n".join(texts).translate(LOWER)
    starts, ends, kind = byte_runs.runs(data, KINDS)
    is_word = kind == WORD
    codes, words = byte_runs.coded(data, starts[is_word], ends[is_word])
    if not len(codes):
        return
    line = np.zeros(len(starts) + 2, np.int64)  # 0 is a break
    line[:-2][is_word] = codes + 1
    at = np.flatnonzero(line)
    second = line[at + 1]
    third = np.where(second > 0, line[at + 2], 0)
    pairs, pair = np.unique(line[at] << 32 | second, return_inverse=True)
    entries, n = np.unique(pair << 32 | third, return_counts=True)
    pair, third = entries >> 32, entries & 0xFFFFFFFF

    names = pa.array([None, *words], pa.binary()).cast(pa.string())
    first_entry = np.searchsorted(pair, pair)
    begins = np.flatnonzero((np.arange(len(pair)) - first_entry) % STRIPE_ENTRIES == 0)
    bounds = np.append(begins, len(pair))
    totals = np.add.reduceat(n, begins)
    for low in range(0, len(begins), ROWS):
        high = min(low + ROWS, len(begins))
        inside = slice(bounds[low], bounds[high])
        offsets = pa.array((bounds[low : high + 1] - bounds[low]).astype(np.int32))
        prefix = pairs[pair[begins[low:high]]]
        yield pa.RecordBatch.from_arrays(
            [
                pa.repeat(pa.scalar(group), high - low),
                names.take(pa.array(prefix >> 32)),
                names.take(pa.array(prefix & 0xFFFFFFFF)),
                pa.array(totals[low:high]),
                pa.ListArray.from_arrays(offsets, names.take(pa.array(third[inside]))),
                pa.ListArray.from_arrays(offsets, pa.array(n[inside])),
            ],
            ["grp", "w1", "w2", "total", "next", "n"],
        )


def stripes(docs: DataFrame, text: str, group: str, missing: str) -> DataFrame:
    """The stripes of all documents, as the tasks have counted them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size = 0
        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                held.setdefault(name, []).append(value.as_buffer().to_pybytes())
                size += len(held[name][-1]) + 1
                if size >= BLOCK_BYTES:
                    for each, texts in held.items():
                        yield from _stripes(each, texts)
                    held, size = {}, 0
        for each, texts in held.items():
            yield from _stripes(each, texts)

    named = F.coalesce(F.col(group).cast("string"), F.lit(missing)).alias("grp")
    raw = F.col(text).cast("string").cast("binary").alias("text")
    return docs.select(named, raw).filter("length(text) > 0").mapInArrow(count, STRIPE)


def _pair(first: str, second: str) -> Column:
    return F.xxhash64("grp", first, second)


def _alone(df: DataFrame, purpose: str) -> DataFrame:
    """`df` stored, without the shuffles it took: together they are several times the input."""
    conf = df.sparkSession.conf
    was = conf.get(SHUFFLE_CLEANUP)
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        return stored(df, purpose)
    finally:
        conf.set(SHUFFLE_CLEANUP, was)


def _block(pair: Column, blocks: int) -> Column:
    """The upper bits of the hash say which block; there are a power of two, at least 2."""
    return F.shiftrightunsigned(pair, 65 - blocks.bit_length()).cast("int")


def _bits(pair: Column) -> list[Column]:
    """Three places in the block, by the lower bits of the hash."""
    last = F.lit(BLOCK_BITS - 1).cast("long")
    return [F.shiftright(pair, at).bitwiseAND(last).cast("int") for at in (0, 12, 24)]


def _sieve(likely: DataFrame, count: int) -> tuple[DataFrame, int]:
    """The Bloom filter of `count` hashes: (block, cells), and how many blocks there are."""
    blocks = 2
    while blocks * BLOCK_BITS < min(PAIR_BITS * count, MOST_BITS):
        blocks *= 2
    pair = F.col("_pair")
    cells = (
        likely.select(
            _block(pair, blocks).alias("_block"), F.explode(F.array(*_bits(pair))).alias("_bit")
        )
        .groupBy("_block", F.shiftright("_bit", 6).alias("_at"))
        .agg(F.expr("bit_or(shiftleft(1L, _bit & 63))").alias("_cell"))
        .groupBy("_block")
        .agg(F.map_from_entries(F.collect_list(F.struct("_at", "_cell"))).alias("_set"))
    )
    every = F.sequence(F.lit(0), F.lit(BLOCK_BITS // 64 - 1))
    full = F.transform(every, lambda at: F.coalesce(F.try_element_at("_set", at), F.lit(0).cast("long")))
    return cells.select("_block", full.alias("_cells")), blocks


def _passing(rows: DataFrame, cells: DataFrame, blocks: int) -> DataFrame:
    """The rows whose `_pair` may be one of those that the filter was made of."""
    pair = F.col("_pair")
    may_be = _block(pair, blocks) == F.col("_block")
    for bit in _bits(pair):
        cell = F.get("_cells", F.shiftright(bit, 6))
        may_be &= F.getbit(cell, bit.bitwiseAND(F.lit(63))) == 1
    return rows.join(F.broadcast(cells), may_be, "left_semi")


def _counted(rows: DataFrame, words: list[str], n: str, name: str, least: int) -> DataFrame:
    """How often each phrase occurs, if `least` times. Words hold no space, so that a phrase and
    its group travel as one string and come apart again."""
    size = len(words)
    parts = F.split("_phrase", " ", size + 1)
    return (
        rows.groupBy(F.concat_ws(" ", *words, "grp").alias("_phrase"))
        .agg(F.sum(n).alias(name))
        .filter(F.col(name) >= least)
        .select(
            parts[size].alias("grp"), *[parts[i].alias(w) for i, w in enumerate(words)], name
        )
    )


def _score(a: Column, part: Column, rest: Column) -> Column:
    """floor(1 000 000 a a / (part rest)) in whole numbers of up to 38 digits."""
    wide = [c.cast("decimal(19,0)") for c in (a, part, rest)]
    return F.call_function(
        "div", F.lit(1_000_000).cast("decimal(7,0)") * wide[0] * wide[0], wide[1] * wide[2]
    )


def phrases(
    docs: DataFrame,
    text: str = "text",
    group: str = "lang",
    missing: str = "und",
    least: int = 10,
    subsumed_percent: int = 50,
) -> DataFrame:
    """(grp, phrase, a, l, r, n, score) of every candidate that no longer one stands for."""
    found = _alone(stripes(docs, text, group, missing), "stripes")
    words = _alone(found.groupBy("grp", "w1").agg(F.sum("total").alias("f")), "words")
    # Sums by a hash of the prefix are at least those of each prefix, so nothing frequent is
    # missed; the few that only share a hash with others fall when words are counted.
    likely = _alone(
        found.filter(F.col("w2").isNotNull())
        .groupBy(_pair("w1", "w2").alias("_pair"))
        .agg(F.sum("total").alias("f"))
        .filter(F.col("f") >= least)
        .select("_pair"),
        "likely-pairs",
    )
    count = likely.count()
    if count > BROADCAST_PAIRS:
        # Like the sums by hash, it can only let more through.
        cells, blocks = _sieve(likely, count)
        cells = _alone(cells, "likely-bits")

    def sifted(df: DataFrame, first: str, second: str) -> DataFrame:
        df = df.withColumn("_pair", _pair(first, second))
        if count <= BROADCAST_PAIRS:
            return df.join(F.broadcast(likely), "_pair", "left_semi")
        return _passing(df, cells, blocks)

    kept = sifted(found, "w1", "w2")
    pairs = _alone(
        _counted(kept.filter(F.col("w2").isNotNull()), ["w1", "w2"], "total", "f", least), "pairs"
    )
    # A phrase of three words is no more frequent than the two pairs in it.
    extended = kept.select(
        "grp", "w1", "w2", F.inline(F.arrays_zip(F.col("next").alias("w3"), "n"))
    ).filter(F.col("w3").isNotNull())
    extended = sifted(extended, "w2", "w3")
    triples = _alone(_counted(extended, ["w1", "w2", "w3"], "n", "a", least), "triples")
    frequent = words.filter(F.col("f") >= least)

    def f(name: str, *keys: str) -> DataFrame:
        """How often a word or pair occurs, under `name`, beside the columns it is found by."""
        source = frequent if len(keys) == 1 else pairs
        own = dict(zip(("w1", "w2"), keys))
        return source.select(
            "grp", *[F.col(a).alias(b) for a, b in own.items()], F.col("f").alias(name)
        )

    inside = (
        triples.select("grp", F.inline(F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2")))), "a")
        .groupBy("grp", "w1", "w2")
        .agg(F.max("a").alias("_longer"))
    )
    twos = (
        pairs.withColumnRenamed("f", "a")
        .join(inside, ["grp", "w1", "w2"], "left")
        .filter(F.coalesce(100 * F.col("_longer") < subsumed_percent * F.col("a"), F.lit(True)))
        .join(f("l", "w1"), ["grp", "w1"])
        .join(f("r", "w2"), ["grp", "w2"])
        .withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))
        .select("grp", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", "score")
    )

    def cut(k: int, part: str, rest: str) -> Column:
        score = _score(F.col("a"), F.col(part), F.col(rest))
        return F.struct(
            score.alias("score"), F.lit(k).alias("k"), F.col(part).alias("l"), F.col(rest).alias("r")
        )

    threes = (
        triples.join(f("_12", "w1", "w2"), ["grp", "w1", "w2"])
        .join(f("_23", "w2", "w3"), ["grp", "w2", "w3"])
        .join(f("_1", "w1"), ["grp", "w1"])
        .join(f("_3", "w3"), ["grp", "w3"])
        .withColumn("_cut", F.least(cut(1, "_1", "_23"), cut(2, "_12", "_3")))
        .select(
            "grp",
            F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"),
            "a",
            "_cut.l",
            "_cut.r",
            "_cut.score",
        )
    )
    totals = words.groupBy("grp").agg(F.sum("f").alias("n"))
    return twos.unionByName(threes).join(totals, "grp")


def top(found: DataFrame, most: int) -> DataFrame:
    """The first `most` phrases of each group by score, count and phrase, with `rank` from 1."""
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    first = F.row_number().over(Window.partitionBy("grp", "_part").orderBy(*order))
    rank = F.row_number().over(Window.partitionBy("grp").orderBy(*order))
    return (
        found.withColumn("_part", part)
        .withColumn("_first", first)
        .filter(F.col("_first") <= most)
        .drop("_part", "_first")
        .withColumn("rank", rank.cast("long"))
        .filter(F.col("rank") <= most)
    )
