"""Benchmark decontamination by a prefix-filtered set join, in DataFrame operations only.

A window is ten consecutive words of a benchmark item. A document that holds a window holds
its rarest word too, so that one word is all of the window's prefix that has to be joined.
Windows of an item that share their rarest word at one place share one anchor. Words of a
document that may be an anchor (a bitmap of the anchors says so, without leaving the row) are
joined with the anchors, and the words around both are compared: a run of equal words that is
as long as a window is a hit. Positions bound the runs at the ends of texts and items.
"""

import string

from pyspark.sql import Column, DataFrame, Window, functions as F

from spanwatch.llm.common import stored, whole_row

WINDOW = 10
# Upper-case letters are in: they are lowered word by word, where it matters.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# An anchor takes below 2 KB; beyond this number they are joined by shuffle.
BROADCAST_ANCHORS = 50_000
MOST_BITS = 1 << 22
# Two longs each: at most 8 MB are broadcast.
BROADCAST_KEYS = 500_000


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def lowered(word: Column) -> Column:
    """A-Z only; other letters stay as they are."""
    return F.translate(word, string.ascii_uppercase, string.ascii_lowercase)


def _bit(word: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(bits)).cast("int")


def _bitmap(words: DataFrame, column: str) -> tuple[Column, int]:
    """Bits of the hashes of the words, at most `MOST_BITS`: a literal of at most 512 KB."""
    count = words.count()
    bits = 1 << 12
    while bits < min(32 * count, MOST_BITS):
        bits *= 2
    bit = _bit(F.col(column), bits)
    parts = (
        words.groupBy(F.shiftright(bit, 6).alias("at"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, pmod(xxhash64({column}), {bits}) & 63)")).alias("b"))
        .collect()
    )
    cells = [0] * (bits // 64)
    for row in parts:
        cells[row["at"]] = row["b"]
    return F.lit(cells).cast("array<bigint>"), bits


def _marked(word: Column, cells: Column, bits: int) -> Column:
    bit = _bit(word, bits)
    cell = F.get(cells, F.shiftright(bit, 6))
    return F.getbit(cell, bit.bitwiseAND(F.lit(63))) == 1


def _places(benchmark: DataFrame, item: str, text: str, window: int) -> DataFrame:
    """Every word of every item with what stands around it; nothing of the size of an item."""
    reach = window - 1
    items = benchmark.select(
        F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"),
        F.transform(words_of(F.col(text)), lowered).alias("words"),
    ).select("item", "words", F.xxhash64("words").alias("body"), F.size("words").alias("length"))
    around = F.transform(
        "words",
        lambda w, i: F.struct(
            i.alias("at"),
            w.alias("word"),
            F.lower(w).alias("token"),
            _before(F.col("words"), i, reach).alias("before"),
            F.slice(F.col("words"), i + 2, F.lit(reach)).alias("after"),
        ),
    )
    # What is taken along with each place is made before, so that the words themselves are not.
    return (
        items.select("item", "body", "length", F.explode(around).alias("place"))
        .select("item", "body", "length", "place.*")
        .distinct()
    )


def anchors(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """Places of items that together lie in every window, the rarest word of each.

    Columns: token (the word, fully lowered), word, item, before (words to the left, nearest
    first) and after, both cut at the window, and need, the length of a hit. Rarity is counted
    over the whole corpus, for words that are the least frequent of some window in the benchmark.
    """
    places = stored(_places(benchmark, item, item_text, window), "places")
    along = Window.partitionBy("item", "body").orderBy("at")
    ahead, behind = along.rowsBetween(0, window - 1), along.rowsBetween(1 - window, 0)
    is_start = F.col("at") <= F.greatest(F.col("length") - window, F.lit(0))
    inside = places.groupBy("token").agg(F.count("*").alias("in_benchmark"))
    ranked = (
        places.join(inside, "token")
        .withColumn("_least", F.when(is_start, F.min("in_benchmark").over(ahead)))
        .withColumn("counted", F.col("in_benchmark") <= F.max("_least").over(behind))
        .drop("_least")
    )
    ranked = stored(ranked, "ranked-places")
    rare = stored(ranked.filter("counted").select("token").distinct(), "rare-words")
    cells, bits = _bitmap(rare, "token")
    corpus = documents.select(words_of(F.col(text)).alias("words")).select(
        F.explode(
            F.filter(F.transform("words", F.lower), lambda w: _marked(w, cells, bits))
        ).alias("token")
    )
    counted = corpus.groupBy("token").agg(F.count("*").alias("in_corpus"))
    rarity = rare.join(counted, "token", "left").select(
        F.col("token"), F.coalesce("in_corpus", F.lit(0)).alias("in_corpus")
    )
    order = F.struct("in_corpus", "in_benchmark", "token", "at")
    best = F.min(F.when(F.col("counted"), order)).over(ahead)
    chosen = (
        ranked.join(rarity, "token", "left")
        .withColumn("_best", F.when(is_start, best))
        .select("item", "body", F.col("_best.at").alias("at"))
        .filter(F.col("at").isNotNull())
        .distinct()
    )
    return ranked.join(chosen, ["item", "body", "at"]).select(
        "token",
        "word",
        "item",
        "before",
        "after",
        F.least(F.col("length"), F.lit(window)).alias("need"),
    )


def _before(words: Column, at: Column, reach: int) -> Column:
    """Up to `reach` words to the left of the 0-based place, the nearest first."""
    begin = F.greatest(at - reach, F.lit(0))
    return F.reverse(F.slice(words, begin + 1, at - begin))


def _equal_run(own: Column, others: Column) -> Column:
    """How many words agree from the first on."""
    same = F.zip_with(own, others, lambda a, b: lowered(a).eqNullSafe(b))
    first = F.array_position(same, False).cast("int")
    return F.when(first == 0, F.size(same)).otherwise(first - 1)


def scan(
    documents: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """One row per document: key, text_hash, n_words, n_hit, items (sorted) and spans of hits.

    `spans` holds (first, last) word positions. An item with fewer words than a window is one
    window. Null and empty texts have no words; items without words and an empty benchmark hit
    nothing. Rows that repeat both id and text stay as many rows. A missing item id is ''.
    """
    spots = stored(anchors(documents, benchmark, text, item, item_text, window), "anchors")
    cells, bits = _bitmap(spots.select("token").distinct(), "token")
    if spots.count() <= BROADCAST_ANCHORS:
        spots = F.broadcast(spots)
    reach = window - 1
    read = documents.select(
        F.col(key).alias("_key"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_hash"),
        words_of(F.col(text)).alias("_words"),
    ).select("*", F.size("_words").cast("long").alias("n_words"))
    places = F.filter(
        F.sequence(F.lit(0), F.size("_words") - 1),
        lambda i: _marked(F.lower(F.get(F.col("_words"), i)), cells, bits),
    )
    # The first entry stands for the document itself and meets no anchor.
    itself = F.struct(
        F.lit(-1).alias("at"),
        F.lit(None).cast("string").alias("word"),
        F.array().cast("array<string>").alias("left"),
        F.array().cast("array<string>").alias("right"),
    )
    around = F.transform(
        F.when(F.size("_words") > 0, places).otherwise(F.array().cast("array<int>")),
        lambda i: F.struct(
            i.alias("at"),
            F.get(F.col("_words"), i).alias("word"),
            _before(F.col("_words"), i, reach).alias("left"),
            F.slice(F.col("_words"), i + 2, F.lit(reach)).alias("right"),
        ),
    )
    found = read.select(
        "_key",
        "_hash",
        "n_words",
        F.explode(F.concat(F.array(itself), around)).alias("_own"),
    ).withColumn("_token", F.lower("_own.word"))
    joined = found.join(spots, found["_token"] == spots["token"], "left")
    left = _equal_run(F.col("_own.left"), F.col("before"))
    right = _equal_run(F.col("_own.right"), F.col("after"))
    hit = (lowered(F.col("_own.word")) == F.col("word")) & (left + right + 1 >= F.col("need"))
    span = F.struct(
        (F.col("_own.at") - left).alias("first"), (F.col("_own.at") + right).alias("last")
    )
    positions = F.flatten(F.transform("spans", lambda s: F.sequence(s["first"], s["last"])))
    return (
        joined.groupBy("_key", "_hash", "n_words")
        .agg(
            F.array_sort(F.collect_set(F.when(hit, span))).alias("spans"),
            F.array_sort(F.collect_set(F.when(hit, F.col("item")))).alias("items"),
            F.count_if(F.col("_own.at") == -1).alias("_rows"),
        )
        .select(
            F.col("_key").alias(key),
            F.col("_hash").alias("text_hash"),
            "n_words",
            F.size(F.array_distinct(positions)).cast("long").alias("n_hit"),
            "items",
            "spans",
            F.explode(F.sequence(F.lit(1), F.col("_rows").cast("int"))).alias("_copy"),
        )
        .drop("_copy")
    )


def clean(documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", **names) -> DataFrame:
    """The documents that hold no window of the benchmark, with all their columns."""
    text = names.get("text", "text")
    hits = scan(documents, benchmark, key, **names).filter("n_hit > 0")
    hits = stored(hits.select(F.col(key).alias("_key"), "text_hash").distinct(), "contaminated")
    if hits.count() <= BROADCAST_KEYS:
        hits = F.broadcast(hits)
    own = documents.select(
        whole_row(documents),
        F.col(key).alias("_own_key"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_own_hash"),
    )
    same = F.col("_own_key").eqNullSafe(F.col("_key")) & (
        F.col("_own_hash") == F.col("text_hash")
    )
    return own.join(hits, same, "left_anti").select("_row.*")
