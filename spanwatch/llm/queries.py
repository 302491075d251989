"""One query for each operator of this folder, over its whole table, with production settings."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from spanwatch.llm import (
    collocations,
    contamination,
    embeddings,
    fill_middle,
    html_text,
    language,
    licences,
    mixing,
    quality,
    sharding,
    simhash,
    token_files,
    toxicity,
)
from spanwatch.llm.common import fold, stored, table
from spanwatch.workspace import fresh_folder


def op1_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence notices of every document: the best one, their number, all licences."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licences.scan(docs).select(
        "doc_id",
        F.get("notices.licence", F.lit(0)).alias("licence"),
        F.get("notices.dice", F.lit(0)).alias("dice"),
        F.size("notices").cast("long").alias("n_notices"),
        F.array_join(F.array_sort(F.array_distinct("notices.licence")), ",").alias("licences"),
    )


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page, with weights learned from pages that mark theirs up."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages, html_text.fit(pages)).drop("html")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the folds that are not held out."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold("doc_id", 5) == 0)
    net = language.fit(docs.filter(~F.col("held_out")).select("doc_id", "text", "lang"))
    return language.predict(docs.select("doc_id", "held_out", "text"), net).drop("text")


def op4_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The links and the component of every vector."""
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document, learned from the folds that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    docs = docs.withColumn("held_out", fold("doc_id", 5) == 0)
    machine = quality.fit(docs.filter(~F.col("held_out")), table(spark, sf_dir, "labels"))
    return quality.score(docs, machine).select("doc_id", "held_out", "score", "predicted")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document."""
    found = mixing.rows(mixing.decide(table(spark, sf_dir, "documents")))
    return found.select(
        F.col("key").alias("doc_id"), "size", "source_size", "target", "taken"
    )


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark words in every document, and the items that they come from."""
    found = contamination.scan(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard and the place in it of every document; shards hold near equal bytes.

    The documents are laid out in old shards, the shards that change are written anew with all
    that the documents hold, and the rows are what their files then say.
    """
    docs = table(spark, sf_dir, "documents")
    text = F.col("text")
    old, new = fresh_folder(spark, "old-shards"), fresh_folder(spark, "new-shards")
    files = sharding.lay_out(
        docs, sharding.old_shard(sharding.group_of(text)), sharding.size_of(text), old
    )
    rows = sharding.laid_out(spark, old, docs.schema, "old_shard").select(
        "*", sharding.size_of(text).alias("size"), sharding.group_of(text).alias("text_group")
    )
    placed, _ = sharding.place(
        rows, "doc_id", "size", "text_group", "old_shard", in_order=True
    )
    folders = sharding.rewrite(spark, placed, "old_shard", files, new, in_order=True)
    # A shard that keeps its files has places by the same plan.
    kept = [s for s, folder in folders.items() if folder == files.get(s)]
    found = placed.filter(F.col("shard").isin(kept))
    if written := [folder for s, folder in sorted(folders.items()) if s not in kept]:
        found = spark.read.schema(placed.schema).parquet(*written).unionByName(found)
    return found.select(
        "doc_id",
        sharding.size_of(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint of every document and the smallest id of its group."""
    return simhash.groups(table(spark, sf_dir, "documents")).select(
        "doc_id", simhash.hex_text(F.col("fp")).alias("fingerprint"), "component_id"
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every document, learned from the folds that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("held_out", fold("doc_id", 3) == 1)
    index = toxicity.fit(
        docs.filter(~F.col("held_out")), docs, table(spark, sf_dir, "labels")
    )
    nearest = F.transform(
        "evidence",
        lambda e: F.struct(e["key"].cast("long").alias("doc_id"), e["cosine"], e["label"]),
    )
    return toxicity.score(docs, index).select(
        "doc_id", "held_out", "score", "predicted", nearest.alias("evidence")
    )


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut for fill-in-the-middle, and rebuilt from the output."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = fill_middle.transform(docs)
    restored = fill_middle.restore(F.col("output"), F.col("form"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored, 256).alias("restored_sha256"),
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2 000 strongest phrases of two and three words of every language."""
    found = collocations.phrases(table(spark, sf_dir, "documents").select("lang", "text"))
    return collocations.top(found, 2_000).select(
        F.col("grp").alias("lang"), "rank", "phrase", "a", "l", "r", "n", "score"
    )


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token ids of every document, written to flat files and read back from them."""
    folder = fresh_folder(spark, "token-files")
    token_files.write(
        table(spark, sf_dir, "documents"),
        folder,
        public_tokenizers.path("word_bpe_49k.json"),
        end_id=2,
        by_words=True,
    )
    return token_files.read(spark, folder).select(
        F.col("key").alias("doc_id"),
        "start",
        F.floor(F.length("ids") / 4).alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


QUERIES = {
    "op1_licences": op1_licences,
    "op2_html_text": op2_html_text,
    "op3_language_id": op3_language_id,
    "op4_embeddings": op4_embeddings,
    "op5_quality": op5_quality,
    "op6_mixing": op6_mixing,
    "op7_decontamination": op7_decontamination,
    "op8_sharding": op8_sharding,
    "op9_simhash": op9_simhash,
    "op10_toxicity": op10_toxicity,
    "op11_fill_middle": op11_fill_middle,
    "op12_collocations": op12_collocations,
    "op13_token_files": op13_token_files,
}
# Words of an item or a document, A-Z lowered.
_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

_TEMPLATE_GRAMS = ", ".join(
    f"({n}, '{licence}', {len(grams)}, {low}, {high}, '{gram}', {grams.count(gram)})"
    for n, (licence, text) in enumerate(licences.TEMPLATES)
    for grams in [licences.template_bigrams(text)]
    for low, high in [licences.size_bounds(len(grams), licences.THRESHOLD)]
    for gram in sorted(set(grams))
)

ORACLE: dict[str, str] = {
    "op1_licences": f"""
WITH templates (t, licence, size, low, high, gram, n) AS (VALUES {_TEMPLATE_GRAMS}
), docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), units AS (
    SELECT DISTINCT r, unnest(list_concat(string_split(text, chr(10)),
        regexp_split_to_array(text, '\\n[ \\t]*\\n'))) AS unit FROM docs
), words AS (
    SELECT r, unit, regexp_extract_all(lower(unit), '[\\p{{L}}\\p{{N}}]+') AS words FROM units
), grams AS (
    SELECT r, unit, size, gram, count(*) AS n FROM (
        SELECT r, unit, len(words) - 1 AS size,
            unnest([words[i] || ' ' || words[i + 1] FOR i IN range(1, len(words))]) AS gram
        FROM words)
    GROUP BY ALL
), dices AS (
    SELECT r, unit, t, licence,
        2.0::DOUBLE * sum(least(g.n, t.n)) / (any_value(g.size) + any_value(t.size)) AS dice
    FROM grams g JOIN templates t ON g.gram = t.gram AND g.size BETWEEN t.low AND t.high
    GROUP BY r, unit, t, licence
), best AS (
    SELECT r, unit, licence, dice FROM dices WHERE dice >= {licences.THRESHOLD}
    QUALIFY row_number() OVER (PARTITION BY r, unit ORDER BY dice DESC, licence) = 1
), found AS (
    SELECT r, first(licence ORDER BY dice DESC, licence) AS licence, max(dice) AS dice,
        count(*) AS n_notices, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences
    FROM best GROUP BY r
)
SELECT doc_id, licence, dice, coalesce(n_notices, 0) AS n_notices,
    coalesce(licences, '') AS licences
FROM docs LEFT JOIN found USING (r)
""",
    "op7_decontamination": f"""
WITH items AS (
    SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS words FROM benchmark
), windows AS (
    SELECT item, least(len(words), 10) AS n,
        unnest([array_to_string(words[i : i + 9], ' ')
                FOR i IN range(1, greatest(len(words) - 9, 1) + 1)]) AS gram
    FROM items WHERE len(words) > 0
), docs AS (
    SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents
), lengths AS (SELECT DISTINCT n FROM windows
), places AS (
    SELECT r, n, unnest(range(1, len(words) - n + 2)) AS p, words
    FROM docs, lengths WHERE len(words) >= n
), grams AS (
    SELECT r, n, p, array_to_string(words[p : p + n - 1], ' ') AS gram FROM places
), hits AS (
    SELECT r, p, g.n, item FROM grams g JOIN windows w ON g.n = w.n AND g.gram = w.gram
), covered AS (
    SELECT r, count(DISTINCT pos) AS n_hit
    FROM (SELECT r, unnest(range(p, p + n)) AS pos FROM hits) GROUP BY r
), found AS (
    SELECT r, count(DISTINCT item) AS n_items,
        sha256(string_agg(DISTINCT item, ',' ORDER BY item)) AS items_sha256
    FROM hits GROUP BY r
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN found USING (r)
""",
    "op11_fill_middle": """
WITH docs AS (
    SELECT doc_id, coalesce(text, '') AS text,
        sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex FROM documents
), units AS (
    SELECT *, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS units,
        [CAST('0x' || hex[8 * i + 1 : 8 * i + 8] AS BIGINT) FOR i IN range(4)] AS h FROM docs
), cuts AS (
    SELECT *, len(units) AS n, least(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) AS a,
        greatest(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) AS b,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
                OR contains(text, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
            WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM units
), parts AS (
    SELECT *, array_to_string(units[1 : a], '') AS p, array_to_string(units[a + 1 : b], '') AS m,
        array_to_string(units[b + 1 :], '') AS s FROM cuts
)
SELECT doc_id, n, form,
    CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text
        WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM parts
""",
    "op12_collocations": r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
    SELECT lang, k, unnest([array_to_string(w[i : i + k - 1], ' ')
        FOR i IN range(1, len(w) - k + 2)]) AS phrase
    FROM words, (VALUES (1), (2), (3)) AS sizes (k)
), f AS (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL
), totals AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang
), candidates AS (
    SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND a >= 10
), cuts AS (
    SELECT lang, k, phrase, a, w, c, array_to_string(w[1 : c], ' ') AS first,
        array_to_string(w[c + 1 :], ' ') AS rest
    FROM candidates, (VALUES (1), (2)) AS cut (c) WHERE c < k
), scored AS (
    SELECT x.lang, x.k, x.phrase, x.a, l.a AS l, r.a AS r,
        1000000::HUGEINT * x.a * x.a // (l.a::HUGEINT * r.a) AS score
    FROM cuts x JOIN f l ON l.lang = x.lang AND l.phrase = x.first AND l.k = x.c
        JOIN f r ON r.lang = x.lang AND r.phrase = x.rest AND r.k = x.k - x.c
    QUALIFY row_number() OVER (PARTITION BY x.lang, x.phrase ORDER BY score, x.c) = 1
), longer AS (
    SELECT lang, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase, a
    FROM candidates WHERE k = 3
), standing AS (
    SELECT s.* FROM scored s LEFT JOIN (
        SELECT lang, phrase, max(a) AS most FROM longer GROUP BY ALL) m
        ON m.lang = s.lang AND m.phrase = s.phrase
    WHERE m.most IS NULL OR 100 * m.most < 50 * s.a
)
SELECT lang, row_number() OVER (
        PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
    phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM standing JOIN totals USING (lang) QUALIFY rank <= 2000
""",
}
