"""The operators applied to the test tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimload.llm import (
    chat,
    decontamination,
    embeddings,
    html_text,
    language_id,
    mixing,
    packing,
    prefix_trie,
    quality_classifier,
    quality_rules,
    simhash,
    spelling,
    warc,
)
from dimload.llm.common import fold, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return found.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.select("doc_id", "fingerprint", "component_id")


@query
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.words_taken(*mixing.mix(table(spark, sf_dir, "documents")))
    return found.select("doc_id", "size", "source_size", "target", "taken")


@query
def op4_warc_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_archives(spark, written).select(
        F.col("record_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


ORACLE["op4_warc_packages"] = """
SELECT page_id, octet_length(encode(body)) AS payload_bytes, sha256(body) AS payload_digest,
       CASE WHEN octet_length(encode(body)) >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN octet_length(encode(body)) >= 100 AND page_id > first THEN first END AS refers_to
FROM (SELECT page_id, coalesce(html, '') AS body, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
"""


@query
def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.embedding_components(table(spark, sf_dir, "embeddings"), threshold=0.93)


@query
def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = html_text.main_text(pages.select("page_id", "url", "html"), html_text.train(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chat.digests(chat.format_conversations(turns, public_tokenizers.path("byte_bpe_50k.json")))


ORACLE["op7_chat_format"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS alone, regexp_replace(role, '<(\\*)\|', '<\1\\|', 'g') AS er, regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g') AS et FROM t
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(25 + length(er) + length(et))::BIGINT AS formatted_chars
FROM e GROUP BY conv_id, alone
"""


@query
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = quality_classifier.quality_scores(docs, labels, learn=lambda doc_id: fold(doc_id, 5) != 0)
    return found.select(
        "doc_id",
        (fold("doc_id", 5) == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", (fold("doc_id", 4) == 2).alias("held_out")
    )
    models = language_id.train(docs.where("not held_out"))
    found = language_id.identify(docs.select("doc_id", "text", "held_out"), models)
    return found.select("doc_id", "held_out", "language.lang_pred", "language.score", "language.accepted")


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.judge(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "words_left", "kept"
    )


ORACLE["op10_quality_rules"] = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS body,
         coalesce(('0x' || left(md5(text), 15))::BIGINT, -1) AS k,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), win AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM d, unnest(range(1, len(w) - 1)) AS u(i)
), twice AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1
), rep AS (
  SELECT doc_id, count(DISTINCT i + o) AS n FROM twice, unnest([0, 1, 2]) AS u(o) GROUP BY 1
), raw AS (
  SELECT doc_id, source, k, x AS line, trim(regexp_replace(lower(x), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS h,
         len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT doc_id, source, k, unnest(string_split(body, chr(10))) AS x FROM d)
  WHERE regexp_matches(x, '[^\x20\x09-\x0D]')
), dup AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM raw GROUP BY 1
), often AS (
  SELECT source, h, min(k) AS first FROM raw GROUP BY 1, 2 HAVING count(DISTINCT k) > 10
), lost AS (
  SELECT doc_id, sum(n)::BIGINT AS n
  FROM raw JOIN often ON raw.h = often.h AND raw.source IS NOT DISTINCT FROM often.source
  WHERE k <> first GROUP BY 1
), m AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words,
         length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(body, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         coalesce(dup.n, 0)::BIGINT AS n_dup_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
         coalesce(lost.n, 0)::BIGINT AS n_lost
  FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN lost USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       n_words - n_lost AS words_left,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words - n_lost >= 0.5 * n_words AS kept
FROM m
"""


@query
def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.contamination(docs, table(spark, sf_dir, "benchmark"), "c")
    return found.select(
        "doc_id",
        "c.n_words",
        "c.n_hit",
        F.size("c.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("c.items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("c.n_hit") > 0).alias("contaminated"),
    )


ORACLE["op11_decontamination"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), win AS (
  SELECT DISTINCT item, least(len(w), 10) AS k, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS g
  FROM b, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS u(i) WHERE len(w) > 0
), hit AS (
  SELECT r, i, d.k, g
  FROM (SELECT r, i, k, array_to_string(w[i : i + k - 1], ' ') AS g
        FROM d, (SELECT DISTINCT k FROM win), unnest(range(1, len(w) - k + 2)) AS u(i)) AS d
  SEMI JOIN win USING (k, g)
), places AS (
  SELECT r, count(DISTINCT i + o) AS n FROM hit, unnest(range(k)) AS u(o) GROUP BY 1
), items AS (
  SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT r, item FROM hit JOIN win USING (k, g)) GROUP BY 1
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(places.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(places.n, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (r) LEFT JOIN items USING (r)
"""


#: crc32 of the texts ``crc_of.s``, as ``crc.h``.
CRC = r"""crc_table AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS t
  FROM range(256) AS r(i)
), crc_bytes AS (
  SELECT s, list_transform(range(octet_length(encode(s))), lambda i: ('0x' || substr(hex(encode(s)), 2 * i + 1, 2))::BIGINT) AS b FROM crc_of
), crc AS (
  SELECT s, xor(list_reduce(list_prepend(4294967295, b), lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) AS h
  FROM crc_bytes, crc_table
)"""


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.narrow(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(*prefix_trie.branched(turns), ["part", "place"]).drop("node")


ORACLE["op12_prefix_trie"] = (
    """WITH crc_of AS (SELECT DISTINCT conv_id::VARCHAR AS s FROM conversations), """
    + CRC
    + r""", turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(octet_length(encode(role)) || ':' || role || text)) AS place, role, text
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
), own AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY place) AS t FROM turns GROUP BY 1
), whole AS (
  SELECT c.conv_id, coalesce(b.t[1 : h % 9], []) || c.t[h % 9 + 1 :] AS t
  FROM own AS c JOIN crc ON s = c.conv_id::VARCHAR LEFT JOIN own AS b ON b.conv_id = c.conv_id - c.conv_id % 5
), part AS (
  SELECT conv_id, d, len(t) AS n, t[1 : d] AS p FROM whole, unnest(range(len(t) + 1)) AS u(d)
), node AS (
  SELECT p, any_value(d) AS d, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce((count(*) - 1) * octet_length(encode(any_value(p)[-1].text)), 0) AS saves,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256
  FROM part GROUP BY p
), kids AS (
  SELECT p[1 : d - 1] AS p, count(*) AS n FROM node WHERE d > 0 GROUP BY 1
), below AS (
  SELECT p[1 : k] AS p, sum(saves) AS saved, count(*) FILTER (kids.n IS NULL) AS leaves
  FROM (SELECT node.p, d, saves, kids.n FROM node LEFT JOIN kids ON kids.p = node.p) AS kids, unnest(range(d + 1)) AS u(k) GROUP BY 1
)
SELECT node.conv_id, node.d AS depth, above.conv_id AS parent_conv_id, node.n_convs, coalesce(kids.n, 0)::BIGINT AS n_children,
       leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, node.ends_sha256
FROM node JOIN below ON below.p = node.p LEFT JOIN kids ON kids.p = node.p
LEFT JOIN node AS above ON node.d > 0 AND above.p = node.p[1 : node.d - 1]
"""
)


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.vocabulary(table(spark, sf_dir, "documents"), least_length=6, least_count=5, typo_every=199)
    return spelling.spelling_variants(words, times=5)


ORACLE["op13_spelling_variants"] = (
    r"""
WITH RECURSIVE run AS (
  SELECT coalesce(doc_id::VARCHAR, '') || ':' || w AS s, w, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS w FROM documents)
  GROUP BY 1, 2
), crc_of AS (SELECT s FROM run), """
    + CRC
    + r""", words AS (
  SELECT w AS word, sum(n)::BIGINT AS n
  FROM (SELECT CASE WHEN h % 199 = 0 THEN left(w, (h % length(w))::INT) || substr(w, (h % length(w))::INT + 2) ELSE w END AS w, n FROM run JOIN crc USING (s))
  WHERE length(w) >= 6 GROUP BY 1 HAVING sum(n) >= 5
), cut AS (
  SELECT word, n, i, left(word, i) || substr(word, i + 2) AS v FROM words, unnest(range(length(word))) AS u(i)
), near AS (
  SELECT a.word, b.word AS other, b.n FROM cut AS a JOIN cut AS b ON a.v = b.v AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut AS a JOIN words AS b ON a.v = b.word
  UNION SELECT b.word, a.word, a.n FROM cut AS a JOIN words AS b ON a.v = b.word
), best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS other, max(n) AS n FROM near GROUP BY 1
), form AS (
  SELECT words.word, CASE WHEN best.n >= 5 * words.n THEN other END AS form, words.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN best.n >= 5 * words.n THEN best.n END AS form_n
  FROM words LEFT JOIN best USING (word)
), way AS (
  SELECT word, word AS here FROM form
  UNION ALL SELECT way.word, form.form FROM way JOIN form ON form.word = way.here WHERE form.form IS NOT NULL
)
SELECT form.word, form.form, here AS root, form.n, form.n_near, form.form_n
FROM form JOIN way USING (word) JOIN form AS f ON f.word = way.here WHERE f.form IS NULL
"""
)


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
