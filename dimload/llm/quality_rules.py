"""Quality rules: measures of one document, and lines that many documents of a host share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimload.llm.common import WORD, as_rows, back, decided, text_key, words
from dimload.sources.scratch import cut_lineage

SYMBOLS = "#*$%&|<>"
WHITE = r"[\x20\x09-\x0D]+"
#: A line in more distinct documents of one host than this is removed there.
MAX_LINE_DOCS = 10
#: A document keeps at least this share of its words, or it is rejected.
MIN_LEFT = 0.5


def normalised(line: Column) -> Column:
    """Lower case, white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(line), WHITE, " "))


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` and ``lines``,
    the lines with a word; a NULL text counts as empty. Intermediate columns are nested
    in one struct, so a column of the input is only replaced by one of these names."""
    body = F.coalesce(F.col(text), F.lit(""))
    found, windows, at = F.col("__m.found"), F.col("__m.windows"), F.col("__m.at")
    out = docs.withColumn(
        "__m",
        F.struct(
            words(body).alias("found"),
            F.filter(F.split(body, "\n", -1), lambda line: line.rlike(WORD)).alias("lines"),
        ),
    )
    hashes = F.transform(
        F.sequence(F.lit(0), F.size(found) - 3),
        lambda i: F.struct(F.xxhash64(F.get(found, i), F.get(found, i + 1), F.get(found, i + 2)).alias("h"), i.alias("i")),
    )
    out = out.withColumn("__m", F.col("__m").withField("windows", F.when(F.size(found) >= 3, F.sort_array(hashes))))
    same = lambda x, i: F.coalesce(x.h == F.get(windows, i).h, F.lit(False))
    twice = F.filter(windows, lambda x, i: same(x, i - 1) | same(x, i + 1))
    out = out.withColumn("__m", F.col("__m").withField("at", F.sort_array(F.transform(twice, lambda x: x.i))))
    covered = F.transform(at, lambda x, i: F.when(i == 0, 3).otherwise(F.least(F.lit(3), x - F.get(at, i - 1))))
    return out.withColumns(
        {
            "n_words": F.size(found).cast("long"),
            "word_chars": F.length(F.array_join(found, "")).cast("long"),
            "n_symbols": F.length(F.regexp_replace(body, f"[^{SYMBOLS}]+", "")).cast("long"),
            "n_dup_lines": (F.size("__m.lines") - F.size(F.array_distinct("__m.lines"))).cast("long"),
            "n_repeat_words": F.coalesce(F.aggregate(covered, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long"),
            "lines": F.col("__m.lines"),
        }
    ).drop("__m")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


#: More hashes than so many are looked for in one of so many lists.
BUCKETS = 64


def _buckets(by: Column) -> Column:
    """``{bucket: hashes}`` as an array, one list a bucket; of few hashes one list."""
    every = F.flatten(F.map_values(by))
    lists = F.transform(F.sequence(F.lit(0), F.lit(BUCKETS - 1)), lambda b: F.coalesce(by[b], F.array().cast("array<bigint>")))
    return F.when(F.size(every) <= BUCKETS, F.array(every)).otherwise(lists)


def _is_in(h: Column, buckets: Column) -> Column:
    """Whether a hash is in such an array, which is empty where there are no hashes."""
    own = F.get(buckets, F.pmod(h, F.greatest(F.size(buckets), F.lit(1))).cast("int"))
    return F.coalesce(F.array_contains(own, h), F.lit(False))


def judge(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    max_line_docs: int = MAX_LINE_DOCS,
    min_left: float = MIN_LEFT,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, host, text_key``, the measures, ``base_failed``,
    ``removed`` (hashes of the lines to go, in lists by their remainder, see ``_buckets``), ``words_left`` and ``kept``.

    A line is normalised and hashed. Per host the distinct documents that carry it are
    counted; copies of one text are one document. A line above ``max_line_docs`` is
    removed from every document of the host but the one with the smallest
    ``text_key``, so that what copies share is not lost altogether. A document is kept
    if the base rules pass and at least ``min_left`` of its words are left.

    A NULL host is a host; a NULL text is empty (no words, base rules fail); repeated
    rows get the same verdict each; other columns are not looked at; no rows, no rows.

    Counting goes over (host, line, text) first and (host, line) then, so a line of
    a third of all documents is spread before it meets. What is moved are hashes, two
    longs and a host a line, never text.
    """
    rows = measures(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.col(host).alias("host"),
            F.col(text).alias("text"),
            text_key(text).alias("text_key"),
        )
    )
    line = F.transform(
        "lines", lambda x: F.struct(F.xxhash64(normalised(x)).alias("h"), F.size(words(x)).cast("long").alias("w"))
    )
    rows = cut_lineage(rows.withColumn("lines", line).drop("text").withColumn("base_failed", base_failed()))
    content = ["host", "text_key"]
    carried = rows.select(*content, F.explode(F.array_distinct(F.col("lines.h"))).alias("h")).distinct()
    frequent = (
        carried.groupBy("host", "h")
        .agg(F.count("*").alias("n"), F.min("text_key").alias("first"))
        .where(F.col("n") > max_line_docs)
        .select(F.col("host").alias("in_host"), F.col("h").alias("in_h"), "first")
    )
    there = (F.col("h") == F.col("in_h")) & F.col("host").eqNullSafe(F.col("in_host"))
    lost = (
        carried.join(frequent, there)
        .where("text_key != first")
        .groupBy(*content, F.pmod("h", F.lit(BUCKETS)).cast("int").alias("bucket"))
        .agg(F.collect_set("h").alias("some"))
        .groupBy(*content)
        .agg(F.map_from_entries(F.collect_list(F.struct("bucket", "some"))).alias("by"))
        .select(F.col("host").alias("in_host"), F.col("text_key").alias("in_key"), _buckets(F.col("by")).alias("removed"))
    )
    same = (F.col("text_key") == F.col("in_key")) & F.col("host").eqNullSafe(F.col("in_host"))
    out = rows.join(lost, same, "left").withColumn("removed", F.coalesce("removed", F.array().cast("array<array<bigint>>")))
    gone = F.filter("lines", lambda x: _is_in(x.h, F.col("removed")))
    out = out.withColumn("words_left", F.col("n_words") - F.aggregate(gone, F.lit(0).cast("long"), lambda a, x: a + x.w))
    out = out.withColumn("kept", ~F.col("base_failed") & (F.col("words_left") >= min_left * F.col("n_words")))
    return out.drop("lines", "in_host", "in_key")


def without_lines(text: Column, removed: Column) -> Column:
    """The text without the lines whose hash is in ``removed``, see ``judge``."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: ~_is_in(F.xxhash64(normalised(x)), removed))
    return F.when(F.size(removed) == 0, text).otherwise(F.array_join(lines, "\n"))


def clean_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", **limits) -> DataFrame:
    """The rows of ``docs`` that are kept, without the lines to remove; a text that loses none
    stays as it is, one that does gets its new ``n_chars``, if there is such a column."""
    judged = judge(docs, doc_id, text, host, **limits).where(~F.col("kept") | (F.size("removed") > 0))
    keys = [F.col("doc_id").alias("of_id"), F.col("host").alias("of_host"), F.col("text_key").alias("of_key")]
    judged = judged.select(*keys, F.when(F.col("kept"), F.col("removed")).alias("removed"), F.lit(True).alias("judged"))
    judged = cut_lineage(judged.dropDuplicates(["of_id", "of_host", "of_key"]))
    rows = as_rows(docs, text, id=doc_id, at=host)
    same = F.col("id").eqNullSafe(F.col("of_id")) & F.col("at").eqNullSafe(F.col("of_host")) & (F.col("key") == F.col("of_key"))
    width = F.coalesce(F.octet_length("of_host"), F.lit(0)) + 8 * F.coalesce(F.size(F.flatten("removed")) + 2 * F.size("removed"), F.lit(0))
    both = decided(rows, judged, same, "left", width).where("judged is null or removed is not null")
    body = F.col("row")[text]
    return back(both, docs, text, F.when(F.col("removed").isNull(), body).otherwise(without_lines(body, F.col("removed"))))
