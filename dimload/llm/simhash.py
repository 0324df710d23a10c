"""SimHash near-duplicates: fingerprints, links at a few differing bits, components."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimload.llm.common import as_rows, back, decided, hand_back, text_key, utf8
from dimload.llm.components import connected_components
from dimload.sources.scratch import cut_lineage

SEED = 42
#: A bucket with more distinct fingerprints than this is cut further before its pairs are compared.
LARGEST_BUCKET = 256
#: Fingerprints of a task that are indexed under their 64 variants.
FAN_OUT = 16_000


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The 64-bit SimHash of one text: bytes a-z for A-Z, words, shingles with repeats."""
    found = text.lower().split()  # on bytes: A-Z only, and the six ASCII white-space characters
    if not found:
        return 0
    line = b" ".join(found)
    if len(found) <= shingle:
        hashes = [xxhash.xxh64_intdigest(line, SEED)]
    else:
        length = np.fromiter(map(len, found), np.int64, len(found))
        end = np.cumsum(length + 1) - 1
        start = (end - length)[: len(found) - shingle + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[s:e], SEED) for s, e in zip(start, end[shingle - 1 :].tolist())]
    bits = np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1)
    n = len(bits)
    whole = n // 255 * 255  # 255 ones fit a byte
    ones = bits[:whole].reshape(-1, 255, 64).sum(1, dtype=np.uint8).sum(0, dtype=np.int64)
    ones += bits[whole:].sum(0, dtype=np.uint8)
    return int(np.packbits(2 * ones > n).view(">i8")[0])


def fingerprint_udf(shingle: int = 3):
    """A column function from the bytes of a text to its fingerprint as a long."""

    @F.pandas_udf("long")
    def simhash(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([fingerprint(x or b"", shingle) for x in batch], dtype="int64")
        hand_back()

    return simhash


def _variants(bits, places: list[tuple[int, int]]):
    """One-wildcard variants of segments ``(lowest bit, width)``: which segment and which of
    its bits is left out in the upper part, the segment without that bit in the lower."""
    made = []
    for segment, (low, width) in enumerate(places):
        value = F.shiftrightunsigned(bits, low).bitwiseAND(F.lit((1 << width) - 1))
        for i in range(width):
            tag = (segment * width + i) << 32
            made.append(value.bitwiseAND(F.lit(((1 << width) - 1) ^ (1 << i))).bitwiseOR(F.lit(tag)))
    return F.array(*made)


def _segments(low: int, width: int) -> list[tuple[int, int]]:
    return [(low, width // 2), (low + width // 2, width // 2)]


def _pairs(rows: DataFrame, keys: list[str], max_bits: int) -> DataFrame:
    """Verified pairs within buckets of bounded size. Fingerprints with an equal segment
    share all its variants; they are taken from the first."""
    left, right = rows.select(*keys, F.col("fp").alias("a")), rows.select(*keys, F.col("fp").alias("b"))
    differing = F.col("a").bitwiseXOR(F.col("b"))
    tag = F.shiftrightunsigned("key", 32)
    segment = F.when(tag < 32, differing).otherwise(F.shiftrightunsigned(differing, 32))
    once = (segment.bitwiseAND(F.lit(0xFFFFFFFF)) != 0) | (tag % 32 == 0)
    close = (F.col("a") < F.col("b")) & (F.bit_count(differing) <= max_bits) & once
    return left.join(right.hint("merge"), keys).where(close).select("a", "b")


def fingerprint_links(fingerprints: DataFrame, max_bits: int = 2, largest: int = LARGEST_BUCKET) -> DataFrame:
    """All pairs ``(a, b)``, a < b, of distinct fingerprints (column ``fp``) at most two bits apart.

    Two segments of 32 bits: of two bits that differ at most, one segment has at most
    one. Each fingerprint is indexed under both segments with each bit left out in
    turn; two segments that differ in one bit at most share such a variant. Buckets
    are joined by equality and pairs verified in the join, so only links leave it.

    A bucket of more than ``largest`` fingerprints is cut by the same rule over the
    other segment's halves (16 bits, then 8), where the pair can differ in no more
    than two bits either. After that a bucket leaves eleven bits open, so it holds at
    most 2,048 fingerprints whatever the input: no bucket is cut off or skipped.
    """
    if max_bits not in (0, 1, 2):
        raise ValueError("two segments with one wildcard find fingerprints at most two bits apart")
    other = F.when(F.col("key") < F.lit(32 << 32), F.shiftrightunsigned("fp", 32)).otherwise(F.col("fp"))
    # A few bytes a fingerprint become a thousand: not too many of them in a task. Dealt by another
    # expression than the fingerprint, by which they may lie already, in fewer tasks.
    tasks = int(fingerprints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = fingerprints.select("fp").repartition(max(tasks, fingerprints.count() // FAN_OUT), F.xxhash64("fp"))
    rows = rows.select("fp", F.explode(_variants(F.col("fp"), _segments(0, 64))).alias("key"))
    keys, found = ["key"], []
    low_word = F.col("rest").bitwiseAND(F.lit(0xFFFFFFFF))
    width = 32
    while True:
        sizes = rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
        shared = cut_lineage(rows.join(sizes, keys))
        last = width == 8
        found.append(_pairs(shared if last else shared.where(F.col("n") <= largest), keys, max_bits))
        crowded = shared.where(F.col("n") > largest).drop("n")
        if last or crowded.isEmpty():
            break
        if width == 32:
            crowded = crowded.withColumn("rest", other)
            place = 0
        else:
            # The half that the last key did not use holds what is still open.
            crowded = crowded.withColumn(
                "rest", F.when(F.col(keys[-1]) < F.lit(width << 32), F.shiftrightunsigned("rest", width)).otherwise(F.col("rest"))
            )
        key = f"key{width}"
        crowded = crowded.withColumn("rest", low_word)
        rows = crowded.select("fp", *keys, "rest", F.explode(_variants(F.col("rest"), _segments(0, width))).alias(key))
        keys = [*keys, key]
        width //= 2
    return reduce(DataFrame.unionAll, found).distinct()


def simhash_components(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    max_bits: int = 2,
    largest: int = LARGEST_BUCKET,
) -> DataFrame:
    """``doc_id, fingerprint, component_id, text_key, kept`` for every row of ``docs``.

    ``fingerprint``: 16 hex digits. A NULL text, or one without words, has fingerprint
    zero and is linked like any other; fewer words than a shingle are one shingle.
    ``component_id``: the smallest id reachable over links, itself included; NULL only
    if all ids of the component are. Repeated rows each get a row. ``kept`` marks one
    content of each component: of the rows with the smallest id (a NULL id comes last)
    those with the smallest ``text_key``; rows that repeat both are all marked. Other
    columns, whatever they are called, are not looked at. No rows: no rows.

    Copies are brought to one row per fingerprint before anything is compared.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        fingerprint_udf(shingle)(utf8(text)).alias("fp"),
        text_key(text).alias("text_key"),
    )
    rows = cut_lineage(rows)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("text_key")))
    distinct = cut_lineage(rows.groupBy("fp").agg(first.alias("first")))
    links = fingerprint_links(distinct.select("fp"), max_bits, largest)
    member = connected_components(links).select(F.col("node").alias("fp"), F.col("component").alias("root"))
    placed = distinct.join(member, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    root = placed.groupBy("root").agg(F.min("first").alias("first"))
    placed = placed.select("fp", "root").join(root, "root").select("fp", "first")
    kept = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key"))
    return rows.join(placed, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first.doc_id").alias("component_id"),
        "text_key",
        kept.alias("kept"),
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of ``docs`` for each component, that with the smallest id, as it is."""
    found = simhash_components(docs, doc_id, text, **options)
    found = found.groupBy(F.col("doc_id").alias("of_id"), F.col("text_key").alias("of_key"))
    found = cut_lineage(found.agg(F.any_value("kept").alias("kept"), F.count("*").alias("n")))
    same = F.col("id").eqNullSafe(F.col("of_id")) & (F.col("key") == F.col("of_key"))
    rows = decided(as_rows(docs, text, id=doc_id), found.where("not kept"), same, "left_anti", F.lit(0))
    if not found.where("kept and n > 1").isEmpty():
        rows = rows.dropDuplicates(["id", "key"])
    return back(rows, docs, text)
