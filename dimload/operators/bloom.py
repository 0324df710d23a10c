"""A Bloom filter as a small table: which rows of a large frame can match at all.

A join of a large table with a feed too large to copy moves the keys of both. With a filter
built from the feed's keys, twelve bits a key, most rows of the table that match nothing
are left out where they are read. What is let through by chance, some three in a hundred,
goes on into the join as it did before, so results never depend on the filter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .joins import BROADCAST_BYTES, quoted, require_columns, sql_name

#: 64-bit words of a block; a block is one row of the filter.
WORDS = 512
BITS_PER_KEY = 12

_EXACT = (T.IntegralType, T.StringType, T.BinaryType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)


def _place(keys: Sequence[str], blocks: int) -> tuple[Column, Column, Column]:
    """Block, word and the three bits of a key."""
    names = [quoted(k) for k in keys]
    other = F.xxhash64(F.lit("bits"), *names)
    mask = F.lit(0).cast("long")
    for shift in (9, 15, 21):
        bit = F.shiftrightunsigned(other, shift).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return F.pmod(F.xxhash64(*names), F.lit(blocks)).cast("int"), other.bitwiseAND(F.lit(WORDS - 1)).cast("int"), mask


def bloom_filter(keys: DataFrame, blocks: int) -> DataFrame:
    """``__block, __words``: bits of the rows of a frame of key columns, words a row of ``blocks``."""
    block, word, mask = _place(keys.columns, blocks)
    # Every block gets all of its words, so they are in place once sorted.
    empty = keys.sparkSession.range(blocks).select(
        F.col("id").cast("int").alias("__block"), F.explode(F.sequence(F.lit(0), F.lit(WORDS - 1))).alias("w"), F.lit(0).cast("long").alias("bits")
    )
    words = keys.select(block.alias("__block"), word.alias("w"), mask.alias("bits")).unionAll(empty)
    words = words.groupBy("__block", "w").agg(F.bit_or("bits").alias("bits"))
    found = words.groupBy("__block").agg(F.array_sort(F.collect_list(F.struct("w", "bits"))).alias("m"))
    return found.select("__block", F.col("m.bits").alias("__words"))


def probably_matching(df: DataFrame, few: DataFrame, keys: Sequence[str], most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Rows of ``df`` without most of those whose key is not in ``few``; no row that has a partner goes.

    NULL counts as a value. The filter is copied to the executors, at most ``most_bytes``. Where that leaves less than half
    of the bits a key is due, or where keys are of types or of different types in which
    equal values can hash differently, all rows are returned. ``few`` is read twice.
    """
    mine, theirs = require_columns(df, keys, "rows"), require_columns(few, keys, "keys")
    kinds = [(df.schema[a].dataType, few.schema[b].dataType) for a, b in zip(mine, theirs)]
    if any(a != b or not isinstance(a, _EXACT) for a, b in kinds):
        return df
    count = few.count()
    blocks = min(-(-count * BITS_PER_KEY // (64 * WORDS)), most_bytes // (8 * WORDS))
    if not count or 2 * blocks * 64 * WORDS < count * BITS_PER_KEY:
        return df
    bits = bloom_filter(few.select(*[quoted(b).alias(a) for a, b in zip(mine, theirs)]), blocks)
    names = df.columns
    block, word, mask = _place(mine, blocks)
    found = df.withColumns({"__at": block, "__word": word, "__mask": mask}).join(F.broadcast(bits), F.col("__at") == F.col("__block"))
    found = found.where(F.col("__words")[F.col("__word")].bitwiseAND(F.col("__mask")) == F.col("__mask"))
    return found.selectExpr(*[sql_name(n) for n in names])
