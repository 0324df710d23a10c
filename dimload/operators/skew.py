"""Finding and spreading keys that hold a large share of a table.

A join moves all rows of one key to one task. When a single key holds a third
of a table that task decides the run time. ``find_hot_keys`` counts keys once,
from the key columns only; the joins of this package then cut each hot key into
pieces ("salts") and copy its one row of the other side to every piece. All
other keys take the ordinary join in the same plan.

The salt of a row is a hash of its other columns. It does not depend on where
the row lies, so a table that keeps a key together in one file or bucket is cut
as well as any other, and a task that is run again after an executor is lost
gives its rows the same salts: no row is lost or doubled.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SALT = "__salt"
#: Groups of keys counted to find hot ones, for each shuffle partition.
GROUPS = 64


@dataclass(frozen=True)
class HotKeys:
    """Key hashes by the number of pieces each is cut into.

    A hot key fills more than one shuffle partition, so there are fewer of them
    than shuffle partitions, and the pieces add up to at most three times that
    number: what the joins copy does not grow with the data.
    """

    pieces: dict[int, list[int]] = field(default_factory=dict)

    def __bool__(self) -> bool:
        return bool(self.pieces)

    def count_for(self, keys: Sequence[str]) -> Column:
        """Number of pieces of a row's key; 1 for a key that is not hot."""
        key_hash = F.xxhash64(*[F.col(k) for k in keys])
        out = F.lit(1)
        for n, hashes in self.pieces.items():
            out = F.when(key_hash.isin(hashes), F.lit(n)).otherwise(out)
        return out

    def salt(self, keys: Sequence[str], others: Sequence[Column]) -> Column:
        """For the side whose rows are spread, by their ``others``. Rows that are
        nothing but their key are told apart by the task that reads them."""
        pieces = self.count_for(keys)
        by = F.xxhash64(*others) if others else F.spark_partition_id()
        return F.when(pieces > 1, F.pmod(by, pieces).cast("int")).otherwise(F.lit(0))

    def all_salts(self, keys: Sequence[str]) -> Column:
        """For the side with one row per key: explode to one row per piece."""
        return F.explode(F.sequence(F.lit(0), self.count_for(keys) - 1))


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def _name(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def spread(df: DataFrame, keys: Sequence[str], hot: HotKeys | None) -> DataFrame:
    """Add the salt column for several joins on the same keys, if any key is hot.

    Joins that find the column use it and leave it in place, so they share one
    shuffle of ``df``. Drop ``SALT`` after the last one.
    """
    if not hot or SALT in df.columns:
        return df
    lowered = {k.lower() for k in keys}
    others = [_name(f.name) for f in df.schema.fields if f.name.lower() not in lowered and _hashable(f.dataType)]
    return df.withColumn(SALT, hot.salt([f"`{k}`" for k in keys], others))


def find_hot_keys(df: DataFrame, keys: Sequence[str]) -> HotKeys:
    """Keys with more rows than a shuffle partition has on average.

    Counts groups of keys first, a fixed number of them, which are added up in the tasks
    that read the rows: no key has more rows than its group. Only if some group has more
    than the average are keys counted exactly, from their hash, and two longs a key shuffled.
    Only keys above the average reach the driver, which cannot be more than there are partitions. A
    NULL key counts as a key. The result only steers how rows are spread, never
    which rows a join returns.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashed = df.select(F.xxhash64(*[F.col(k) for k in keys]).alias("h"))
    groups = hashed.groupBy(F.pmod("h", F.lit(GROUPS * partitions)).alias("g")).agg(F.count("*").alias("n"))
    total, largest = groups.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    if largest * partitions <= total:
        return HotKeys()
    counts = hashed.groupBy("h").agg(F.count("*").alias("n"))
    pieces: dict[int, list[int]] = {}
    for key in counts.where(F.col("n") * partitions > total).collect():
        n = 2 ** math.ceil(math.log2(key["n"] / total * partitions))
        pieces.setdefault(n, []).append(key["h"])
    return HotKeys(pieces)
