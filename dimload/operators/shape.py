"""Shaping frames: projection, fitting to a schema, union, replace by key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bloom import probably_matching
from .joins import fits_broadcast, match_one, only_matching, quoted, require_columns, sql_name
from .skew import HotKeys


def project(df: DataFrame, columns: Mapping[str, str | Column]) -> DataFrame:
    """Select ``{output: input column or expression}``."""
    return df.select(
        *[
            F.expr(f"{sql_name(e)} AS {sql_name(o)}") if isinstance(e, str) else e.alias(o)
            for o, e in columns.items()
        ]
    )


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Fit a frame to a table: its column order and types, NULL where absent.

    Names ignore case. A column the table does not have is an error.
    """
    have = {c.lower(): c for c in df.columns}
    out = []
    for field in schema.fields:
        mine = have.pop(field.name.lower(), None)
        value = "NULL" if mine is None else sql_name(mine)
        out.append(f"CAST({value} AS {field.dataType.simpleString()}) AS {sql_name(field.name)}")
    if have:
        raise ValueError(f"the table has no columns {sorted(have.values())}")
    return df.selectExpr(*out)


def union_rows(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of all frames, by column name; a column a frame lacks is NULL."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def without_keys(
    target: DataFrame,
    keys: DataFrame,
    on: Sequence[str],
    unique: bool = False,
    *,
    small: bool = False,
    hot: HotKeys | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """The target without the rows whose key is in ``keys`` (delete by key).

    Where the keys are known to be ``small`` (see ``fits_broadcast``) they are
    copied to the executors and the target stays in place. ``hot`` spreads
    frequent target keys otherwise. With ``null_safe`` NULL is a key like any other;
    without, rows with NULL in the key all stay.
    """
    if small:
        few = keys.select(*[quoted(k) for k in require_columns(keys, on, "keys")])
        few = F.broadcast(few if unique else few.distinct())
        return match_one(target, few, on, "left_anti", unique=True, null_safe=null_safe)
    return match_one(target, keys, on, "left_anti", unique=unique, hot=hot, null_safe=null_safe)


def upsert_replace(
    target: DataFrame,
    staged: DataFrame,
    on: Sequence[str],
    unique: bool = False,
    *,
    small: bool = False,
    hot: HotKeys | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Staged rows replace target rows of the same key whole; new ones are added.

    A target column the staged rows do not have is NULL in a replaced row.
    ``small``, ``hot`` and ``null_safe`` as in ``without_keys``.
    """
    rest = without_keys(target, staged, on, unique, small=small, hot=hot, null_safe=null_safe)
    return rest.unionByName(align(staged, target.schema))


def changed_rows(staged: DataFrame, target: DataFrame, on: Sequence[str], ignore: Sequence[str] = ()) -> DataFrame:
    """Staged rows of keys for which the target does not hold just these rows.

    Compared are all staged columns but ``ignore``, as the target's types, and how often each row is there; NULL
    equals NULL, also in keys. An upsert of these rows leaves the others alone, so
    it can be run again: a second time there are none.

    Staged rows and the stored ones of staged keys are counted against each other in one
    shuffle, by all columns compared, so a key with very many rows is dealt by its content.
    """
    keys = require_columns(staged, on, "staged rows")
    ignored = {c.lower() for c in ignore}
    columns = [c for c in staged.columns if c.lower() not in ignored]
    typed = align(staged.select(*[quoted(c) for c in columns]), target.select(*[quoted(c) for c in columns]).schema)
    few = fits_broadcast(typed.select(*[quoted(k) for k in keys]))
    stored = target.select(*[quoted(c) for c in columns])
    stored = only_matching(stored, typed, keys, null_safe=True) if few else probably_matching(stored, typed, keys)
    if not few:
        stored = match_one(stored, typed, keys, "left_semi", null_safe=True)
    both = typed.withColumn("__n", F.lit(1)).unionAll(stored.withColumn("__n", F.lit(-1)))
    differing = both.groupBy(*[quoted(c) for c in columns]).agg(F.sum("__n").alias("__n")).where("__n <> 0")
    differing = differing.select(*[quoted(k) for k in keys])
    casts = {k: quoted(k).cast(typed.schema[k].dataType) for k in keys}
    staged = staged.withColumns(casts)
    if few:
        return only_matching(staged, differing.distinct(), keys, null_safe=True)
    return match_one(staged, differing, keys, "left_semi", null_safe=True)


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct values of some columns, under the frame's own spelling; NULL is a value."""
    return df.select(*[quoted(k) for k in require_columns(df, keys, "rows")]).distinct()


def without_copies(df: DataFrame) -> DataFrame:
    """Each different row once. NULL equals NULL."""
    return df.dropDuplicates()
