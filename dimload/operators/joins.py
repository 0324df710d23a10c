"""The one join every operator here is built on: many rows to one row.

A dimension load never multiplies the rows of its left side. Each operator
reduces the other side to one row per key first (or is told that it already is)
and then joins. The reduced row arrives as one struct column, so "did the key
match" is a NULL test on the struct and a NULL inside it stays distinct from
"no match".
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .skew import SALT, HotKeys, spread

MATCH = "__match"


def sql_name(name: str) -> str:
    """A column name as SQL text. Long column lists are passed as text: one
    ``selectExpr`` of 80 names costs far less driver time than 80 ``Column``s."""
    return "`" + name.replace("`", "``") + "`"


def sql_struct(names: Sequence[str]) -> str:
    return f"struct({', '.join(sql_name(n) for n in names)})"


def quoted(name: str) -> Column:
    return F.col(sql_name(name))


def find_column(df: DataFrame, name: str) -> str | None:
    """The frame's own spelling of a column name; names ignore case."""
    return {c.lower(): c for c in df.columns}.get(name.lower())


def require_columns(df: DataFrame, names: Sequence[str], side: str) -> list[str]:
    found = [find_column(df, n) for n in names]
    missing = [n for n, f in zip(names, found) if f is None]
    if missing:
        raise ValueError(f"{side} lacks columns {missing}")
    return found


def without(df: DataFrame, names: Sequence[str]) -> list[str]:
    lowered = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in lowered]


# What a join may copy to every executor.
BROADCAST_BYTES = 64 << 20


def measured_bytes(df: DataFrame) -> int | None:
    """About what the rows of a frame take in memory, by running it; None if it has
    columns whose size cannot be told."""
    width = F.lit(16 + 8 * len(df.columns))
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(quoted(field.name)), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            return None
    return df.agg(F.sum(width).alias("bytes")).first()["bytes"] or 0


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the frame, measured by running it, is small enough to copy."""
    size = measured_bytes(df)
    return size is not None and size <= limit


def first_match(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column],
    latest: bool = False,
) -> DataFrame:
    """One row per key: the first in ``order_by``, or the last if ``latest``.

    NULL comes first, so the last row is one without NULL if there is one. Rows
    ``order_by`` leaves equal are told apart by their other columns, so the result
    does not depend on where a row was read. Rows are reduced in the task that reads
    them, before the shuffle, so a key with very many rows sends one row per task.
    """
    keys = require_columns(df, keys, "first_match input")
    return _reduced(df, keys, order_by, latest, list(keys)).selectExpr(
        *[sql_name(c) if c in keys else f"{MATCH}.{sql_name(c)} AS {sql_name(c)}" for c in df.columns]
    )


def _reduced(df, keys, order_by, latest, group, carry=()) -> DataFrame:
    payload = [c for c in df.columns if c not in keys and c not in carry] or [keys[0]]
    # Rows that are first in their task are found before the shuffle.
    order = W.partitionBy(*[quoted(g) for g in group]).orderBy(*_total_order(df, payload, order_by, latest))
    kept = df.withColumn("__place", F.row_number().over(order)).where("__place = 1")
    return kept.selectExpr(*[sql_name(g) for g in group], f"{sql_struct(payload)} AS {MATCH}")


def _total_order(df: DataFrame, payload: Sequence[str], order_by: Sequence[str | Column], latest: bool) -> list[Column]:
    """``order_by``, and then the other columns of ``payload``, which settle ties; all reversed if ``latest``."""
    if not order_by:
        raise ValueError("order_by is required: which of several matching rows wins must be stated")
    by_name = require_columns(df, [o for o in order_by if isinstance(o, str)], "order_by")
    names = iter(by_name)
    first = [quoted(next(names)) if isinstance(o, str) else o for o in order_by]
    rest = [quoted(c) for c in payload if c not in by_name and _orderable(df.schema[c].dataType)]
    return [c.desc() if latest else c.asc() for c in [*first, *rest]]


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def _require_same_types(left, lkeys, right, rkeys) -> None:
    # Hashes and structs of an int and a bigint differ although the values match.
    for a, b in zip(lkeys, rkeys):
        if left.schema[a].dataType != right.schema[b].dataType:
            raise ValueError(f"cast key {a} to the same type on both sides for a null-safe or spread join")


def match_one(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    *,
    order_by: Sequence[str | Column] | None = None,
    latest: bool = False,
    unique: bool = False,
    null_safe: bool = False,
    hot: HotKeys | None = None,
    also_equal: Sequence[str] = (),
) -> DataFrame:
    """Join each left row with at most one right row.

    ``how`` is ``left``, ``inner``, ``left_semi`` or ``left_anti``. For the
    first two the right row's other columns arrive in the struct ``__match``.

    ``unique`` states that ``right`` has one row per key and saves reducing it.
    Otherwise several right rows are reduced by ``order_by`` (for semi and anti
    joins, where it makes no difference which one is kept, by a distinct).

    ``null_safe`` lets NULL match NULL. The key columns are then compared as one
    struct, which is never NULL itself, so this costs no second shuffle.

    ``hot`` spreads frequent left keys, see ``find_hot_keys``.

    ``also_equal`` names columns that have to agree too but do not decide where
    a row goes: a left side already partitioned by ``keys`` stays where it is.
    ``right`` then has one row per ``keys`` and ``also_equal`` together.
    """
    if also_equal and not (unique and how in ("left", "inner")):
        raise ValueError("also_equal needs a unique right side and a left or inner join")
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join {how}")
    lkeys = require_columns(left, keys, "left side")
    rkeys = require_columns(right, keys, "right side")
    names = left.columns
    if hot or null_safe:
        _require_same_types(left, lkeys, right, rkeys)

    if null_safe:
        rnames = ["__key"]
        right = right.withColumn(
            "__key", F.struct(*[quoted(k).alias(f"k{i}") for i, k in enumerate(rkeys)])
        )
        left = left.withColumn(
            "__lkey", F.struct(*[quoted(k).alias(f"k{i}") for i, k in enumerate(lkeys)])
        )
        lnames = ["__lkey"]
    else:
        rnames, lnames = rkeys, lkeys

    if how in ("left_semi", "left_anti"):
        right = right.select(*[quoted(k) for k in rnames])
        if not unique:
            right = right.distinct()
    elif unique:
        payload = [c for c in right.columns if c not in rkeys and c not in rnames] or [rkeys[0]]
        further = [
            f"{sql_name(c)} AS __e{i}" for i, c in enumerate(require_columns(right, also_equal, "right side"))
        ]
        right = right.selectExpr(
            *[sql_name(k) for k in rnames], *further, f"{sql_struct(payload)} AS {MATCH}"
        )
    else:
        right = _reduced(right, rkeys, order_by, latest, rnames, carry=rnames)

    right = right.withColumnsRenamed({k: f"__r{i}" for i, k in enumerate(rnames)})
    on = [quoted(k) == F.col(f"__r{i}") for i, k in enumerate(lnames)]
    if hot:
        # Null-safe keys hash by the columns inside the struct, as on the left.
        inside = (
            [f"__r0.k{i}" for i in range(len(rkeys))] if null_safe else [f"__r{i}" for i in range(len(rkeys))]
        )
        left = spread(left, lkeys, hot)
        right = right.withColumn("__rsalt", hot.all_salts(inside))
        on.append(F.col(SALT) == F.col("__rsalt"))

    for i, name in enumerate(require_columns(left, also_equal, "left side")):
        # Written as two bounds because an equality would become a join key.
        on += [quoted(name) <= F.col(f"__e{i}"), quoted(name) >= F.col(f"__e{i}")]

    joined = left.join(right, on, how)
    return joined.selectExpr(*[sql_name(c) for c in names], *([MATCH] if how in ("left", "inner") else []))


def only_matching(
    df: DataFrame, few: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """The rows of a large frame whose key occurs in a small one.

    ``few`` is copied to the executors, so ``df`` is read without a shuffle.
    Pass only a frame that ``fits_broadcast``.
    """
    few = F.broadcast(few.select(*[quoted(k) for k in require_columns(few, keys, "small side")]))
    return match_one(df, few, keys, "left_semi", unique=True, null_safe=null_safe)
