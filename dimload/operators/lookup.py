"""Lookups: insert-only, current row with incoming row, key resolution, rejects."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.scratch import cut_lineage
from .bloom import probably_matching
from .joins import (
    MATCH,
    _require_same_types,
    fits_broadcast,
    match_one,
    only_matching,
    quoted,
    require_columns,
    sql_name,
    without,
)
from .overlay import replaced
from .skew import HotKeys

REJECT_REASON = "REJECT_REASON"


class Resolved(NamedTuple):
    """Rows whose key was found, and the others with a reason column."""

    accepted: DataFrame
    rejected: DataFrame


def insert_only(
    staged: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    *,
    unique: bool = False,
    null_safe: bool = False,
    hot: HotKeys | None = None,
    small: bool = False,
    prefilter: bool = False,
) -> DataFrame:
    """Staged rows whose key the target does not have yet.

    ``unique`` says the target has one row per key. Several staged rows of one
    new key are all returned.

    ``small`` says the staged keys are known to fit in memory (see
    ``fits_broadcast``); the target's keys are then not shuffled. For staged keys that do not,
    ``prefilter`` shuffles only those of the target's keys that can match, found
    by a Bloom filter of the staged ones (see ``probably_matching``).
    """
    if small:
        target = only_matching(target, staged, keys, null_safe)
    elif prefilter:
        target = target.select(*[quoted(k) for k in require_columns(target, keys, "target")])
        target = probably_matching(target, staged, keys)
    return match_one(staged, target, keys, "left_anti", unique=unique, null_safe=null_safe, hot=hot)


def lookup_overlay(
    rows: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column] | None = None,
    *,
    winner: str = "incoming",
    latest: bool = False,
    unique: bool = False,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Rows whose key is incoming, overlaid by the incoming row; others dropped.

    ``winner="rows"`` lets the looked-up row's own values win instead, so only
    columns it does not have are taken from ``incoming``.
    """
    if winner not in ("incoming", "rows"):
        raise ValueError("winner is 'incoming' or 'rows'")
    joined = match_one(
        rows, incoming, keys, "inner", order_by=order_by, latest=latest, unique=unique, hot=hot
    )
    if winner == "incoming":
        return joined.selectExpr(*replaced(rows, incoming, keys))
    added = [sql_name(c) for c in without(incoming, rows.columns)]
    return joined.selectExpr(*[sql_name(c) for c in rows.columns], *[f"{MATCH}.{c} AS {c}" for c in added])


def resolve_key(
    rows: DataFrame,
    reference: DataFrame,
    on: Sequence[str],
    order_by: Sequence[str | Column] | None = None,
    *,
    unique: bool = False,
    hot: HotKeys | None = None,
    small: bool = False,
    save: bool = False,
    reason: str = "key not found",
) -> Resolved:
    """Take the reference's columns (the foreign key) for each row.

    Whether a row is accepted depends on whether its key was found, not on the
    value found. Accepted and rejected rows add up to the input. ``small`` says
    the keys of ``rows`` are known to fit in memory; the reference is then not
    shuffled. ``save`` writes the joined rows once, for when both parts are used.
    """
    if small:
        reference = only_matching(reference, rows, on)
    joined = match_one(rows, reference, on, "left", order_by=order_by, unique=unique, hot=hot)
    if save:
        joined = cut_lineage(joined)
    return resolved(joined, rows, reference, on, reason)


def resolved(joined: DataFrame, rows: DataFrame, reference: DataFrame, on: Sequence[str], reason: str) -> Resolved:
    """Rows with their reference row, or NULL, as ``__match``, split by whether there is one."""
    found = F.col(MATCH).isNotNull()
    return Resolved(
        joined.where(found).selectExpr(*replaced(rows, reference, on)),
        joined.where(~found).drop(MATCH).withColumn(REJECT_REASON, F.lit(reason)),
    )


def content_digest(columns: Sequence[Column]) -> Column:
    """Sixteen bytes that stand for some values: the MD5 of each one's length and text. NULL has a digest of its own."""
    parts = []
    for c in columns:
        text = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.md5(F.concat(*parts).cast("binary")))


#: Types whose equal values have equal texts.
_ONE_TEXT = (T.IntegralType, T.StringType, T.BooleanType, T.DateType, T.TimestampNTZType, T.TimestampType, T.DecimalType)


def content_anti_join(
    staged: DataFrame,
    target: DataFrame,
    content: Sequence[str],
    keys: Sequence[str] = (),
    *,
    scope: str = "key",
    hot: HotKeys | None = None,
    small: bool = False,
    digest: Callable[[Sequence[Column]], Column] = content_digest,
) -> DataFrame:
    """Staged rows with content the target does not have.

    ``scope="key"`` compares with target rows of the same ``keys`` (pass only
    current rows to compare with the current version). ``scope="global"``
    compares with every target row, whatever its key. NULL equals NULL.
    ``small`` says the staged columns compared are known to fit in memory.

    Otherwise a target row is moved as sixteen bytes, the digest of its columns, if a Bloom filter of the
    staged digests lets it through. Where a digest is found on both sides, the columns of its rows
    are compared, so equal digests of different rows do no harm. Floating-point and
    nested columns are compared as they are, without digests.
    """
    if scope not in ("key", "global"):
        raise ValueError("scope is 'key' or 'global'")
    if scope == "key" and not keys:
        raise ValueError("scope 'key' needs keys")
    columns = (list(keys) if scope == "key" else []) + list(content)
    mine, theirs = require_columns(staged, columns, "staged rows"), require_columns(target, columns, "target")
    digested = all(isinstance(target.schema[c].dataType, _ONE_TEXT) for c in theirs)
    if small or not digested:
        if small:
            target = only_matching(target, staged, columns, null_safe=True)
        return match_one(staged, target, columns, "left_anti", null_safe=True, hot=hot)
    _require_same_types(staged, mine, target, theirs)

    # Written once, with a number by which the rows found are taken out again.
    rows = cut_lineage(staged.withColumns({"__row": F.monotonically_increasing_id(), "__digest": digest([quoted(c) for c in mine])}))
    stored = target.select(*[quoted(c).alias(m) for c, m in zip(theirs, mine)]).withColumn("__digest", digest([quoted(c) for c in mine]))
    wanted = rows.select("__digest").distinct()
    found = match_one(wanted, probably_matching(stored.select("__digest"), wanted, ["__digest"]), ["__digest"], "left_semi")
    found = cut_lineage(found)
    if found.isEmpty():
        return rows.drop("__row", "__digest")
    if fits_broadcast(found):
        found = F.broadcast(found)
    suspects = match_one(rows, found, ["__digest"], "left_semi", unique=True).select(*[quoted(m) for m in mine], "__row", "__digest")
    stored = match_one(stored, found, ["__digest"], "left_semi", unique=True)
    known = cut_lineage(match_one(suspects, stored, [*mine, "__digest"], "left_semi", null_safe=True).select("__row"))
    known = F.broadcast(known) if fits_broadcast(known) else known
    return match_one(rows, known, ["__row"], "left_anti", unique=True).drop("__row", "__digest")


def registry_base(registry: DataFrame, table_name: str) -> int:
    """The largest surrogate key handed out so far for a table.

    The registry must have exactly one row for the table. Only that row, or the
    first two if there are more, reaches the driver.
    """
    names = require_columns(registry, ["TABLE_NAME", "MAX_VALUE_KEY"], "registry")
    rows = registry.where(quoted(names[0]) == table_name).select(quoted(names[1])).take(2)
    if len(rows) != 1:
        found = "none" if not rows else "several"
        raise ValueError(f"the registry needs one row for {table_name}, found {found}")
    return int(rows[0][0])


def with_registry_base(
    df: DataFrame, registry: DataFrame, table_name: str, column: str = "MAX_VALUE_KEY"
) -> DataFrame:
    """Every row with the registry's key for a table beside it, as a constant."""
    return df.withColumn(column, F.lit(registry_base(registry, table_name)).cast("bigint"))
