"""Overlay: a feed's columns replace the target's where the key matches."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import cut_lineage
from .joins import (
    BROADCAST_BYTES,
    MATCH,
    first_match,
    match_one,
    measured_bytes,
    require_columns,
    sql_name,
    without,
)
from .skew import SALT, HotKeys, spread


def replaced(left: DataFrame, right: DataFrame, keys: Sequence[str], erase: bool = False) -> list[str]:
    """Output expressions of an overlay, for a frame joined by ``match_one``.

    All left columns come in their order, then those only the right side has.
    A matched row takes every right value, also NULL, cast to the left type.
    An unmatched row keeps its own, or with ``erase`` loses what the feed owns.
    """
    lowered = {k.lower() for k in keys}
    incoming = {c.lower(): c for c in right.columns if c.lower() not in lowered}
    out = []
    for field in left.schema.fields:
        theirs = incoming.pop(field.name.lower(), None)
        mine = sql_name(field.name)
        if theirs is None:
            out.append(mine)
            continue
        value = f"CAST({MATCH}.{sql_name(theirs)} AS {field.dataType.simpleString()})"
        if not erase:
            value = f"CASE WHEN {MATCH} IS NOT NULL THEN {value} ELSE {mine} END"
        out.append(f"{value} AS {mine}")
    return out + [f"{MATCH}.{sql_name(c)} AS {sql_name(c)}" for c in incoming.values()]


def overlay(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column] | None = None,
    *,
    latest: bool = False,
    unique: bool = False,
    null_safe: bool = False,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Left join in which the right side's columns overwrite the left's.

    Every left row stays exactly once, duplicates included. If the key is found
    on the right, all right columns replace the left ones, with NULL too, and
    right-only columns are added. Keys found only on the right are dropped. Of
    several right rows the first in ``order_by`` is used.
    """
    joined = match_one(
        left, right, keys, "left",
        order_by=order_by, latest=latest, unique=unique, null_safe=null_safe, hot=hot,
    )
    return joined.selectExpr(*replaced(left, right, keys))


@dataclass(frozen=True)
class Feed:
    """One step of an overlay chain. ``small``: copied to the executors, so the target
    is not shuffled for it."""

    rows: DataFrame
    order_by: Sequence[str | Column] | None = None
    latest: bool = False
    unique: bool = False
    small: bool = False


def settle_all(feeds: Sequence[Feed], keys: Sequence[str], limit: int = BROADCAST_BYTES) -> list[Feed]:
    """Reduce feeds to one row per key, write each once and measure it.

    Feeds that turn out small are copied to the executors, the smallest first and
    ``limit`` bytes together at most; if all are, the target they are laid over stays
    in place. Costs one write of each feed, which is worth it when the target is much
    larger.
    """
    rows = [cut_lineage(f.rows if f.unique else first_match(f.rows, keys, f.order_by, f.latest)) for f in feeds]
    sizes = [measured_bytes(r) for r in rows]
    small, left = set(), limit
    for i in sorted((i for i, n in enumerate(sizes) if n is not None), key=lambda i: sizes[i]):
        if sizes[i] <= left:
            small.add(i)
            left -= sizes[i]
    return [Feed(F.broadcast(r) if i in small else r, unique=True, small=i in small) for i, r in enumerate(rows)]


def settle(feed: Feed, keys: Sequence[str]) -> Feed:
    """``settle_all`` for one feed."""
    return settle_all([feed], keys)[0]


def overlay_chain(
    target: DataFrame,
    feeds: Sequence[Feed],
    keys: Sequence[str],
    *,
    null_safe: bool = False,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Overlay several feeds on one key; a later feed wins on shared columns.

    All joins use the same key (and salt), so the target is shuffled and sorted
    once however many feeds there are.
    """
    out = spread(target, keys, hot)
    for feed in feeds:
        out = overlay(
            out, feed.rows, keys, feed.order_by,
            latest=feed.latest, unique=feed.unique, null_safe=null_safe, hot=hot,
        )
    return out if SALT in target.columns else out.drop(SALT)


def refresh(
    target: DataFrame,
    feed: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column] | None = None,
    *,
    on_missing: str = "keep",
    also_erase: Sequence[str] = (),
    latest: bool = False,
    unique: bool = False,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Overlay one feed on its target, keeping the target's columns.

    ``on_missing`` says what happens to the columns the feed owns in rows the
    feed does not mention: ``keep`` leaves them, ``null`` erases them.
    ``also_erase`` names further columns that ``null`` erases in every row.
    """
    if on_missing not in ("keep", "null"):
        raise ValueError("on_missing is 'keep' or 'null'")
    if without(feed, target.columns):
        raise ValueError(f"the target lacks columns {without(feed, target.columns)}")
    erase = on_missing == "null"
    joined = match_one(
        target, feed, keys, "left", order_by=order_by, latest=latest, unique=unique, hot=hot
    )
    out = joined.selectExpr(*replaced(target, feed, keys, erase=erase))
    if erase and also_erase:
        names = require_columns(target, also_erase, "target")
        out = out.withColumns({n: F.lit(None).cast(target.schema[n].dataType) for n in names})
    return out
