"""Type-2 dimensions: initial load and merge of new versions.

A stored row is one version of its natural key. At most one version per key is
current. A merge closes the current version of every key whose content changed
and adds a version in its place; all other stored rows pass through.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import (
    OPEN_BEGIN,
    OPEN_END,
    batch_number,
    plus_days,
    timestamp_literal,
    to_second,
    void_flag,
)
from ..sources.scratch import cut_lineage
from .bloom import probably_matching
from .joins import MATCH, _total_order, first_match, fits_broadcast, match_one, only_matching, quoted, require_columns, without
from .keys import assign_surrogate_keys
from .lookup import REJECT_REASON, content_anti_join, insert_only, resolve_key, resolved
from .overlay import replaced
from .shape import align, union_rows
from .skew import SALT, HotKeys, find_hot_keys, spread


@dataclass(frozen=True)
class Scd2Layout:
    """Which column of a type-2 table plays which part.

    ``parent`` is the foreign key resolved from a parent dimension by
    ``parent_id``.
    """

    natural_key: Sequence[str]
    content: Sequence[str]
    surrogate: str
    parent: str
    parent_id: str
    begin: str
    end: str
    current: str
    version: str
    void: str
    ins_batch: str
    upd_batch: str


class Rules(NamedTuple):
    """What a merge does where the behaviours differ.

    expire_all     close every version of a staged key, changed or not
    compare        look for equal content under the same key, anywhere, or not
    number_first   take surrogate keys before unchanged and rejected rows go
    """

    expire_all: bool
    compare: str
    number_first: bool


CORRECTED = "corrected"
RULES = {
    CORRECTED: Rules(expire_all=False, compare="key", number_first=False),
    "reference": Rules(expire_all=True, compare="global", number_first=True),
    "reference_without_compare": Rules(expire_all=True, compare="none", number_first=True),
}


class Loaded(NamedTuple):
    """New rows ready to append, staged rows refused with a reason, and those whose key
    is stored already. Together they are the staged rows."""

    rows: DataFrame
    rejected: DataFrame
    existing: DataFrame


class Merged(NamedTuple):
    """The whole new table, the versions added, staged rows refused with a reason, and those
    that change nothing; ``closing`` has the keys whose current version is closed. Added,
    rejected and unchanged rows are together as many as the staged rows."""

    table: DataFrame
    added: DataFrame
    rejected: DataFrame
    unchanged: DataFrame
    closing: DataFrame


NULL_KEY = "NULL in the natural key"
SUPERSEDED = "another staged row of the key is used"
NOT_STORED = "no stored version"


def _null_key(rows: DataFrame, keys: Sequence[str]) -> Column:
    missing = F.lit(False)
    for key in require_columns(rows, keys, "rows"):
        missing = missing | quoted(key).isNull()
    return missing


def _because(rows: DataFrame, reason: str) -> DataFrame:
    return rows.withColumn(REJECT_REASON, F.lit(reason))


#: A staged row's number, given when it is first written.
ROW = "__row"


def _numbered(staged: DataFrame) -> DataFrame:
    """Staged rows, written once, each with a number that stays the same from here on."""
    return cut_lineage(staged.withColumn(ROW, F.monotonically_increasing_id()))


def _superseded(rows: DataFrame, used: DataFrame, small: bool) -> DataFrame:
    """The numbered rows that are not among ``used``. Only numbers are moved where these are ``small``."""
    taken = used.select(ROW)
    return match_one(rows, F.broadcast(taken) if small else taken, [ROW], "left_anti", unique=True)


#: A staged row's place among those of its key: 1 is used.
PLACE = "__place"


def _placed(
    staged: DataFrame, keys: Sequence[str], order_by, latest: bool, parent_id: str, hot_parents: HotKeys | None
) -> tuple[DataFrame, HotKeys | None]:
    """All staged rows with their place, for extracts too large to copy, and the hot parents they are spread by.

    Rows are moved once, by the parent's id where that is part of the key, so a join with
    the parents finds them in place. Rows of hot ids are cut into pieces; the first ones of
    a key's pieces meet once more, as many as it has pieces.
    """
    by = [parent_id] if parent_id in keys else list(keys)
    hot = hot_parents if hot_parents is not None and parent_id in keys else find_hot_keys(staged, [f"`{k}`" for k in by])
    rows = spread(staged, by, hot)
    columns = [*by, *([SALT] if hot else []), *[k for k in keys if k not in by]]
    order = _total_order(staged, [c for c in staged.columns if c not in keys], order_by, latest)
    rows = rows.repartition(*[quoted(c) for c in columns[: len(by) + bool(hot)]])
    rows = rows.withColumn(PLACE, F.row_number().over(W.partitionBy(*[quoted(c) for c in columns]).orderBy(*order)))
    if hot:
        rows = cut_lineage(rows)
        first = (F.col(PLACE) == 1) & (hot.count_for([f"`{k}`" for k in by]) > 1) & ~_null_key(staged, keys)
        of_key = W.partitionBy(*[quoted(k) for k in keys]).orderBy(*order)
        rows = rows.where(~first).unionByName(rows.where(first).withColumn(PLACE, F.row_number().over(of_key)))
    if by != [parent_id]:
        return rows.drop(SALT), hot_parents
    return rows, hot


def _refused(placed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows with NULL in the key, and those another one is preferred to."""
    no_key = _null_key(placed, keys)
    reason = F.when(no_key, F.lit(NULL_KEY)).otherwise(F.lit(SUPERSEDED))
    return placed.where(no_key | (F.col(PLACE) > 1)).drop(PLACE).withColumn(REJECT_REASON, reason)


def _used(placed: DataFrame, keys: Sequence[str]) -> DataFrame:
    return placed.where(~_null_key(placed, keys) & (F.col(PLACE) == 1)).drop(PLACE)


def initial_load(
    staged: DataFrame,
    target: DataFrame,
    parents: DataFrame,
    base: int,
    batch_ts: str | datetime,
    layout: Scd2Layout,
    order_by: Sequence[str | Column] | None = None,
    *,
    latest: bool = False,
    parents_unique: bool = False,
    hot_parents: HotKeys | None = None,
) -> Loaded:
    """First versions of natural keys the target does not have.

    Several staged rows of one key are reduced to the first in ``order_by``, or the
    last if ``latest``; without ``order_by`` all of them are loaded. Rows whose parent
    is unknown, rows with NULL in the natural key and rows another one was preferred
    to are returned as rejected, with the reason, and take no surrogate key.
    ``hot_parents`` spreads parent ids that hold a large share of the staged rows.
    """
    keys = require_columns(staged, layout.natural_key, "staged rows")
    if order_by and not fits_broadcast(staged.select(*[quoted(k) for k in keys])):
        return _large_load(staged, target, parents, base, batch_ts, layout, order_by, latest, parents_unique, hot_parents)
    staged = _numbered(staged)
    refused = _because(staged.where(_null_key(staged, keys)), NULL_KEY)
    staged = staged.where(~_null_key(staged, keys))
    # Written once: it is measured, looked up and compared with what it leaves out.
    used = cut_lineage(first_match(staged, keys, order_by, latest)) if order_by else staged
    few = fits_broadcast(used.select(*[quoted(k) for k in keys]))
    if order_by:
        refused = refused.unionByName(_because(_superseded(staged, used, few), SUPERSEDED))
    used, refused = used.drop(ROW), refused.drop(ROW)
    hot = None if few or order_by else find_hot_keys(used, keys)
    # Written once: the new rows are numbered in two passes and split twice.
    new = cut_lineage(insert_only(used, target, keys, small=few, hot=hot, prefilter=True))
    stored = only_matching(target, used, keys) if few else target
    existing = match_one(used, stored, keys, "left_semi", hot=hot)
    accepted, rejected = _with_parent(new, parents, layout, parents_unique, hot_parents)
    return Loaded(_numbered_versions(accepted, base, batch_ts, layout, target), rejected.unionByName(refused), existing)


def _large_load(staged, target, parents, base, batch_ts, layout, order_by, latest, parents_unique, hot_parents) -> Loaded:
    """``initial_load`` of an extract too large to copy: places and parents are found in one shuffle and written once."""
    keys, on = require_columns(staged, layout.natural_key, "staged rows"), [layout.parent_id]
    parents = parents.select(*require_columns(parents, [layout.parent_id, layout.parent], "parents"))
    placed, hot = _placed(staged, keys, order_by, latest, *require_columns(staged, on, "staged rows"), hot_parents)
    joined = match_one(placed, parents, on, "left", order_by=[layout.parent], unique=parents_unique, hot=hot)
    joined = cut_lineage(joined.drop(SALT))
    used = _used(joined, keys)
    stored = target.select(*[quoted(k) for k in require_columns(target, keys, "target")])
    few = fits_broadcast(stored)
    if few:
        stored = F.broadcast(stored.distinct())
        new = match_one(used, stored, keys, "left_anti", unique=True)
    else:
        # Written once: the new rows are numbered in two passes and split twice.
        new = cut_lineage(insert_only(used, stored, keys, prefilter=True))
    existing = match_one(used, stored, keys, "left_semi", unique=few)
    accepted, rejected = resolved(new, staged, parents, on, f"{layout.parent} not found")
    refused = _refused(joined, keys).drop(MATCH)
    return Loaded(
        _numbered_versions(accepted, base, batch_ts, layout, target), rejected.unionByName(refused), existing.drop(MATCH)
    )


def _numbered_versions(accepted, base, batch_ts, layout, target) -> DataFrame:
    ready = _first_versions(accepted, batch_ts, layout, target)
    ready = ready.drop(*without(ready, target.columns))
    keyed = assign_surrogate_keys(ready, base, layout.surrogate, layout.natural_key)
    return align(keyed, target.schema)


def _with_parent(rows, parents, layout, unique, hot=None, small=False):
    parents = parents.select(*require_columns(parents, [layout.parent_id, layout.parent], "parents"))
    # ``rows`` have been written before, so measuring them is cheap. Of several
    # parents of one id the lowest key is used. Both parts are used: the join is
    # written once, so the parents are read once.
    few = small or fits_broadcast(rows.select(quoted(layout.parent_id)))
    return resolve_key(
        rows, parents, [layout.parent_id], [layout.parent], unique=unique, hot=None if few else hot, small=few,
        save=True, reason=f"{layout.parent} not found",
    )


def _first_versions(rows, batch_ts, layout, target) -> DataFrame:
    batch = batch_number(timestamp_literal(batch_ts))
    return rows.withColumns(
        {
            layout.begin: _typed(OPEN_BEGIN, target, layout.begin),
            layout.end: _typed(OPEN_END, target, layout.end),
            layout.current: F.lit(1),
            layout.version: F.lit(1),
            layout.void: F.lit(0),
            layout.ins_batch: batch,
            layout.upd_batch: batch,
        }
    )


def _typed(ts, target, column) -> Column:
    return timestamp_literal(ts).cast(target.schema[column].dataType)


CONTENT = "__content"


def _content(rows: DataFrame, layout: Scd2Layout, like: DataFrame) -> Column:
    """The content columns as one value, with the types they have in ``like``.

    Comparing one value keeps the predicate on one attribute. As 14 separate
    comparisons, Catalyst would derive a constraint for every mix of renamed and
    original columns, which takes it minutes.
    """
    columns = require_columns(rows, layout.content, "rows")
    types = [like.schema[c].dataType for c in require_columns(like, layout.content, "stored rows")]
    return F.struct(*[quoted(c).cast(t).alias(f"c{i}") for i, (c, t) in enumerate(zip(columns, types))])


def new_versions(
    current: DataFrame,
    incoming: DataFrame,
    layout: Scd2Layout,
    batch_ts: str | datetime,
    *,
    changed_only: bool = True,
    effective: str | None = None,
    begin_offset_days: int = 1,
    hot: HotKeys | None = None,
) -> DataFrame:
    """The version following each current row that has an incoming row.

    The new row is the current one overlaid by the incoming one, so a column the
    feed does not have carries over, and so do the keys unless the feed brings
    them. It begins ``begin_offset_days`` after the time of the load (or after
    the staged column ``effective``) and its version is one higher. ``incoming``
    has one row per natural key.
    """
    side = incoming.withColumn(CONTENT, _content(incoming, layout, current)) if changed_only else incoming
    joined = match_one(current, side, layout.natural_key, "inner", unique=True, hot=hot)
    if changed_only:
        joined = joined.where(~_content(current, layout, current).eqNullSafe(F.col(f"{MATCH}.{CONTENT}")))
    return _following(joined, current, incoming, layout, batch_ts, effective, begin_offset_days)


def _following(joined, current, incoming, layout, batch_ts, effective, begin_offset_days) -> DataFrame:
    """New versions from stored rows, the columns of ``current``, with their incoming row as ``__match``."""
    batch = batch_number(timestamp_literal(batch_ts))
    opened = {
        layout.begin: plus_days(_closing_time(batch_ts, effective), begin_offset_days),
        layout.end: timestamp_literal(OPEN_END),
        layout.current: F.lit(1),
        layout.version: quoted(layout.version) + 1,
        layout.void: F.lit(0),
        layout.ins_batch: batch,
        layout.upd_batch: batch,
    }
    feed = incoming.drop(*opened, *([effective] if effective else []))
    typed = {name: value.cast(current.schema[name].dataType) for name, value in opened.items()}
    # Columns only the feed has come last and are left out.
    out = replaced(current, feed, layout.natural_key)[: len(current.columns)]
    return joined.withColumns(typed).selectExpr(*out)


STORED, STAGED, CHANGED = "__stored", "__staged", "__changed"


class Paired(NamedTuple):
    """Stored rows with their staged row as ``__match`` and whether they differ as ``__changed``,
    and staged rows by what became of them: no stored row, none that differs."""

    stored: DataFrame
    unseen: DataFrame
    unchanged: DataFrame


def _paired(stored: DataFrame, staged: DataFrame, layout: Scd2Layout, small: bool, matching: bool = False) -> Paired:
    """Stored and staged rows of a key brought together in one shuffle, and decided there.

    ``staged`` has one row per natural key, ``stored`` any number, none with NULL in the key.
    Both become one frame, tagged by which of two structs is filled; a window over the key
    gives each stored row its staged row, and each staged row the verdict. The result is written
    once, and its parts are read from there. Stored rows whose key is not staged are left
    out before the shuffle: all of them if the staged rows are ``small``, else
    those that a Bloom filter tells; where ``stored`` is known to be ``matching``, there are none.
    """
    keys = require_columns(stored, layout.natural_key, "stored rows")
    theirs = require_columns(staged, layout.natural_key, "staged rows")
    typed = staged.withColumns({t: quoted(t).cast(stored.schema[k].dataType) for k, t in zip(keys, theirs)})
    bare = typed.select(*[quoted(t).alias(k) for k, t in zip(keys, theirs)])
    candidates = stored
    if not matching:
        candidates = only_matching(stored, bare, keys) if small else probably_matching(stored, bare, keys)
    typed = typed.withColumn(CONTENT, _content(staged, layout, stored))
    names = [f"k{i}" for i in range(len(keys))]
    kind = {c: f.dataType.simpleString() for c, f in ((STORED, _struct_type(candidates)), (STAGED, _struct_type(typed)))}
    old = candidates.select(
        *[quoted(k).alias(n) for k, n in zip(keys, names)],
        F.struct(*[quoted(c) for c in candidates.columns]).alias(STORED),
        F.lit(None).cast(kind[STAGED]).alias(STAGED),
    )
    new = typed.select(
        *[quoted(t).alias(n) for t, n in zip(theirs, names)],
        F.lit(None).cast(kind[STORED]).alias(STORED),
        F.struct(*[quoted(c) for c in typed.columns]).alias(STAGED),
    )
    of_key = W.partitionBy(*names)
    both = old.unionAll(new).withColumns(
        {MATCH: F.first(STAGED, ignorenulls=True).over(of_key), "__n": F.count(STORED).over(of_key)}
    )
    content = F.struct(
        *[F.col(STORED)[c].alias(f"c{i}") for i, c in enumerate(require_columns(stored, layout.content, "stored rows"))]
    )
    is_stored = F.col(STORED).isNotNull()
    differs = is_stored & ~content.eqNullSafe(F.col(f"{MATCH}.{CONTENT}"))
    both = both.where(F.col(MATCH).isNotNull()).withColumn(CHANGED, differs)
    both = both.withColumn("__any", F.max(CHANGED).over(of_key))
    both = cut_lineage(both.selectExpr(STORED, f"CASE WHEN {STORED} IS NOT NULL THEN {MATCH} END AS {MATCH}", STAGED, CHANGED, "__n", "__any"))
    columns = [F.col(STORED)[c].alias(c) for c in stored.columns]
    back = both.where(~is_stored).select(*[F.col(STAGED)[c].cast(staged.schema[c].dataType).alias(c) for c in staged.columns], "__n", "__any")
    return Paired(
        both.where(is_stored).select(*columns, MATCH, CHANGED),
        back.where("__n = 0").drop("__n", "__any"),
        back.where("__n > 0 AND NOT __any").drop("__n", "__any"),
    )


def _struct_type(df: DataFrame):
    return T.StructField("s", T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields]))


def _closing_time(batch_ts, effective) -> Column:
    return F.col(f"{MATCH}.`{effective}`") if effective else to_second(timestamp_literal(batch_ts))


def expire(
    target: DataFrame,
    closing: DataFrame,
    layout: Scd2Layout,
    batch_ts: str | datetime,
    *,
    all_versions: bool = False,
    effective: str | None = None,
    small: bool = False,
    mark_void: bool = True,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Close stored versions of the natural keys in ``closing``.

    Only the current version of a key is closed, or with ``all_versions`` every
    one. ``closing`` has one row per key. Where it is known to be ``small`` it is
    copied to the executors and the target is read once without a shuffle;
    otherwise only current rows take part in the join and the history, most of
    the table, goes past it.

    The void flag of every stored row is set from its dates before closing.
    """
    keys = list(layout.natural_key)
    closing = closing.select(*[quoted(c) for c in keys + ([effective] if effective else [])])
    stored = target
    if mark_void:
        stored = target.withColumn(
            layout.void,
            void_flag(layout.begin, layout.end).cast(target.schema[layout.void].dataType),
        )
    values = {
        layout.end: _closing_time(batch_ts, effective),
        layout.current: F.lit(0),
        layout.upd_batch: batch_number(timestamp_literal(batch_ts)),
    }
    is_current = quoted(layout.current) == 1
    is_history = (quoted(layout.current) != 1) | quoted(layout.current).isNull()

    def closed(rows: DataFrame, side: DataFrame) -> DataFrame:
        joined = match_one(rows, side, keys, "left", unique=True, hot=None if small else hot)
        hit = F.col(MATCH).isNotNull() & (F.lit(True) if all_versions else is_current)
        closed_values = {
            name: F.when(hit, value.cast(target.schema[name].dataType)).otherwise(quoted(name))
            for name, value in values.items()
        }
        return joined.withColumns(closed_values).drop(MATCH)

    if small:
        return closed(stored, F.broadcast(closing))
    # Rows with NULL in the key match nothing and would meet in one task.
    no_key = _null_key(stored, keys)
    if all_versions:
        return closed(stored.where(~no_key), closing).unionByName(stored.where(no_key))
    return closed(stored.where(is_current & ~no_key), closing).unionByName(stored.where(is_history | no_key))


def scd2_merge(
    target: DataFrame,
    staged: DataFrame,
    parents: DataFrame,
    base: int,
    batch_ts: str | datetime,
    layout: Scd2Layout,
    order_by: Sequence[str | Column],
    *,
    latest: bool = False,
    compat: str = CORRECTED,
    effective: str | None = None,
    begin_offset_days: int = 1,
    parents_unique: bool = False,
    hot: HotKeys | None = None,
    hot_parents: HotKeys | None = None,
) -> Merged:
    """Close changed versions and add their successors.

    Several staged rows of one natural key are reduced to the first in ``order_by``,
    or the last if ``latest``. ``hot`` spreads natural keys that hold a large share
    of ``target`` (for ``expire_all`` rules, where the history takes part in the
    join), ``hot_parents`` parent ids that hold a large share of ``staged``.

    ``compat`` names a set of ``RULES``. The default closes only what it replaces:
    the current version, if its content differs from the staged one and its parent
    is known. A key whose versions are all closed gets a new one, numbered after the
    last. The others also close unchanged rows and rewrite the end of closed ones, for
    loads that have to agree with that behaviour; they know current versions only.

    Staged keys that are not stored are left to ``initial_load``: they come back as
    rejected with that reason, as do rows with NULL in the key, rows another one was
    preferred to and rows without a parent.
    """
    rules = RULES[compat]
    keys = list(layout.natural_key)
    names = staged.columns

    # Staged rows and what becomes of them are written once each. The target, much
    # larger than both, is read once to find the versions and once to write the
    # result, and is not shuffled for a small load.
    if not fits_broadcast(staged.select(*[quoted(k) for k in require_columns(staged, keys, "staged rows")])):
        placed, _ = _placed(
            staged, require_columns(staged, keys, "staged rows"), order_by, latest,
            *require_columns(staged, [layout.parent_id], "staged rows"), hot_parents,
        )
        placed = cut_lineage(placed.drop(SALT))
        refused, incoming = _refused(placed, keys), _used(placed, keys)
        if rules.number_first:
            incoming = cut_lineage(assign_surrogate_keys(incoming, base, layout.surrogate, keys))
        few = fits_broadcast(incoming)
    else:
        staged = _numbered(staged)
        refused = _because(staged.where(_null_key(staged, keys)), NULL_KEY)
        staged = staged.where(~_null_key(staged, keys))
        incoming = first_match(staged, keys, order_by, latest)
        if rules.number_first:
            incoming = assign_surrogate_keys(incoming, base, layout.surrogate, keys)
        incoming = cut_lineage(incoming)
        few = fits_broadcast(incoming)
        refused = refused.unionByName(_because(_superseded(staged, incoming, few), SUPERSEDED)).drop(ROW)
        incoming = incoming.drop(ROW)
    current = target.where((quoted(layout.current) == 1) & ~_null_key(target, keys))
    paired = _paired(current, incoming, layout, few)
    timing = (layout, batch_ts, effective, begin_offset_days)

    def plain(rows: DataFrame) -> DataFrame:
        return rows.select(*[quoted(c) for c in names])

    unseen, unchanged = paired.unseen, paired.unchanged
    if rules.number_first:
        versions = _following(paired.stored, current, incoming, *timing)
        if rules.compare == "global":
            content = versions.select(*[quoted(c) for c in layout.content])
            versions = cut_lineage(
                content_anti_join(versions, target, layout.content, scope="global", small=fits_broadcast(content))
            )
            seen = _without_rows(incoming, unseen, keys, few)
            unchanged = _without_rows(seen, versions, keys, few)
        else:
            unchanged = unchanged.where("false")
        added, rejected = _with_parent(versions, parents, layout, parents_unique, hot_parents, few)
        closing = incoming.select(*[quoted(c) for c in keys + ([effective] if effective else [])])
        closing_small = few
    else:
        changed = paired.stored if rules.compare == "none" else paired.stored.where(CHANGED)
        versions = _following(changed, current, incoming, *timing)
        history = target.where(((quoted(layout.current) != 1) | quoted(layout.current).isNull()) & ~_null_key(target, keys))
        if not (unseen.isEmpty() or history.isEmpty()):
            if few or fits_broadcast(unseen.select(*[quoted(k) for k in keys])):
                history = only_matching(history, unseen, keys)
            else:
                history = match_one(probably_matching(history, unseen, keys), unseen, keys, "left_semi", unique=True, hot=hot)
            last = first_match(history, keys, [layout.version], latest=True)
            never = None
            if not few:
                # Written once: it is measured, and mostly few of the keys were closed before. Then
                # the other staged rows stay where they are.
                last = cut_lineage(last)
                closed = last.select(*[quoted(k) for k in keys])
                if fits_broadcast(closed):
                    never = match_one(unseen, F.broadcast(closed), keys, "left_anti", unique=True)
                    unseen = only_matching(unseen, closed, keys)
            reopened = _paired(last, unseen, layout, few, matching=True)
            versions = versions.unionByName(_following(reopened.stored, current, incoming, *timing))
            unseen = reopened.unseen.unionByName(never) if never is not None else reopened.unseen
        accepted, rejected = _with_parent(versions, parents, layout, parents_unique, hot_parents, few)
        added = assign_surrogate_keys(accepted, base, layout.surrogate, keys)
        closing = accepted.select(*[quoted(c) for c in keys])
        if effective:
            ended = plus_days(layout.begin, -begin_offset_days).alias(effective)
            closing = accepted.select(*[quoted(c) for c in keys], ended)
        # No more keys than were staged; the rows come from the checkpoint folder, so measuring them is cheap.
        closing_small = few or fits_broadcast(closing)

    added = align(added, target.schema)
    rejected = union_rows(rejected, _because(plain(unseen), NOT_STORED), refused)
    stored = expire(
        target, closing, layout, batch_ts,
        all_versions=rules.expire_all, effective=effective, small=closing_small, hot=hot,
    )
    return Merged(union_rows(stored, added), added, rejected, plain(unchanged), closing)


def _without_rows(rows: DataFrame, others: DataFrame, keys: Sequence[str], small: bool) -> DataFrame:
    """Rows whose key ``others`` do not have; both hold staged keys only."""
    others = others.select(*[quoted(k) for k in keys])
    return match_one(rows, F.broadcast(others.distinct()) if small else others, keys, "left_anti", unique=small)
