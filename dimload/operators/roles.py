"""Foreign keys chosen by the role of the referenced row, with a fallback."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import cut_lineage
from .joins import MATCH, fits_broadcast, match_one, quoted, require_columns
from .skew import HotKeys


def pick_by_role(
    rows: DataFrame,
    key: str,
    value: str,
    role: str,
    roles: Sequence[str],
    order_by: Sequence[str | Column] | None = None,
    within: str | None = None,
) -> DataFrame:
    """One row per key (and ``within``) with the value of each role's first row, NULL if none.

    Without ``order_by`` the largest value of a role is taken: with surrogate
    keys as values, the row added last.

    One conditional aggregation instead of one scan and join per role. Rows are
    combined before the shuffle, so the hottest key sends one row per task.
    """
    key, value, role = require_columns(rows, [key, value, role], "role rows")
    order = F.struct(*[quoted(o) if isinstance(o, str) else o for o in order_by]) if order_by else None

    def pick(r: str) -> Column:
        mine = quoted(role) == r
        if order is None:
            return F.max(F.when(mine, quoted(value)))
        return F.min_by(F.when(mine, quoted(value)), F.when(mine, order))

    return (
        rows.where(quoted(role).isin(list(roles)))
        .groupBy(*([quoted(within)] if within else []), quoted(key))
        .agg(*[pick(r).alias(f"__role{i}") for i, r in enumerate(roles)])
    )


def role_keys(
    target: DataFrame,
    rows: DataFrame,
    key: str,
    value: str,
    role: str,
    assign: Mapping[str, Sequence[str]],
    order_by: Sequence[str | Column] | None = None,
    stamp: Mapping[str, Column] | None = None,
    within: str | None = None,
    hot: HotKeys | Callable[[], HotKeys] | None = None,
) -> DataFrame:
    """Set foreign keys of ``target`` from the roles of ``rows``.

    ``assign`` lists, for each target column, the roles that may fill it, best
    first. A column none of whose roles exists stays as it is. ``stamp`` sets
    further columns in every target row that has at least one of the roles.

    ``within`` names a column of both sides that ``key`` determines, such as the
    business key behind a surrogate key. Rows are then brought together by it,
    so a target just joined on ``within`` is not shuffled again. ``hot`` spreads
    frequent values of ``within`` (or ``key``) in the target. As a function it is called only
    if it is needed: the picked roles are written and measured first, and where they can be
    copied to the executors the target stays in place.
    """
    roles = list(dict.fromkeys(r for choices in assign.values() for r in choices))
    picked = pick_by_role(rows, key, value, role, roles, order_by, within)
    if callable(hot):
        picked = cut_lineage(picked)
        small = fits_broadcast(picked)
        picked, hot = (F.broadcast(picked), None) if small else (picked, hot())
    if within:
        joined = match_one(target, picked, [within], "left", unique=True, also_equal=[key], hot=hot)
    else:
        joined = match_one(target, picked, [key], "left", unique=True, hot=hot)
    slot = {r: F.col(f"{MATCH}.__role{i}") for i, r in enumerate(roles)}
    filled = {
        column: F.coalesce(*[slot[r] for r in choices], quoted(column)) for column, choices in assign.items()
    }
    for column, stamped in (stamp or {}).items():
        filled[column] = F.when(F.col(MATCH).isNotNull(), stamped).otherwise(quoted(column))
    return joined.withColumns(_typed(target, filled)).drop(MATCH)


def _typed(target: DataFrame, values: Mapping[str, Column]) -> dict[str, Column]:
    names = require_columns(target, list(values), "target")
    return {n: v.cast(target.schema[n].dataType) for n, v in zip(names, values.values())}
