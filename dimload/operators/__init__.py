from .bloom import bloom_filter, probably_matching
from .joins import first_match, fits_broadcast, match_one, only_matching
from .keys import advance_registry, assign_surrogate_keys, largest_key, row_numbers
from .lookup import (
    REJECT_REASON,
    Resolved,
    content_anti_join,
    content_digest,
    insert_only,
    lookup_overlay,
    registry_base,
    resolve_key,
    with_registry_base,
)
from .overlay import Feed, overlay, overlay_chain, refresh, settle, settle_all
from .roles import pick_by_role, role_keys
from .scd2 import Loaded, Merged, Scd2Layout, expire, initial_load, new_versions, scd2_merge
from .shape import (
    align,
    changed_rows,
    distinct_keys,
    project,
    union_rows,
    upsert_replace,
    without_copies,
    without_keys,
)
from .skew import HotKeys, find_hot_keys, spread

__all__ = [
    "REJECT_REASON",
    "Feed",
    "HotKeys",
    "Loaded",
    "Merged",
    "Resolved",
    "Scd2Layout",
    "advance_registry",
    "align",
    "assign_surrogate_keys",
    "bloom_filter",
    "changed_rows",
    "content_anti_join",
    "content_digest",
    "distinct_keys",
    "expire",
    "find_hot_keys",
    "first_match",
    "fits_broadcast",
    "initial_load",
    "insert_only",
    "largest_key",
    "lookup_overlay",
    "match_one",
    "new_versions",
    "only_matching",
    "overlay",
    "overlay_chain",
    "pick_by_role",
    "probably_matching",
    "project",
    "refresh",
    "registry_base",
    "resolve_key",
    "role_keys",
    "row_numbers",
    "scd2_merge",
    "settle",
    "settle_all",
    "spread",
    "union_rows",
    "upsert_replace",
    "with_registry_base",
    "without_copies",
    "without_keys",
]
