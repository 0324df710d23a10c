from .lease import Lease, LeaseHeld, LeaseLost, lease
from .scratch import cut_lineage, scratch_dir
from .tables import (
    TableMissing,
    append,
    partition_columns,
    recover,
    replace,
    replace_open,
    require_table,
    rewrite_rows,
    scan,
)

__all__ = [
    "Lease",
    "LeaseHeld",
    "LeaseLost",
    "TableMissing",
    "append",
    "cut_lineage",
    "lease",
    "partition_columns",
    "recover",
    "replace",
    "replace_open",
    "require_table",
    "rewrite_rows",
    "scan",
    "scratch_dir",
]
