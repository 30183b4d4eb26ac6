from .advice import partition_advice
from .checksums import KeyDifference, key_difference
from .diff import bag_minus, set_minus
from .enforce import append_evolve, enforce_schema, uncastable_rows
from .latest import latest_per_key
from .layout import (cluster, compact_files, file_inventory, largest_file, partition_counts,
                     publish_partitioned, zorder_layout)
from .merge import merge_newer_wins, merge_upsert
from .quality import amount_consistent, check_constraints, constraint_violations
from .rows import active_rows, delete_where, update_where
from .zones import ZoneMap, file_zones

__all__ = [
    "KeyDifference", "ZoneMap", "file_zones", "key_difference", "partition_advice",
    "active_rows", "amount_consistent", "append_evolve", "bag_minus", "check_constraints",
    "cluster", "compact_files", "constraint_violations", "delete_where", "enforce_schema",
    "file_inventory", "largest_file", "latest_per_key", "merge_newer_wins", "merge_upsert",
    "partition_counts", "publish_partitioned", "set_minus", "uncastable_rows", "update_where",
    "zorder_layout",
]
