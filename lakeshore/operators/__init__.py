"""Table-level operators built from DataFrame transformations."""

from lakeshore.operators.incremental import (
    commit_mark,
    committed_mark,
    high_water_mark,
    mark_frame,
    newer_than,
    newer_than_target,
)
from lakeshore.operators.nesting import explode_items, inline_items, map_by_key, nest, unnest
from lakeshore.operators.reconcile import (
    ReconcilePair,
    count_reconciliation,
    key_reconciliation,
    missing_keys,
    run_gate,
    validation_gate,
)
from lakeshore.operators.upsert import (
    DuplicateKeyError,
    check_no_matched_duplicates,
    drop_old_versions,
    duplicated_keys,
    keep_unmatched,
    matched_duplicate_keys,
    merge_frames,
    overwrite_table,
    rebucket_table,
    upsert_table,
)

__all__ = [
    "DuplicateKeyError",
    "ReconcilePair",
    "check_no_matched_duplicates",
    "commit_mark",
    "committed_mark",
    "count_reconciliation",
    "drop_old_versions",
    "duplicated_keys",
    "keep_unmatched",
    "explode_items",
    "high_water_mark",
    "inline_items",
    "key_reconciliation",
    "map_by_key",
    "mark_frame",
    "matched_duplicate_keys",
    "merge_frames",
    "missing_keys",
    "nest",
    "newer_than",
    "newer_than_target",
    "overwrite_table",
    "rebucket_table",
    "run_gate",
    "unnest",
    "upsert_table",
    "validation_gate",
]
