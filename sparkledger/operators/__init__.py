"""Relational operators the pipelines are built from."""

from sparkledger.operators.align import align_events, period_cutoffs
from sparkledger.operators.diff import new_rows, updated_rows
from sparkledger.operators.lookup import (
    asset_map,
    key_subset,
    lookup_scalar,
    map_values,
    reattach_key,
    to_period_id,
)
from sparkledger.operators.quality import PayloadStatusError, key_metrics, observed, require_status, split_null_keys
from sparkledger.operators.ranking import (
    keep_first,
    keep_last,
    nth_latest,
    sequence_within,
    top_k_per_key,
    with_row_index,
)
from sparkledger.operators.shape import add_constants, apply_schema, blank_to_null, common_columns, drop_null_rows
from sparkledger.operators.union import stack, stack_diagonal, supertype
from sparkledger.operators.upsert import append, next_id, update_non_null, upsert

__all__ = [
    "PayloadStatusError", "add_constants", "align_events", "append", "apply_schema", "asset_map", "blank_to_null",
    "common_columns", "drop_null_rows", "keep_first", "keep_last",
    "key_metrics", "key_subset", "observed", "lookup_scalar", "map_values", "new_rows", "nth_latest",
    "period_cutoffs", "reattach_key", "require_status", "sequence_within", "split_null_keys",
    "stack", "stack_diagonal", "supertype", "to_period_id", "top_k_per_key", "update_non_null",
    "updated_rows", "upsert", "with_row_index",
]
