"""Sources and sinks: stored tables, landing payloads, the snapshot store."""

from sparkledger.sources.json_array import array_texts, read_array
from sparkledger.sources.landing import (
    BROKEN,
    FETCHED,
    explode_series,
    fan_out,
    first_match,
    landed_texts,
    newest_fetch,
    newest_per_symbol,
    parse_payload_column,
    parse_records,
    read_landed,
    read_payload,
    read_series,
    screen,
    since,
    undated,
    unlisted_fields,
)
from sparkledger.sources.store import CommitConflict, SnapshotStore
from sparkledger.sources.tables import (
    describe_columns,
    list_tables,
    read_jdbc,
    read_table,
    records_to_df,
    small_rows,
    table_handle,
)

__all__ = [
    "BROKEN", "CommitConflict", "FETCHED", "SnapshotStore", "array_texts", "describe_columns", "explode_series", "fan_out", "first_match",
    "landed_texts", "list_tables", "newest_fetch", "newest_per_symbol", "parse_payload_column", "parse_records", "read_array", "read_jdbc",
    "read_landed", "read_payload", "read_series", "read_table", "records_to_df", "screen", "since", "small_rows", "table_handle",
    "undated", "unlisted_fields",
]
