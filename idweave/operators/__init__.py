"""DataFrame operators of the identifier job."""

from .allocations import dedup_allocations, filter_allocations
from .asof import previous_snapshot, previous_snapshot_by_key
from .audit import duplicate_keys, observe_count, stage_counts
from .enrich import audit_missing, join_reference, join_snapshot, with_file_days
from .ids import assign_ids, dense_index
from .intervals import compress_snapshots, expand_intervals, join_intervals, snapshot_calendar
from .registry import registered_ids
from .setops import union_snapshots
from .skew import hot_keys, salted_join
from .symbols import (ServiceFailed, attach_symbols, batch_requests, lookup_symbols,
                      lookup_with_ledger, lookup_with_service,
                      merge_responses, sedol_requests, symbol_requests, ticker_requests,
                      valid_requests)

__all__ = [
    "dedup_allocations", "filter_allocations", "previous_snapshot", "previous_snapshot_by_key",
    "observe_count", "stage_counts", "duplicate_keys", "audit_missing", "join_reference", "join_snapshot",
    "assign_ids", "dense_index", "registered_ids",
    "snapshot_calendar", "compress_snapshots", "expand_intervals", "join_intervals", "union_snapshots", "hot_keys", "salted_join", "attach_symbols", "batch_requests",
    "lookup_symbols", "lookup_with_service",
    "lookup_with_ledger", "ServiceFailed", "merge_responses", "sedol_requests",
    "ticker_requests", "valid_requests", "symbol_requests",
]
