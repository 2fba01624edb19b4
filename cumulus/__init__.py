"""Snapshot-delta analytics on Spark: month-to-date counters -> increments -> mart -> reconciliation.

The public API, re-exported here::

    from cumulus import snapshot_delta, build_mart, reconcile, missing_files
"""

from .operators.delta import delta_pair, snapshot_delta
from .operators.dims import groups_dim, keep_listed, lookup, map_dim, read_json_map, unmapped
from .operators.joins import bounded_broadcast, join_null_safe
from .operators.mart import audit_totals, build_mart, month_to_date
from .operators.master import drop_run, replace_and_append, write_run_partition
from .operators.quality import (
    completeness_totals,
    header_audit,
    keep_last_per_target,
    missing_files,
    read_manifest,
    rescrape_targets,
    status_counts,
    targets_per_state,
)
from .operators.reconcile import apply_corrections, filler_rows, monthly_summary, reconcile
from .operators.reshape import add_missing, pivot_long, union_aligned, unpivot_wide
from .operators.snapshots import latest_by, latest_pair, require_snapshots, restrict_to_latest_pair, snapshot_index
from .session import build_session, ensure_checkpoint_dir, materialize
from .sources.files import observed, read_csv_export, read_snapshot_csv, write_csv_export, write_table
from .sources.reports import consolidate_reports, read_report_rows
from .streaming.incremental import run_incremental

__all__ = [
    "add_missing", "apply_corrections", "audit_totals", "bounded_broadcast", "build_mart", "build_session",
    "completeness_totals", "consolidate_reports", "delta_pair", "drop_run", "ensure_checkpoint_dir", "filler_rows",
    "groups_dim", "header_audit", "join_null_safe", "keep_last_per_target", "keep_listed", "latest_by", "latest_pair",
    "lookup", "map_dim", "materialize", "missing_files", "month_to_date", "monthly_summary", "observed", "pivot_long",
    "read_csv_export", "read_json_map", "read_manifest", "read_report_rows", "read_snapshot_csv", "reconcile",
    "replace_and_append", "require_snapshots", "rescrape_targets", "restrict_to_latest_pair", "run_incremental",
    "snapshot_delta", "snapshot_index", "status_counts", "targets_per_state", "union_aligned", "unmapped",
    "unpivot_wide", "write_csv_export", "write_run_partition", "write_table",
]
