from millrace.operators.cleanse import (
    derive_partitions,
    drop_empty_rows,
    normalize_column_names,
    standardize_boolean,
    standardize_nulls,
    trim_whitespace,
)
from millrace.operators.clustering import cluster_by, curve_position
from millrace.operators.dedup import hash_dedup, remove_duplicates, window_dedup
from millrace.operators.differences import bucket_checksums, reconcile_rows
from millrace.operators.evolution import conform, merged_schema, read_generations, wider
from millrace.operators.history import as_of_join, failure_episodes, version_history
from millrace.operators.ledger import (
    append_log_events,
    append_run_events,
    compact_ledger,
    incremental_filter,
    last_success,
    logged_events,
    read_event_log,
    read_ledger,
    run_intervals,
    run_metrics,
    run_state,
)
from millrace.operators.lookup import enrich, enrich_hot, hot_keys
from millrace.operators.profiles import (
    merged_profile,
    partition_profiles,
    profile_gate,
    read_profiles,
    refresh_profiles,
)
from millrace.operators.quality import (
    failed_checks,
    null_rates,
    profile,
    quality_gate,
    reconcile,
    reconcile_lines,
    row_count_check,
    uniqueness,
)
from millrace.operators.schema import (
    cast_to_schema,
    contract_gate,
    contract_violations,
    drift_report,
    load_fields,
    schema_drift,
    schema_from_spec,
)

__all__ = [
    "append_log_events",
    "append_run_events",
    "as_of_join",
    "bucket_checksums",
    "cast_to_schema",
    "cluster_by",
    "compact_ledger",
    "conform",
    "contract_gate",
    "contract_violations",
    "curve_position",
    "derive_partitions",
    "drift_report",
    "drop_empty_rows",
    "enrich",
    "enrich_hot",
    "failed_checks",
    "failure_episodes",
    "hash_dedup",
    "hot_keys",
    "incremental_filter",
    "last_success",
    "load_fields",
    "logged_events",
    "merged_profile",
    "merged_schema",
    "normalize_column_names",
    "null_rates",
    "partition_profiles",
    "profile",
    "profile_gate",
    "quality_gate",
    "read_event_log",
    "read_generations",
    "read_ledger",
    "read_profiles",
    "reconcile",
    "reconcile_lines",
    "reconcile_rows",
    "refresh_profiles",
    "remove_duplicates",
    "row_count_check",
    "run_intervals",
    "run_metrics",
    "run_state",
    "schema_drift",
    "schema_from_spec",
    "standardize_boolean",
    "standardize_nulls",
    "trim_whitespace",
    "uniqueness",
    "version_history",
    "wider",
    "window_dedup",
]
