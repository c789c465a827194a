from flowatlas.operators.calls import call_closure, direct_calls
from flowatlas.operators.changes import (
    ACTION,
    apply_changes,
    append_rows,
    change_counts,
    changed,
    classify,
    column_changes,
    count_deleted,
    count_inserted,
    keep_present,
    keys_counted,
    null_keyed,
    rows_changed,
)
from flowatlas.operators.extract import (
    activities,
    activity_lookup,
    counts,
    counts_per_document,
    dependencies,
    pipelines,
)
from flowatlas.operators.quality import (
    DuplicateKeysError,
    check_unique,
    dedupe_by_key,
    duplicate_keys,
    key_collisions,
    profile,
)

__all__ = [
    "ACTION",
    "DuplicateKeysError",
    "activities",
    "activity_lookup",
    "append_rows",
    "apply_changes",
    "call_closure",
    "change_counts",
    "changed",
    "check_unique",
    "classify",
    "column_changes",
    "count_deleted",
    "count_inserted",
    "counts",
    "counts_per_document",
    "dedupe_by_key",
    "dependencies",
    "direct_calls",
    "duplicate_keys",
    "keep_present",
    "key_collisions",
    "keys_counted",
    "null_keyed",
    "pipelines",
    "profile",
    "rows_changed",
]
