from flowatlas.sources.documents import (
    document_profile,
    filter_paths,
    json_files,
    list_files,
    read_documents,
)
from flowatlas.sources.groups import commit_group, group_history, group_versions, read_group
from flowatlas.sources.parse import (
    parse_documents,
    rejected_documents,
    require_valid,
    stage,
    valid_documents,
)
from flowatlas.sources.snapshots import (
    create_if_absent,
    drop_versions,
    forget_version,
    history,
    latest_version,
    read_apart,
    read_days,
    read_snapshot,
    write_snapshot,
)

__all__ = [
    "commit_group",
    "create_if_absent",
    "document_profile",
    "drop_versions",
    "filter_paths",
    "forget_version",
    "group_history",
    "group_versions",
    "history",
    "json_files",
    "latest_version",
    "list_files",
    "parse_documents",
    "read_apart",
    "read_days",
    "read_documents",
    "read_group",
    "read_snapshot",
    "rejected_documents",
    "require_valid",
    "stage",
    "valid_documents",
    "write_snapshot",
]
