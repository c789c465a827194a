from flowatlas.plans.extraction import extract_all, first_document
from flowatlas.plans.naming import DATASET_PREFIX, arrival_path, dataset_name, table_name
from flowatlas.plans.outputs import create_views, write_json_tables
from flowatlas.plans.sync import SyncResult, summary, sync_all, sync_table, total_summary, validate_all

__all__ = [
    "DATASET_PREFIX",
    "SyncResult",
    "arrival_path",
    "create_views",
    "dataset_name",
    "extract_all",
    "first_document",
    "summary",
    "sync_all",
    "sync_table",
    "table_name",
    "total_summary",
    "validate_all",
    "write_json_tables",
]
