"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8)
the cores of the local session, BENCH_QUERIES a comma-separated choice of queries.
"""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import QUERIES  # noqa: E402
from flowatlas.session import local_session  # noqa: E402

HEADLINE = [
    "document_profile",
    "parse_event_props",
    "flagship",
    "extract_workflows",
    "extract_activities",
    "extract_dependencies",
    "extract_dependencies_staged",
    "activity_lookup_last_wins",
    "quarantine_documents",
    "extract_counts",
    "duplicate_keys",
    "dedupe_by_key",
    "validate_unique",
    "change_counts",
    "rows_changed_except",
    "merge_upsert",
    "sync_table",
    "sync_table_bucketed",
    "sync_all_tables",
    "version_diff",
    "incremental_ingest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/nation.parquet").count()  # start the session before timing
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    sf = Path(sf_dir).name.removeprefix("sf")
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {"metric": "total query time", "value": total, "unit": "sec", "queries": seconds, "sf": float(sf)}
        )
    )


if __name__ == "__main__":
    main()
