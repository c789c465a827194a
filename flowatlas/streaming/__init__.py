from flowatlas.streaming.arrivals import (
    arrival_summary,
    ingest_arrivals,
    rejected_arrivals,
    remove_vanished,
    sync_batch,
)

__all__ = ["arrival_summary", "ingest_arrivals", "rejected_arrivals", "remove_vanished", "sync_batch"]
