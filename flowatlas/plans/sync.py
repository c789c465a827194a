"""Bring stored tables into line with new extracts, one version per sync."""

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import partial, reduce
from operator import and_

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from flowatlas.functions import pack_columns, text_columns, unpack_columns
from flowatlas.operators.changes import (
    ACTION,
    INSERT,
    KEY_ROWS,
    NULL_KEY,
    SAME,
    STAMPED,
    append_rows,
    apply_changes,
    classify,
    count_columns,
    keys_counted,
    null_keyed,
    repeated_key,
    with_keys,
)
from flowatlas.operators.quality import DuplicateKeysError, check_unique, dedupe_by_key, duplicate_keys
from flowatlas.plans.naming import dataset_name
from flowatlas.plans.together import run_together
from flowatlas.schemas import TABLE_IDS, TABLE_KEYS
from flowatlas.sources import groups, snapshots

STRATEGIES = ("upsert", "append", "replace")


@dataclass(frozen=True)
class SyncResult:
    """What a sync wrote, and the rows it did not take."""

    path: str
    version: int
    counts: dict[str, int]
    null_keyed: DataFrame
    duplicates: DataFrame


def sync_table(
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    strategy: str = "upsert",
    on_duplicate: str = "raise",
    order_by: Sequence[str] | None = None,
    ignore_columns: Sequence[str] = STAMPED,
    null_safe: bool = True,
    delete_missing: bool = True,
    delete_scope: DataFrame | None = None,
    run_ts: datetime | None = None,
    batch_id: int | None = None,
    day_column: str | None = None,
    buckets: int | None = None,
    stream_id: str | None = None,
    id_columns: Sequence[str] = (),
) -> SyncResult:
    """Write the next version of the table at `path`.

    Order: keys are checked, NULL keys set aside (by every strategy), both sides joined
    once, the result written once. The counts are observed on the rows as they are written.

    With `on_duplicate="raise"` the rows of each key are counted on their way to the write, so
    the source runs once. If a key repeats, the version is not committed and its files go: the
    table stays as it was.

    `day_column` partitions the files by the day of a timestamp; `buckets` buckets them
    by the keys. A table keeps the layout it has. Stored keys may repeat after an append or
    a plain write; the next upsert keeps the first row of each, by its other columns.

    `id_columns` are columns beside the keys that hold SHA-256 ids or NULL, and so may move
    packed like the keys: their order is the same. Of other texts in them, the ids come first.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy is one of {STRATEGIES}, not {strategy!r}")
    spark = source.sparkSession
    entry = snapshots.latest_entry(spark, path)
    target = source.limit(0) if entry is None else snapshots.read_entry(spark, path, entry)
    moves = strategy == "upsert" and on_duplicate == "dedupe" and order_by is None and delete_scope is None
    layout = snapshots.Buckets(buckets, list(keys)) if buckets else snapshots.buckets_of(entry)
    # files in buckets are of the plain keys
    texts = _text_columns([*keys, *id_columns], source, target) if moves and not layout else []
    if strategy == "append":
        unique, duplicates = source, duplicate_keys(source, keys)
    elif texts:
        unique, duplicates = dedupe_by_key(pack_columns(source, texts), keys, order_by), duplicate_keys(source, keys)
    elif on_duplicate == "raise":
        unique, duplicates = keys_counted(source, keys), duplicate_keys(source, keys)
    else:
        unique, duplicates = check_unique(source, keys, on_duplicate, order_by)
    rejected = null_keyed(source, keys)
    if KEY_ROWS not in unique.columns:
        unique = with_keys(unique, keys)
    if entry is not None and not buckets and not day_column:
        day_column = entry["day_column"]
    if layout and day_column:
        raise ValueError("a table is either bucketed or partitioned by day")
    # An absent table is known to be empty when planned, so the first sync has no join.
    target = pack_columns(target, texts)
    if entry is not None and strategy == "upsert" and entry["operation"] != "upsert":
        stored = dedupe_by_key(with_keys(target, keys), keys)
        target = stored.unionByName(null_keyed(target, keys))
    if strategy == "upsert":
        changes = classify(
            target, unique, keys, ignore_columns, null_safe, delete_missing, delete_scope
        )
        changes = unpack_columns(changes, texts)
    elif strategy == "append":
        kept = target.withColumn(ACTION, F.lit(SAME))
        changes = append_rows(kept, unique.withColumn(ACTION, F.lit(INSERT)))
    else:
        whole = reduce(and_, [F.col(k).isNotNull() for k in keys])
        changes = unique.withColumn(ACTION, F.when(whole, F.lit(INSERT)).otherwise(F.lit(NULL_KEY)))
    if day_column:
        changes = snapshots.by_day(changes, day_column)
    elif layout and (entry is None or strategy != "upsert"):
        changes = changes.repartition(layout.count, *layout.keys)
    version = 0 if entry is None else entry["version"] + 1
    counts, repeated = _write_counted(changes, path, keys, version, layout, day_column)
    if repeated is not None:
        snapshots.discard_data(spark, path, version)
        raise DuplicateKeysError(f"duplicate key {json.loads(repeated)}")
    snapshots.commit_version(
        spark, path, version, strategy, counts, run_ts, batch_id, layout, stream_id, day_column
    )
    return SyncResult(path, version, counts, rejected, duplicates)


def _text_columns(columns: Sequence[str], *sides: DataFrame) -> list[str]:
    """Those of the columns that are text on every side: they move packed, and are compared so."""
    return [c for c in columns if all(c in text_columns(side) for side in sides)]


def _write_counted(
    changes: DataFrame,
    path: str,
    keys: Sequence[str],
    version: int,
    layout: snapshots.Buckets | None,
    day_column: str | None,
) -> tuple[dict[str, int], str | None]:
    """The counts, and a key that repeats as JSON where the rows of each are counted."""
    # Nothing is shuffled between the observation and the write, so the counts come
    # from the tasks that commit the files, each taken once however often it is retried.
    seen = Observation()
    gate = [repeated_key(keys).alias("repeated")] if KEY_ROWS in changes.columns else []
    observed = changes.observe(seen, *count_columns(), *gate)
    snapshots.write_data(apply_changes(observed), path, version, layout, day_column)
    return {name: int(seen.get[name]) for name in snapshots.COUNTS}, seen.get["repeated"] if gate else None


def validate_all(
    tables: Mapping[str, DataFrame],
    keys: Mapping[str, Sequence[str]] = TABLE_KEYS,
    on_duplicate: str = "dedupe",
) -> dict[str, tuple[DataFrame, DataFrame]]:
    """`(rows with unique keys, report of duplicates)` of every table."""
    if on_duplicate != "dedupe":
        return {name: check_unique(df, keys[name], on_duplicate) for name, df in tables.items()}
    found = {}
    for name, df in tables.items():
        texts = _text_columns(keys[name], df)
        both = check_unique(pack_columns(df, texts), keys[name], on_duplicate)
        found[name] = tuple(unpack_columns(part, texts) for part in both)
    return found


def sync_all(
    tables: Mapping[str, DataFrame],
    root: str,
    keys: Mapping[str, Sequence[str]] = TABLE_KEYS,
    on_duplicate: str = "dedupe",
    delete_scopes: Mapping[str, DataFrame] | None = None,
    id_columns: Mapping[str, Sequence[str]] = TABLE_IDS,
    **options,
) -> dict[str, SyncResult]:
    """Check and sync every table below `root`; see `sync_table` for the options.

    When all are written they become visible together, see `sources.read_group`.
    """
    scopes = delete_scopes or {}
    if not tables:
        return {}
    spark = next(iter(tables.values())).sparkSession
    results = run_together(
        spark,
        {
            name: partial(
                sync_table,
                df,
                f"{root}/{dataset_name(name)}",
                keys[name],
                on_duplicate=on_duplicate,
                delete_scope=scopes.get(name),
                id_columns=id_columns.get(name, ()),
                **options,
            )
            for name, df in tables.items()
        },
    )
    versions = {name: (dataset_name(name), result.version) for name, result in results.items()}
    groups.commit_group(spark, root, versions, options.get("run_ts"))
    return results


def summary(spark: SparkSession, results: Mapping[str, SyncResult]) -> DataFrame:
    """One row per table: name, version and counts."""
    rows = [
        (name, result.version, *[result.counts[c] for c in snapshots.COUNTS])
        for name, result in results.items()
    ]
    counts = ", ".join(f"{c} BIGINT" for c in snapshots.COUNTS)
    return spark.createDataFrame(rows, f"table STRING, version BIGINT, {counts}")


def total_summary(per_table: DataFrame) -> DataFrame:
    """One row: the counts added up over all tables."""
    return per_table.agg(*[F.sum(c).alias(c) for c in snapshots.COUNTS])
