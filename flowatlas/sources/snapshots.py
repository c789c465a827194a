"""Versioned Parquet tables.

    <table>/data/version=N/       the rows of version N
    <table>/history/version=N/    one row about version N, written last

A version exists once its history row does: a run lost half-way leaves data that no
reader sees and that the next run overwrites. One writer per table is assumed.

A table may be bucketed by its keys. A sync then reads it without a shuffle: only the
new rows move to the buckets. Take as many buckets as `spark.sql.shuffle.partitions`,
so that the join writes one file per bucket. Spark knows buckets of catalog tables only,
so every bucketed version is an external table of the current database as well.
"""

import json
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime
from hashlib import sha256

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import StructType

HISTORY = (
    "operation STRING, run_ts TIMESTAMP, stream_id STRING, batch_id BIGINT, inserted BIGINT, "
    "updated BIGINT, deleted BIGINT, unchanged BIGINT, bucket_count INT, "
    "bucket_keys ARRAY<STRING>, day_column STRING, slice_count INT, slices MAP<INT, BIGINT>, "
    "slice_bytes MAP<INT, BIGINT>, slice_schema STRING, slice_widest MAP<INT, BIGINT>, version BIGINT"
)
COUNTS = ["inserted", "updated", "deleted", "unchanged"]
# Private columns of tables in slices: see plans.sliced.
SLICE, WORKFLOW = "_slice", "_workflow"
# Half of a row are ids in hex, which the default codec leaves as they are.
CODEC = "zstd"
# Private partition column of a table that is partitioned by day.
DAY = "_partition_day"


@dataclass(frozen=True)
class Buckets:
    count: int
    keys: Sequence[str]


@dataclass(frozen=True)
class Slices:
    """How many there are, which version holds each, its bytes, and the schema of the rows as JSON.

    `widest` bounds the bytes of the largest document in each slice, None where that is not known.
    """

    count: int
    held: dict[int, int]
    sizes: dict[int, int]
    schema: str
    widest: dict[int, int] | None = None


def data_path(table: str, version: int) -> str:
    return f"{table}/data/version={version}"


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def history(spark: SparkSession, table: str) -> DataFrame:
    """One row per finished version; empty for a table that does not exist."""
    folder = f"{table}/history"
    if not exists(spark, folder):
        return spark.createDataFrame([], HISTORY)
    return spark.read.schema(HISTORY).parquet(folder)


def latest_version(spark: SparkSession, table: str) -> int | None:
    """Number of the newest finished version, or None."""
    entry = latest_entry(spark, table)
    return entry["version"] if entry else None


def latest_entry(spark: SparkSession, table: str) -> Row | None:
    """History row of the newest finished version, or None; no other row is read."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{table}/history")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return None
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    numbers = [int(name.removeprefix("version=")) for name in names if name.startswith("version=")]
    # an unfinished version has a folder without a row
    return next(filter(None, (version_entry(spark, table, n) for n in sorted(numbers, reverse=True))), None)


def version_entry(spark: SparkSession, table: str, version: int) -> Row | None:
    """History row of a finished version, or None."""
    folder = f"{table}/history"
    if not exists(spark, f"{folder}/version={version}"):
        return None
    rows = spark.read.schema(HISTORY).option("basePath", folder).parquet(f"{folder}/version={version}")
    return rows.first()


def buckets_of(entry: Row | None) -> Buckets | None:
    if entry is None or entry["bucket_count"] is None:
        return None
    return Buckets(entry["bucket_count"], entry["bucket_keys"])


def last_batch(spark: SparkSession, table: str, stream_id: str | None = None) -> int | None:
    """Highest micro-batch number of this stream already written, or None."""
    own = history(spark, table).filter(F.col("stream_id").eqNullSafe(F.lit(stream_id)))
    return own.agg(F.max("batch_id")).first()[0]


def version_before_batch(
    spark: SparkSession, table: str, batch_id: int, stream_id: str | None = None
) -> int | None:
    """Newest version that does not come from this micro-batch of this stream, or None."""
    own = F.col("batch_id").eqNullSafe(batch_id) & F.col("stream_id").eqNullSafe(F.lit(stream_id))
    return history(spark, table).filter(~own).agg(F.max("version")).first()[0]


def read_snapshot(
    spark: SparkSession, table: str, version: int | None = None, keep_day: bool = False
) -> DataFrame:
    """Rows of a version, by default of the newest."""
    entry = latest_entry(spark, table) if version is None else version_entry(spark, table, version)
    if entry is None:
        raise ValueError(f"no finished version {'' if version is None else version} in {table}")
    return read_entry(spark, table, entry, keep_day)


def read_entry(spark: SparkSession, table: str, entry: Row, keep_day: bool = False) -> DataFrame:
    """Rows of the version that a history row is about."""
    if entry["slice_count"] is not None:
        return read_slices(spark, table, entry).drop(WORKFLOW)
    path = data_path(table, entry["version"])
    buckets = buckets_of(entry)
    if buckets:
        return _bucketed(spark, path, buckets)
    rows = spark.read.parquet(path)
    return rows if keep_day else rows.drop(DAY)


def read_days(
    spark: SparkSession, table: str, first: date, last: date, version: int | None = None
) -> DataFrame:
    """Rows of a version whose day lies in the range; other days' files are not read."""
    rows = read_snapshot(spark, table, version, keep_day=True)
    if DAY not in rows.columns:
        raise ValueError(f"{table} is not partitioned by day")
    return rows.filter(F.col(DAY).between(F.lit(first), F.lit(last))).drop(DAY)


def read_slices(
    spark: SparkSession, table: str, entry: Row, only: Sequence[int] | None = None
) -> DataFrame:
    """Rows of some or all slices, each from the version that holds it, with their workflow."""
    schema = StructType.fromJson(json.loads(entry["slice_schema"]))
    wanted = None if only is None else set(only)
    chosen = {k: v for k, v in entry["slices"].items() if wanted is None or k in wanted}
    if not chosen:
        return spark.createDataFrame([], schema)
    paths = [f"{data_path(table, v)}/{SLICE}={k}" for k, v in sorted(chosen.items())]
    return spark.read.schema(schema).parquet(*paths)


def write_slices(df: DataFrame, table: str, version: int) -> None:
    df.write.mode("overwrite").option("compression", CODEC).partitionBy(SLICE).parquet(data_path(table, version))


def written_slices(spark: SparkSession, table: str, version: int) -> dict[int, int]:
    """The slices that a version wrote rows of, with the bytes of their files."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(data_path(table, version))
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(folder, True)
    sizes: dict[int, int] = {}
    while found.hasNext():
        status = found.next()
        name = status.getPath().getParent().getName()
        if name.startswith(f"{SLICE}="):
            k = int(name.removeprefix(f"{SLICE}="))
            sizes[k] = sizes.get(k, 0) + status.getLen()
    return sizes


def data_bytes(spark: SparkSession, table: str, version: int) -> int:
    """Bytes of the files of a version."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(data_path(table, version))
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()


def read_apart(spark: SparkSession, table: str, older: int, newer: int) -> tuple[DataFrame, DataFrame]:
    """Rows of two versions, without the slices that both have from the same version.

    What differs between the versions lies in these rows; a table without slices is read whole.
    """
    entries = [version_entry(spark, table, v) for v in (older, newer)]
    for version, entry in zip((older, newer), entries):
        if entry is None:
            raise ValueError(f"no finished version {version} in {table}")
    if any(entry["slice_count"] is None for entry in entries):
        return tuple(read_entry(spark, table, entry) for entry in entries)
    one, other = (entry["slices"] for entry in entries)
    shared = {k for k, v in one.items() if other.get(k) == v}
    return tuple(
        read_slices(spark, table, entry, [k for k in entry["slices"] if k not in shared]).drop(WORKFLOW)
        for entry in entries
    )


def columns_ddl(schema: StructType) -> str:
    """Column list of a CREATE TABLE statement, names quoted at every depth."""
    return schema.toDDL()


def _catalog_name(path: str) -> str:
    return f"snapshot_{sha256(path.encode()).hexdigest()[:32]}"


def _bucketed(spark: SparkSession, path: str, buckets: Buckets) -> DataFrame:
    name = _catalog_name(path)
    if not spark.catalog.tableExists(name):
        keys = ", ".join(f"`{key}`" for key in buckets.keys)
        location = path.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({columns_ddl(spark.read.parquet(path).schema)}) "
            f"USING parquet CLUSTERED BY ({keys}) INTO {buckets.count} BUCKETS "
            f"LOCATION '{location}'"
        )
    return spark.table(name)


def by_day(df: DataFrame, column: str) -> DataFrame:
    """Add the day of a timestamp as partition column, with rows of a day kept together.

    The rebalance lets AQE split a day that is too large for one task and merge small
    ones, instead of every task writing a file per day.
    """
    if DAY in df.columns:
        raise ValueError(f"the name {DAY} is taken for the partition column")
    return df.withColumn(DAY, F.to_date(column)).hint("rebalance", DAY)


def write_data(
    df: DataFrame, table: str, version: int, buckets: Buckets | None = None, day_column: str | None = None
) -> None:
    path = data_path(table, version)
    writer = df.write.mode("overwrite").option("compression", CODEC)
    if buckets:
        name = _catalog_name(path)
        # An unfinished earlier attempt at this version may have left its definition.
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
        bucketed = writer.format("parquet").bucketBy(buckets.count, *buckets.keys)
        bucketed.option("path", path).saveAsTable(name)
        return
    if day_column:
        writer = writer.partitionBy(DAY)
    writer.parquet(path)


def commit_version(
    spark: SparkSession,
    table: str,
    version: int,
    operation: str,
    counts: dict[str, int],
    run_ts: datetime | None = None,
    batch_id: int | None = None,
    buckets: Buckets | None = None,
    stream_id: str | None = None,
    day_column: str | None = None,
    slices: Slices | None = None,
) -> None:
    """Write the history row that makes `version` visible; without `run_ts` it has the time now."""
    values = {
        "operation": F.lit(operation),
        "run_ts": F.coalesce(F.lit(run_ts).cast("timestamp"), F.current_timestamp()),
        "stream_id": F.lit(stream_id).cast("string"),
        "batch_id": F.lit(batch_id).cast("bigint"),
        **{name: F.lit(counts.get(name)).cast("bigint") for name in COUNTS},
        "bucket_count": F.lit(buckets.count if buckets else None).cast("int"),
        "bucket_keys": F.array(*map(F.lit, buckets.keys)) if buckets else F.lit(None),
        "day_column": F.lit(day_column).cast("string"),
        "slice_count": F.lit(slices.count if slices else None).cast("int"),
        "slices": _int_map(slices.held if slices else None),
        "slice_bytes": _int_map(slices.sizes if slices else None),
        "slice_schema": F.lit(slices.schema if slices else None).cast("string"),
        "slice_widest": _int_map(slices.widest if slices else None),
    }
    entry = spark.range(0, 1, 1, 1).select(*[c.alias(name) for name, c in values.items()])
    entry = entry.withColumn("bucket_keys", F.col("bucket_keys").cast("array<string>"))
    entry.write.mode("overwrite").parquet(f"{table}/history/version={version}")


def _int_map(values: dict[int, int] | None) -> Column:
    if values is None:
        return F.lit(None).cast("map<int,bigint>")
    keys = F.from_json(F.lit(json.dumps(list(values))), "array<int>")
    return F.map_from_arrays(keys, F.from_json(F.lit(json.dumps(list(values.values()))), "array<bigint>"))


def write_snapshot(
    df: DataFrame,
    table: str,
    operation: str = "replace",
    run_ts: datetime | None = None,
    day_column: str | None = None,
) -> int:
    """Write `df` as the next version and return its number."""
    spark = df.sparkSession
    current = latest_version(spark, table)
    version = 0 if current is None else current + 1
    write_data(by_day(df, day_column) if day_column else df, table, version, None, day_column)
    commit_version(spark, table, version, operation, {}, run_ts, day_column=day_column)
    return version


def drop_versions(spark: SparkSession, table: str, before: int) -> None:
    """Remove the versions below `before`; the newest one always stays.

    A version's history row goes first, so no reader finds one whose data is gone. Slices that
    a later version still reads stay.
    """
    newest = latest_version(spark, table)
    if newest is None:
        return
    rows = history(spark, table).select("version", "slices").collect()  # one for each version
    kept = [row for row in rows if row["version"] >= min(before, newest)]
    held = {version for row in kept for version in (row["slices"] or {}).values()}
    for row in rows:
        if row not in kept:
            delete_folder(spark, f"{table}/history/version={row['version']}")
            path = data_path(table, row["version"])
            spark.sql(f"DROP TABLE IF EXISTS {_catalog_name(path)}")
            if row["version"] not in held:
                delete_folder(spark, path)


def forget_version(spark: SparkSession, table: str, version: int) -> None:
    """Remove a bucketed version's entry in the catalog; its files stay and can be read."""
    spark.sql(f"DROP TABLE IF EXISTS {_catalog_name(data_path(table, version))}")


def discard_data(spark: SparkSession, table: str, version: int) -> None:
    """Remove the rows of a version that was written and is not to be committed."""
    forget_version(spark, table, version)
    delete_folder(spark, data_path(table, version))


def delete_folder(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def create_if_absent(df: DataFrame, table: str, **options) -> int:
    """Write `df` as version 0 unless the table exists; return the newest version."""
    current = latest_version(df.sparkSession, table)
    if current is not None:
        return current
    return write_snapshot(df, table, operation="create", **options)
