"""Token ids of documents in binary files, with an index for access by key.

Files. Documents are put in order of key by a range shuffle; each task writes the ids of its
range to one file: 16 bytes that name the format and the width of an id, then the ids alone,
little-endian, two bytes each where the vocabulary allows it. A file's name is new with every
attempt of a task, and only what `entries` names was written to its end, so a lost executor
leaves at worst a file that nobody reads.

Index. Keys are dealt into buckets by hash. Each bucket is one row: a minimal perfect hash of
its keys and, at the place that it gives, a record of 32 bytes: fingerprint, file number, first
id, number of ids, ids of all documents before. A lookup reads one bucket, computes the place,
compares the fingerprint and reads that slice of the file. A key that is not in the index is
told by its fingerprint, but for one in four thousand millions.

Documents of equal keys are told apart by a copy number from 0, in order of a hash of the text;
with the other copies they may fill several files. Null is a key of its own and comes first.
Null and empty texts have the end id only. Very long texts are encoded in parts and are one
document. An empty table makes an empty index. Other columns are not read.

Tables below the folder: `entries` (key, copy, shard, file, place, at, n), `shards` (one row a
file; these pass through the driver, a few numbers for each task) and `index`.
"""

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flowatlas.llm.common import slices, worker_store
from flowatlas.llm.perfect_hash import PerfectHash, fingerprints, hashes
from flowatlas.llm.word_ids import WordEncoder

HEAD = 16
FORMAT = b"ids, le "
RECORD = np.dtype([("mark", "<u4"), ("shard", "<u4"), ("at", "<i8"), ("n", "<i8"), ("start", "<i8")])
#: Bytes of texts that are encoded at a time, and of ids that are read at a time.
BLOCK = 8 << 20
INDEX = "bucket bigint, buckets bigint, sizes array<bigint>, bits binary, counts binary, records binary"
FOUND = "key string, shard bigint, at bigint, n bigint, start bigint"


def storage(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder that tasks write to, and the folder's name there."""
    local = re.sub("^file:/+", "/", path)
    return (fs.LocalFileSystem(), local) if local.startswith("/") else fs.FileSystem.from_uri(path)


# --- writing -------------------------------------------------------------------------


def write_shard(batches: Iterator[pa.RecordBatch], folder: str, tokenizer: str, end_id: int | None, memory: int):
    """Writes the ids of a task's documents and yields where each lies."""
    settings = (tokenizer, memory)
    store = worker_store()
    if settings not in store:
        store[settings] = WordEncoder(tokenizer, memory)
    encoder, shard = store[settings], TaskContext.get().partitionId()
    name = f"part-{shard:06d}-{uuid.uuid4().hex}.ids"
    system, root = storage(folder)
    file, place, at, copy, last = None, 0, 0, -1, None
    end = np.array([] if end_id is None else [end_id], encoder.kind)
    if end_id is not None and end_id > np.iinfo(encoder.kind).max:
        raise ValueError("the end id does not fit the width of the ids")
    try:
        for batch in batches:
            whole = pa.StructArray.from_arrays([batch["key"], batch["text"]], names=["key", "text"])
            for part in slices(whole, BLOCK):
                if not len(part):
                    continue
                if file is None:
                    system.create_dir(root, recursive=True)
                    file = system.open_output_stream(f"{root}/{name}")
                    file.write(FORMAT + encoder.width.to_bytes(8, "little"))
                rows = encoder.encode([t or "" for t in part.field("text").to_pylist()])
                file.write(np.concatenate([x for row in rows for x in (row, end)]).astype(encoder.kind).tobytes())
                sizes = np.fromiter(map(len, rows), np.int64, len(rows)) + len(end)
                keys, copies = part.field("key").to_pylist(), []
                for key in keys:
                    copy = copy + 1 if copy >= 0 and key == last else 0
                    last = key
                    copies.append(copy)
                ends = at + np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [part.field("key"), pa.array(copies, pa.int64()), pa.array([shard] * len(rows), pa.int64()),
                     pa.array([name] * len(rows)), pa.array(np.arange(place, place + len(rows))),
                     pa.array(ends - sizes), pa.array(sizes)],
                    names=["key", "copy", "shard", "file", "place", "at", "n"],
                )
                place, at = place + len(rows), int(ends[-1])
    finally:
        if file is not None:
            file.close()


def shard_rows(entries: DataFrame) -> list[tuple]:
    """(shard, file, documents, ids, ids of all shards before, copies of its first key before), in order."""
    ends = entries.groupBy("shard", "file").agg(
        F.count("*").alias("documents"), F.sum("n").alias("ids"),
        F.min_by("key", "place").alias("first"), F.max(F.struct("place", "copy", "key")).alias("last"),
    )
    out, start, key, copies = [], 0, None, 0
    for row in sorted(ends.collect(), key=lambda r: r.shard):
        carried = copies if out and row["first"] == key else 0
        out.append((row.shard, row.file, row.documents, row.ids, start, carried))
        alone = row["last"].place == row["last"].copy  # the whole shard is one key
        key, copies = row["last"].key, row["last"].copy + 1 + (carried if alone else 0)
        start += row.ids
    return out


def key_text(key: Column, copy: Column) -> Column:
    """Key and copy number as one string; null differs from every string."""
    shown = F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit(""))
    return F.when(copy > 0, F.concat(shown, F.lit("\0"), copy.cast("string"))).otherwise(shown)


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("long")


def build_bucket(table: pa.Table) -> pa.Table:
    """One row of the index from (bucket, buckets, key, shard, at, n, start)."""
    pairs = hashes(table["key"].to_pylist())
    hashed = PerfectHash.build(pairs)
    records = np.zeros(len(pairs), RECORD)
    place = hashed.places(pairs)
    records["mark"][place] = fingerprints(pairs)
    for name in ("shard", "at", "n", "start"):
        records[name][place] = table[name].to_numpy()
    return pa.table(
        {"bucket": table["bucket"][:1], "buckets": table["buckets"][:1], "sizes": pa.array([hashed.sizes], pa.list_(pa.int64())),
         "bits": pa.array([hashed.bits.tobytes()], pa.binary()), "counts": pa.array([hashed.counts.tobytes()], pa.binary()),
         "records": pa.array([records.tobytes()], pa.binary())}
    )


def write(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    text: str = "text",
    key: str = "doc_id",
    end_id: int | None = 1,
    keys_each: int = 20_000,
    memory: int = 192 << 20,
) -> None:
    """Encodes all documents into files below a new folder, in order of key, and builds the index.

    `keys_each` is the number of keys in a bucket, `memory` bounds the words that a worker keeps.
    """
    spark = docs.sparkSession
    kind = docs.select(F.col(key).alias("key")).schema["key"].dataType.simpleString()
    given = docs.select(
        F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("order"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = [F.asc_nulls_first("key"), "order", "row"]
    dealt = given.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "text")
    schema = f"key {kind}, copy bigint, shard bigint, file string, place bigint, at bigint, n bigint"
    files = f"{folder}/ids"
    written = dealt.mapInArrow(lambda batches: write_shard(batches, files, tokenizer, end_id, memory), schema)
    written.write.parquet(f"{folder}/entries")

    entries = spark.read.schema(schema).parquet(f"{folder}/entries")
    columns = "shard bigint, file string, documents bigint, ids bigint, start bigint, carried bigint"
    rows = shard_rows(entries)
    spark.createDataFrame(rows, columns).coalesce(1).write.parquet(f"{folder}/shards")
    located = keyed(spark, folder).withColumn("key", key_text(F.col("key"), F.col("copy")))
    buckets = max(1, -(-sum(r[2] for r in rows) // keys_each))
    dealt = located.select(bucket_of(F.col("key"), buckets).alias("bucket"), F.lit(buckets).cast("long").alias("buckets"), "key", "shard", "at", "n", "start")
    dealt.groupBy("bucket").applyInArrow(build_bucket, INDEX).write.parquet(f"{folder}/index")


def keyed(spark: SparkSession, folder: str) -> DataFrame:
    """Every document as (key, copy, shard, at, n, start): copy numbers and starts across files."""
    entries, shards = spark.read.parquet(f"{folder}/entries"), spark.read.parquet(f"{folder}/shards")
    joined = entries.join(shards.select("shard", F.col("start").alias("base"), "carried"), "shard")
    first = F.col("place") == F.col("copy")  # still the shard's first key
    copy = F.col("copy") + F.when(first, F.col("carried")).otherwise(0)
    return joined.select("key", copy.alias("copy"), "shard", "at", "n", (F.col("base") + F.col("at")).alias("start"))


# --- reading -------------------------------------------------------------------------


def read_index(spark: SparkSession, folder: str) -> tuple[DataFrame, int]:
    """The index and into how many buckets keys are dealt; some of them may have none."""
    index = spark.read.schema(INDEX).parquet(f"{folder}/index")
    row = index.select("buckets").first()
    return index, row.buckets if row else 1


def look_up(keys: list[str], index: dict) -> list[tuple]:
    """(shard, at, n, start) of each key in one bucket's row, or four nulls."""
    hashed = PerfectHash(list(index["sizes"]), np.frombuffer(index["bits"], np.uint64), np.frombuffer(index["counts"], np.uint32))
    records = np.frombuffer(index["records"], RECORD)
    pairs = hashes(keys)
    place = hashed.places(pairs)
    good = place >= 0
    good[good] = records["mark"][place[good]] == fingerprints(pairs[good])
    return [tuple(int(records[c][p]) for c in ("shard", "at", "n", "start")) if g else (None,) * 4 for p, g in zip(place, good)]


def locate(keys: DataFrame, folder: str) -> DataFrame:
    """Where the documents of some keys lie: (key, shard, at, n, start), nulls if there is none.

    `keys` has a column `key` made by `key_text`; repeated ones are looked up once.
    """
    spark = keys.sparkSession
    index, buckets = read_index(spark, folder)

    def find(asked: pa.Table, rows: pa.Table) -> pa.Table:
        names = asked["key"].to_pylist()
        found = look_up(names, rows.to_pylist()[0]) if rows.num_rows else [(None,) * 4] * len(names)
        columns = list(zip(*found)) or [()] * 4
        fields = dict(zip(("shard", "at", "n", "start"), columns))
        return pa.table({"key": asked["key"]} | {c: pa.array(v, pa.int64()) for c, v in fields.items()})

    asked = keys.select("key").distinct().withColumn("bucket", bucket_of(F.col("key"), buckets))
    return asked.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInArrow(find, FOUND)


def read_slices(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """Adds the ids of each slice, read in one go where slices lie side by side."""
    system, root = storage(folder)
    open_name, file, width = None, None, 0
    for batch in batches:
        names, at, n = (batch[c].to_pylist() for c in ("file", "at", "n"))
        k = 0
        while k < len(names):
            if names[k] != open_name:
                if file is not None:
                    file.close()
                open_name, file = names[k], system.open_input_file(f"{root}/{names[k]}")
                head = file.read_at(HEAD, 0)
                if head[:8] != FORMAT:
                    raise ValueError(f"{names[k]} is no file of ids")
                width = int.from_bytes(head[8:], "little")
            last = k
            while (last + 1 < len(names) and names[last + 1] == open_name and at[last + 1] == at[last] + n[last]
                   and (at[last + 1] + n[last + 1] - at[k]) * width <= BLOCK):
                last += 1
            size = at[last] + n[last] - at[k]
            raw = file.read_at(size * width, HEAD + at[k] * width)
            ids = np.frombuffer(raw, f"<u{width}").astype("<u4")
            if len(ids) != size:
                raise ValueError(f"{open_name} is cut short")
            cut = [ids[a - at[k] : a - at[k] + m].tobytes() for a, m in zip(at[k : last + 1], n[k : last + 1])]
            rows = batch.slice(k, last + 1 - k)
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(cut, pa.binary())], names=[*rows.schema.names, "ids"])
            k = last + 1
    if file is not None:
        file.close()


def read_ids(located: DataFrame, folder: str) -> DataFrame:
    """(key, shard, at, n, start, file, ids) of what `locate` found; ids are little-endian 32-bit numbers."""
    spark = located.sparkSession
    shards = spark.read.parquet(f"{folder}/shards").select("shard", "file")
    named = located.filter("shard is not null").join(shards, "shard").select("key", "shard", "at", "n", "start", "file")
    part = F.floor(F.col("at") / F.lit(BLOCK))
    dealt = named.repartition("file", part).sortWithinPartitions("file", "at")
    files = f"{folder}/ids"
    return dealt.mapInArrow(lambda batches: read_slices(batches, files), f"{FOUND}, file string, ids binary")


def fetch(spark: SparkSession, folder: str, key, copy: int = 0) -> np.ndarray | None:
    """The ids of one document; None if the index has no such key."""
    index, buckets = read_index(spark, folder)
    name = ("" if key is None else f"={key}") + (f"\0{copy}" if copy else "")
    bucket = bucket_of(F.lit(name), buckets)
    rows = index.filter(F.col("bucket") == bucket).collect()
    if not rows:
        return None
    shard, at, n, _ = look_up([name], rows[0].asDict())[0]
    if shard is None:
        return None
    file = spark.read.parquet(f"{folder}/shards").filter(F.col("shard") == shard).first().file
    slice_ = pa.RecordBatch.from_pydict({"file": [file], "at": [at], "n": [n]})
    return np.frombuffer(next(read_slices(iter([slice_]), f"{folder}/ids"))["ids"][0].as_py(), "<u4")
