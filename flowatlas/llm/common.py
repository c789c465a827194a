"""Helpers shared by the corpus operators: tables, folders, Arrow functions, folds."""

import math
import sys
import types
from collections import defaultdict
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from flowatlas.session import shared_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER_BYTES = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder, so that a lost executor costs no rerun."""
    spark = df.sparkSession
    path = shared_folder(spark, "llm")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows that a Python worker holds at a time. Texts differ in length, so the default of 10,000
#: would tie its memory to the longest ones.
BATCH_ROWS = 2500


def bound_batches(spark: SparkSession) -> None:
    """Send no more than BATCH_ROWS rows at a time to Python workers of this session."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


#: Bytes that a batch function is given at a time; a longer text comes alone.
BATCH_BYTES = 2 << 20


def slices(batch: pa.Array, most: int = BATCH_BYTES) -> Iterator[pa.Array]:
    """A batch in parts of bounded bytes, one row each at least."""
    if len(batch) < 2 or batch.nbytes <= most:
        yield batch
        return
    half = len(batch) // 2
    yield from slices(batch.slice(0, half), most)
    yield from slices(batch.slice(half), most)


def with_new(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """The rows with new columns; a name that is taken is an error, as a column would be lost."""
    taken = {c.lower() for c in df.columns} & {c.lower() for c in columns}
    if taken:
        raise ValueError(f"the table already has {sorted(taken)}; give another name with into=")
    return df.withColumns(columns)


def free_name(df: DataFrame, name: str) -> str:
    """`name`, or it with underscores behind it until no column of `df` has that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def arrow_function(make: Callable[[], Callable[[pa.Array], pa.Array]], returns: str, most: int | None = None):
    """A Spark function of one column; `make` runs once a task and gives the batch function.

    With `most` it gets parts of so many bytes, so its memory does not grow with a batch's texts.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        function = make()
        for batch in batches:
            for part in slices(batch, most or sys.maxsize):
                yield function(part)
        pa.default_memory_pool().release_unused()

    return F.arrow_udf(run, returns)


def worker_store() -> dict:
    """Kept as long as the Python worker lives, so tasks of one executor can share it."""
    name = "_corpus_worker_store"
    return vars(sys.modules.setdefault(name, types.ModuleType(name)))


def struct_array(fields: dict[str, tuple[list, pa.DataType]]) -> pa.StructArray:
    columns = [pa.array(values, kind) for values, kind in fields.values()]
    return pa.StructArray.from_arrays(columns, names=list(fields))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, nothing else; `lower` does the same and is faster on plain ASCII."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def held_out(doc_id: Column) -> Column:
    """Rows that no model may learn from; a null id counts as held out."""
    remainder = F.crc32(doc_id.cast("string").cast("binary")) % 3
    return F.coalesce(remainder == 1, F.lit(True))


def sampled(df: DataFrame, rows: int, *key: str) -> DataFrame:
    """About `rows` rows, chosen by a hash of the key; never more than one and a half times that.

    For fitting a model only, and for rows that the key tells apart: then the limit is not met
    in practice, and the choice is the same in every run. See `sampled_texts` for texts.
    """
    total = df.count()
    bucket = F.pmod(F.xxhash64(*key), F.lit(1_000_000))
    return df.filter(bucket < F.lit(int(1_000_000 * rows / max(total, 1)) + 1)).limit(rows * 3 // 2)


def sampled_texts(df: DataFrame, rows: int, least: int) -> list[tuple[str, object]]:
    """Distinct (text, label) of a table of `text` and `label`, neither null, ordered by both.

    For fitting a model only. Copies count once. A label gets its share of `rows`, and `least`
    or all it has at least, so no label is missing. Within a label those with the smallest hash
    are taken, so the choice is the same in every run.
    """
    spark = df.sparkSession
    digest = F.sha2("text", 256)
    known = cut_lineage(df.select("label", digest.alias("digest")).distinct())
    sizes = dict(known.groupBy("label").count().collect())
    total = sum(sizes.values())
    quotas = {y: max(least, math.ceil(rows * n / total)) for y, n in sizes.items()}
    # twice the quota is looked at, so that a chance shortage can be left out of account
    shares = [(y, min(1.0, (2 * quotas[y] + 100) / n)) for y, n in sizes.items()]
    kind = known.schema["label"].dataType
    wanted = StructType().add("label", kind).add("share", "double")
    order = F.xxhash64("digest")
    place = F.pmod(order, F.lit(1 << 53)) / F.lit(1 << 53)
    near = known.join(F.broadcast(spark.createDataFrame(shares, wanted)), "label").filter(place < F.col("share"))
    taken = defaultdict(list)
    for label, _, text_digest in sorted(near.select("label", order, "digest").collect()):
        if len(taken[label]) < quotas[label]:
            taken[label].append(text_digest)
    chosen = [(y, d) for y, digests in taken.items() for d in digests]
    once = spark.createDataFrame(sorted({(d,) for _, d in chosen}), "digest string")
    found = df.select(digest.alias("digest"), "text").join(F.broadcast(once), "digest", "left_semi")
    texts = dict(found.mapInArrow(_first_of_each, found.schema).dropDuplicates(["digest"]).collect())
    return sorted((texts[d], y) for y, d in chosen)


def _first_of_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's first row of each digest, however many copies it reads."""
    seen = set()
    for batch in batches:
        new = {d: k for k, d in reversed(list(enumerate(batch["digest"].to_pylist()))) if d not in seen}
        seen.update(new)
        yield batch.take(pa.array(sorted(new.values()), pa.int64()))
