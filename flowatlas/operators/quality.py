"""Checks on keys, and a profile of a DataFrame."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StringType


class DuplicateKeysError(ValueError):
    """Rows share a key that must be unique."""


def require_keys(keys: Sequence[str]) -> list[str]:
    keys = list(keys)
    if not keys:
        raise ValueError("at least one key column is needed")
    return keys


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with `duplicate_count`. NULLs count as equal."""
    grouped = df.groupBy(*require_keys(keys)).agg(F.count("*").alias("duplicate_count"))
    return grouped.filter("duplicate_count > 1")


def key_collisions(df: DataFrame, keys: Sequence[str], natural: Sequence[str]) -> DataFrame:
    """Keys of more than one row: `n_rows`, `n_natural` and whether they are a `collision`.

    `natural` are the columns that a key is made from. A key whose rows agree in them is a true
    duplicate; one with different values is a collision: parts with the separator in them, or
    an empty part, gave the same key. NULL and an empty text are different values. Rows are
    counted by key and natural columns first, so a key of many rows moves as few.
    """
    keys, natural = require_keys(keys), require_keys(natural)
    rest = [c for c in natural if c not in keys]
    each = df.groupBy(*keys, *rest).agg(F.count("*").alias("_n"))
    found = each.groupBy(*keys).agg(F.sum("_n").alias("n_rows"), F.count("*").alias("n_natural"))
    return found.filter("n_rows > 1").withColumn("collision", F.col("n_natural") > 1)


def dedupe_by_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] | None = None
) -> DataFrame:
    """One row per key: the first by `order_by`, by default by all other columns.

    Spark limits each key to one row before the shuffle as well as after it, so a key
    that holds a large share of the rows arrives as one row per task.
    """
    keys = require_keys(keys)
    order = order_by or [c for c in df.columns if c not in keys] or keys
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.filter("_rank = 1").drop("_rank")


def check_unique(
    df: DataFrame,
    keys: Sequence[str],
    on_duplicate: str = "raise",
    order_by: Sequence[str | Column] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Return `(rows with unique keys, report of duplicate keys)`.

    `"raise"` runs the report and fails when it has a row; `"dedupe"` runs nothing and
    returns the de-duplicated rows, which equal the input when it has no duplicates.
    """
    report = duplicate_keys(df, keys)
    if on_duplicate == "dedupe":
        return dedupe_by_key(df, keys, order_by), report
    if on_duplicate != "raise":
        raise ValueError(f"on_duplicate is 'raise' or 'dedupe', not {on_duplicate!r}")
    example = report.take(1)
    if example:
        raise DuplicateKeysError(f"duplicate key {example[0].asDict()}")
    return df, report


def profile(df: DataFrame, label: str) -> DataFrame:
    """One row: number of rows and columns, text sizes and the schema.

    `text_chars` adds up the string columns, `json_bytes` whole rows as JSON text.
    """
    strings = [f.name for f in df.schema if isinstance(f.dataType, StringType)]
    chars = F.lit(0).cast("bigint")
    for name in strings:
        chars = chars + F.coalesce(F.length(name), F.lit(0))
    row_bytes = F.octet_length(F.to_json(F.struct(*df.columns)))
    return df.agg(
        F.count("*").alias("n_rows"),
        F.coalesce(F.sum(chars), F.lit(0)).alias("text_chars"),
        F.coalesce(F.sum(row_bytes), F.lit(0)).alias("json_bytes"),
    ).select(
        F.lit(label).alias("label"),
        "n_rows",
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        "text_chars",
        "json_bytes",
        F.lit(df.schema.simpleString()).alias("schema"),
    )
