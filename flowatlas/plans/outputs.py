"""Views and JSON files of a set of tables."""

from collections.abc import Mapping

from pyspark.sql import DataFrame


def create_views(tables: Mapping[str, DataFrame]) -> list[str]:
    """Register each table as the temporary view `view_<name>`."""
    names = []
    for name, df in tables.items():
        df.createOrReplaceTempView(f"view_{name}")
        names.append(f"view_{name}")
    return names


def write_json_tables(tables: Mapping[str, DataFrame], folder: str, compression: str = "none") -> None:
    """Write each table as JSON lines to its own folder, NULL fields included.

    `compression` is a codec of Spark's JSON files: with `gzip` they are `.json.gz`.
    """
    for name, df in tables.items():
        lines = df.write.mode("overwrite").option("ignoreNullFields", False)
        lines.json(f"{folder}/{name}", compression=compression)
