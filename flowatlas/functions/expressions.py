"""Scalar column expressions. All are JVM-side built-ins."""

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind `value` to a name for `body`, so that it is evaluated once per row."""
    return F.transform(F.array(value), body)[0]


def surrogate_key(*columns: Column | str) -> Column:
    """SHA-256 hex of the non-empty values, joined by `|`.

    NULL and `""` are left out, so `("a", NULL, "b")` and `("a", "b")` have one key.
    """
    parts = [F.nullif(_col(c).cast("string"), F.lit("")) for c in columns]
    return F.sha2(F.concat_ws("|", *parts), 256)


def random_id() -> Column:
    """A random version-4 UUID per row. Not repeatable; never a join key."""
    return F.uuid()


def last_path_part(path: Column | str) -> Column:
    """Text after the last `/`; NULL for an empty or missing path."""
    path = _col(path)
    return F.when(path != "", F.substring_index(path, "/", -1))


def json_path(text: Column | str, path: str) -> Column:
    """Value at a JSON path of a text column; a missing path gives NULL."""
    return F.get_json_object(_col(text), path)


def parse_json(text: Column | str, schema: str) -> Column:
    """Struct of a JSON text; `_corrupt` holds texts that do not fit the schema."""
    options = {"columnNameOfCorruptRecord": "_corrupt", "allowSingleQuotes": "false"}
    return F.from_json(_col(text), f"{schema}, _corrupt STRING", options)


def pretty_json(column: Column | str) -> Column:
    """Indented JSON text of a struct, array or map column."""
    return F.to_json(_col(column), {"pretty": "true"})


def differs(left: Column, right: Column, null_safe: bool = True) -> Column:
    """True when two values differ.

    With `null_safe` a change from or to NULL counts. Without it such a change is
    missed, as a plain `<>` does; the result is never NULL.
    """
    if null_safe:
        return ~left.eqNullSafe(right)
    return F.coalesce(left != right, F.lit(False))
