"""Text columns as bytes, for the way through a shuffle.

SHA-256 ids as 64 hex characters are random text that shuffles cannot compress. Packed they are
32 bytes and a mark, other text its own bytes and another mark. Two texts are equal exactly if
their packed forms are, and `unpacked` gives every text back, so joins and groups may use either.

An id that the columns beside it tell need not move at all: where a text is what `derived` says,
it becomes no bytes and is made again afterwards. Any other text moves as it is. Such forms are
compared with those of the same row's other columns only.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType


def packed(column: Column | str) -> Column:
    """Bytes of a text; NULL stays NULL."""
    text = F.col(column) if isinstance(column, str) else column
    data = F.unhex(text)
    # of 64 hex digits, none of them a capital; cheaper than a pattern
    digest = (F.octet_length(text) == 64) & data.isNotNull() & (F.lower(text) == text)
    plain = F.concat(F.unhex(F.lit("01")), text.cast("binary"))
    return F.when(digest, F.concat(F.unhex(F.lit("00")), data)).otherwise(plain)


def unpacked(column: Column | str) -> Column:
    """The text that `packed` was given."""
    data = F.col(column) if isinstance(column, str) else column
    rest = F.substring(data, 2, (1 << 31) - 1)
    digest = F.substring(data, 1, 1) == F.unhex(F.lit("00"))
    return F.when(digest, F.lower(F.hex(rest))).otherwise(rest.cast("string"))


def text_columns(df: DataFrame) -> list[str]:
    """The columns that can be packed: text without a collation of its own."""
    return [f.name for f in df.schema if f.dataType == StringType()]


def pack_columns(df: DataFrame, columns: Sequence[str], derived: Mapping[str, Column] | None = None) -> DataFrame:
    """`derived` has, for some of the columns, the value expected by columns that are not in it."""
    forms = {c: packed(F.col(f"`{c}`")) for c in columns}
    for c in set(forms) & set(derived or {}):
        forms[c] = F.when(F.col(f"`{c}`").eqNullSafe(derived[c]), F.lit(bytearray())).otherwise(forms[c])
    return df.withColumns(forms) if forms else df


def unpack_columns(df: DataFrame, columns: Sequence[str], derived: Mapping[str, Column] | None = None) -> DataFrame:
    """The texts again; `derived` as it was for packing."""
    made = {c: derived[c] for c in columns if c in (derived or {})}
    texts = {c: unpacked(F.col(f"`{c}`")) for c in columns}
    first = {c: text for c, text in texts.items() if c not in made}
    df = df.withColumns(first) if first else df
    last = {c: F.when(F.octet_length(f"`{c}`") == 0, value).otherwise(texts[c]) for c, value in made.items()}
    return df.withColumns(last) if last else df
