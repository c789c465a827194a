"""Column helpers for operators that stay in built-in functions."""

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from flowatlas.llm.common import ascii_lower

#: What stands between words, after A-Z were lower-cased.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: White space of ASCII.
SPACES = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with the value worked out once however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Words of digits, letters a-z and non-ASCII characters, A-Z lower-cased; none for null."""
    return _split(ascii_lower(text), BETWEEN_WORDS)


def spaced_words(text: Column) -> Column:
    """Words between ASCII white space; none for null."""
    return _split(text, SPACES)


def _split(text: Column, between: str) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), between), lambda w: w != "")


def places(first: Column | int, last: Column, step: int = 1) -> Column:
    """first, first + step, ... up to last; none where last is smaller."""
    first = F.lit(first) if isinstance(first, int) else first
    return F.when(last >= first, F.sequence(first, last, F.lit(step))).otherwise(F.array().cast("array<int>"))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, b: a + b)


def totals_before(values: Column) -> Column:
    """For each element of an array of ints the sum of those before it.

    Sums of blocks keep the work at n to the power 1.5, as an array can't be built in passing.
    """

    def with_block(parts: Column) -> Column:
        values, block = parts["values"], parts["block"]
        n = F.size(values)
        sums = F.transform(
            places(0, F.floor((n - 1) / block).cast("int")), lambda b: total(F.slice(values, b * block + 1, block))
        )
        heads = let(sums, lambda s: F.transform(s, lambda _, b: total(F.slice(s, F.lit(1), b))))
        return let(
            heads,
            lambda h: F.transform(
                places(0, n - 1),
                lambda i: F.get(h, F.floor(i / block).cast("int"))
                + total(F.slice(values, F.floor(i / block).cast("int") * block + 1, i % block)),
            ),
        )

    block = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(values))).cast("int"))
    return let(F.struct(values.alias("values"), block.alias("block")), with_block)


def matches(text: Column, pattern: str) -> Column:
    """(begin, end, found) of a pattern's leftmost matches, in code points; none for null.

    The pattern must not match the empty string.
    """
    none = F.array().cast("array<struct<begin:int,end:int,found:string>>")

    def locate(parts: Column) -> Column:
        sizes = F.transform(parts["found"], lambda f: F.length(f))
        gaps = F.transform(F.slice(parts["gaps"], F.lit(1), F.size(parts["found"])), lambda g: F.length(g))
        both = F.arrays_zip(
            totals_before(F.zip_with(gaps, sizes, lambda a, b: a + b)).alias("head"),
            gaps.alias("gap"), sizes.alias("size"), parts["found"].alias("found"),
        )
        return F.transform(
            both,
            lambda m: F.struct(
                (m["head"] + m["gap"]).alias("begin"), (m["head"] + m["gap"] + m["size"]).alias("end"), m["found"].alias("found")
            ),
        )

    parts = F.struct(
        F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found")
    )
    return F.when(text.rlike(pattern), let(parts, locate)).otherwise(none)
