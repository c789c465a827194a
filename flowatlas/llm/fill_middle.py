"""Fill-in-middle: texts cut into prefix, middle and suffix, and put in another order.

Cuts fall between lines (a line takes its newline along). Which lines, whether a text is
changed at all and which of two orders it gets follow from four numbers, read from the SHA-256
of a seed and the row's key, so a rerun gives the same result.

    psm: <P> prefix <S> suffix <M> middle        spm: <S> suffix <P> prefix <M> middle

All texts of a batch are handled at once, as one run of bytes. The cuts make segments; a
difference array takes the change of shift at each segment's first byte, its running sum is
the place of every byte in the output, and one scatter writes them. Restoring goes the other
way: marks found in the output give the segments, and one gather reads them in the old order.

A text is left plain where it is empty or null, holds one of the marks, or is not chosen.
Very long texts take about 40 bytes of memory a byte, in a batch of their own. A null key
counts as an empty string; rows with equal keys get equal numbers. Repeated rows give repeated
results, an empty table an empty one; other columns pass through, and a column of the name
`into` is an error.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from flowatlas.llm.arrow_bytes import flat, places_of, shifts, texts_of
from flowatlas.llm.common import BATCH_BYTES, arrow_function, with_new

MARKS = ("<P>", "<S>", "<M>")
ORDERS = {"psm": (0, 2, 1), "spm": (2, 0, 1)}  # which of prefix, middle, suffix comes when
HEADS = {"psm": (0, 1, 2), "spm": (1, 0, 2)}  # the marks before them
FORMS = ("plain", "psm", "spm")
RETURNS = "struct<n:bigint,form:string,prefix_chars:bigint,middle_chars:bigint,output:string>"


def numbers(key: Column, seed: int) -> list[Column]:
    """Four unsigned numbers of 32 bits for a key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def line_cuts(data: np.ndarray, offsets: np.ndarray, h1: np.ndarray, h2: np.ndarray):
    """(number of lines, end of prefix, end of middle) of every text, the ends as places in `data`."""
    begin, end = offsets[:-1], offsets[1:]
    breaks = np.flatnonzero(data == 10)
    first = np.searchsorted(breaks, begin)
    full = np.searchsorted(breaks, end) - first
    tail = np.zeros(len(begin), bool)
    some = end > begin
    tail[some] = data[end[some] - 1] != 10
    n = full + tail
    a, b = h1 % (n + 1), h2 % (n + 1)

    def end_of(units: np.ndarray) -> np.ndarray:
        if not len(breaks):
            return np.where(units == 0, begin, end)
        inside = breaks[np.clip(first + units - 1, 0, len(breaks) - 1)] + 1
        return np.where(units == 0, begin, np.where(units <= full, inside, end))

    return n, end_of(np.minimum(a, b)), end_of(np.maximum(a, b))


def holding(data: np.ndarray, offsets: np.ndarray, marks: list[bytes]) -> np.ndarray:
    """Texts in which one of the marks stands."""
    found = np.zeros(len(offsets) - 1, bool)
    for mark in marks:
        at = places_of(data, mark)
        row = np.searchsorted(offsets, at, "right") - 1
        found[row[at + len(mark) <= offsets[row + 1]]] = True
    return found


def scatter(batch: pa.StructArray, marks: tuple[str, str, str], share: int, spm_share: int) -> pa.StructArray:
    data, offsets = flat(batch.field("text"))
    h1, h2, h3, h4 = (batch.field(f"h{k}").to_numpy(zero_copy_only=False) for k in (1, 2, 3, 4))
    heads = [m.encode() for m in marks]
    n, cut, last = line_cuts(data, offsets, h1, h2)
    begin, end = offsets[:-1], offsets[1:]
    plain = (begin == end) | (h3 % 100 >= share) | holding(data, offsets, heads)
    form = np.where(plain, 0, np.where(h4 % 100 < spm_share, 2, 1))

    sizes = np.where(plain, end - begin, end - begin + sum(map(len, heads)))
    placed = np.concatenate([[0], np.cumsum(sizes)])
    starts = np.stack([begin, np.where(plain, end, cut), np.where(plain, end, last)], axis=1)
    lengths = np.diff(np.concatenate([starts, end[:, None]], axis=1), axis=1)
    targets = np.repeat(placed[:-1, None], 3, axis=1)
    out = np.empty(placed[-1], np.uint8)
    for code, name in enumerate(FORMS):
        rows = np.flatnonzero(form == code)
        if name == "plain" or not len(rows):
            continue
        at = placed[:-1][rows].copy()
        for head, part in zip(HEADS[name], ORDERS[name]):
            letters = np.frombuffer(heads[head], np.uint8)
            out[at[:, None] + np.arange(len(letters))] = letters
            at += len(letters)
            targets[rows, part] = at
            at += lengths[rows, part]
    # an empty segment shares its first byte with the next one, whose shift then holds
    shift = shifts(starts.ravel(), (targets - starts).ravel(), len(data))
    out[np.arange(len(data)) + shift] = data

    before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    chars = before[starts[:, 1:]] - before[starts[:, :2]]
    return pa.StructArray.from_arrays(
        [
            pa.array(n, pa.int64()), pa.array(np.array(FORMS, object)[form], pa.string()),
            *[pa.array(chars[:, k], pa.int64(), mask=plain) for k in (0, 1)], texts_of(out, placed),
        ],
        names=["n", "form", "prefix_chars", "middle_chars", "output"],
    )


def gather(batch: pa.StructArray, marks: tuple[str, str, str]) -> pa.Array:
    data, offsets = flat(batch.field("output"))
    forms = np.array(batch.field("form").to_pylist(), object)
    heads = [m.encode() for m in marks]
    found = [places_of(data, h) for h in heads]
    begin, end = offsets[:-1], offsets[1:]
    sources = np.stack([begin, end, end], axis=1)
    lengths = np.stack([end - begin, 0 * begin, 0 * begin], axis=1)
    for name in FORMS[1:]:
        rows = np.flatnonzero(forms == name)
        at = begin[rows]
        for step, (head, part) in enumerate(zip(HEADS[name], ORDERS[name])):
            sources[rows, part] = at + len(heads[head])
            if step < 2:  # up to the next mark, the last part up to the end
                following = found[HEADS[name][step + 1]]
                at = following[np.searchsorted(following, sources[rows, part])]
            else:
                at = end[rows]
            lengths[rows, part] = at - sources[rows, part]
    placed = np.concatenate([[0], np.cumsum(lengths.sum(axis=1))])
    targets = placed[:-1, None] + np.cumsum(lengths, axis=1) - lengths
    shift = shifts(targets.ravel(), (sources - targets).ravel(), placed[-1])
    return texts_of(data[np.arange(placed[-1]) + shift], placed)


def fill_in_middle(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    into: str = "fim",
    seed: int = 7,
    share: int = 100,
    spm_share: int = 50,
    marks: tuple[str, str, str] = MARKS,
) -> DataFrame:
    """Each row with a struct: number of lines, form, code points of prefix and middle, output.

    `share` of a hundred texts are changed, `spm_share` of a hundred of those get the form spm.
    """
    if len(set(marks)) < 3 or not all(marks):
        raise ValueError("three different marks are needed")
    make = lambda: lambda batch: scatter(batch, marks, share, spm_share)
    given = F.struct(F.col(text).alias("text"), *numbers(F.col(key), seed))
    return with_new(docs, {into: arrow_function(make, RETURNS, BATCH_BYTES)(given)})


def restore(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text before it was put in another order, from the output and its form alone."""
    make = lambda: lambda batch: gather(batch, marks)
    return arrow_function(make, "string", BATCH_BYTES)(F.struct(output.alias("output"), form.alias("form")))
