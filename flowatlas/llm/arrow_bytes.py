"""Texts of an Arrow array as one run of bytes, and back."""

import numpy as np
import pyarrow as pa


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets with the end); null counts as empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, places, content = texts.buffers()
    if places is None:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(content, np.uint8) if content is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def texts_of(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, buffers[1], buffers[2]).cast(pa.string())


def places_of(data: np.ndarray, mark: bytes) -> np.ndarray:
    """Where a byte string begins, overlapping ones included."""
    n = len(data) - len(mark) + 1
    if n <= 0:
        return np.empty(0, np.int64)
    at = np.flatnonzero(data[:n] == mark[0])
    for k in range(1, len(mark)):
        at = at[data[at + k] == mark[k]]
    return at


def shifts(begin: np.ndarray, shift: np.ndarray, size: int) -> np.ndarray:
    """For each of `size` bytes the shift of its segment; segments are in order and may be empty.

    A difference array takes the change of shift at every segment's first byte; its running
    sum is the shift.
    """
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, begin, np.diff(shift, prepend=0))
    return np.cumsum(change[:size])
