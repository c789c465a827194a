"""Byte-level BPE with chunk reuse: encode each content-defined chunk once, repair the joins.

Chunking. A rolling hash over the UTF-8 bytes cuts a text where the hash of the last 16
bytes has `bits` low zeros, between `least` and `most` bytes after the last cut and never
inside a character. Equal passages so get equal chunks wherever they stand in a document.

Reuse. Each Python worker keeps a dictionary from chunk to tokens, bounded in bytes, for as
long as it lives. It has two generations: when the newer is full the older goes, and what is
used again moves up, so chunks in use are not encoded again in any document or task.

Repair. Tokens near a chunk's ends may differ from those of the whole text. A text can always
be cut safely between a printing ASCII character and a single space before another one,
since the pattern that splits text before the merges never joins across it. Of every chunk
the tokens between its second safe point and its last but one are kept (its core). What lies
between two cores is encoded on its own, and accepted when its tokens agree with both chunks
in the stretch between the two outer safe points at either side. Else, or where a chunk has
too few safe points, its core is given up and the stretch grows by the whole chunk, at last
to the whole text, which is exact by definition.

Two encoders give the same ids: the tokenizer file's own, and a faster one from the same
vocabulary as ranks. The faster one takes only text of ASCII and Latin letters, where the
splitting pattern has one meaning, and never text that holds an added token's string.

Null is encoded as the empty text: no ids. Decoding joins the tokens' bytes and reads them as
UTF-8, with U+FFFD for what is not valid; null ids decode to the empty text. Repeated rows
give repeated results; other columns pass through.
"""

import base64
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from flowatlas.llm.common import BATCH_BYTES, arrow_function, bound_batches, worker_store

PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
OUTSIDE_LATIN = re.compile("[^\t\n\r\x20-\x7e¡-§©«®°±¶·»¿-ſ]")
GEAR = np.random.Generator(np.random.PCG64(7)).integers(0, 1 << 32, 256, dtype=np.uint32)


# --- vocabulary ----------------------------------------------------------------------


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def token_bytes(path: str) -> list[bytes]:
    """The bytes of every id of a tokenizer file; added tokens stand for their own text."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    letters = byte_letters()
    table = {i: bytes(letters[c] for c in t) for t, i in content["model"]["vocab"].items() if set(t) <= letters.keys()}
    table |= {added["id"]: added["content"].encode() for added in content["added_tokens"]}
    return [table.get(i, b"") for i in range(max(table) + 1)]


class Encoder:
    """Encodes pieces of text exactly as the tokenizer file says."""

    def __init__(self, path: str, ranks_path: str | None):
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        self.exact.no_truncation()
        self.exact.no_padding()
        self.lengths = np.array([len(b) for b in token_bytes(path)], np.int64)
        with open(path, encoding="utf-8") as file:
            added = [re.escape(token["content"]) for token in json.load(file)["added_tokens"]]
        self.added = re.compile("|".join(added) or r"(?!)")
        self.fast = None
        if ranks_path:
            import tiktoken

            with open(ranks_path, "rb") as file:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
            self.fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if self.fast and not self.added.search(text) and (text.isascii() or not OUTSIDE_LATIN.search(text)):
            if text.isascii() and any(c in text for c in "\x0b\x0c\x1c\x1d\x1e\x1f"):
                return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.int32)
            return np.array(self.fast.encode_ordinary(text), np.int32)
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.int32)


# --- chunks --------------------------------------------------------------------------


def rolling_cuts(data: np.ndarray, bits: int) -> np.ndarray:
    """Places after which the hash of the last 16 bytes has `bits` zeros, between characters."""
    value = GEAR[data]
    for step in (1, 2, 4, 8):
        value[step:] = value[step:] + (value[:-step] << np.uint32(step))
    # the high bits have taken in all 16 bytes
    hit = (value >> np.uint32(32 - bits)) == 0
    hit[:-1] &= (data[1:] & 0xC0) != 0x80
    return np.flatnonzero(hit) + 1


def chunk_ends(raw: bytes, bits: int, least: int, most: int) -> list[int]:
    """Where the chunks of a text end, its own end last."""
    ends, at = [], 0
    for cut in [*rolling_cuts(np.frombuffer(raw, np.uint8), bits).tolist(), len(raw)]:
        while cut - at > most:
            at += most
            while raw[at] & 0xC0 == 0x80:
                at -= 1
            ends.append(at)
        if cut - at >= least or cut == len(raw):
            if cut > at:
                ends.append(cut)
            at = cut
    return ends


def printing(byte: int) -> bool:
    return 0x21 <= byte <= 0x7E


def safe_points(raw: bytes, from_end: bool) -> list[int]:
    """The first two places, or the last two, where a text can always be cut."""
    found, at = [], len(raw) - 1 if from_end else 0
    while len(found) < 2:
        at = raw.rfind(b" ", 1, at) if from_end else raw.find(b" ", at + 1, -1)
        if at < 0:
            break
        if printing(raw[at - 1]) and printing(raw[at + 1]):
            found.append(at)
    return sorted(found)


class Chunk:
    """Tokens of a chunk and its core: bytes from `head` to `tail`, with what lies just outside.

    `before` are the tokens from the first safe point to the head, `after` those from the
    tail to the last safe point; a neighbour's re-encoding has to agree with them.
    """

    __slots__ = ("ids", "head", "tail", "core", "before", "after", "behind")

    def __init__(self, raw: bytes, encoder: Encoder):
        self.ids = encoder.ids(raw.decode())
        ends = np.cumsum(encoder.lengths[self.ids])
        self.head = self.tail = None
        points = [*safe_points(raw, False), *safe_points(raw, True)]
        if len(points) < 4 or points[1] >= points[2]:
            return
        at = np.searchsorted(ends, points) + 1
        if (ends[at - 1] != points).any():  # not at tokens' ends: no core
            return
        self.head, self.tail = points[1], points[2]
        self.before, self.core, self.after = self.ids[at[0] : at[1]], self.ids[at[1] : at[2]], self.ids[at[2] : at[3]]
        self.behind = len(self.ids) - at[2]


class ChunkEncoder:
    """Encodes whole texts; holds up to `memory` bytes of chunks and joins between calls."""

    def __init__(self, encoder: Encoder, bits: int, least: int, most: int, memory: int):
        self.encoder, self.bits, self.least, self.most, self.memory = encoder, bits, least, most, memory
        self.chunks: dict[bytes, Chunk] = {}
        self.joins: dict[bytes, np.ndarray] = {}
        self.old_chunks: dict[bytes, Chunk] = {}
        self.old_joins: dict[bytes, np.ndarray] = {}
        self.held = self.encoded = self.reused = self.repaired = 0

    def _keep(self, size: int) -> None:
        if self.held > self.memory // 2:
            self.old_chunks, self.old_joins = self.chunks, self.joins
            self.chunks, self.joins, self.held = {}, {}, 0
        self.held += size

    def chunk(self, raw: bytes) -> Chunk:
        found = self.chunks.get(raw)
        if found is not None:
            self.reused += 1
            return found
        found = self.old_chunks.get(raw)
        if found is None:
            found = Chunk(raw, self.encoder)
            self.encoded += 1
        else:
            self.reused += 1
        self._keep(2 * len(raw) + 400)
        self.chunks[raw] = found
        return found

    def join(self, raw: bytes) -> np.ndarray:
        found = self.joins.get(raw)
        if found is None:
            found = self.old_joins.get(raw)
            if found is None:
                found = self.encoder.ids(raw.decode())
            self._keep(3 * len(raw) + 200)
            self.joins[raw] = found
        return found

    def encode(self, text: str) -> np.ndarray:
        raw = text.encode()
        if len(raw) <= 2 * self.least:
            return self.chunk(raw).ids if raw else np.empty(0, np.int32)
        ends = chunk_ends(raw, self.bits, self.least, self.most)
        starts = [0, *ends[:-1]]
        last = len(ends) - 1
        out, at, left = [], 0, None  # all before byte `at` is in `out`; left: the last core's chunk
        for k, (start, end) in enumerate(zip(starts, ends)):
            chunk = self.chunk(raw[start:end])
            if k == last or chunk.head is None or k == 0:
                if k == 0 and chunk.head is not None:
                    out.append(chunk.ids[: len(chunk.ids) - chunk.behind])
                    at, left = start + chunk.tail, chunk
                continue
            gap = self.join(raw[at : start + chunk.head])
            if self._agrees(left, gap, chunk.before):
                out += [gap, chunk.core]
                at, left = start + chunk.tail, chunk
            # else this chunk's core is given up; the stretch goes on through it
        out.append(self._whole(raw, at, left, out))
        return np.concatenate(out)

    def _agrees(self, left: Chunk | None, gap: np.ndarray, before: np.ndarray) -> bool:
        self.repaired += 1
        ahead = left is None or np.array_equal(gap[: len(left.after)], left.after)
        return ahead and np.array_equal(gap[len(gap) - len(before) :], before)

    def _whole(self, raw: bytes, at: int, left: Chunk | None, out: list[np.ndarray]) -> np.ndarray:
        """Tokens from `at` to the end; where they don't agree with the last core, all again."""
        rest = self.encoder.ids(raw[at:].decode())
        if left is None or np.array_equal(rest[: len(left.after)], left.after):
            return rest
        out.clear()
        return self.encoder.ids(raw.decode())


# --- Spark ---------------------------------------------------------------------------


def encode(
    docs: DataFrame,
    path: str,
    ranks_path: str | None = None,
    text: str = "text",
    into: str = "ids",
    bits: int = 10,
    least: int = 256,
    most: int = 8192,
    memory: int = 24 << 20,
) -> DataFrame:
    """Each row with the token ids of its text.

    `path` is a byte-level tokenizer file, `ranks_path` the same vocabulary as ranks; both
    must be readable on every executor. A chunk has 2^bits bytes beyond `least` on average.
    `memory` bounds the dictionary of a worker, in bytes.
    """
    settings = (path, ranks_path, bits, least, most, memory)

    def make():
        store = worker_store()
        if settings not in store:
            store[settings] = ChunkEncoder(Encoder(path, ranks_path), bits, least, most, memory)
        encoder = store[settings]

        def batch(texts: pa.Array) -> pa.Array:
            rows = [encoder.encode(t or "") for t in texts.to_pylist()]
            sizes = np.fromiter(map(len, rows), np.int64, len(rows))
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            flat = np.concatenate(rows) if rows else np.empty(0, np.int32)
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))

        return batch

    bound_batches(docs.sparkSession)
    return docs.withColumn(into, arrow_function(make, "array<int>", BATCH_BYTES)(F.col(text)))


def decode(docs: DataFrame, path: str, ids: str = "ids", into: str = "decoded", block: int = 1 << 20) -> DataFrame:
    """Each row with the text of its token ids; an id outside the vocabulary stands for nothing."""

    def make():
        table = token_bytes(path)
        blob = np.frombuffer(b"".join(table), np.uint8)
        size = np.fromiter(map(len, table), np.int64, len(table))
        begin = np.cumsum(size) - size

        def to_bytes(flat: np.ndarray) -> bytes:
            pieces = []
            for at in range(0, len(flat), block):
                some = flat[at : at + block]
                some = some[(some >= 0) & (some < len(size))]
                lengths = size[some]
                place = np.cumsum(lengths) - lengths
                pieces.append(blob[np.repeat(begin[some] - place, lengths) + np.arange(lengths.sum())].tobytes())
            return b"".join(pieces)

        def batch(rows: pa.Array) -> pa.Array:
            offsets = rows.offsets.to_numpy()
            flat = rows.values.fill_null(-1).to_numpy(zero_copy_only=False)
            null = rows.is_null().to_pylist()
            spans = zip(offsets[:-1].tolist(), offsets[1:].tolist(), null)
            texts = ["" if gone else to_bytes(flat[a:b]).decode("utf-8", "replace") for a, b, gone in spans]
            return pa.array(texts, pa.string())

        return batch

    bound_batches(docs.sparkSession)
    return docs.withColumn(into, arrow_function(make, "string", 4 * BATCH_BYTES)(F.col(ids)))
