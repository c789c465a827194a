"""Token ids of a word-level BPE tokenizer, each distinct word encoded once for each worker.

The tokenizer's own rules never join text across white space, so the ids of a text are those
of its parts. Texts of plain Latin letters are cut into the tokenizer's words by byte classes;
all others into what stands between ASCII white space, added tokens included. Words and parts
are encoded by the library, and the results kept: recently used ones in two generations, of
which the older goes when the newer is full. A tokenizer file with other rules is used as it
is, text by text.
"""

import json
import re
import unicodedata
from collections.abc import Iterable

import numpy as np
import pyarrow as pa

#: The rules of the tokenizer file for which texts may be cut into words beforehand (fixed values).
NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    {"type": "Lowercase"},
]
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: What keeps a text out of the Latin way: other letters, controls, less usual white space.
UNUSUAL = re.compile("[^\t\n\r\x20-\x7e¡-ÿ]")
BLANK = re.compile("[\t\n\r ]+")
NONE, LETTER, DIGIT, OTHER = range(4)
LATIN = [chr(c) for c in range(256)]
CLASS = np.array([
    NONE if c in "\t\n\r " else {"L": LETTER, "N": DIGIT}.get(unicodedata.category(c)[0], OTHER) for c in LATIN
], np.uint8)
LOWER = np.array([ord(c.lower()) if len(c.lower()) == 1 and ord(c.lower()) < 256 else ord(c) for c in LATIN], np.uint8)
PART = 1 << 20


def word_places(data: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Where the tokenizer's words begin in lower-case Latin bytes."""
    begins = kind != NONE
    begins[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    # an apostrophe alone before a letter takes a short ending along
    tail = np.concatenate([data, np.zeros(3, np.uint8)])
    tail_kind = np.concatenate([kind, np.full(3, NONE, np.uint8)])
    at = np.flatnonzero((data == ord("'")) & begins)
    at = at[tail_kind[at + 1] == LETTER]
    one, two = tail[at + 1], tail[at + 2]
    short = np.isin(one, list(b"stmd"))
    long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    for those, size in ((at[short], 2), (at[long], 3)):
        begins[those + 1] = False
        rest = those + size
        begins[rest[tail_kind[rest] == LETTER]] = True
    return np.flatnonzero(begins)


class WordEncoder:
    """Ids of texts as the tokenizer file says; holds up to `memory` bytes of words."""

    def __init__(self, path: str, memory: int):
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        self.exact.no_truncation()
        self.exact.no_padding()
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        splits = content["pre_tokenizer"].get("pretokenizers", [{}]) if content["pre_tokenizer"] else [{}]
        self.by_words = (
            content["normalizer"] == {"type": "Sequence", "normalizers": NORMALIZERS}
            and splits[0].get("pattern") == {"Regex": WORDS}
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or BLANK.search(t["content"]) for t in content["added_tokens"])
        )
        #: for words that are in normal form already
        self.plain = Tokenizer.from_file(path)
        self.plain.no_truncation()
        self.plain.no_padding()
        self.plain.normalizer = None
        self.added = re.compile("|".join(re.escape(t["content"]) for t in content["added_tokens"]) or r"(?!)")
        size = self.exact.get_vocab_size()
        self.width = 2 if size <= 1 << 16 else 4
        self.last = np.zeros(size, bool)  # ids that end a word
        self.last[[i for t, i in content["model"]["vocab"].items() if t.endswith("</w>")]] = True
        self.kind = np.dtype(f"<u{self.width}")
        self.new: dict = {}
        self.old: dict = {}
        self.held, self.memory = 0, memory

    def _keep(self, word, ids: bytes) -> None:
        self.held += len(word) + len(ids) + 160
        if self.held > self.memory // 2:
            self.old, self.new, self.held = self.new, {}, 0
        self.new[word] = ids

    def _all(self, words: list) -> list[bytes]:
        """The ids of each of some different words, as bytes."""
        found, missing = [None] * len(words), []
        for k, word in enumerate(words):
            ids = self.new.get(word)
            if ids is None:
                ids = self.old.get(word)
                if ids is None:
                    missing.append(k)
                    continue
                self._keep(word, ids)
            found[k] = ids
        for k, ids in zip(missing, self._encode([words[k] for k in missing])):
            found[k] = ids
            self._keep(words[k], ids)
        return found

    def _encode(self, words: list) -> Iterable[bytes]:
        for at in range(0, len(words), 20_000):
            some = words[at : at + 20_000]
            if isinstance(some[0], bytes):
                line = b" ".join(some).decode("latin-1")
                ids = np.array(self.plain.encode_batch_fast([line], add_special_tokens=False)[0].ids, self.kind)
                ends = (np.flatnonzero(self.last[ids]) + 1) * self.width
                if len(ends) == len(some):
                    raw, at = ids.tobytes(), 0
                    for end in ends.tolist():
                        yield raw[at:end]
                        at = end
                    continue
                some = [w.decode("latin-1") for w in some]
            for each in self.exact.encode_batch_fast(some, add_special_tokens=False):
                yield np.array(each.ids, self.kind).tobytes()

    def _latin(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        raw = "\n".join(texts).encode("latin-1")
        data = LOWER[np.frombuffer(raw, np.uint8)]
        kind = CLASS[data]
        at = word_places(data, kind)
        inside = kind != NONE
        content = data[inside]
        ends = np.append((np.cumsum(inside) - 1)[at], len(content)).astype(np.int32)
        words = pa.BinaryArray.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(content)])
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        return self._gathered(words, np.searchsorted(at, np.cumsum(sizes)))

    def _parts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parts = [[p for p in BLANK.split(t) if p] for t in texts]
        return self._gathered(pa.array([p for row in parts for p in row], pa.string()), np.cumsum([*map(len, parts)], dtype=np.int64))

    def _gathered(self, words: pa.Array, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends) of texts whose words end there."""
        coded = words.dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False)
        known = self._all(coded.dictionary.to_pylist())
        size = np.fromiter(map(len, known), np.int64, len(known)) // self.width
        begin = np.cumsum(size) - size
        flat = np.frombuffer(b"".join(known), self.kind)
        lengths = size[code]
        place = np.cumsum(lengths)
        ids = flat[np.repeat(begin[code] - (place - lengths), lengths) + np.arange(place[-1] if len(place) else 0)]
        return ids, np.concatenate([[0], place])[ends]

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        rows = [np.array(e.ids, self.kind) for e in self.exact.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate(rows), np.cumsum([len(r) for r in rows])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        parts = [[*long_parts(t)] if self.by_words else [t] for t in texts]
        each = [p for row in parts for p in row]
        latin = [self.by_words and not UNUSUAL.search(t) and not self.added.search(t) for t in each]
        out: list = [None] * len(each)
        for way, those in (
            (self._latin, [k for k, x in enumerate(latin) if x]),
            (self._parts if self.by_words else self._whole, [k for k, x in enumerate(latin) if not x]),
        ):
            if those:
                ids, ends = way([each[k] for k in those])
                for k, row in zip(those, np.split(ids, ends[:-1])):
                    out[k] = row
        found, at = [], 0
        for row in parts:
            found.append(out[at] if len(row) == 1 else np.concatenate(out[at : at + len(row)]))
            at += len(row)
        return found


def long_parts(text: str) -> Iterable[str]:
    """A text in parts of about a million characters that end before white space."""
    at = 0
    while len(text) - at > PART and (found := BLANK.search(text, at + PART)):
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]
