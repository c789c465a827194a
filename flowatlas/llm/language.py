"""Language identification by a linear-chain conditional random field over words.

Every word gets a label. Its emission scores add up character bigrams and trigrams with the
word's bounds, its three-letter prefix and suffix, and its entry in a hashed lexicon; learned
transitions join neighbouring words, and forward-backward gives each word's marginals. A
document's language is the one with the largest sum of marginals, each word counting with
its length, and the score is that sum's share. Segments are runs of words with one label.

Words are runs of letters and non-ASCII characters in lower case. A text that is null or has
no letter is `und` with score 0 and no segments; so is every text where nothing was learned.
Rows are independent, ties go to the first language by name, other columns pass through.

Training takes a bounded, hashed sample of distinct labelled documents with some of every
language, each as it is and joined with the next one, so that switches within a text are learned too; weights start from log odds
and follow the likelihood's gradient.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from flowatlas.llm.common import BATCH_BYTES, arrow_function, bound_batches, held_out, sampled_texts, struct_array

SLOTS = 1 << 16
LETTER = np.array([chr(b).isalpha() if b < 0x80 else True for b in range(256)])
ANY_LETTER = re.compile(r"[^\W\d_]")
HAS_WORD = r"[A-Za-z\x{80}-\x{10FFFF}]"
BLOCK = 1 << 20
#: Characters of the texts that are labelled together; a longer text is on its own.
PIECE = 1 << 19
RESULT = "struct<lang_pred:string,score:double,segments:array<struct<lang:string,words:long>>>"


def word_features(data: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray | None]]]:
    """Word ends in a byte buffer, and hashed features: (slots, ends of each word's run or None for one each).

    The buffer starts and ends with a byte that is no letter.
    """
    inside = LETTER[data]
    shift = np.diff(inside.astype(np.int8))
    starts, ends = np.flatnonzero(shift == 1) + 1, np.flatnonzero(shift == -1) + 1
    if not len(starts):
        return ends, []
    kept = np.where(inside, data, 0).astype(np.uint32)
    two = kept.copy()
    two[1:] += kept[:-1] << 8
    three = two.copy()
    three[2:] += kept[:-2] << 16
    three = (three * np.uint32(0x9E3779B1)) >> np.uint32(16)
    # a word's n-grams end at its own letters and at the byte after it
    held = inside.copy()
    held[ends] = True
    counts = ends - starts + 1
    run = np.cumsum(counts)

    def at(places: np.ndarray, offsets: tuple[int, ...]) -> np.ndarray:
        value = np.zeros(len(places), np.uint32)
        for k in offsets:
            value = (value + kept[np.clip(places + k, 0, len(kept) - 1)]) * np.uint32(0x01000193)
        return (value * np.uint32(0x85EBCA6B)) >> np.uint32(16)

    place = np.zeros(len(data), np.int64)  # in its word
    place[starts[0] :] = np.arange(starts[0], len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
    powers = np.uint32(0x01000193) ** (np.arange(1, 32, dtype=np.uint32))
    mixed = (kept + np.uint32(1)) * powers[np.minimum(place, 30)]
    mixed[~inside] = 0
    whole = np.add.reduceat(mixed, starts, dtype=np.uint32)
    whole = (whole * np.uint32(0xC2B2AE35)) >> np.uint32(16)
    short = ends - starts
    prefix = at(starts, (0, 1, 2))
    suffix = at(ends, (-1, -2, -3)) ^ np.uint32(0x5A5A)
    return ends, [
        (two[held], run), (three[held], run), (prefix, None), (suffix, None),
        (whole, None), (np.minimum(short, 31).astype(np.uint32), None),
    ]


def emissions(data: np.ndarray, tables: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    ends, features = word_features(data)
    total = np.zeros((len(ends), tables[0].shape[1]), np.float32)
    for (slots, run), table in zip(features, tables):
        values = table[slots]
        total += values if run is None else np.add.reduceat(values, run - np.diff(run, prepend=0), axis=0)
    return ends, total


def marginals(scores: np.ndarray, sizes: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Posterior of every word's label; `scores` holds the sequences one after another.

    Sequences are walked together, the longest first, so one step costs a few array operations.
    """
    order = np.argsort(-sizes, kind="stable")
    first = (np.cumsum(sizes) - sizes)[order]
    longest = int(sizes.max(initial=0))
    active = len(sizes) - np.searchsorted(np.sort(sizes), np.arange(longest), side="right")
    emit = np.exp(scores - scores.max(1, keepdims=True)) if len(scores) else scores
    ahead = np.empty_like(emit)
    move = np.exp(step - step.max()).astype(np.float32)
    last = None
    for t in range(longest):
        rows = first[: active[t]] + t
        now = emit[rows] if last is None else emit[rows] * (last[: active[t]] @ move)
        now = now / now.sum(1, keepdims=True)
        ahead[rows] = last = now
    out = ahead.copy()
    behind = np.ones((len(sizes), scores.shape[1]), np.float32)
    for t in range(longest - 2, -1, -1):
        n = active[t + 1]
        rows = first[:n] + t + 1
        back = (emit[rows] * behind[:n]) @ move.T
        behind[:n] = back / back.sum(1, keepdims=True)
        out[first[:n] + t] *= behind[:n]
    return out / out.sum(1, keepdims=True)


class Model:
    """Feature tables, transitions and language names; arrays only, so it travels as it is."""

    def __init__(self, names: list[str], tables: list[np.ndarray], step: np.ndarray):
        self.names, self.tables, self.step = names, tables, step


def buffers(texts: list[str], limit: int):
    """Byte buffers of whole texts, lower case and apart by a zero, with the texts' ends in each."""
    held, size = [], 0
    for text in texts:
        raw = text.lower().encode()
        if held and size + len(raw) > limit:
            yield held
            held, size = [], 0
        held.append(raw)
        size += len(raw)
    if held:
        yield held


def texts_to_words(texts: list[str], make) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """make(buffer) -> (word ends, rows); rows of all words, words of each text, bytes of each word."""
    rows, sizes, lengths = [], [], []
    for held in buffers(texts, BLOCK):
        data = np.frombuffer(b"\0" + b"\0".join(held) + b"\0", np.uint8)
        ends, some = make(data)
        text_ends = np.cumsum([len(r) + 1 for r in held])
        sizes.append(np.diff(np.searchsorted(ends, text_ends, side="right"), prepend=0))
        inside = LETTER[data]
        letters = np.cumsum(inside)[ends - 1] if len(ends) else np.empty(0, np.int64)
        lengths.append(np.diff(letters, prepend=0))
        rows.append(some)
    return np.concatenate(rows), np.concatenate(sizes), np.concatenate(lengths)


def fit(texts: list[str], langs: list[str], rounds: int = 10, rate: float = 0.3, decay: float = 1e-4) -> Model:
    """Learn from whole texts with one language each."""
    names = sorted(set(langs))
    n = len(names)
    tables = [np.zeros((s, n), np.float32) for s in (SLOTS, SLOTS, SLOTS, SLOTS, SLOTS, 32)]
    if not names:
        return Model(names, tables, np.zeros((n, n), np.float32))
    labels = np.array([names.index(x) for x in langs])
    parts = []
    for k, held in enumerate(buffers(texts, 1)):  # one text each
        data = np.frombuffer(b"\0" + b"\0".join(held) + b"\0", np.uint8)
        ends, features = word_features(data)
        parts.append((k, len(ends), features))
    parts = [p for p in parts if p[1]]
    if not parts:
        return Model(names, tables, np.zeros((n, n), np.float32))
    sizes = np.array([p[1] for p in parts])
    truth = np.repeat(labels[[p[0] for p in parts]], sizes)
    features = []
    for f in range(len(tables)):
        slots = np.concatenate([p[2][f][0] for p in parts])
        run = None
        if parts[0][2][f][1] is not None:
            run = np.cumsum(np.concatenate([np.diff(p[2][f][1], prepend=0) for p in parts]))
        features.append((slots, run))
    words_of = [np.arange(len(truth)) if run is None else np.repeat(np.arange(len(truth)), np.diff(run, prepend=0)) for _, run in features]
    for (slots, _), owner, table in zip(features, words_of, tables):
        counts = np.stack([np.bincount(slots[truth[owner] == y], minlength=len(table)) for y in range(n)], 1)
        odds = np.log((counts + 0.5) / (counts.sum(0) + 0.5 * len(table)))
        table[:] = 0.3 * (odds - odds.mean(1, keepdims=True)) * (counts.sum(1, keepdims=True) > 0)
    step = np.zeros((n, n), np.float32)
    # pairs of neighbouring documents are one sequence, then shifted by one document
    layouts = []
    for offset in (0, 1):
        cuts = [sizes[:offset], *np.split(sizes[offset:], range(2, max(2, len(sizes) - offset), 2))]
        layouts.append(np.array([int(c.sum()) for c in cuts if len(c)]))
    squares = [np.full_like(t, 1e-3) for t in tables] + [np.full_like(step, 1e-3)]
    truth_rows = np.eye(n, dtype=np.float32)[truth]
    for k in range(rounds):
        layout = layouts[k % 2]
        scores = np.zeros((len(truth), n), np.float32)
        for (slots, run), table in zip(features, tables):
            values = table[slots]
            scores += values if run is None else np.add.reduceat(values, run - np.diff(run, prepend=0), axis=0)
        post = marginals(scores, layout, step)
        error = (truth_rows - post) / len(truth)
        for f, ((slots, _), owner, table) in enumerate(zip(features, words_of, tables)):
            pull = np.stack([np.bincount(slots, error[owner, y], len(table)) for y in range(n)], 1).astype(np.float32)
            pull = pull * 1000 - decay * table
            squares[f] += pull**2
            table += rate * pull / np.sqrt(squares[f])
        inner = np.ones(len(truth), bool)
        inner[np.cumsum(layout) - 1] = False
        now = np.flatnonzero(inner)
        seen = truth_rows[now].T @ truth_rows[now + 1]
        move = np.exp(step)
        joint = post[now].T @ (post[now + 1] / np.maximum(post[now] @ move, 1e-9)) * move
        pull = ((seen - joint) / max(len(now), 1) * 100 - decay * step).astype(np.float32)
        squares[-1] += pull**2
        step = step + rate * pull / np.sqrt(squares[-1])
    return Model(names, tables, step.astype(np.float32))


def train(docs: DataFrame, text: str = "text", lang: str = "lang", learn_from: Column | None = None,
          train_docs: int = 500, least: int = 20, **options) -> Model:
    """A model from about `train_docs` distinct documents, and at least `least` of each language.

    A language with fewer gives all it has. They are chosen by a hash among rows with a word,
    a language and `learn_from`; copies of a text count once.
    """
    rows = docs.filter(F.col(text).rlike(HAS_WORD) & F.col(lang).isNotNull())
    if learn_from is not None:
        rows = rows.filter(learn_from)
    picked = sampled_texts(rows.select(F.col(text).alias("text"), F.col(lang).alias("label")), train_docs, least)
    order = np.random.default_rng(1).permutation(len(picked))
    return fit([picked[i][0] for i in order], [picked[i][1] for i in order], **options)


def label_texts(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Language, score and segments (labels, words) of every text."""
    names = model.names
    plain = [t if t and names and ANY_LETTER.search(t) else "" for t in texts]
    if not any(plain):
        nothing = (np.empty(0, np.int64), np.empty(0, np.int64))
        return ["und"] * len(texts), np.zeros(len(texts)), [nothing] * len(texts)
    scores, sizes, lengths = texts_to_words(plain, lambda data: emissions(data, model.tables))
    post = marginals(scores, sizes, model.step)
    owner = np.repeat(np.arange(len(texts)), sizes)
    mass = np.stack([np.bincount(owner, post[:, y] * lengths, len(texts)) for y in range(len(names))], 1)
    total = mass.sum(1)
    best = mass.argmax(1)
    share = np.where(total > 0, mass[np.arange(len(texts)), best] / np.where(total > 0, total, 1), 0.0)
    label = post.argmax(1)
    new = np.ones(len(label), bool)
    new[1:] = (label[1:] != label[:-1]) | (owner[1:] != owner[:-1])
    begin = np.flatnonzero(new)
    size = np.diff(np.append(begin, len(label)))
    cuts = np.searchsorted(owner[begin], np.arange(len(texts) + 1))
    segments = [(label[begin[a:b]], size[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
    found = [names[b] if t > 0 else "und" for b, t in zip(best.tolist(), total.tolist())]
    return found, np.clip(share, 0.0, 1.0), segments


def label_batch(model: Model, texts: list[str | None]):
    """`label_texts` over pieces of bounded size, texts of like length together."""
    order = sorted(range(len(texts)), key=lambda k: -len(texts[k] or ""))
    langs, scores, segments = ["und"] * len(texts), np.zeros(len(texts)), [None] * len(texts)
    at = 0
    while at < len(order):
        end, size = at, 0
        while end < len(order) and (end == at or size < PIECE):
            size += len(texts[order[end]] or "")
            end += 1
        some = order[at:end]
        found = label_texts(model, [texts[k] for k in some])
        for i, k in enumerate(some):
            langs[k], segments[k] = found[0][i], found[2][i]
        scores[some] = found[1]
        at = end
    return langs, scores, segments


def identify(docs: DataFrame, model: Model, text: str = "text", into: str = "language") -> DataFrame:
    """Each row with a struct of its language, score and segments."""
    names, tables, step = model.names, model.tables, model.step

    def make():
        own = Model(names, tables, step)
        kind = pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int64())]))

        def batch(texts: pa.Array) -> pa.Array:
            langs, scores, segments = label_batch(own, texts.to_pylist())
            offsets = np.cumsum([0, *(len(a) for a, _ in segments)]).astype(np.int32)
            labels = np.concatenate([a for a, _ in segments] or [np.empty(0, np.int64)]).astype(np.int64)
            words = np.concatenate([b for _, b in segments] or [np.empty(0, np.int64)]).astype(np.int64)
            label_names = pa.array(names, pa.string()).take(pa.array(labels))
            inner = pa.StructArray.from_arrays([label_names, pa.array(words)], names=["lang", "words"])
            runs = pa.ListArray.from_arrays(pa.array(offsets), inner).cast(kind)
            top = struct_array({"lang_pred": (langs, pa.string()), "score": (scores, pa.float64())})
            return pa.StructArray.from_arrays([*top.flatten(), runs], names=["lang_pred", "score", "segments"])

        return batch

    bound_batches(docs.sparkSession)
    return docs.withColumn(into, arrow_function(make, RESULT, BATCH_BYTES)(F.col(text)))


def learnable(doc_id: str = "doc_id") -> Column:
    return ~held_out(F.col(doc_id))
