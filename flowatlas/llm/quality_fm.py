"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

Features of a text: its words, hashed into slots, with their share of the text's words
(scaled to unit length together); figures of its structure, standardised on the training
rows; and metadata columns as logarithms. The score is the logistic of

    w0 + sum w_j x_j + 1/2 sum_f [ (sum_j v_jf x_j)^2 - sum_j v_jf^2 x_j^2 ]

the sum-of-squares identity, so that all pairs of features count at the cost of a pass.

A null or empty text has no words and zero figures, and is scored like any other. Missing
metadata counts as zero. Labels are joined by id: several labels of one document count with
their mean, null ones not at all. Repeated rows give repeated scores, other columns pass
through. With no labelled rows every score is one half.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from flowatlas.llm.common import arrow_function, bound_batches, sampled, struct_array

SLOTS = 1 << 16
BLOCK = 1 << 21
SPACE = np.array([chr(b) in " \t\n\r\x0b\x0c" for b in range(256)])
FIGURES = (
    "log_chars", "log_words", "word_length", "symbols", "digits", "upper", "punctuation",
    "line_words", "repeated_lines", "distinct_words", "top_word", "long_words",
)
SYMBOLS = "#*$%&|<>{}[]\\^~_=+@"
PUNCTUATION = ".,;:!?\"'()-"


def word_slots(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the white-space words of a buffer that begins and ends with white space; their slots."""
    shift = np.diff(SPACE[data].astype(np.int8))
    starts, ends = np.flatnonzero(shift == -1) + 1, np.flatnonzero(shift == 1) + 1
    if not len(starts):
        return ends, starts
    place = np.zeros(len(data), np.int64)
    place[starts[0] :] = np.arange(starts[0], len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
    powers = np.uint32(0x01000193) ** np.arange(1, 65, dtype=np.uint32)
    mixed = (data.astype(np.uint32) + np.uint32(1)) * powers[place & 63]
    mixed[SPACE[data]] = 0
    whole = np.add.reduceat(mixed, starts, dtype=np.uint32) * np.uint32(0x85EBCA6B)
    return ends, (whole >> np.uint32(16)).astype(np.int64)


def structure(text: str, words: int, distinct: int, top: int) -> list[float]:
    n = max(len(text), 1)
    raw = text.encode()
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) if raw else np.zeros(256)
    lines = [line for line in text.split("\n") if line.strip()]
    letters = n - counts[SPACE].sum()
    symbols = counts[[ord(c) for c in SYMBOLS]].sum()
    return [
        np.log1p(len(text)), np.log1p(words), letters / max(words, 1), symbols / n,
        counts[48:58].sum() / n, counts[65:91].sum() / n, counts[[ord(c) for c in PUNCTUATION]].sum() / n,
        np.log1p(words / max(len(lines), 1)), 1 - len(set(lines)) / max(len(lines), 1),
        distinct / max(words, 1), top / max(words, 1), max(0.0, letters / max(words, 1) - 8),
    ]


def vectors(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, slot and value of every word feature, and the figures of every text."""
    rows, slots, values, figures = [], [], [], []
    at = 0
    while at < len(texts):
        some, size = [], 0
        while at + len(some) < len(texts) and (not some or size < BLOCK):
            some.append((texts[at + len(some)] or ""))
            size += len(some[-1])
        encoded = [t.lower().encode() for t in some]
        data = np.frombuffer(b" " + b" ".join(encoded) + b" ", np.uint8)
        ends, slot = word_slots(data)
        text_ends = np.cumsum([len(r) + 1 for r in encoded])
        sizes = np.diff(np.searchsorted(ends, text_ends, side="right"), prepend=0)
        key, count = np.unique(np.repeat(np.arange(len(some)), sizes) * SLOTS + slot, return_counts=True)
        row = key // SLOTS
        distinct = np.bincount(row, minlength=len(some))
        top = np.zeros(len(some), np.int64)
        np.maximum.at(top, row, count)
        norm = np.sqrt(np.bincount(row, count.astype(float) ** 2, len(some)))
        rows.append(row + at)
        slots.append(key % SLOTS)
        values.append((count / norm[row]).astype(np.float32))
        figures += [structure(*x) for x in zip(some, sizes.tolist(), distinct.tolist(), top.tolist())]
        at += len(some)
    empty = np.empty(0, np.int64)
    return (
        np.concatenate(rows or [empty]), np.concatenate(slots or [empty]),
        np.concatenate(values or [empty.astype(np.float32)]),
        np.array(figures, np.float32).reshape(-1, len(FIGURES)),
    )


class Machine:
    """Weights of the factorisation machine; dense features follow the word slots."""

    def __init__(self, n_dense: int, factors: int, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.bias, self.linear = 0.0, np.zeros(SLOTS + n_dense, np.float32)
        self.factors = rng.normal(0, 0.02, (SLOTS + n_dense, factors)).astype(np.float32)
        self.mean, self.spread = np.zeros(n_dense, np.float32), np.ones(n_dense, np.float32)

    def dense(self, figures: np.ndarray) -> np.ndarray:
        return np.clip((figures - self.mean) / self.spread, -4, 4) / np.sqrt(len(self.mean))

    def score(self, n: int, row: np.ndarray, slot: np.ndarray, value: np.ndarray, dense: np.ndarray):
        """Scores before the logistic, and for each text the sums of v x."""
        width = self.factors.shape[1]
        out = self.bias + dense @ self.linear[SLOTS:] + np.bincount(row, self.linear[slot] * value, n)
        sums = dense @ self.factors[SLOTS:]
        squares = (dense**2) @ (self.factors[SLOTS:] ** 2)
        if len(row):
            first = np.flatnonzero(np.diff(row, prepend=-1))
            weighted = self.factors[slot] * value[:, None]
            sums[row[first]] += np.add.reduceat(weighted, first, axis=0)
            squares[row[first]] += np.add.reduceat(weighted**2, first, axis=0)
        return out + 0.5 * (sums**2 - squares).sum(1), sums.reshape(n, width)


def fit(texts: list[str], extra: np.ndarray, labels: np.ndarray, factors: int = 8, rounds: int = 40,
        rate: float = 0.05, decay: float = 2e-4) -> Machine:
    """Learn from labelled texts (labels 0 to 1) with the adaptive gradient method."""
    row, slot, value, figures = vectors(texts)
    figures = np.concatenate([figures, extra], axis=1)
    model = Machine(figures.shape[1], factors)
    if not len(texts):
        model.factors[:] = 0
        return model
    model.mean, model.spread = figures.mean(0), np.maximum(figures.std(0), 1e-3)
    model.bias = float(np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1)))
    dense, n = model.dense(figures), len(texts)
    square = [1e-6, np.full_like(model.linear, 1e-6), np.full_like(model.factors, 1e-6)]
    for _ in range(rounds):
        raw, sums = model.score(n, row, slot, value, dense)
        error = (1 / (1 + np.exp(-raw)) - labels) / n
        pull = error[row] * value
        linear = np.concatenate([np.bincount(slot, pull, SLOTS), error @ dense]).astype(np.float32)
        outer = np.zeros_like(model.factors)
        for f in range(factors):
            outer[:SLOTS, f] = np.bincount(slot, pull * (sums[row, f] - model.factors[slot, f] * value), SLOTS)
        outer[SLOTS:] = dense.T @ (error[:, None] * sums) - ((dense**2).T @ error)[:, None] * model.factors[SLOTS:]
        linear += decay * model.linear / 10
        outer += decay * model.factors / 10
        for k, (weights, slope) in enumerate(((None, error.sum()), (model.linear, linear), (model.factors, outer))):
            square[k] = square[k] + slope**2
            move = rate * slope / np.sqrt(square[k])
            if weights is None:
                model.bias -= float(move)
            else:
                weights -= move
    return model


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text",
          metadata: tuple[str, ...] = ("n_chars",), learn_from: Column | None = None,
          train_docs: int = 3000, **options) -> Machine:
    """A model from about `train_docs` labelled documents (never over one and a half times as many).

    `learn_from` is a condition on the labels' id. A document that stands several times in
    `docs` counts once, with its smallest text.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
    if learn_from is not None:
        known = known.filter(learn_from)
    known = known.groupBy(doc_id).agg(F.avg(label).alias("_label"))
    bounded = F.broadcast(sampled(known, train_docs, doc_id))  # at most 1.5 times train_docs rows
    extra = [F.coalesce(F.log1p(F.greatest(F.col(m).cast("double"), F.lit(0.0))), F.lit(0.0)) for m in metadata]
    extra = F.array(*extra) if extra else F.lit(None).cast("array<double>")
    row = F.struct(F.coalesce(text, F.lit("")).alias("text"), extra.alias("extra"), F.col("_label").alias("label"))
    picked = docs.join(bounded, doc_id).groupBy(doc_id).agg(F.min(row).alias("row"))
    rows = [r["row"] for r in picked.orderBy(F.xxhash64(doc_id), doc_id).collect()]
    meta = np.array([r["extra"] or [] for r in rows], np.float32).reshape(len(rows), len(metadata))
    return fit([r["text"] for r in rows], meta, np.array([r["label"] for r in rows], np.float64), **options)


def score_quality(docs: DataFrame, model: Machine, text: str = "text", metadata: tuple[str, ...] = ("n_chars",),
                  into: str = "quality") -> DataFrame:
    """Each row with a struct of its score and predicted class (1 from one half on)."""
    state = dict(vars(model))

    def batch(texts: pa.Array, *extra: pa.Array) -> pa.Array:
        own = object.__new__(Machine)
        vars(own).update(state)
        plain = texts.to_pylist()
        scores = np.empty(len(plain))
        at = 0
        while at < len(plain):  # a bounded number of characters at a time
            end, size = at, 0
            while end < len(plain) and (end == at or size < 2 * BLOCK):
                size += len(plain[end] or "")
                end += 1
            row, slot, value, figures = vectors(plain[at:end])
            meta = [np.nan_to_num(np.log1p(np.maximum(e.slice(at, end - at).cast(pa.float64()).fill_null(0).to_numpy(), 0))) for e in extra]
            dense = own.dense(np.column_stack([figures, *meta]).astype(np.float32))
            raw, _ = own.score(end - at, row, slot, value, dense)
            scores[at:end] = 1 / (1 + np.exp(-np.clip(raw, -50, 50)))
            at = end
        predicted = (scores >= 0.5).astype(np.int32)
        return struct_array({"score": (scores, pa.float64()), "predicted": (predicted, pa.int32())})

    columns = [F.col(text), *(F.col(m).cast("double") for m in metadata)]
    bound_batches(docs.sparkSession)
    return docs.withColumn(into, _many(batch, len(columns))(*columns))


def _many(function, n_columns: int):
    """An Arrow function of one or two columns."""
    def one(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield function(batch)

    def several(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for batch in batches:
            yield function(*batch)

    return F.arrow_udf(one if n_columns == 1 else several, "struct<score:double,predicted:int>")
