"""Personal data by patterns and a skip-chain conditional random field.

Base spans come from fixed patterns, leftmost and non-overlapping for each kind; matches
that fail a kind's check are dropped and not tried again. They count as they are.

The field adds spans. Its nodes are the tokens of a text that hold a digit or an at sign
(any other token is `other` for certain). Neighbouring nodes that are close in the text share
a transition potential. Distant nodes that are the same, or whose digits are the same, share a
skip potential with the previous such node, so a value that stands many times makes a chain
and not all pairs. Loopy belief propagation passes messages over both kinds of edges, for all
texts of a batch at once, and so carries a label from one mention to the others. Weights are
learned from the base spans of a bounded, hashed sample with some of every kind, without the checks (a digit sum, a
largest part) among the features: tokens that look and stand like a kind are labelled with
it where a check or a neighbour had hidden them from the pattern.

A run of tokens with one label becomes a span if the mean marginal is `sure` at least, it has
as much of the kind's form as `WHOLE` asks, and no base span overlaps it. Null and empty
texts have none. Rows are independent and other columns pass through.
"""

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from flowatlas.llm.common import BATCH_BYTES, arrow_function, bound_batches, sampled_texts

KINDS = ("email", "ip", "card", "phone")
LABELS = ("other", *KINDS)
HINT = re.compile(r"[0-9@]")
TOKEN = re.compile(r"\S+")
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: Equal to the plain patterns: what follows a run can't begin inside it.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")
EDGE_MARKS = "\"'`.,;:!?()[]{}<>|"
N_FEATURES = 1024
RESULT = "struct<spans:array<struct<kind:string,begin:long,end:long,base:boolean>>,redacted:string>"
WHOLE = {
    "email": lambda s: "@" in s.strip("@") and "." in s.rpartition("@")[2],
    "ip": lambda s: s.count(".") == 3,
    "card": lambda s: 14 <= len(NOT_DIGIT.sub("", s)) <= 19,
    "phone": lambda s: 10 <= len(NOT_DIGIT.sub("", s)) <= 15 and s.startswith("+"),
}


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return (sum(values[::2]) + sum(sum(divmod(2 * v, 10)) for v in values[1::2])) % 10 == 0


def emails(text: str):
    """Spans of the e-mail pattern, found from each at sign outwards."""
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in LOCAL:
            begin -= 1
        if begin < at and (match := DOMAIN.match(text, at + 1)):
            done = match.end()
            yield begin, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, begin, end) by begin, then kind."""
    found = [("email", *span) for span in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = NOT_DIGIT.sub("", m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 10 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
            found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


# --- nodes and edges -----------------------------------------------------------------


def nodes_of(text: str) -> list[tuple[int, int, str]]:
    """(begin, end, string) of the tokens with a digit or at sign, outer marks left out."""
    nodes, done = [], 0
    for hint in HINT.finditer(text):
        if hint.start() < done:
            continue
        begin = hint.start()
        while begin > done and not text[begin - 1].isspace():
            begin -= 1
        done = TOKEN.match(text, begin).end()
        a, b = begin, done
        while b > a and text[b - 1] in EDGE_MARKS:
            b -= 1
        while a < b and text[a] in EDGE_MARKS:
            a += 1
        if a < b:
            nodes.append((a, b, text[a:b]))
    return nodes


def slot(name: str) -> int:
    value = 2166136261
    for c in name.encode():
        value = (value ^ c) * 16777619 & 0xFFFFFFFF
    return value % N_FEATURES


def features_of(text: str, node: tuple[int, int, str]) -> list[int]:
    begin, end, token = node
    digits = NOT_DIGIT.sub("", token)
    rest = token.replace("@", "")
    shape = re.sub(r"[0-9]+", "9", re.sub(r"[A-Za-z]+", "a", token))[:12]
    before = text[max(0, begin - 24) : begin].split()
    names = [
        "bias", f"digits={min(len(digits), 20)}", f"shape={shape}", f"dots={min(token.count('.'), 4)}",
        f"at={token.count('@')}", f"plus={token[0] == '+' or text[max(0, begin - 1)] == '+'}",
        f"letters={any(c.isalpha() for c in rest)}", f"dash={min(token.count('-'), 3)}",
        f"long={min(len(token) // 4, 8)}", f"before={before[-1].lower() if before else ''}",
        f"only={len(digits) == len(token)}:{min(len(digits), 20)}",
    ]
    return [slot(name) for name in names]


class Graph:
    """Nodes of many texts with chain (0) and skip (1) edges."""

    def __init__(self, texts: list[str]):
        self.place, self.features, edges = [], [], []
        for k, text in enumerate(texts):
            last: dict[str, int] = {}
            for node in nodes_of(text):
                i = len(self.place)
                if i and self.place[-1][0] == k and node[0] - self.place[-1][2] <= 3:
                    edges.append((i - 1, i, 0))
                self.place.append((k, *node))
                self.features.append(features_of(text, node))
                digits = NOT_DIGIT.sub("", node[2])
                keys = {node[2].lower()} | ({digits} if len(digits) >= 6 else set())
                for before in {last[key] for key in keys if key in last}:
                    edges.append((before, i, 1))
                last |= dict.fromkeys(keys, i)
        self.edges = np.array(edges, np.int64).reshape(-1, 3)
        self.features = np.array(self.features, np.int64).reshape(len(self.place), -1 if self.place else 1)


def log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    most = values.max(axis, keepdims=True)
    return np.squeeze(most, axis) + np.log(np.exp(values - most).sum(axis))


class Field:
    """Weights: of features by label, and of label pairs by kind of edge."""

    def __init__(self):
        n = len(LABELS)
        self.node = np.zeros((N_FEATURES, n))
        self.pair = np.stack([np.zeros((n, n)), np.eye(n)])  # the same value has the same label

    def infer(self, graph: Graph, rounds: int = 15, edges: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Marginals of nodes, and of edges if asked for, by damped messages until they rest or `rounds` passed."""
        own = self.node[graph.features].sum(1)
        source = np.concatenate([graph.edges[:, 0], graph.edges[:, 1]])
        target = np.concatenate([graph.edges[:, 1], graph.edges[:, 0]])
        m, n = len(graph.edges), len(LABELS)
        kind = graph.edges[:, 2]
        pair = np.concatenate([self.pair[kind], self.pair[kind].transpose(0, 2, 1)]) if m else np.zeros((0, n, n))
        back = np.concatenate([np.arange(m, 2 * m), np.arange(m)])
        message = np.zeros((2 * m, n))
        belief = own
        for _ in range(rounds if m else 0):
            new = log_sum((belief[source] - message[back])[:, :, None] + pair, 1)
            new = 0.3 * message + 0.7 * (new - log_sum(new, 1)[:, None])
            rest = np.abs(new - message).max()
            message = new
            belief = own + np.stack([np.bincount(target, message[:, y], len(own)) for y in range(n)], 1)
            if rest < 1e-4:
                break
        nodes = np.exp(belief - log_sum(belief, 1)[:, None]) if len(own) else belief
        if not edges:
            return nodes, None
        a, b = graph.edges[:, 0], graph.edges[:, 1]
        joint = (belief[a] - message[m:])[:, :, None] + (belief[b] - message[:m])[:, None, :] + pair[:m]
        joint = np.exp(joint - joint.max((1, 2), keepdims=True)) if m else joint
        return nodes, joint / joint.sum((1, 2), keepdims=True) if m else joint


def fit(texts: list[str], rounds: int = 60, rate: float = 0.3, decay: float = 1e-3) -> Field:
    """Learn from the base spans: gradient of the likelihood, with belief propagation's marginals."""
    field, graph = Field(), Graph(texts)
    if not graph.place:
        field.node[:, 0] = 1.0  # nothing seen: all other
        return field
    truth = np.zeros(len(graph.place), np.int64)
    spans = [base_spans(t) for t in texts]
    for i, (k, a, b, _) in enumerate(graph.place):
        for kind, begin, end in spans[k]:
            if begin < b and a < end:
                truth[i] = LABELS.index(kind)
    n = len(LABELS)
    hot = np.eye(n)[truth]
    square_node, square_pair = np.full_like(field.node, 1e-6), np.full_like(field.pair, 1e-6)
    for _ in range(rounds):
        nodes, joint = field.infer(graph, 8, edges=True)
        error = (hot - nodes) / len(nodes)
        pull = np.stack(
            [np.bincount(graph.features.ravel(), np.repeat(error[:, y], graph.features.shape[1]), N_FEATURES) for y in range(n)], 1
        ) - decay * field.node / 100
        square_node += pull**2
        field.node += rate * pull / np.sqrt(square_node)
        pull = -decay * (field.pair - Field().pair) / 10
        for kind in (0, 1):
            here = graph.edges[:, 2] == kind
            a, b = graph.edges[here, 0], graph.edges[here, 1]
            pull[kind] += (hot[a].T @ hot[b] - joint[here].sum(0)) / len(nodes)
            if kind == 1:  # a skip edge knows no order
                pull[kind] = (pull[kind] + pull[kind].T) / 2
        square_pair += pull**2
        field.pair += rate * pull / np.sqrt(square_pair)
    return field


def kinds_of(texts: pa.Array) -> pa.Array:
    """The kinds of each text's base spans, as bits."""
    return pa.array([sum({1 << KINDS.index(kind) for kind, _, _ in base_spans(t)}) for t in texts.to_pylist()], pa.int32())


def train(docs: DataFrame, text: str = "text", learn_from: Column | None = None, train_docs: int = 2000,
          least: int = 100, **options) -> Field:
    """Weights from about `train_docs` distinct documents with a digit or at sign.

    They are chosen by a hash of the text, and of each set of base kinds that texts have there
    are `least` or all at least; copies of a text count once. No label is used but base spans.
    """
    rows = docs.filter(F.col(text).rlike("[0-9@]"))
    if learn_from is not None:
        rows = rows.filter(learn_from)
    bound_batches(docs.sparkSession)
    kinds = arrow_function(lambda: kinds_of, "int", BATCH_BYTES)(F.col("text"))
    rows = rows.select(F.col(text).alias("text")).withColumn("label", kinds)
    return fit([t for t, _ in sampled_texts(rows, train_docs, least)], **options)


def added_spans(field: Field, texts: list[str], bases: list[list[tuple[str, int, int]]], sure: float) -> dict[int, list]:
    """Spans of the field alone, by the texts' numbers."""
    graph = Graph(texts)
    found = defaultdict(list)
    if not graph.place:
        return found
    nodes, _ = field.infer(graph)
    label, share = nodes.argmax(1), nodes.max(1)
    i = 0
    while i < len(label):
        j = i + 1
        if label[i]:
            k, text, kind = graph.place[i][0], texts[graph.place[i][0]], LABELS[label[i]]

            def span(last: int) -> tuple[int, int]:
                begin = graph.place[i][1]
                return begin - (begin > 0 and text[begin - 1] == "+"), graph.place[last][2]

            # a whole token stands alone; parts of one value join
            while (
                j < len(label) and label[j] == label[i] and graph.place[j][0] == k
                and graph.place[j][1] - graph.place[j - 1][2] <= 3
                and not WHOLE[kind](text[slice(*span(j - 1))]) and kind in ("card", "phone")
            ):
                j += 1
            begin, end = span(j - 1)
            free = all(end <= a or b <= begin for _, a, b in bases[k])
            if free and share[i:j].mean() >= sure and WHOLE[kind](text[begin:end]):
                found[k].append((kind, begin, end))
        i = j
    return found


def redact(text: str, spans: list[tuple[str, int, int, bool]]) -> str:
    """Each span, or run of overlapping ones, as the first one's kind in brackets."""
    out, at = [], 0
    for kind, begin, end, _ in spans:
        if begin >= at:
            out += [text[at:begin], f"[{kind.upper()}]"]
            at = end
        else:
            at = max(at, end)
    return "".join([*out, text[at:]])


def find_personal_data(docs: DataFrame, field: Field, text: str = "text", into: str = "pii", sure: float = 0.9) -> DataFrame:
    """Each row with its spans (by begin, then kind) and the text with all of them replaced.

    Null stays null where it is redacted.
    """
    node, pair = field.node, field.pair

    def make():
        own = Field()
        own.node, own.pair = node, pair
        one = pa.struct([("kind", pa.string()), ("begin", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])

        def batch(texts: pa.Array) -> pa.Array:
            plain = texts.to_pylist()
            at = [k for k, t in enumerate(plain) if t and HINT.search(t)]
            some = [plain[k] for k in at]
            bases = [base_spans(t) for t in some]
            added = added_spans(own, some, bases, sure)
            spans, redacted = [[] for _ in plain], [None] * len(plain)
            for i, k in enumerate(at):
                both = [(*s, True) for s in bases[i]] + [(*s, False) for s in added.get(i, [])]
                both.sort(key=lambda s: (s[1], KINDS.index(s[0])))
                redacted[k] = redact(plain[k], both) if both else None
                spans[k] = [dict(zip(("kind", "begin", "end", "base"), s)) for s in both]
            columns = [pa.array(spans, pa.list_(one)), pa.array(redacted, pa.string())]
            return pa.StructArray.from_arrays(columns, names=["spans", "redacted"])

        return batch

    bound_batches(docs.sparkSession)
    found = docs.withColumn(into, arrow_function(make, RESULT, BATCH_BYTES)(F.col(text)))
    # texts without a span stay where they are and don't come back from Python
    whole = F.coalesce(F.col(into)["redacted"], F.col(text)).alias("redacted")
    return found.withColumn(into, F.struct(F.col(into)["spans"].alias("spans"), whole))


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
