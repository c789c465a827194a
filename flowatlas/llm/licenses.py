"""License scan: Aho-Corasick over normalised words, shunting-yard over tag expressions.

Every text is lower-cased in A-Z and cut into words of digits, letters and non-ASCII
characters. One automaton holds all notice phrases and identifier tags; a phrase matches
where its words stand consecutively, whatever stands between them. After an identifier tag
the licence expression is read from the raw text, parsed with a shunting-yard and evaluated.

Evaluation: every identifier has an openness from 0 to 1, an unknown one that of `UNKNOWN`.
`and` takes the smaller, `or` the larger, `with` lifts a licence halfway to 1 (an exception
grants more). A text's score is the smallest openness of all it states, as all of it holds
at once; 0 where it states nothing.

Null and empty texts have no words and no labels, and score 0. Rows are independent, so
repeated rows give repeated results; other columns pass through.
"""

import re
from collections.abc import Iterable

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from flowatlas.llm.common import LOWER_BYTES, arrow_function, bound_batches, struct_array

BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
NOTICE_PHRASES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the apache license": "apache-2",
    "redistribution and use in source and binary forms": "bsd",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl-2",
    "boost software license": "bsl-1",
    "isc license": "isc",
    "creative commons attribution": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc0 1 0 universal": "cc0",
    "dedicated to the public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}
TAGS = ("spdx license identifier", "license expression")
OPENNESS = {
    "mit": 1.0, "apache-2": 1.0, "bsd": 1.0, "isc": 1.0, "bsl-1": 1.0, "cc0": 1.0,
    "public-domain": 1.0, "cc-by": 0.9, "mpl-2": 0.7, "lgpl": 0.6, "cc-by-sa": 0.5,
    "gpl": 0.4, "agpl": 0.3, "cc-by-nd": 0.2, "cc-by-nc": 0.2, "all-rights-reserved": 0.0,
}
UNKNOWN = 0.3
#: Families of identifiers, by their start, to labels.
FAMILIES = (
    ("apache-2", "apache-2"), ("bsd-", "bsd"), ("agpl", "agpl"), ("lgpl", "lgpl"), ("gpl", "gpl"),
    ("mpl-2", "mpl-2"), ("cc0", "cc0"), ("cc-by-nc", "cc-by-nc"), ("cc-by-nd", "cc-by-nd"),
    ("cc-by-sa", "cc-by-sa"), ("cc-by", "cc-by"), ("bsl-1", "bsl-1"), ("isc", "isc"), ("mit", "mit"),
)

SEPARATORS = bytes(b for b in range(0x80) if not chr(b).isalnum())
WORD_TABLE = LOWER_BYTES.translate(bytes.maketrans(SEPARATORS, b" " * len(SEPARATORS)))
TAGGED = re.compile(
    r"(?:spdx-license-identifier|license-expression)[ \t]*:[ \t]*([A-Za-z0-9.+() \t-]+)", re.I
)
PIECE = re.compile(r"[()]|[A-Za-z0-9.+-]+")
PRECEDENCE = {"or": 1, "and": 2, "with": 3}

RESULT = (
    "n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
    "labels array<string>, score double, notices array<struct<label:string,word:long>>, "
    "expressions array<string>"
)


def words_of(text: str | None) -> bytes:
    """The text's words, one space between two."""
    return b" ".join((text or "").encode().translate(WORD_TABLE).split())


def label_of(identifier: str) -> str:
    name = identifier.lower().rstrip("+")
    return next((label for start, label in FAMILIES if name.startswith(start)), name)


def to_postfix(expression: str) -> list[str] | None:
    """Shunting-yard; None where the pieces make no whole expression."""
    output, operators, operand_next = [], [], True
    for piece in PIECE.findall(expression):
        name = piece.lower()
        if piece == "(":
            if not operand_next:
                return None
            operators.append(piece)
        elif piece == ")":
            if operand_next:
                return None
            while operators and operators[-1] != "(":
                output.append(operators.pop())
            if not operators:
                return None
            operators.pop()
        elif name in PRECEDENCE:
            if operand_next:
                return None
            while operators and PRECEDENCE.get(operators[-1], 0) >= PRECEDENCE[name]:
                output.append(operators.pop())
            operators.append(name)
            operand_next = True
        else:
            if not operand_next:
                return None
            output.append(piece)
            operand_next = False
    if operand_next or "(" in operators:
        return None
    return output + operators[::-1]


def evaluate(postfix: Iterable[str]) -> tuple[float, set[str]]:
    """Openness and labels of a parsed expression; an exception's name is no label."""
    stack: list[tuple[float, set[str]]] = []
    for piece in postfix:
        if piece in PRECEDENCE:
            right, left = stack.pop(), stack.pop()
            if piece == "with":
                stack.append(((left[0] + 1) / 2, left[1]))
            else:
                choose = min if piece == "and" else max
                stack.append((choose(left[0], right[0]), left[1] | right[1]))
        else:
            label = label_of(piece)
            stack.append((OPENNESS.get(label, UNKNOWN), {label}))
    return stack.pop()


def expressions_in(text: str) -> list[tuple[str, float, set[str]]]:
    """Tagged expressions; prose after one on its line is left out, word by word."""
    found = []
    for match in TAGGED.finditer(text):
        pieces = PIECE.findall(match[1])
        while pieces and (postfix := to_postfix(" ".join(pieces))) is None:
            pieces.pop()
        if pieces:
            found.append((" ".join(pieces), *evaluate(postfix)))
    return found


def automaton(base: dict[str, str], notices: dict[str, str]):
    machine = ahocorasick.Automaton()
    for kind, phrases in (("notice", notices), ("base", base), ("tag", dict.fromkeys(TAGS))):
        for phrase, label in phrases.items():
            machine.add_word(f" {phrase} ", (kind, label, len(phrase) + 1))
    machine.make_automaton()
    return machine


def scan_text(machine, text: str | None) -> tuple:
    words = words_of(text)
    spaced = f" {words.decode('latin-1')} "
    n_words = spaced.count(" ") - 1 if words else 0
    base, notices, tagged = [], [], False
    at, counted = 0, 0  # words before `at` are counted already
    for end, (kind, label, length) in machine.iter(spaced):
        start = end - length
        if kind == "tag":
            tagged = True
            continue
        word = counted + spaced.count(" ", at, start) if start >= at else spaced.count(" ", 0, start)
        if start > at:
            at, counted = start, word
        notices.append((label, word))
        if kind == "base":
            base.append((label, word))
    stated = {label: OPENNESS[label] for label, _ in notices}
    expressions = expressions_in(text) if tagged else []
    labels = set(stated).union(*(x[2] for x in expressions))
    scores = [*stated.values(), *(x[1] for x in expressions)]
    starts = [word for _, word in base]
    return (
        n_words, len(base), min(starts, default=None), max(starts, default=None),
        sorted({label for label, _ in base}), sorted(labels), min(scores, default=0.0),
        [{"label": a, "word": b} for a, b in sorted(notices, key=lambda x: (x[1], x[0]))],
        [x[0] for x in expressions],
    )


def scan_licenses(
    docs: DataFrame,
    text: str = "text",
    into: str = "licenses",
    base: dict[str, str] = BASE_PHRASES,
    notices: dict[str, str] = NOTICE_PHRASES,
) -> DataFrame:
    """Each row with a struct of what its text states; see the module for the rules."""

    def make():
        machine = automaton(base, notices)
        notice = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))
        kinds = [pa.int64()] * 4 + [pa.list_(pa.string())] * 2
        kinds += [pa.float64(), notice, pa.list_(pa.string())]
        names = [field.split()[0] for field in RESULT.split(", ")]

        def scan(texts: pa.Array) -> pa.Array:
            rows = [scan_text(machine, t) for t in texts.to_pylist()]
            columns = zip(*rows) if rows else [[]] * len(names)
            return struct_array({n: (list(c), k) for n, c, k in zip(names, columns, kinds)})

        return scan

    bound_batches(docs.sparkSession)
    return docs.withColumn(into, arrow_function(make, f"struct<{_fields(RESULT)}>")(F.col(text)))


def _fields(ddl: str) -> str:
    return ", ".join(f.replace(" ", ":", 1) for f in ddl.split(", "))
