"""Secret scan: fixed patterns, and sliding-window entropy per character class.

Base kinds (`assign`, `access`, `hex`) are leftmost, non-overlapping matches of fixed patterns.

The method adds `entropy` spans. Candidate strings are runs of one character class (hex
digits, also inside a longer run; letters, digits and the marks of base 64). A window of `WINDOW` characters slides over
each candidate: one count goes up, one goes down, and with them the sum of c log2 c, from which
the window's Shannon entropy follows. Sums are kept in millionths, as whole numbers, so that
every engine agrees. Windows at or over the class's threshold merge into one span from the
first to the last. Candidates on the allow list (words of letters alone, numbers, UUIDs, runs
of one character) are left out before any window is counted; of a run with a placeholder only
the part between = / _ - that holds it is left out. Spans that overlap a base span, which is
reported already, are left out too.

Built-in functions only. Null and empty texts have no spans. Rows are independent, repeated
rows give repeated results, and other columns pass through.
"""

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from flowatlas.llm.native import let, matches, places

#: Fixed patterns. Group 1 in either case; what follows the mark has 6 characters at least.
ASSIGN = r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ASSIGN_HEAD = r"""^(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
BASE = {"assign": ASSIGN, "access": ACCESS, "hex": HEX}
KINDS = (*BASE, "entropy")

WINDOW = 20
MILLION = 1_000_000
PLACEHOLDERS = "example|sample|dummy|placeholder|changeme|abcdefghij|0123456789"
#: A whole candidate that matches is no secret.
ALLOWED = (
    r"[A-Za-z]+",  # a word
    r"[0-9]+",  # a number
    r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}",  # a UUID
    r"(.)\1*",  # one character over and over
    r"[A-Za-z]+(?:[-_/+=]+[A-Za-z]+)*",  # joined words
    f"(?i:.*(?:{PLACEHOLDERS}).*)",
)


@dataclass(frozen=True)
class CharacterClass:
    """A class of characters, what its candidates are made of, and the entropy in bits that counts."""

    alphabet: str
    whole: str
    threshold: float

    @property
    def most(self) -> int:
        """The largest sum of c log2 c, in millionths, that a window over the threshold has."""
        return math.floor((math.log2(WINDOW) - self.threshold) * WINDOW * MILLION)


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = "0123456789"
CLASSES = (
    CharacterClass(DIGITS + "abcdefABCDEF", "[0-9a-fA-F]+", 3.2),
    CharacterClass(UPPER + UPPER.lower() + DIGITS + "+/_=-", "[A-Za-z0-9+/_=-]+", 3.8),
)
#: Runs long enough for a window. Hex runs inside them are candidates of their own.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
HEX_RUN = r"[0-9a-fA-F]{20,}"
#: A part between the marks = / _ - that holds a placeholder; what stands beside it is looked at.
PLACED = rf"(?<![A-Za-z0-9+])[A-Za-z0-9+]*(?i:{PLACEHOLDERS})[A-Za-z0-9+]*"
#: c log2 c in millionths for every count of a window.
TERMS = tuple(round(c * math.log2(c) * MILLION) if c else 0 for c in range(WINDOW + 1))


def _window_span(found: Column, kind: CharacterClass) -> Column:
    """First and last place of windows over the threshold, in one pass over the characters."""
    terms = F.array(*[F.lit(t) for t in TERMS])
    size = len(kind.alphabet)
    empty = F.array_repeat(F.lit(0), size)
    start = F.struct(
        empty.alias("counts"), F.lit(0).alias("sum"), F.lit(-1).alias("first"), F.lit(-1).alias("last")
    )

    def slide(chars: Column) -> Column:
        codes = F.transform(chars, lambda c: F.instr(F.lit(kind.alphabet), c) - 1)

        def over(codes: Column) -> Column:
            def step(state: Column, i: Column) -> Column:
                return let(
                    F.struct(
                        F.get(codes, i).alias("new"),
                        F.when(i >= WINDOW, F.get(codes, i - WINDOW)).otherwise(F.lit(-1)).alias("old"),
                        state.alias("state"),
                        i.alias("i"),
                    ),
                    update,
                )

            def update(s: Column) -> Column:
                counts, new, old = s["state"]["counts"], s["new"], s["old"]
                up = F.get(counts, new)
                down = F.get(counts, old)
                moved = (
                    F.when(new == old, F.lit(0))
                    .when(old < 0, F.get(terms, up + 1) - F.get(terms, up))
                    .otherwise(F.get(terms, up + 1) - F.get(terms, up) + F.get(terms, down - 1) - F.get(terms, down))
                )
                sum_now = s["state"]["sum"] + moved
                hit = (s["i"] >= WINDOW - 1) & (sum_now <= kind.most)
                first = s["state"]["first"]
                return F.struct(
                    F.transform(
                        counts, lambda c, k: c + F.when(k == new, 1).otherwise(0) - F.when(k == old, 1).otherwise(0)
                    ).alias("counts"),
                    sum_now.alias("sum"),
                    F.when(hit & (first < 0), s["i"] - (WINDOW - 1)).otherwise(first).alias("first"),
                    F.when(hit, s["i"] + 1).otherwise(s["state"]["last"]).alias("last"),
                )

            return F.aggregate(places(0, F.size(codes) - 1), start, step)

        return let(codes, over)

    return slide(F.split(found, ""))


def _not_allowed(found: Column) -> Column:
    """Candidates that are no word, number, UUID and so on as a whole, less their placeholders."""
    whole = "^(?:" + "|".join(ALLOWED[:-1]) + ")$"

    def kept(some: Column) -> Column:
        return F.filter(some, lambda m: ~m["found"].rlike(whole))

    def beside(m: Column) -> Column:
        def runs(cuts: Column) -> Column:
            def run(i: Column) -> Column:
                begin = F.when(i > 0, F.get(cuts, i - 1)["end"]).otherwise(F.lit(0))
                end = F.when(i < F.size(cuts), F.get(cuts, i)["begin"]).otherwise(F.length(m["found"]))
                return _part(m, begin, end)

            return F.transform(places(0, F.size(cuts)), run)

        return F.when(m["found"].rlike(PLACED), let(matches(m["found"], PLACED), runs)).otherwise(F.array(m))

    parts = F.flatten(F.transform(kept(found), beside))
    return kept(F.filter(parts, lambda m: m["end"] - m["begin"] >= WINDOW))


def _part(m: Column, begin: Column, end: Column) -> Column:
    return F.struct(
        (m["begin"] + begin).alias("begin"), (m["begin"] + end).alias("end"),
        F.substring(m["found"], begin + 1, end - begin).alias("found"),
    )


def _hex_runs(candidates: Column) -> Column:
    """The longest runs of hex digits in the candidates."""
    inside = F.transform(
        candidates, lambda m: F.transform(matches(m["found"], HEX_RUN), lambda h: _part(m, h["begin"], h["end"]))
    )
    return _not_allowed(F.flatten(inside))


def _entropy_spans(candidates: Column, kind: CharacterClass) -> Column:
    spans = F.transform(
        candidates,
        lambda m: let(
            _window_span(m["found"], kind),
            lambda w: F.struct(
                (m["begin"] + w["first"]).alias("begin"), (m["begin"] + w["last"]).alias("end"), (w["first"] >= 0).alias("hit")
            ),
        ),
    )
    return _as_spans(F.filter(spans, lambda s: s["hit"]), KINDS.index("entropy"))


def _span(begin: Column, kind: int, end: Column) -> Column:
    return F.struct(begin.alias("begin"), F.lit(kind).alias("kind"), end.alias("end"))


def _as_spans(found: Column, kind: int) -> Column:
    return F.transform(found, lambda m: _span(m["begin"], kind, m["end"]))


def _base_spans(text: Column) -> Column:
    """Spans of the fixed patterns, by begin, then kind."""
    kept = []
    for k, (name, pattern) in enumerate(BASE.items()):
        found = matches(text, pattern)
        if name == "assign":
            found = F.filter(found, lambda m: F.length(F.regexp_replace(m["found"], ASSIGN_HEAD, "")) >= 6)
        kept.append(_as_spans(found, k))
    return F.sort_array(F.concat(*kept))


def find_secrets(docs: DataFrame, text: str = "text", into: str = "secrets") -> DataFrame:
    """Each row with a struct of its base spans and of all spans, each (begin, kind, end, name).

    Both arrays are ordered by begin, then by the order of `KINDS`.
    """
    hex_digits, base_64 = CLASSES
    # steps of their own, as one nested expression is too deep for the analyzer
    longest = max(map(len, docs.columns), default=0)
    parts, runs = (name + "_" * longest for name in ("parts", "hex_runs"))  # no column has these names
    candidates = _not_allowed(matches(F.col(text), CANDIDATE))
    docs = docs.withColumn(parts, F.struct(_base_spans(F.col(text)).alias("base"), candidates.alias("candidates")))
    docs = docs.withColumn(runs, _hex_runs(F.col(parts)["candidates"]))

    def all_spans(p: Column) -> Column:
        base = p["parts"]["base"]
        of_hex = _entropy_spans(p["runs"], hex_digits)
        found = F.array_distinct(F.concat(of_hex, _entropy_spans(p["parts"]["candidates"], base_64)))
        free = F.filter(
            found, lambda s: ~F.exists(base, lambda b: (s["begin"] < b["end"]) & (b["begin"] < s["end"]))
        )
        return F.struct(base.alias("base"), F.sort_array(F.concat(base, _without_inner(free))).alias("spans"))

    both = F.struct(F.col(parts).alias("parts"), F.col(runs).alias("runs"))
    return docs.withColumn(into, let(both, all_spans)).drop(parts, runs)


def _without_inner(spans: Column) -> Column:
    """Spans that lie in no other span."""
    return let(
        spans,
        lambda all_: F.filter(
            all_,
            lambda s: ~F.exists(
                all_, lambda o: (o != s) & (o["begin"] <= s["begin"]) & (s["end"] <= o["end"])
            ),
        ),
    )


def written(spans: Column) -> Column:
    """kind:begin:end of every span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    each = F.transform(
        spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["begin"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(each, ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")
