"""Shell-style patterns on whole paths, as Spark predicates."""

import re

from pyspark.sql import Column, functions as F

_WILDCARDS = frozenset("*?[")


def ensure_json_suffix(pattern: str) -> str:
    """Append `.json` unless the pattern already ends with it."""
    return pattern if pattern.endswith(".json") else pattern + ".json"


def _escape(char: str) -> str:
    return "\\" + char if not char.isalnum() and char.isascii() else char


def _bracket(body: str) -> str:
    """Java regex for the inside of a `[...]` pattern."""
    negated = body.startswith("!")
    body = body[1:] if negated else body
    members, at = [], 0
    while at < len(body):
        if at + 2 < len(body) and body[at + 1] == "-":
            low, high = body[at], body[at + 2]
            if low <= high:
                members.append(f"{_escape(low)}-{_escape(high)}")
            at += 3
        else:
            members.append(_escape(body[at]))
            at += 1
    if not members:
        return "." if negated else "(?!)"
    return f"[{'^' if negated else ''}{''.join(members)}]"


def glob_to_regex(pattern: str) -> str:
    """Java regex for a pattern with `*` (crosses `/`), `?`, `[..]` and `[!..]`."""
    # A bracket holds at least one character, so `[]a]` and `[!]a]` start with a literal `]`.
    token = re.compile(r"\*+|\?|\[((?:!.|[^!])[^\]]*)\]|.", re.DOTALL)
    out = []
    for match in token.finditer(pattern):
        text = match.group()
        if text.startswith("*"):
            out.append(".*")
        elif text == "?":
            out.append(".")
        elif match.group(1) is not None:
            out.append(_bracket(match.group(1)))
        else:
            out.append(_escape(text))
    return "(?s)^" + "".join(out) + "\\z"


def matches_glob(path: Column, pattern: str) -> Column:
    """True when the path ends with a part that matches `pattern`.

    A pattern without wildcards becomes a plain suffix test, which the Parquet reader
    can use for row-group pruning.
    """
    pattern = ensure_json_suffix(pattern)
    if pattern == "*.json":
        return F.lit(True)
    if not _WILDCARDS & set(pattern):
        return path.endswith(pattern)
    return path.rlike(glob_to_regex("*" + pattern))
