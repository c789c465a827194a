"""Quality rules: text statistics and a learned decision list, as Spark conditional expressions.

Statistics are worked out in each row. The list is learned by sequential covering from rows
with a label of 0 (bad) or 1 (good): a rule for bad rows grows by the threshold condition of
the largest information gain until none gains; its last conditions are pruned while that helps
on rows set apart; covered rows leave, and the next rule is grown. Ties between conditions go
to the first figure and the smallest threshold. Neither rules nor conditions are limited in
number, see `learn`. Texts of any length are taken whole.
Every step takes counts of labels by statistic and bin over all labelled rows with one
aggregate; only those counts, a few hundred numbers, reach the driver. Thresholds lie at
quantiles. The list becomes one `when(...).when(...)` expression: the first rule that holds
decides, and no rule means the row is kept.

A null or empty text has no words, and zero statistics. Rows without a label don't bear on
the list; several labels of one id count with their mean, rounded. With no labelled rows, or
none that is bad, the list is empty and keeps all. Repeated rows give repeated results; other
columns pass through.
"""

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from flowatlas.llm.common import cut_lineage
from flowatlas.llm.native import let, places, spaced_words, total

SYMBOL = r"[#*$%&|<>]"
FIGURES = (
    "n_words", "word_length", "symbols_per_word", "duplicate_lines", "repeated_words",
    "distinct_words", "upper_share", "digit_share", "words_per_line",
)


# --- statistics ----------------------------------------------------------------------


def _repeat_words(w: Column, width: int) -> Column:
    """Words in windows of `width` words that stand twice or more, each word once."""

    def count(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))

        def covered(s: Column) -> Column:
            twice = F.filter(
                F.transform(
                    s,
                    lambda x, i: F.when(
                        (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]), x["at"]
                    ),
                ),
                lambda at: at.isNotNull(),
            )
            start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
            ends = F.aggregate(
                F.sort_array(twice),
                start,
                lambda state, at: F.struct(
                    (state["n"] + at + width - F.greatest(at, state["end"])).alias("n"), (at + width).alias("end")
                ),
            )
            return ends["n"]

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(pairs, covered))

    hashes = F.transform(places(0, F.size(w) - width), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)]))
    return let(hashes, count)


def statistics(docs: DataFrame, text: str = "text", into: str = "statistics", width: int = 3) -> DataFrame:
    """Each row with a struct of counts (whole numbers) and of the figures that rules may use."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))

    def counts(w: Column) -> Column:
        n_lines = let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("different")))
        return F.struct(
            F.size(w).alias("n_words"),
            F.length(F.array_join(w, "")).alias("word_chars"),
            F.regexp_count(body, F.lit(SYMBOL)).alias("n_symbols"),
            n_lines.alias("lines"),
            _repeat_words(w, width).alias("n_repeat_words"),
            F.size(F.array_distinct(w)).alias("n_distinct"),
            F.regexp_count(body, F.lit("[A-Z]")).alias("n_upper"),
            F.regexp_count(body, F.lit("[0-9]")).alias("n_digits"),
        )

    def figures(c: Column) -> Column:
        n = F.greatest(c["n_words"], F.lit(1))
        chars = F.greatest(c["word_chars"], F.lit(1))
        lines = F.greatest(c["lines"]["n"], F.lit(1))
        values = (
            c["n_words"].cast("double"), c["word_chars"] / n, c["n_symbols"] / n,
            (c["lines"]["n"] - c["lines"]["different"]) / lines, c["n_repeat_words"] / n,
            c["n_distinct"] / n, c["n_upper"] / chars, c["n_digits"] / chars, c["n_words"] / lines,
        )
        whole = {
            "n_words": c["n_words"], "word_chars": c["word_chars"], "n_symbols": c["n_symbols"],
            "n_dup_lines": c["lines"]["n"] - c["lines"]["different"], "n_repeat_words": c["n_repeat_words"],
        }
        return F.struct(
            F.struct(*[v.cast("long").alias(k) for k, v in whole.items()]).alias("counts"),
            F.struct(*[v.alias(k) for k, v in zip(FIGURES, values)]).alias("figures"),
        )

    return docs.withColumn(into, let(let(spaced_words(F.col(text)), counts), figures))


# --- decision list -------------------------------------------------------------------


@dataclass(frozen=True)
class Condition:
    figure: str
    above: bool
    threshold: float

    def holds(self, figures: Column) -> Column:
        value = figures[self.figure]
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.figure} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    bad: int
    good: int

    def holds(self, figures: Column) -> Column:
        out = F.lit(True)
        for condition in self.conditions:
            out = out & condition.holds(figures)
        return out

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


def keep_expression(rules: list[Rule], figures: Column) -> Column:
    """False where a rule of the list holds, the first of them deciding; else true."""
    out = None
    for rule in rules:
        out = (F if out is None else out).when(rule.holds(figures), F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def deciding_rule(rules: list[Rule], figures: Column) -> Column:
    """The text of the rule that decides, null where none holds."""
    out = None
    for rule in rules:
        out = (F if out is None else out).when(rule.holds(figures), F.lit(str(rule)))
    return F.lit(None).cast("string") if out is None else out


def _gain(before: tuple[int, int], after: tuple[int, int]) -> float:
    bits = [math.log2(b / (b + g)) if b else -math.inf for b, g in (before, after)]
    return after[0] * (bits[1] - bits[0]) if after[0] else -math.inf


def _bin(value: Column, cuts: list[float]) -> Column:
    """How many of the cuts the value is over."""
    return total(F.transform(F.array(*map(F.lit, cuts)), lambda cut: F.when(value > cut, 1).otherwise(0)))


def _histogram(rows: DataFrame) -> dict[tuple[int, int], tuple[int, int]]:
    """(bad, good) rows by figure and bin; bin k holds values over k of the figure's cuts."""
    each = rows.select("bad", F.posexplode("bins").alias("figure", "bin"))
    counted = each.groupBy("figure", "bin").agg(F.sum("bad").alias("bad"), F.sum(1 - F.col("bad")).alias("good"))
    return {(r["figure"], r["bin"]): (r["bad"], r["good"]) for r in counted.collect()}


def _offers(histogram: dict, cuts: dict[str, list[float]]):
    """Every threshold condition with the (bad, good) rows it covers."""
    for k, figure in enumerate(FIGURES):
        n = len(cuts[figure])
        below = [0, 0]
        whole = [sum(histogram.get((k, b), (0, 0))[y] for b in range(n + 1)) for y in (0, 1)]
        for b, cut in enumerate(cuts[figure]):
            here = histogram.get((k, b), (0, 0))
            below = [below[0] + here[0], below[1] + here[1]]
            yield Condition(figure, False, cut), tuple(below)
            yield Condition(figure, True, cut), (whole[0] - below[0], whole[1] - below[1])


def learn(cases: DataFrame, bins: int = 32, least_share: float = 0.01, precision: float = 0.9,
          deviations: float = 3.0) -> list[Rule]:
    """An ordered list of rules for bad rows.

    `cases` has the columns of `FIGURES`, `bad` (0 or 1) and `set_apart` (rows for pruning). A
    rule grows while a condition gains and `least_share` of the bad rows stay covered. Among
    the rows set apart its leading conditions must do better than chance (their lower bound,
    `deviations` standard deviations down, is above the share of bad rows there), and the best
    of them must reach `precision`. If none does, the widest is left out of the list: the rows
    it covers no longer take part in growing, so that a noisy region hides no later rule outside
    it. Rules and conditions are not limited in number. The end comes when nothing grows, or
    when what grows is no better than chance.
    """
    cases = cut_lineage(cases)
    known = cases.filter(~F.col("set_apart"))
    shares = [k / bins for k in range(1, bins)]
    quantiles = known.agg(*[F.percentile_approx(f, shares, 10_000).alias(f) for f in FIGURES]).first()
    bad = known.filter("bad = 1").agg(*[F.percentile_approx(f, shares, 10_000).alias(f) for f in FIGURES]).first()
    cuts = {f: sorted(set(quantiles[f] or []) | set(bad[f] or [])) for f in FIGURES}
    all_bad = known.filter("bad = 1").count()
    rules: list[Rule] = []
    if not all_bad:
        return rules
    binned = F.array(*[_bin(F.col(f), cuts[f]) for f in FIGURES]).alias("bins")
    cases = cut_lineage(cases.select("bad", "set_apart", binned))
    growing, apart = cases.filter(~F.col("set_apart")), cases.filter("set_apart")
    while conditions := _grown(growing, cuts, least_share * all_bad):
        offers, whole = _prefixes(apart, conditions, cuts)
        offers = [rule for rule in offers if _beyond_chance(rule, whole, deviations)]
        if not offers:
            break
        rule = max(reversed(offers), key=lambda r: (r.bad - r.good) / (r.bad + r.good))
        if rule.bad >= precision * (rule.bad + rule.good):
            rules.append(rule)
            apart = apart.filter(~_on_bins(rule.conditions, cuts))
        else:
            rule = offers[0]
        growing = growing.filter(~_on_bins(rule.conditions, cuts))
    return rules


def _grown(rows: DataFrame, cuts: dict[str, list[float]], least: float) -> tuple[Condition, ...]:
    """Conditions in the order of growth; none if no condition gains."""
    conditions: tuple[Condition, ...] = ()
    while True:
        histogram = _histogram(rows)
        whole = tuple(sum(v[y] for (f, _), v in histogram.items() if f == 0) for y in (0, 1))
        if not whole[0] or not whole[1]:
            return conditions
        offers = (o for o in _offers(histogram, cuts) if o[1][0] >= least)
        best, after = max(offers, key=lambda o: _gain(whole, o[1]), default=(None, (0, 0)))
        if best is None or _gain(whole, after) <= 0:
            return conditions
        conditions += (best,)
        rows = rows.filter(_on_bins((best,), cuts))


def _on_bins(conditions: Sequence[Condition], cuts: dict[str, list[float]]) -> Column:
    """Whether all conditions hold, from the bins: a value is over a cut if it is over more cuts than stand before it."""
    out = F.lit(True)
    for c in conditions:
        above = F.col("bins")[FIGURES.index(c.figure)] > cuts[c.figure].index(c.threshold)
        out = out & (above if c.above else ~above)
    return out


def _prefixes(
    apart: DataFrame, conditions: Sequence[Condition], cuts: dict[str, list[float]]
) -> tuple[list[Rule], tuple[int, int]]:
    """The rules of leading conditions that hold for rows set apart, widest first, and (bad, good) of all those rows."""
    sums = [F.sum("bad").alias("b0"), F.sum(1 - F.col("bad")).alias("g0")]
    for k in range(1, len(conditions) + 1):
        holds = _on_bins(conditions[:k], cuts)
        sums += [F.sum(F.when(holds, F.col("bad"))).alias(f"b{k}"), F.sum(F.when(holds, 1 - F.col("bad"))).alias(f"g{k}")]
    row = apart.agg(*sums).first()
    offers = [Rule(tuple(conditions[:k]), row[f"b{k}"] or 0, row[f"g{k}"] or 0) for k in range(1, len(conditions) + 1)]
    return [r for r in offers if r.bad + r.good], (row["b0"] or 0, row["g0"] or 0)


def _beyond_chance(rule: Rule, whole: tuple[int, int], deviations: float) -> bool:
    """Whether Wilson's lower bound of the rule's share of bad rows is above that of all rows."""
    n, z = rule.bad + rule.good, deviations
    share = rule.bad / n
    spread = z * math.sqrt(share * (1 - share) / n + z * z / (4 * n * n))
    return (share + z * z / (2 * n) - spread) / (1 + z * z / n) > whole[0] / (whole[0] + whole[1])


def learn_from_labels(counted: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id",
                      column: str = "statistics", learn_from: Column | None = None, **options) -> list[Rule]:
    """Rules from rows of `counted` (with a `statistics` column) that `labels` names.

    Labels with a null id or value don't count. A third of the ids, by hash, is set apart.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
    if learn_from is not None:
        known = known.filter(learn_from)
    known = known.groupBy(F.col(doc_id).alias("_id")).agg(F.avg(label).alias("_label"))
    slim = counted.select(F.col(doc_id).alias("_id"), F.col(column)["figures"].alias("f"))
    cases = slim.join(known, "_id").select(
        "f.*", F.when(F.col("_label") < 0.5, 1).otherwise(0).alias("bad"),
        (F.pmod(F.xxhash64("_id"), F.lit(3)) == 0).alias("set_apart"),
    )
    return learn(cases, **options)
