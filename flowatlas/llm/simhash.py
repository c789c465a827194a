"""SimHash near-duplicates by the generalised pigeonhole.

Fingerprint: 64 bits over word shingles; a bit is 1 if it is set in over half of the
shingles' hashes, repeats included. Two fingerprints link at `radius` or fewer differing
bits; a document's component is the smallest doc_id that links reach.

Search. The bits are dealt into parts, and each part i gets its own threshold t_i, where the
thresholds sum to radius - parts + 1 (-1: the part is not looked at). Two fingerprints
within the radius then differ by at most t_i bits in some part i. Correlated bits go into
the same part, since two parts that say the same filter twice. Candidate counts of every
part and threshold are estimated from a sample of fingerprints; dynamic programming picks
the thresholds, and the cheapest number of parts is taken. One side of a part is probed with
all values within t_i of its own, the other is stored as it is; hits are verified with the
exact distance. The sample bears only on cost: every choice of parts finds every link.

A part's value that very many different fingerprints share ("hot") would make all pairs of
them candidates. Those fingerprints are linked through values of all 64 bits instead: any
two within distance 2r share a value within distance r of both, and so within distance 2
each other where r = 1. All who share such a value are linked to the smallest of them, which
is exact for radius 2 without verifying, and emits one row for each fingerprint and value.

Only different fingerprints are compared; equal ones are one group from the start. A null,
empty or blank text has fingerprint zero and links like any other. A row with a null doc_id
gets its fingerprint, and the component of its group, but names none. Repeated rows give
repeated results.
"""

import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import MapType

from flowatlas.llm.common import LOWER_BYTES, arrow_function, bound_batches, cut_lineage, sampled
from flowatlas.llm.components import components

BITS = 64
HASH_BLOCK = 1 << 18


def text_fingerprint(text: str | None, words_each: int = 3, seed: int = 42) -> int:
    """The unsigned fingerprint of one text."""
    words = (text or "").encode().translate(LOWER_BYTES).split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - words_each + 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    lasts = ends[words_each - 1 :] if len(words) >= words_each else ends[-1:]
    digest = xxhash.xxh64_digest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, HASH_BLOCK):
        spans = zip(starts[at : at + HASH_BLOCK].tolist(), lasts[at : at + HASH_BLOCK].tolist())
        hashes = b"".join([digest(joined[a:b], seed) for a, b in spans])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8)).reshape(-1, BITS)
        ones += bits.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", into: str = "fp", words_each: int = 3) -> DataFrame:
    """Each row with the fingerprint of its text, as a signed long."""

    def make():
        def batch(texts: pa.Array) -> pa.Array:
            values = [text_fingerprint(t, words_each) for t in texts.to_pylist()]
            return pa.array(np.array(values, np.uint64).view(np.int64))

        return batch

    bound_batches(docs.sparkSession)
    return docs.withColumn(into, arrow_function(make, "long")(F.col(text)))


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# --- parts and thresholds ------------------------------------------------------------


def bit_matrix(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(values.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)


def deal_bits(bits: np.ndarray, n_parts: int) -> list[list[int]]:
    """Parts of near equal size; each grows from a free bit by the one most correlated with it."""
    with np.errstate(invalid="ignore", divide="ignore"):
        like = np.nan_to_num(np.abs(np.corrcoef(bits.T))) if len(bits) > 1 else np.zeros((BITS, BITS))
    free, parts = list(range(BITS)), []
    for k in range(n_parts):
        size = (BITS - sum(map(len, parts))) // (n_parts - k)
        part = [free.pop(0)]
        while len(part) < size:
            best = max(free, key=lambda b: (like[b, part].mean(), -b))
            free.remove(best)
            part.append(best)
        parts.append(sorted(part))
    return parts


def candidate_estimates(bits: np.ndarray, parts: list[list[int]], radius: int, total: int) -> np.ndarray:
    """[part, t + 1]: candidate pairs and probes expected among `total` fingerprints.

    Pairs agreeing within t bits in a part are counted in the sample and scaled with the
    square of the size; where the sample has none, the chance of independent bits is used.
    """
    n = len(bits)
    cost = np.zeros((len(parts), radius + 2))
    for i, part in enumerate(parts):
        sub = bits[:, part].astype(np.float32)
        away = sub @ (1 - sub.T)
        away = (away + away.T)[np.triu_indices(n, 1)]
        share = sub.mean(0) if n else np.full(len(part), 0.5)
        equal = np.clip(share**2 + (1 - share) ** 2, 0.5, 1 - 1e-9)
        odds = np.sum((1 - equal) / equal)
        for t in range(radius + 1):
            seen = np.mean(away <= t) if len(away) else 0.0
            chance = np.prod(equal) * sum(odds**k / math.factorial(k) for k in range(t + 1))
            pairs = max(seen, chance) * total * total / 2
            probes = sum(math.comb(len(part), k) for k in range(t + 1))
            cost[i, t + 1] = pairs + total * (probes + 1)
    return cost


def allocate(cost: np.ndarray, radius: int) -> tuple[float, list[int]]:
    """Thresholds from -1 to radius, summing to radius - parts + 1, of least total cost."""
    n_parts = len(cost)
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}  # by the sum of t + 1
    for row in cost:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (so_far, chosen) in best.items():
            for t in range(-1, radius + 1):
                total = used + t + 1
                offer = (so_far + row[t + 1], [*chosen, t])
                if total <= radius + 1 and (total not in step or offer[0] < step[total][0]):
                    step[total] = offer
        best = step
    spent, chosen = best[radius + 1]
    assert sum(chosen) == radius - n_parts + 1
    return spent, chosen


def plan_search(sample: np.ndarray, total: int, radius: int) -> list[tuple[list[int], int]]:
    """The parts to look at, each with its threshold."""
    bits = bit_matrix(sample)
    offers = []
    for n_parts in range(1, radius + 3):
        parts = deal_bits(bits, n_parts)
        spent, chosen = allocate(candidate_estimates(bits, parts, radius, total), radius)
        offers.append((spent, [(p, t) for p, t in zip(parts, chosen) if t >= 0]))
    return min(offers, key=lambda offer: offer[0])[1]


# --- probe and verify ----------------------------------------------------------------


def _mask(bits: list[int]) -> int:
    value = sum(1 << (BITS - 1 - b) for b in bits)
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _flips(bits: list[int], most: int) -> list[int]:
    """Masks that flip up to `most` of the bits, in signed longs; none flipped comes first."""
    return [_mask(list(c)) for k in range(most + 1) for c in itertools.combinations(bits, k)]


def _spread(fps: DataFrame, part: list[int], most: int) -> DataFrame:
    """(fp, value): every value of the part within `most` bits of the fingerprint's own."""
    own = F.col("fp").bitwiseAND(F.lit(_mask(part)))
    flips = F.array(*[F.lit(m) for m in _flips(part, most)])
    return fps.select("fp", F.explode(F.transform(flips, lambda m: own.bitwiseXOR(m))).alias("value"))


def links_between(
    fps: DataFrame, radius: int = 2, sample_rows: int = 2000, hot: int = 64
) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of `fps` within the radius.

    `fps` has one column, fp, without repeats. `sample_rows` bounds what the plan is made
    from. Values of a part that more than `hot` fingerprints share take the other way.
    """
    if radius != 2:
        raise ValueError("values of all bits link hot fingerprints exactly at radius 2 only")
    total = fps.count()
    rows = sampled(fps, sample_rows, "fp").collect()
    sample = np.array([r["fp"] for r in rows], np.int64).view(np.uint64)
    found, crowded = [], []
    for part, most in plan_search(sample, total, radius):
        stored = fps.select("fp", F.col("fp").bitwiseAND(F.lit(_mask(part))).alias("value"))
        many = stored.groupBy("value").count().filter(F.col("count") > hot).select("value")
        rest = stored.join(many, "value", "left_anti").withColumnRenamed("fp", "b")
        probes = _spread(fps, part, most).withColumnRenamed("fp", "a")
        pairs = probes.join(rest, "value").filter("a <> b")
        near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
        found.append(pairs.filter(near).select("a", "b"))
        crowded.append(probes.join(many, "value", "left_semi").select(F.col("a").alias("fp")))
    links = found[0]
    for more in found[1:]:
        links = links.unionAll(more)
    hot_fps = crowded[0]
    for more in crowded[1:]:
        hot_fps = hot_fps.unionAll(more)
    return links.unionAll(_linked_by_values(hot_fps.distinct()))


def _linked_by_values(fps: DataFrame) -> DataFrame:
    """Links within distance 2 through shared values of all bits; no pair is formed.

    Two that share a value within distance 1 of both are within distance 2 of each other.
    """
    values = _spread(fps, list(range(BITS)), 1)
    least = values.groupBy("value").agg(F.min("fp").alias("b"), F.count("*").alias("n"))
    pairs = values.withColumnRenamed("fp", "a").join(least.filter("n > 1"), "value")
    return pairs.filter("a <> b").select("a", "b")


def fingerprint_groups(printed: DataFrame, doc_id: str = "doc_id", radius: int = 2) -> DataFrame:
    """(fp, component, component_id, least_id) for every fingerprint of `printed`.

    `printed` has doc_id and fp; a component is named by a fingerprint and by its least doc_id.
    """
    groups = cut_lineage(printed.groupBy("fp").agg(F.min(doc_id).alias("least_id")))
    linked = components(links_between(groups.select("fp"), radius))
    named = groups.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
    named = named.withColumn("component", F.coalesce("component", "fp"))
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    return named.join(least, "component").select("fp", "component", "component_id", "least_id")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id for every row."""
    printed = cut_lineage(fingerprints(docs, text).select(F.col(doc_id).alias("doc_id"), "fp"))
    grouped = fingerprint_groups(printed, "doc_id", radius)
    return printed.join(grouped, "fp").select("doc_id", as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = 2) -> DataFrame:
    """One row of every component: that of the smallest doc_id, and of the smallest row if that repeats.

    Columns stay as they are. Of a component whose ids are all null, one row stays.
    """
    columns = docs.columns
    fp = "_fp" + "_" * max(map(len, columns))
    printed = fingerprints(docs, text, fp)
    slim = printed.select(F.col(doc_id).alias("doc_id"), F.col(fp).alias("fp"))
    grouped = fingerprint_groups(cut_lineage(slim), "doc_id", radius)
    first = F.min(F.struct(F.col("least_id").isNull(), "least_id", "fp")).alias("first")
    chosen = grouped.groupBy("component").agg(first).select(F.col("first.fp").alias(fp))
    sortable = [f.name for f in docs.schema if not isinstance(f.dataType, MapType) and f.name != doc_id]
    order = F.struct(F.col(doc_id).isNull(), doc_id, *sortable)
    row = F.min_by(F.struct(*columns), order).alias("row")
    # copies are reduced to one row for each task before anything is shuffled by fingerprint
    kept = printed.groupBy(fp).agg(row).join(chosen, fp, "left_semi")
    return kept.select(*[F.col("row")[c].alias(c) for c in columns])
