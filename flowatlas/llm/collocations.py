"""Collocations: phrases of frequent words that hold together more than chance would have them.

Counting. Every word of a piece (texts are cut at punctuation and line ends) begins a suffix,
read up to `longest` words. Suffixes are routed by their leading words, so that all that
share them meet in one task, and sorted there by multikey three-way quicksort over pointers:
a partition is split by the word at its depth into smaller, equal and larger ones; the equal
ones go on at the next depth and their sizes are the counts of the phrases read so far. A
partition lighter than `least` is abandoned, as nothing in it can be frequent.

Before that, runs of two and three words are counted by cells of a hash, 2^27 of them, and
suffixes end where a run's cell is lighter than `least`. Counts travel as sorted arrays, four
bytes for a cell and task, and are added up in arrays of fixed size; the tasks are told by a bit
for each cell (16 MB). A cell holds all occurrences of its runs and perhaps others', so no frequent
phrase is lost, and a run too many costs time only, as the sort counts anew. Beyond some 50 GB
most cells are heavy and little is left out: then all suffixes are routed.

Equal suffixes are added up before they move, in a task for each core or for `words_each` words,
whichever are more. Were it a task for each part of the input, each would send nearly all frequent
phrases, which grow in number themselves, as `least` is fixed.

Hot leading words. Where a hash cell of leading words holds over a 1024th of all suffixes
(less where there are more than 256 tasks), its suffixes are routed by one word more, and so
on; phrases shorter than their route are then counted by an aggregate. No group thus lies in
one task because many share its first words.

A null text is empty, a null group is `und`. A text of over 3 MB is taken in parts that end at
punctuation. Repeated rows count each time. Ties of score are in order of count, then phrase
in byte order; an empty table gives no phrases. Other columns are not read.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from flowatlas.llm.arrow_bytes import flat
from flowatlas.llm.common import LOWER_BYTES, bound_batches, cut_lineage, slices

SPACE, BREAK = b"\x20\x09", b".,;:!?\x0a\x0b\x0c\x0d"
BLOCK = 3 << 20
#: Runs of two and three words are counted by cells of a hash, in ranges of SPAN cells.
RUNS = (2, 3)
CELL_BITS = 27
SPAN = 1 << 16
#: Counts of a cell end here; `least` must not be larger.
MOST = (1 << 16) - 1
#: Cells in which leading words are looked at when hot ones are split.
ROUTE_CELLS = 1 << 16

LOWER = np.frombuffer(LOWER_BYTES, np.uint8)
CLASS = np.zeros(256, np.uint8)
CLASS[list(SPACE)] = 1
CLASS[list(BREAK)] = 2


# --- words of a batch ----------------------------------------------------------------


class Words:
    """The words of some texts as numbers, with where pieces begin."""

    def __init__(self, texts: pa.Array, groups: list[str]):
        data, offsets = flat(texts)
        kind = CLASS[data]
        word, piece = kind == 0, kind == 2
        opens = np.zeros(len(data), bool)
        opens[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
        begins = word.copy()
        begins[1:] &= ~word[:-1] | opens[1:]
        at = np.flatnonzero(begins)
        ends = np.append((np.cumsum(word) - 1)[at], np.count_nonzero(word)).astype(np.int32)
        content = LOWER[data[word]]
        letters = pa.BinaryArray.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(content)])
        coded = letters.dictionary_encode()
        self.code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.words = coded.dictionary
        number = np.cumsum(piece | opens)[at]
        #: whether a word follows the one before it within a piece
        self.follows = np.zeros(len(at), bool)
        self.follows[1:] = number[1:] == number[:-1]
        names = sorted(set(groups))
        of = {g: k for k, g in enumerate(names)}
        self.names = names
        rows = np.searchsorted(offsets, at, "right") - 1
        self.group = np.array([of[g] for g in groups], np.int64)[rows]

    def one(self) -> np.ndarray:
        """A number for each place that tells group and word."""
        return self.group * len(self.words) + self.code

    def parts(self, numbers: np.ndarray, words: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """Groups and words that such numbers tell, first word first."""
        out = []
        for _ in range(words - 1):
            numbers, before = np.divmod(numbers, len(self.words))
            out.append(before)
        group, code = np.divmod(numbers, len(self.words))
        return group, [*out, code]

    def text(self, codes: np.ndarray) -> pa.Array:
        missing = codes < 0
        return self.words.take(pa.array(np.where(missing, 0, codes), mask=missing)).cast(pa.string())


def blocks(batch: pa.RecordBatch) -> Iterator[Words]:
    """The words of a batch, in blocks of bounded bytes."""
    rows = pa.StructArray.from_arrays([batch["text"], batch["group"]], names=["text", "group"])
    for part in slices(rows, BLOCK):
        groups = part.field("group").to_pylist()
        if len(part) == 1 and part.nbytes > BLOCK:
            for piece in at_breaks(part.field("text")[0].as_py() or ""):
                yield Words(pa.array([piece]), groups)
        elif len(part):
            yield Words(part.field("text"), groups)


def at_breaks(text: str, most: int = BLOCK // 2) -> Iterator[str]:
    """A long text in parts that end where a piece ends; a longer piece stays whole."""
    pattern, at = re.compile(f"[{re.escape(BREAK.decode())}]"), 0
    while at < len(text):
        found = pattern.search(text, min(at + most, len(text)))
        end = found.end() if found else len(text)
        yield text[at:end]
        at = end


class Sums:
    """Rows with a count `n`, added up when there are many, so that few leave the task."""

    def __init__(self, most: int = 400_000):
        self.tables, self.rows, self.most = [], 0, most

    def add(self, table: pa.Table) -> Iterator[pa.RecordBatch]:
        self.tables.append(table)
        self.rows += len(table)
        if self.rows > self.most:
            self._reduce()
            if self.rows > self.most // 2:
                yield from self.rest()

    def _reduce(self) -> None:
        table = pa.concat_tables(self.tables)
        names = [c for c in table.column_names if c != "n"]
        table = table.group_by(names, use_threads=False).aggregate([("n", "sum")]).rename_columns([*names, "n"])
        self.tables, self.rows = [table], len(table)

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.tables:
            self._reduce()
            yield from self.tables[0].to_batches(max_chunksize=100_000)
        self.tables, self.rows = [], 0


def summed(read):
    """A function over batches that yields the sums of what `read(words)` counts in them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums()
        for batch in batches:
            for words in blocks(batch):
                yield from sums.add(read(words))
        yield from sums.rest()
        pa.default_memory_pool().release_unused()

    return run


def _grouped(words: Words, group: np.ndarray, codes: list[np.ndarray], n: np.ndarray) -> pa.Table:
    columns = {"group": pa.array(words.names, pa.string()).take(pa.array(group))}
    columns |= {f"w{k}": words.text(c) for k, c in enumerate(codes, 1)}
    return pa.table(columns | {"n": pa.array(n, pa.int64())})


def count_words(words: Words) -> pa.Table:
    number, n = np.unique(words.one(), return_counts=True)
    return _grouped(words, *words.parts(number, 1), n)


def cells_of(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(place of the last word, cell) of all runs of `size` words in a piece."""
    inside = words.follows.copy()
    for k in range(1, size - 1):
        inside[k:] &= words.follows[:-k]
        inside[:k] = False
    at = np.flatnonzero(inside)
    letters = np.array([xxhash.xxh64_intdigest(w) for w in words.words.to_pylist()], np.uint64)
    value = np.array([xxhash.xxh64_intdigest(g.encode()) for g in words.names], np.uint64)[words.group[at]]
    for k in range(size - 1, -1, -1):
        value = (value ^ letters[words.code[at - k]]) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(32)
    return at, (value >> np.uint64(64 - CELL_BITS)).astype(np.uint32)


def count_cells(batches: Iterator[pa.RecordBatch], most: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """(size, range, entries): of each cell in a range its place there and its count, 16 bits each."""
    for_size: dict[int, list[np.ndarray]] = {s: [] for s in RUNS}
    rows = 0

    def flushed() -> Iterator[pa.RecordBatch]:
        for size, held in for_size.items():
            cell, n = np.unique(np.concatenate([np.zeros(0, np.uint32), *held]), return_counts=True)
            entry = ((cell & np.uint32(SPAN - 1)) << np.uint32(16)) | np.minimum(n, MOST).astype(np.uint32)
            part = (cell // np.uint32(SPAN)).astype(np.int32)
            begin = np.flatnonzero(np.diff(part, prepend=-1))
            parts = [x.tobytes() for x in np.split(entry, begin[1:])] if len(begin) else []
            columns = [pa.array([size] * len(begin), pa.int32()), pa.array(part[begin], pa.int32()), pa.array(parts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["size", "range", "entries"])
            held.clear()

    for batch in batches:
        for words in blocks(batch):
            for size in RUNS:
                for_size[size].append(cells_of(words, size)[1])
            rows += len(words.code)
            if rows > most:
                yield from flushed()
                rows = 0
    yield from flushed()
    pa.default_memory_pool().release_unused()


def merge_cells(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """(size, range, bits): which cells of a range have `least` in all; one array of SPAN counts a range."""
    sums: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for size, part, entries in zip(*(batch[c].to_pylist() for c in ("size", "range", "entries"))):
            held = sums.setdefault((size, part), np.zeros(SPAN, np.uint16))
            entry = np.frombuffer(entries, np.uint32)
            place = entry >> np.uint32(16)
            held[place] = np.minimum(held[place] + (entry & np.uint32(MOST)), MOST)
    for (size, part), held in sums.items():
        if (held >= least).any():
            bits = np.packbits(held >= least, bitorder="little").tobytes()
            columns = [pa.array([size], pa.int32()), pa.array([part], pa.int32()), pa.array([bits], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["size", "range", "bits"])


def bit_maps(texts: DataFrame, least: int) -> dict[int, np.ndarray]:
    """For runs of each size a bit for every cell: set where the cell's runs reach `least` in all."""
    counted = texts.mapInArrow(count_cells, "size int, range int, entries binary")
    merged = counted.repartition("size", "range").mapInArrow(
        lambda batches: merge_cells(batches, least), "size int, range int, bits binary"
    )
    maps = {size: np.zeros(1 << CELL_BITS >> 3, np.uint8) for size in RUNS}
    for size, part, bits in merged.collect():  # 16 MB for each size at most
        maps[size][part * SPAN // 8 : (part + 1) * SPAN // 8] = np.frombuffer(bytes(bits), np.uint8)
    return maps


def count_suffixes(words: Words, maps: dict[int, np.ndarray], longest: int) -> pa.Table:
    """Suffixes of two words or more, which end before an infrequent pair or run of three; -1 is no word."""
    good = {size: np.zeros(len(words.code) + longest, bool) for size in RUNS}
    for size, known in good.items():
        at, cell = cells_of(words, size)
        known[at] = (maps[size][cell >> np.uint32(3)] >> (cell & np.uint32(7)).astype(np.uint8) & 1).astype(bool)
    at = np.flatnonzero(good[2][1 : len(words.code)])
    codes, padded = [words.code[at]], np.concatenate([words.code, np.zeros(longest, np.int64)])
    alive = np.ones(len(at), bool)
    for k in range(1, longest):
        alive = alive & good[2][at + k] & (good[3][at + k] if k > 1 else True)
        codes.append(np.where(alive, padded[at + k], -1))
    table = pa.table({"group": words.group[at]} | {f"w{k}": c for k, c in enumerate(codes, 1)} | {"n": np.ones(len(at), np.int64)})
    names = table.column_names[:-1]
    return table.group_by(names).aggregate([("n", "sum")]).rename_columns([*names, "n"])


def numbered(words: Words, table: pa.Table, numbers: dict[bytes, int]) -> pa.Table:
    """Such suffixes with numbers of the task, not of the block, for groups and words."""
    number = lambda texts: [numbers.setdefault(x, len(numbers)) for x in texts]
    codes = [table[c].to_numpy() for c in table.column_names[1:-1]]
    used = np.unique(np.concatenate(codes))
    used = used[used >= 0]
    known = np.full(len(words.words) + 1, -1, np.int32)  # the last is for no word, -1
    known[used] = number(words.words.take(pa.array(used)).to_pylist())
    groups = np.array(number(g.encode() for g in words.names), np.int32)
    columns = [groups[table["group"].to_numpy()], *(known[c] for c in codes), table["n"].to_numpy()]
    return pa.table(columns, names=table.column_names)


def spelled(batch: pa.RecordBatch, numbers: dict[bytes, int]) -> pa.RecordBatch:
    """Rows of such numbers with their texts."""
    texts = pa.array(list(numbers), pa.binary()).cast(pa.string())
    codes = [c.to_numpy() for c in batch.columns[:-1]]
    columns = [texts.take(pa.array(c, mask=c < 0)) for c in codes]
    return pa.RecordBatch.from_arrays([*columns, batch.column(batch.num_columns - 1)], names=batch.schema.names)


def sum_suffixes(
    batches: Iterator[pa.RecordBatch], maps: dict[int, np.ndarray], longest: int, most: int = 1 << 20
) -> Iterator[pa.RecordBatch]:
    """The suffixes of a task, added up as rows of numbers, of which many more can be held."""
    sums, numbers = Sums(most), {}
    for batch in batches:
        for words in blocks(batch):
            for part in sums.add(numbered(words, count_suffixes(words, maps, longest), numbers)):
                yield spelled(part, numbers)
            if not sums.rows:
                numbers.clear()
    for part in sums.rest():
        yield spelled(part, numbers)
    pa.default_memory_pool().release_unused()


# --- multikey quicksort --------------------------------------------------------------


def frequent_prefixes(keys: np.ndarray, weights: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, length, weight) of every prefix of rows with that weight in total.

    Rows end at a negative key. All partitions of a step are split together; `point` holds the
    pointers of those not yet done, partition after partition.
    """
    width = keys.shape[1]
    point, starts, depth = np.arange(len(keys)), np.zeros(min(len(keys), 1), np.int64), np.zeros(min(len(keys), 1), np.int64)
    out = []
    while len(point):
        sizes = np.diff(np.append(starts, len(point)))
        part = np.repeat(np.arange(len(starts)), sizes)
        value = keys[point, depth[part]]
        pivot = np.median([value[starts], value[starts + sizes // 2], value[starts + sizes - 1]], axis=0).astype(np.int64)
        side = np.sign(value - pivot[part]) + 1
        count = np.bincount(3 * part + side, minlength=3 * len(starts))
        first = np.cumsum(count) - count
        moved = np.empty_like(point)
        for s in range(3):
            those = np.flatnonzero(side == s)
            before = np.cumsum(count[s::3]) - count[s::3]
            own = part[those]
            moved[first[3 * own + s] + np.arange(len(those)) - before[own]] = point[those]
        filled = np.flatnonzero(count)
        weight = np.add.reduceat(weights[moved], first[filled])
        equal, parent = filled % 3 == 1, filled // 3
        keep = (weight >= least) & ~(equal & (pivot[parent] < 0))
        deeper = depth[parent] + equal
        said = keep & equal
        out.append((moved[first[filled[said]]], deeper[said], weight[said]))
        keep &= deeper < width
        point = moved[np.repeat(keep, count[filled])]
        sizes = count[filled[keep]]
        starts, depth = np.cumsum(sizes) - sizes, deeper[keep]
    empty = (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(empty, *out))


def sort_suffixes(batches: Iterator[pa.RecordBatch], least: int, longest: int) -> Iterator[pa.RecordBatch]:
    """Frequent phrases of two words or more among the suffixes of a task."""
    table = pa.Table.from_batches(batches) if (batches := list(batches)) else None
    if not table:
        return
    names = ["group", *[f"w{k}" for k in range(1, longest + 1)]]
    coded = [table[c].combine_chunks().dictionary_encode() for c in names]
    keys = np.stack([c.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) for c in coded], axis=1)
    row, length, weight = frequent_prefixes(keys, table["n"].to_numpy(), least)
    # shorter than its route: others of this phrase may be in other tasks
    own = (length > 2) & (length - 1 >= table["depth"].to_numpy()[row])
    row, length, weight = row[own], length[own], weight[own]
    parts = [c.dictionary.to_pylist() for c in coded]
    phrases = [" ".join(parts[k][keys[r, k]] for k in range(1, n)) for r, n in zip(row.tolist(), length.tolist())]
    yield pa.RecordBatch.from_arrays(
        [pa.array([parts[0][keys[r, 0]] for r in row.tolist()], pa.string()), pa.array(phrases, pa.string()),
         pa.array(length - 1, pa.int32()), pa.array(weight, pa.int64())],
        names=["group", "phrase", "words", "f"],
    )


# --- Spark ---------------------------------------------------------------------------


def in_few_tasks(texts: DataFrame, words: int, words_each: int) -> DataFrame:
    """The texts in a task for each core, or in more of some `words_each` of their words."""
    return texts.coalesce(max(texts.sparkSession.sparkContext.defaultParallelism, -(-words // words_each)))


def local_suffixes(texts: DataFrame, least: int, longest: int, words: int, words_each: int) -> DataFrame:
    """(group, w1.., n): the suffixes of each task, equal ones added up."""
    maps = texts.sparkSession.sparkContext.broadcast(bit_maps(texts, least))
    found = in_few_tasks(texts, words, words_each)
    return found.mapInArrow(lambda batches: sum_suffixes(batches, maps.value, longest), kind_of(longest))


def routed(suffixes: DataFrame, longest: int, rows_each: int) -> tuple[DataFrame, DataFrame | None]:
    """(suffixes dealt out by leading words, counts of phrases that are shorter than their route)."""
    names = [f"w{k}" for k in range(1, longest + 1)]
    total = suffixes.count()
    tasks = max(1, -(-total // rows_each))
    limit = total / max(1024, 4 * tasks)
    hot: Column = F.lit(True)
    depth, short = F.lit(1), None
    for k in range(1, longest):
        cell = F.xxhash64("group", *names[:k]).bitwiseAND(F.lit(ROUTE_CELLS - 1))
        full = suffixes.filter(hot).groupBy(cell.alias("cell")).count().filter(F.col("count") > limit)
        cells = [r.cell for r in full.select("cell").collect()]  # ROUTE_CELLS at most
        if not cells:
            break
        hot = hot & cell.isin(cells)
        depth = F.when(hot, k + 1).otherwise(depth)
        if k > 1:
            phrase = F.concat_ws(" ", *names[:k])
            counted = suffixes.filter(hot & F.col(names[k - 1]).isNotNull()).groupBy("group", phrase.alias("phrase"))
            counted = counted.agg(F.sum("n").alias("f")).withColumn("words", F.lit(k))
            short = counted if short is None else short.unionByName(counted)
    given = suffixes.withColumn("depth", depth)
    route = [F.when(F.col("depth") >= k, F.col(c)) for k, c in enumerate(names, 1)]
    return given.repartition(tasks, F.xxhash64("group", *route)), short


def kind_of(words: int) -> str:
    return "group string, " + "".join(f"w{k} string, " for k in range(1, words + 1)) + "n bigint"


def phrase_counts(
    docs: DataFrame, text: str, group: str, least: int, longest: int, rows_each: int, words_each: int = 1 << 25
) -> tuple[DataFrame, DataFrame]:
    """(group, phrase, words, f) of all phrases with f >= least, and (group, n) with all words."""
    texts = docs.select(F.coalesce(F.col(group).cast("string"), F.lit("und")).alias("group"), F.col(text).alias("text"))
    bound_batches(docs.sparkSession)

    found = texts.mapInArrow(summed(count_words), kind_of(1))
    words = cut_lineage(found.groupBy("group", "w1").agg(F.sum("n").alias("f")))
    sizes = words.groupBy("group").agg(F.sum("f").alias("n"))
    common = words.filter(F.col("f") >= least)

    total = words.agg(F.sum("f")).first()[0] or 0
    suffixes = cut_lineage(local_suffixes(texts, least, longest, total, words_each))
    dealt, short = routed(suffixes, longest, rows_each)
    schema = "group string, phrase string, words int, f bigint"
    phrases = dealt.mapInArrow(lambda batches: sort_suffixes(batches, least, longest), schema)
    phrases = phrases.unionByName(common.select("group", F.col("w1").alias("phrase"), F.lit(1).alias("words"), "f"))
    if short is not None:
        phrases = phrases.unionByName(short.filter(F.col("f") >= least))
    return cut_lineage(phrases), sizes


def score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 a n / (l r)), exact: the products are decimals of 38 digits."""
    whole = lambda c: c.cast("decimal(19,0)")
    made = F.struct((whole(a * 1000) * whole(n)).alias("over"), (whole(left) * whole(right)).alias("under"))
    return F.transform(F.array(made), lambda s: F.call_function("div", s["over"], s["under"]))[0]


def mine(
    docs: DataFrame,
    text: str = "text",
    group: str = "lang",
    least: int = 100,
    longest: int = 5,
    top: int = 2000,
    cover: int = 100,
    rows_each: int = 250_000,
    words_each: int = 1 << 25,
) -> DataFrame:
    """The `top` phrases of each group: group, rank, phrase, a, l, r, n, score.

    A phrase of which a longer one has `cover` percent of the occurrences or more is left out.
    `rows_each` is how many suffixes a task sorts, `words_each` of how many words a task adds
    them up before they move.
    """
    if longest < 2 or not 1 <= least <= MOST:
        raise ValueError(f"phrases have two words at least, and `least` is 1 to {MOST}")
    counts, sizes = phrase_counts(docs, text, group, least, longest, rows_each, words_each)
    phrases = counts.filter("words > 1")

    parts = F.split("phrase", " ")
    spans = [(k, n) for n in range(2, longest) for k in range(1, longest - n + 2)]
    inner = F.array(*[F.when((F.col("words") > n) & (F.col("words") >= k + n - 1), F.slice(parts, k, n)) for k, n in spans] or [F.lit(None).cast("array<string>")])
    within = phrases.filter("words > 2").select("group", F.explode(F.array_distinct(inner)).alias("inner"), "f").filter("inner is not null")
    held = within.groupBy("group", F.array_join("inner", " ").alias("phrase")).agg(F.max("f").alias("longer"))
    free = phrases.join(held, ["group", "phrase"], "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < cover * F.col("f")))

    cut = free.select("group", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cut = cut.withColumn("left", F.expr("substring_index(phrase, ' ', k)")).withColumn("right", F.expr("substring(phrase, length(left) + 2)"))
    cut = cut.join(counts.select("group", F.col("phrase").alias("left"), F.col("f").alias("l")), ["group", "left"])
    cut = cut.join(counts.select("group", F.col("phrase").alias("right"), F.col("f").alias("r")), ["group", "right"])
    cut = cut.join(sizes, "group")
    scored = cut.withColumn("score", score(F.col("a"), F.col("n"), F.col("l"), F.col("r")))
    lowest = scored.groupBy("group", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("low"))
    order = Window.partitionBy("group").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = lowest.select("group", "phrase", "a", "low.l", "low.r", "n", "low.score")
    ranked = ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select(F.col("group").alias(group), F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
