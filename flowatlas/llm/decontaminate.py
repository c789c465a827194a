"""Benchmark decontamination by n-gram windows.

Test items are cut into windows of `size` consecutive normalised words (an item of fewer words
is one window). The windows are kept as a hash set in the plan itself, which every task gets
with its code; their number is checked against `most` first. A training text is scanned with
anchors: of any `size` consecutive words, one run of four begins at a place that the stride
divides, so only every tenth run of four is looked up in the set of the windows' runs. Around
an anchor that is found, each whole window is compared as a string, which verifies the hit.
Items shorter than the size get their own stride, for each length that occurs.

Beyond `most` windows the texts' windows are joined with the test windows by their hash and
verified as strings; results are the same (`overlap_by_join`).

Built-in functions only. A null or empty text has no words; an item without words has no
windows. Repeated rows give repeated results, also with a null id; other columns pass through.
"""

from pyspark.sql import Column, DataFrame, functions as F

from flowatlas.llm.native import let, places, words

RUN = 4


def test_windows(items: DataFrame, text: str = "text", item_id: str = "item_id", size: int = 13) -> DataFrame:
    """(item_id, n, window): the different windows of every item, n words each."""
    cut = items.select(F.col(item_id).alias("item_id"), words(F.col(text)).alias("w"))
    n = F.least(F.size("w"), F.lit(size))
    each = F.transform(
        places(0, F.size("w") - n), lambda i: F.struct(n.alias("n"), F.array_join(F.slice("w", i + 1, n), " ").alias("window"))
    )
    return cut.filter(F.size("w") > 0).select("item_id", F.explode(F.array_distinct(each)).alias("x")).select("item_id", "x.*")


def _hits(w: Column, n: int, runs: list[int], windows: list[str]) -> Column:
    """Places in the array of words where a window of n words stands."""
    run = min(RUN, n)
    stride = n - run + 1
    size = F.size(w)
    anchors = F.filter(places(0, size - run, stride), lambda p: F.xxhash64(F.slice(w, p + 1, F.lit(run))).isin(runs))
    around = F.transform(
        anchors, lambda p: places(F.greatest(p - (stride - 1), F.lit(0)), F.least(p, size - n))
    )
    return F.filter(
        F.flatten(around), lambda s: F.array_join(F.slice(w, s + 1, F.lit(n)), " ").isin(windows)
    )


def _with_size(starts: Column, n: int) -> Column:
    return F.transform(starts, lambda s: F.struct(s.alias("at"), F.lit(n).alias("n")))


def _windows_at(w: Column, n: int) -> Column:
    """Every window of n words with its place."""
    return F.transform(
        places(0, F.size(w) - n),
        lambda i: F.struct(i.alias("at"), F.lit(n).alias("n"), F.array_join(F.slice(w, i + 1, F.lit(n)), " ").alias("window")),
    )


def _described(w: Column, hits: Column) -> Column:
    """n_words, hit words, and the different windows found, from the places (at, n)."""
    covered = F.array_distinct(F.flatten(F.transform(hits, lambda h: F.sequence(h["at"], h["at"] + h["n"] - 1))))
    found = F.array_distinct(F.transform(hits, lambda h: F.array_join(F.slice(w, h["at"] + 1, h["n"]), " ")))
    return F.struct(F.size(w).cast("long").alias("n_words"), covered.alias("hit_words"), found.alias("windows"))


def overlap(docs: DataFrame, windows: DataFrame, text: str = "text", into: str = "overlap", most: int = 100_000) -> DataFrame:
    """Each row with its number of words, the places of hit words and the windows that occur."""
    if windows.select("window").distinct().limit(most + 1).count() > most:
        return overlap_by_join(docs, windows, text, into)
    by_size: dict[int, list[str]] = {}
    for row in windows.select("n", "window").distinct().collect():  # at most `most` rows
        by_size.setdefault(row["n"], []).append(row["window"])
    runs: dict[int, list[int]] = {}
    for n in by_size:
        run = min(RUN, n)
        w = F.split("window", " ")
        each = F.transform(places(0, F.lit(n - run)), lambda i: F.xxhash64(F.slice(w, i + 1, F.lit(run))))
        found = windows.filter(F.col("n") == n).select(F.explode(each).alias("run")).distinct()
        runs[n] = [r["run"] for r in found.collect()]  # at most ten for each window

    def scan(w: Column) -> Column:
        hits = [_with_size(_hits(w, n, sorted(runs[n]), sorted(by_size[n])), n) for n in sorted(by_size)]
        hits = F.concat(*hits) if hits else F.array().cast("array<struct<at:int,n:int>>")
        return let(hits, lambda h: _described(w, h))

    return docs.withColumn(into, let(words(F.col(text)), scan))


def overlap_by_join(docs: DataFrame, windows: DataFrame, text: str = "text", into: str = "overlap") -> DataFrame:
    """The same for any number of windows: texts are looked up once, by a hash join of windows.

    Each different text is scanned once; hot windows meet different texts only, and of each
    text a window counts once for every place it stands at.
    """
    key = into + "_key"
    sizes = [r["n"] for r in windows.select("n").distinct().orderBy("n").collect()]  # 13 at most
    texts = docs.select(F.sha2(F.coalesce(text, F.lit("")), 256).alias(key), F.col(text).alias("text")).dropDuplicates([key])
    cut = texts.select(key, words(F.col("text")).alias("w"))
    none = F.array().cast("array<struct<at:int,n:int,window:string>>")
    at = F.concat(none, *[_windows_at(F.col("w"), n) for n in sizes])
    test = windows.select("window").distinct().withColumn("hash", F.xxhash64("window"))
    places_of = cut.select(key, F.explode(at).alias("h")).select(key, "h.*").withColumn("hash", F.xxhash64("window"))
    found = places_of.join(test, ["hash", "window"], "left_semi")
    covered = F.array_distinct(F.flatten(F.collect_list(F.sequence(F.col("at"), F.col("at") + F.col("n") - 1))))
    by_text = found.groupBy(key).agg(covered.alias("hit_words"), F.collect_set("window").alias("windows"))
    joined = docs.withColumn(key, F.sha2(F.coalesce(text, F.lit("")), 256)).join(by_text, key, "left")
    result = F.struct(
        F.size(words(F.col(text))).cast("long").alias("n_words"),
        F.coalesce("hit_words", F.array().cast("array<int>")).alias("hit_words"),
        F.coalesce("windows", F.array().cast("array<string>")).alias("windows"),
    )
    return joined.withColumn(into, result).drop(key, "hit_words", "windows")


def contaminated(found: Column, share: int = 20) -> Column:
    """Whether hit words are at least one in `share` of all words, and there are any."""
    n_hit = F.size(found["hit_words"])
    return (n_hit > 0) & (share * n_hit >= found["n_words"])


def items_of(found: DataFrame, windows: DataFrame, key: list[str], column: str = "windows") -> DataFrame:
    """key and the distinct items, as sorted strings, whose windows stand in the array `column`.

    Items that share a window are gathered by window first, so a common window costs one row.
    """
    by_window = windows.groupBy("window").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
    each = found.select(*key, F.explode(column).alias("window")).join(by_window, "window")
    sets = each.groupBy(*key).agg(F.collect_set("items").alias("sets"))
    return sets.withColumn("items", F.sort_array(F.array_distinct(F.flatten("sets")))).drop("sets")


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text",
                  item_id: str = "item_id", remove: str = "documents", size: int = 13) -> DataFrame:
    """Rows without contaminated documents, or (remove="spans") with hit words cut out of every text."""
    mark = "_overlap" + "_" * max(map(len, docs.columns))
    windows = test_windows(benchmark, item_text, item_id, size)
    scanned = overlap(docs, windows, text, mark)
    found = F.col(mark)
    if remove == "documents":
        return scanned.filter(~contaminated(found)).drop(mark)
    other = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    word = other.replace("[", "[^", 1)
    pieces = F.regexp_extract_all(F.col(text), F.lit(f"{word}|{other}"), F.lit(0))
    lead = F.when(F.col(text).rlike(f"^{word}"), 0).otherwise(1)  # pieces before the first word

    def stays(piece: Column, i: Column) -> Column:
        is_word = (i >= lead) & ((i - lead) % 2 == 0)
        return ~(is_word & F.array_contains(found["hit_words"], F.floor((i - lead) / 2).cast("int")))

    kept = F.filter(pieces, stays)
    cut = F.when(F.size(found["hit_words"]) > 0, F.array_join(kept, "")).otherwise(F.col(text))
    return scanned.withColumn(text, cut).drop(mark)
