"""Token files, the perfect hash, collocations and fill-in-middle against plain Python."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from flowatlas.llm import collocations, fill_middle, perfect_hash, queries, token_files, word_ids

SMALL = "/root/testdata/sf0.001"
PIECES = [" ", "  ", "\n", "a", "The", "don't", "it's", "'sam", "''s", "!'s", "'real", "'ll", "'lla", "I'm", "é", "É", "ß", "²", "½",
          "漢", "23", "...", "<|endoftext|>", "<|endo", "ftext|>", "\xa0", "\x85", "\x1c", "\x0b", "\r\n", "😀", "́", "İ", "Σ",
          "_", "-", "×", "’s", "'t1", "'S", "'d"]


def test_cached_words_give_the_ids_of_the_library(monkeypatch):
    exact = Tokenizer.from_file(queries.WORD_TOKENIZER)
    encoder = word_ids.WordEncoder(queries.WORD_TOKENIZER, 50_000)  # so small that words are dropped
    rng = random.Random(3)
    latin = [p for p in PIECES if not word_ids.UNUSUAL.search(p)]
    texts = ["".join(rng.choice(some) for _ in range(rng.randint(0, 100))) for some in (PIECES, latin) for _ in range(400)]
    monkeypatch.setattr(word_ids, "PART", 60)
    for at in range(0, len(texts), 50):
        for text, ids in zip(texts[at : at + 50], encoder.encode(texts[at : at + 50])):
            assert exact.encode(text, add_special_tokens=False).ids == ids.tolist(), text


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash(n):
    pairs = perfect_hash.hashes([f"key {k}" for k in range(n)])
    hashed = perfect_hash.PerfectHash.build(pairs)
    assert sorted(hashed.places(pairs).tolist()) == list(range(n))
    with pytest.raises(ValueError):
        perfect_hash.PerfectHash.build(perfect_hash.hashes(["same", "same"]))


def ids_of(rows, exact):
    for doc_id, text in rows:
        yield doc_id, np.array([*exact.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def test_token_files_hold_every_document(spark, edge_tables, edge_rows):
    exact = Tokenizer.from_file(queries.WORD_TOKENIZER)
    rows = queries.op11_token_files(spark, edge_tables).collect()
    found = sorted(rows, key=lambda r: r.start)
    assert [r.doc_id for r in found] == sorted((i for i, _ in edge_rows), key=lambda i: (i is not None, i))
    start = 0
    for row in found:
        assert row.start == start
        start += row.n_tokens
    want = Counter((i, len(x), zlib.crc32(x.tobytes())) for i, x in ids_of(edge_rows, exact))
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == want


def test_access_by_key_and_hot_keys(spark, folder):
    """A third of the rows have one key, over several files; unknown keys are told apart."""
    exact = Tokenizer.from_file(queries.WORD_TOKENIZER)
    rows = [(7 if k % 3 else k, f"text number {k} of many") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        token_files.write(docs, folder, queries.WORD_TOKENIZER, keys_each=20)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    shards = spark.read.parquet(f"{folder}/shards").count()
    keys = token_files.keyed(spark, folder)
    assert shards > 1 and keys.filter("key = 7").select("copy").distinct().count() == 200
    ids = dict(ids_of([r for r in rows if r[0] != 7], exact))
    for key in (0, 3, 297):
        assert token_files.fetch(spark, folder, key).tolist() == ids[key].tolist()
    assert token_files.fetch(spark, folder, 7, 199) is not None
    assert token_files.fetch(spark, folder, 7, 200) is None and token_files.fetch(spark, folder, 1) is None
    asked = spark.createDataFrame([("=3",), ("=3",), ("=1",)], "key string")
    located = {r.key: r.n for r in token_files.locate(asked, folder).collect()}
    assert located == {"=3": len(ids[3]), "=1": None}


def test_frequent_prefixes_by_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(150):
        n, width = rng.integers(0, 60), rng.integers(1, 6)
        keys = rng.integers(-1, rng.integers(1, 5), (n, width))
        keys = np.where(np.cumsum(keys < 0, axis=1) > 0, -1, keys)
        weights, least = rng.integers(1, 5, n), int(rng.integers(1, 12))
        row, length, weight = collocations.frequent_prefixes(keys, weights, least)
        want = Counter()
        for key, x in zip(keys.tolist(), weights.tolist()):
            for d in range(1, width + 1):
                if key[d - 1] < 0:
                    break
                want[tuple(key[:d])] += x
        got = [(tuple(keys[r, :m]), int(w)) for r, m, w in zip(row, length, weight)]
        assert len(got) == len(set(got)) and dict(got) == {k: w for k, w in want.items() if w >= least}


def test_hot_leading_words_are_split_and_counted(spark, monkeypatch):
    """One pair leads most suffixes; cells and blocks are small, so every way is taken."""
    rng = random.Random(4)
    lines = [" ".join(["hot", "pair", *rng.choices("abcdefg", k=rng.randint(0, 6))]) for _ in range(4000)]
    texts = [". ".join(lines[k : k + 40]) for k in range(0, len(lines), 40)]
    docs = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string")
    counts, _ = collocations.phrase_counts(docs, "text", "lang", 3, 5, 50)
    want = Counter()
    for line in lines:
        words = line.split()
        want.update(" ".join(words[i : i + n]) for n in range(1, 6) for i in range(len(words) - n + 1))
    assert {r.phrase: r.f for r in counts.collect()} == {p: n for p, n in want.items() if n >= 3}


def test_equal_suffixes_of_many_parts_are_added_up_before_they_move(spark):
    """Rows sent are told by the cores, not by the parts of the input; more words make more tasks."""
    cores = spark.sparkContext.defaultParallelism
    texts = spark.range(0, 20 * cores, 1, 5 * cores).selectExpr("'en' AS group", "'one two three four five six' AS text")
    sent = collocations.local_suffixes(texts, 3, 5, 6 * 20 * cores, 1 << 25)
    rows = [(r.w1, r.w5, r.n) for r in sent.collect()]
    assert len(rows) == 5 * cores and Counter(w for w, _, _ in rows) == dict.fromkeys(["one", "two", "three", "four", "five"], cores)
    assert all(sum(n for w, _, n in rows if w == first) == 20 * cores for first in ("one", "five"))
    assert {last for w, last, _ in rows if w == "one"} == {"five"} and {last for w, last, _ in rows if w == "five"} == {None}
    more = collocations.in_few_tasks(texts, 6 * 20 * cores, 60)
    assert more.rdd.getNumPartitions() == 2 * cores


def test_suffixes_are_summed_alike_however_few_are_held():
    rng = random.Random(8)
    texts = [" ".join(rng.choices(["a", "é", "漢字", "d", "e,"], k=rng.randint(0, 30))) for _ in range(600)]
    groups = [rng.choice(["en", "dé", ""]) for _ in texts]
    want = Counter()
    for text, group in zip(texts, groups):
        for words in (piece.split() for piece in text.split(",")):
            want.update((group, *(words + [None] * 5)[i : i + 5]) if i + 5 > len(words) else (group, *words[i : i + 5]) for i in range(len(words) - 1))
    rows = pa.RecordBatch.from_arrays([pa.array(groups), pa.array(texts)], names=["group", "text"])
    maps = {size: np.full(1 << collocations.CELL_BITS >> 3, 255, np.uint8) for size in collocations.RUNS}
    for most in (20, 1 << 21):
        got, sent = Counter(), 0
        for part in collocations.sum_suffixes(iter([rows.slice(k, 20) for k in range(0, 600, 20)]), maps, 5, most):
            sent += len(part)
            for *key, n in zip(*(c.to_pylist() for c in part.columns)):
                got[tuple(key)] += n
        assert got == want and (sent == len(want)) == (most > 20)


def test_long_texts_are_cut_where_pieces_end():
    text = "one two. three four, five six\nseven" * 20
    parts = list(collocations.at_breaks(text, 30))
    assert len(parts) > 5 and "".join(parts) == text and all(p[-1] in ".,\n" for p in parts[:-1])


def test_fill_in_middle_in_one_batch_and_back():
    rng = random.Random(5)
    texts = [None, "", "\n", "é\n漢字", "a <P> b", *("".join(rng.choices("aé\n漢<PSM>", k=rng.randint(1, 40))) for _ in range(400))]
    numbers = {f"h{k}": pa.array([rng.getrandbits(32) for _ in texts], pa.int64()) for k in (1, 2, 3, 4)}
    batch = pa.StructArray.from_arrays([pa.array(texts, pa.string()), *numbers.values()], names=["text", *numbers])
    made = fill_middle.scatter(batch, fill_middle.MARKS, 100, 50)
    back = fill_middle.gather(pa.StructArray.from_arrays([made.field("output"), made.field("form")], names=["output", "form"]), fill_middle.MARKS)
    assert back.to_pylist() == [t or "" for t in texts] and set(made.field("form").to_pylist()) == {"plain", "psm", "spm"}
    for text, h1, h2, row in zip(texts, *(numbers[f"h{k}"].to_pylist() for k in (1, 2)), made.to_pylist()):
        lines = (text or "").splitlines(keepends=True) if "\r" not in (text or "") else []
        assert row["n"] == len(lines)
        if row["form"] != "plain":
            a, b = sorted((h1 % (len(lines) + 1), h2 % (len(lines) + 1)))
            parts = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
            assert (row["prefix_chars"], row["middle_chars"]) == (len(parts[0]), len(parts[1]))
            psm = row["form"] == "psm"
            p, m, s = parts
            assert row["output"] == (f"<P>{p}<S>{s}<M>{m}" if psm else f"<S>{s}<P>{p}<M>{m}")


def test_a_taken_name_is_an_error(spark):
    docs = spark.createDataFrame([(1, "x", "y")], "doc_id long, text string, fim string")
    with pytest.raises(ValueError):
        fill_middle.fill_in_middle(docs)
    made = fill_middle.fill_in_middle(docs, into="made")
    assert made.select("fim", fill_middle.restore(F.col("made.output"), F.col("made.form"))).first() == ("y", "x")
