"""The registered queries: against SQL, against brute force on odd rows, and on empty tables."""

import hashlib
import json
import random
import re
import zlib
from collections import Counter

import duckdb
import pytest
import xxhash
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from flowatlas.llm import licenses, pii, queries

SMALL = "/root/testdata/sf0.001"
TABLES = ("documents", "benchmark", "labels", "conversations")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def rows_of(spark, name: str, folder: str) -> list[dict]:
    return [r.asDict() for r in contract.queries()[name](spark, folder).collect()]


def by_text(rows: list[dict], edge_rows: list[tuple]) -> list[tuple[dict, str | None]]:
    """Result rows with their texts; ids that repeat are told apart by the checks themselves."""
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, _ in edge_rows)
    once = {i: t for i, t in edge_rows if Counter(x for x, _ in edge_rows)[i] == 1}
    return [(r, once[r["doc_id"]]) for r in rows if r["doc_id"] in once]


def same_as_sql(spark, name: str, folder: str) -> None:
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    got = connection.execute(contract.oracle_sql()[name])
    names = [c[0] for c in got.description]
    want = [dict(zip(names, r)) for r in got.fetchall()]
    have = rows_of(spark, name, folder)
    assert have and set(have[0]) == set(names)
    key = lambda r: json.dumps([str(r[n]) for n in sorted(names)])
    assert sorted(map(key, have)) == sorted(map(key, want))


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql_small(spark, name):
    same_as_sql(spark, name, SMALL)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql_odd_rows(spark, name, edge_tables):
    same_as_sql(spark, name, edge_tables)


@pytest.mark.parametrize("name", sorted([*queries.QUERIES, "pipeline"]))
def test_empty_tables(spark, name, empty_tables):
    rows = rows_of(spark, name, empty_tables)
    assert len(rows) == (1 if name == "op7_chat" else 0)  # the forged conversation is always there


def test_secrets_by_hand(spark, edge_tables, edge_rows):
    for row, text in by_text(rows_of(spark, "op1_secrets", edge_tables), edge_rows):
        if text and text.startswith("password"):
            assert (row["n_assign"], row["n_access"], row["n_hex"]) == (2, 1, 1)
        if text and text.startswith("key Zk8"):
            assert row["spans"] == "entropy:4:28"  # neither the UUID nor the x's
        assert text or row["spans"] == ""


def test_bpe(spark, edge_tables, edge_rows):
    exact = Tokenizer.from_file(queries.TOKENIZER)
    for row, text in by_text(rows_of(spark, "op3_bpe", edge_tables), edge_rows):
        ids = exact.encode(text or "", add_special_tokens=False).ids
        assert row["n_tokens"] == len(ids) and row["ids_sha256"] == sha(",".join(map(str, ids)))
        assert row["decoded_sha256"] == sha(exact.decode(ids, skip_special_tokens=False))


def test_licenses(spark, edge_tables, edge_rows):
    for row, text in by_text(rows_of(spark, "op4_licenses", edge_tables), edge_rows):
        lowered = "".join(c.lower() if c < "\x80" else c for c in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
        found = [
            (i, label) for p, label in licenses.BASE_PHRASES.items() for i in range(len(words))
            if words[i : i + len(p.split())] == p.split()
        ]
        assert row["n_words"] == len(words) and row["n_base"] == len(found)
        assert row["first_word"] == min((i for i, _ in found), default=None)
        assert row["last_word"] == max((i for i, _ in found), default=None)
        assert row["base_labels"] == ",".join(sorted({x for _, x in found}))
        assert set(row["base_labels"].split(",")) <= set(row["labels"].split(",")) | {""}
        if text and text.startswith("SPDX"):
            assert row["labels"] == "bsd,gpl,mit" and row["score"] == 1.0


def brute_pii(t: str) -> list[tuple]:
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        out += [("ip", *m.span())] if all(int(p) <= 255 for p in m[0].split(".")) else []
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        out += [("card", *m.span())] if 14 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0])) else []
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        out += [("phone", *m.span())] if 10 <= len(digits(m[0])) <= 15 else []
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_pii(spark, edge_tables, edge_rows):
    for row, text in by_text(rows_of(spark, "op5_pii", edge_tables), edge_rows):
        base = brute_pii(text or "")
        listed = [f"{k}:{a}:{b}" for k, a, b in base]
        assert row["base_sha256"] == sha(",".join(listed))
        assert [row[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        assert set(listed) <= set(row["spans"].split(",")) | {""}


def fold(doc_id) -> bool:
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_scores(spark, edge_tables, edge_rows):
    quality = rows_of(spark, "op6_quality", edge_tables)
    for row, _ in by_text(quality, edge_rows):
        assert row["held_out"] == fold(row["doc_id"]) and 0 <= row["score"] <= 1
        assert row["predicted"] == int(row["score"] >= 0.5)
    for row, text in by_text(rows_of(spark, "op9_language", edge_tables), edge_rows):
        assert row["held_out"] == fold(row["doc_id"]) and 0 <= row["score"] <= 1
        letters = any(c.isalpha() for c in text or "")
        assert (row["lang_pred"] in ("en", "de")) == letters and (row["lang_pred"] == "und") != letters


def fingerprint(text: str | None) -> int:
    lowered = "".join(c.lower() if c < "\x80" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    ones = Counter(b for s in shingles for h in [xxhash.xxh64_intdigest(s.encode(), 42)] for b in range(64) if h >> b & 1)
    return sum(1 << b for b, n in ones.items() if 2 * n > len(shingles))


def components_of(prints: dict) -> dict:
    """(component, smallest id in it) of every fingerprint, by brute force."""
    root = {fp: fp for fp in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    fps = list(prints)
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    least: dict = {}
    for fp, ids in prints.items():
        known = [i for i in ids if i is not None]
        least[find(fp)] = min([*known, *([least[find(fp)]] if least.get(find(fp)) is not None else [])], default=None)
    return {fp: (find(fp), least[find(fp)]) for fp in prints}


def check_simhash(rows: list[dict], source: list[tuple]) -> None:
    prints: dict = {}
    for doc_id, text in source:
        prints.setdefault(fingerprint(text), []).append(doc_id)
    groups = components_of(prints)
    want = Counter((i, f"{fingerprint(t):016x}", groups[fingerprint(t)][1]) for i, t in source)
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in rows) == want


def test_simhash(spark, edge_tables, edge_rows):
    check_simhash(rows_of(spark, "op8_simhash", edge_tables), edge_rows)
    source = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    check_simhash(rows_of(spark, "op8_simhash", SMALL), source)


def test_rules(spark, edge_tables, edge_rows):
    for row, text in by_text(rows_of(spark, "op10_rules", edge_tables), edge_rows):
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        often = {w for w, n in Counter(windows).items() if n > 1}
        repeated = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert row["n_words"] == len(words) and row["word_chars"] == sum(map(len, words))
        assert row["n_symbols"] == len(re.findall(r"[#*$%&|<>]", t))
        assert row["n_dup_lines"] == len(lines) - len(set(lines)) and row["n_repeat_words"] == len(repeated)
        failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
        assert row["base_failed"] == failed and not (failed and row["kept"])


def test_chat_turns(spark, edge_tables):
    rows = {r["conv_id"]: r for r in rows_of(spark, "op7_chat", edge_tables)}
    assert rows[7]["n_turns"] == 70 and rows[4]["loss_chars"] == 100_002 and rows[None]["n_turns"] == 2


def test_pipeline(spark, edge_tables, edge_rows):
    """Every stage against its rule in plain Python, on what the stage before it kept."""
    docs = spark.read.parquet(f"{edge_tables}/documents.parquet")
    key = lambda r: (r["doc_id"], r["text"])
    for name, stage in corpus_pipeline.STAGES:
        before = [key(r) for r in docs.collect()]
        columns = docs.columns
        docs = corpus_pipeline.cut_lineage(stage(spark, docs, edge_tables))
        after = docs.collect()
        if name == "tokens":
            exact = Tokenizer.from_file(queries.TOKENIZER)
            want = Counter((i, tuple(exact.encode(t, add_special_tokens=False).ids)) for i, t in before)
            assert Counter((r["doc_id"], tuple(r["ids"])) for r in after) == want and all(r["exact"] for r in after)
            continue
        assert docs.columns == columns
        kept = Counter(map(key, after))
        if name == "language":
            assert all(any(c.isalpha() for c in t) for _, t in kept)
            assert sum(kept.values()) == sum(any(c.isalpha() for c in t or "") for _, t in before)
        elif name == "near_duplicates":
            prints: dict = {}
            for doc_id, text in before:
                prints.setdefault(fingerprint(text), []).append(doc_id)
            groups = components_of(prints)
            assert not kept - Counter(before)
            assert Counter(r["doc_id"] for r in after) == Counter(least for _, least in set(groups.values()))
        elif name == "decontamination":
            assert not kept - Counter(before) and not any("fourteen" in t.lower() and len(t) < 200 for _, t in kept)
        elif name == "personal_data":
            assert Counter(i for i, _ in before) == Counter(r["doc_id"] for r in after)
            assert not any(brute_pii(r["text"]) for r in after)
            assert all(r["n_chars"] == len(r["text"]) for r in after)


def test_sql_of_joined_runs(spark, tmp_path, write_documents):
    """Hex runs inside longer runs, and runs of which a part holds a placeholder."""
    digits = hashlib.sha256(b"a key").hexdigest().upper()[:40]
    texts = [
        "/sample/Zk8vQ2mX7pL4nT9wR1yB6cD3",
        f"ENC_KEY={digits} and a/b/{digits.lower()[:22]} id-{digits[:20]}",
        f"{digits}/Dummy12/{digits[::-1]}=EXAMPLE+1_Zk8vQ2mX7pL4nT9wR1yB6cD3-{digits[:25]}zz{digits[5:30]}",
        "sample" * 10 + " example/placeholder/changeme012345 " + "ab" * 15 + " /dummy/" + "7" * 30,
        f"exampleZk8vQ2mX7pL4nT9wR1yB6cD3 0123456789{digits} x{digits}y",
        "550e8400-e29b-41d4-a716-446655440000/sample/550e8400-e29b-41d4-a716-446655440000",
    ]
    rng = random.Random(7)
    parts = ["sample", "DUMMY", "/", "=", "_", "-", "é", " ", "Abc", digits, digits.lower()[:24], "Zk8vQ2mX7pL4nT9wR1yB", "9f" * 11]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(3, 9))) for _ in range(300)]
    folder = write_documents(tmp_path / "joined", texts)
    same_as_sql(spark, "op1_secrets", folder)
    spans = queries.QUERIES["op1_secrets"](spark, folder).filter("doc_id = 0").first().spans
    assert spans == "entropy:7:32"
