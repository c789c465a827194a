import fnmatch
import hashlib
import re
import uuid

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from flowatlas import functions as fx


def test_surrogate_key_equals_hashlib_and_skips_empty_values(spark):
    rows = [("Test", "123"), ("Test", None), ("", "x"), ("größe|", "日本"), (None, None)]
    df = spark.createDataFrame(rows, "a STRING, b STRING")
    got = [r[0] for r in df.select(fx.surrogate_key("a", "b")).collect()]
    want = [hashlib.sha256("|".join(v for v in row if v).encode()).hexdigest() for row in rows]
    assert got == want
    assert all(len(key) == 64 for key in got)


def test_random_id_is_a_distinct_uuid_per_row(spark):
    ids = [r[0] for r in spark.range(1000).select(fx.random_id()).collect()]
    assert len(set(ids)) == 1000
    assert {uuid.UUID(value).version for value in ids} == {4}


@pytest.mark.parametrize(
    "path, want",
    [
        ("/dbfs/mnt/storage/file.json", "file.json"),
        ("plain", "plain"),
        ("/a/b/", ""),
        ("", None),
        (None, None),
    ],
)
def test_last_path_part(spark, path, want):
    df = spark.createDataFrame([(path,)], "p STRING")
    assert df.select(fx.last_path_part("p")).first()[0] == want


def test_differs_null_safe_and_plain(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, None), (None, None)], "a INT, b INT")
    rows = df.select(
        fx.differs(F.col("a"), F.col("b")), fx.differs(F.col("a"), F.col("b"), null_safe=False)
    ).collect()
    assert [tuple(r) for r in rows] == [(False, False), (True, True), (True, False), (False, False)]


def test_pretty_json_is_indented_and_reads_back(spark):
    df = spark.range(1).select(F.struct(F.lit("value").alias("key")).alias("s"))
    text = df.select(fx.pretty_json("s")).first()[0]
    assert len(text.splitlines()) == 3
    assert re.sub(r"\s", "", text) == '{"key":"value"}'


def test_parse_json_marks_what_does_not_fit(spark):
    df = spark.createDataFrame([('{"key": "value"}',), ("{",), ("{'key': 1}",)], "t STRING")
    rows = df.select(fx.parse_json("t", "key STRING").alias("j")).collect()
    assert rows[0].j.key == "value" and rows[0].j._corrupt is None
    assert rows[1].j._corrupt == "{"
    assert rows[2].j._corrupt == "{'key': 1}"


def _matched(spark, pairs):
    df = spark.createDataFrame(
        [(path, fx.glob_to_regex("*" + pattern)) for path, pattern in pairs], "p STRING, r STRING"
    )
    return [r[0] for r in df.select(F.expr("p RLIKE r")).collect()]


def test_glob_cases(spark):
    pairs = [
        ("/flows/a/b.json", "b.json"),
        ("/flows/a/xb.json", "b.json"),
        ("/flows/a/b.jsonx", "b.json"),
        ("/flows/a/b.json\n", "b.json"),
        ("/flows/a/b1.json", "b[0-9].json"),
        ("/flows/a/bx.json", "b[!0-9].json"),
        ("/flows/a/b1.json", "b[!0-9].json"),
        ("/flows/a/b].json", "b[]].json"),
        ("/flows/a/b^.json", "b[^a].json"),
        ("/flows/a/b[.json", "b[.json"),
        ("/flows/a/b!.json", "b[!].json"),
        ("/flows/a/x/y.json", "a*y.json"),
        ("/flows/a+b(c).json", "a+b(c).json"),
        ("/flows/a\\b.json", "a\\b.json"),
        ("/flows/b5.json", "b[9-0].json"),
        ("/flows/b5.json", "b[!9-0].json"),
        ("/flows/b&.json", "b[a&&b].json"),
    ]
    assert _matched(spark, pairs) == [fnmatch.fnmatchcase(p, "*" + g) for p, g in pairs]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.text("ab/.]-!^", max_size=5), st.text("ab*?[]!-^./", max_size=6)),
        min_size=40,
        max_size=80,
    )
)
def test_glob_agrees_with_fnmatch(spark, pairs):
    assert _matched(spark, pairs) == [fnmatch.fnmatchcase(p, "*" + g) for p, g in pairs]


def test_glob_predicate_forms(spark):
    paths = spark.createDataFrame([("test1.json",), ("test2.json",)], "path STRING")

    def kept(pattern):
        return [r.path for r in paths.filter(fx.matches_glob(F.col("path"), pattern)).collect()]

    assert kept("*") == kept("*.json") == ["test1.json", "test2.json"]
    assert kept("test1.json") == kept("test1") == ["test1.json"]
    assert kept("t*2") == ["test2.json"]
    assert fx.ensure_json_suffix("a") == fx.ensure_json_suffix("a.json") == "a.json"
