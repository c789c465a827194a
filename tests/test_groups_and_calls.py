"""States of several tables, call closures and collisions of keys."""

from datetime import datetime

import pytest

from flowatlas import operators as ops, plans, sources
from flowatlas.functions import surrogate_key
from flowatlas.sources import snapshots
from flowatlas.streaming.arrivals import sync_batch

FIRST, SECOND = datetime(2024, 1, 1, 12), datetime(2024, 2, 1, 12)
KEYS = {"a": ["id"], "b": ["id"]}


def one(spark, value):
    return spark.createDataFrame([("1", value)], "id STRING, value STRING")


def seen(spark, root, state=None):
    return {name: df.first()["value"] for name, df in sources.read_group(spark, root, state).items()}


def test_a_run_stopped_between_tables_shows_the_old_state(spark, folder, monkeypatch):
    with pytest.raises(ValueError, match="no state"):
        sources.read_group(spark, folder)
    plans.sync_all({"a": one(spark, "x"), "b": one(spark, "x")}, folder, KEYS, run_ts=FIRST)
    assert seen(spark, folder) == {"a": "x", "b": "x"}

    broken = spark.range(1).selectExpr("'1' AS id", "CAST(raise_error('lost') AS STRING) AS value")
    with pytest.raises(Exception, match="lost"):
        plans.sync_all({"a": one(spark, "y"), "b": broken}, folder, KEYS, run_ts=SECOND)
    assert snapshots.latest_version(spark, f"{folder}/{plans.dataset_name('a')}") == 1
    assert seen(spark, folder) == {"a": "x", "b": "x"}

    plans.sync_all({"a": one(spark, "y"), "b": one(spark, "y")}, folder, KEYS, run_ts=SECOND)
    assert seen(spark, folder) == {"a": "y", "b": "y"} and seen(spark, folder, 0) == {"a": "x", "b": "x"}
    versions = {name: version for name, (_, version) in sources.group_versions(spark, folder).items()}
    assert versions == {"a": 2, "b": 1}


def test_a_part_of_the_tables_keeps_the_rest(spark, folder):
    plans.sync_all({"a": one(spark, "x"), "b": one(spark, "x")}, folder, KEYS)
    plans.sync_all({"b": one(spark, "y")}, folder, KEYS)
    assert seen(spark, folder) == {"a": "x", "b": "y"}
    same = sources.group_versions(spark, folder)
    assert sources.commit_group(spark, folder, same) == 1 == sources.group_history(spark, folder).agg({"state": "max"}).first()[0]
    with pytest.raises(ValueError, match="at least one"):
        sources.commit_group(spark, folder, {})
    with pytest.raises(ValueError, match="taken"):
        sources.commit_group(spark, folder, {"t": ("table_states", 0)})


def test_arriving_batches_are_visible_as_one(spark, folder):
    def batch(*targets):
        acts = ",".join(f'{{"name":"{t}","type":"DatabricksNotebook"}}' for t in targets)
        text = f'{{"name":"w","properties":{{"activities":[{acts}]}}}}'
        return spark.createDataFrame([("/w.json", text)], "path STRING, value STRING")

    sync_batch(batch("s", "t"), 0, folder)
    sync_batch(batch("s"), 1, folder)
    counts = [{n: df.count() for n, df in sources.read_group(spark, folder, k).items()} for k in (0, 1)]
    assert [c["activities_df"] for c in counts] == [2, 1] and [c["pipelines_df"] for c in counts] == [1, 1]
    assert set(counts[0]) == {"pipelines_df", "activities_df", "dependencies_df"}


@pytest.mark.parametrize(
    "calls, expected",
    [
        ([], []),
        ([("a", "b"), ("b", "c"), ("c", "d")],
         [("a", "b", 1), ("a", "c", 2), ("a", "d", 3), ("b", "c", 1), ("b", "d", 2), ("c", "d", 1)]),
        ([("a", "b"), ("a", "c"), ("b", "d"), ("c", "d"), ("a", "b")],
         [("a", "b", 1), ("a", "c", 1), ("a", "d", 2), ("b", "d", 1), ("c", "d", 1)]),
        ([("a", "b"), ("b", "a")], [("a", "a", 2), ("a", "b", 1), ("b", "a", 1), ("b", "b", 2)]),
        ([("a", "a"), (None, "b"), ("a", None)], [("a", "a", 1)]),
    ],
)
def test_call_closure(spark, folder, calls, expected):
    found = ops.call_closure(spark, spark.createDataFrame(calls, "caller STRING, callee STRING"), folder)
    assert sorted(tuple(r) for r in found.collect()) == expected


def test_direct_calls(spark):
    pipelines = spark.createDataFrame(
        [("1", "a"), ("2", "b"), ("1", "a"), ("3", None)], "PipelineId STRING, PipelineName STRING"
    )
    activities = spark.createDataFrame(
        [("1", "b", "Pipeline"), ("1", "b", "Pipeline"), ("2", "gone", "Pipeline"), ("1", "f", "DataFlow"),
         ("1", None, "Pipeline"), ("3", "a", "Pipeline"), ("9", "a", "Pipeline")],
        "ParentId STRING, ActivityTargetName STRING, ActivityTargetType STRING",
    )
    assert sorted(tuple(r) for r in ops.direct_calls(pipelines, activities).collect()) == [("a", "b"), ("b", "gone")]


def test_key_collisions(spark):
    rows = [("a|b", "c"), ("a", "b|c"), ("x", "y"), ("x", "y"), ("x", "y"), ("n", None), ("n", ""), ("u", "v")]
    df = spark.createDataFrame(rows, "name STRING, type STRING").withColumn("key", surrogate_key("name", "type"))
    found = ops.key_collisions(df, ["key"], ["name", "type"]).join(df.dropDuplicates(["key"]), "key")
    shown = {r["name"][0]: (r["n_rows"], r["n_natural"], r["collision"]) for r in found.collect()}
    assert shown == {"a": (2, 2, True), "x": (3, 1, False), "n": (2, 2, True)}
    assert ops.key_collisions(df.limit(0), ["key"], ["name"]).count() == 0
    with pytest.raises(ValueError, match="key"):
        ops.key_collisions(df, ["key"], [])
