import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from flowatlas import operators as ops, plans, sources
from flowatlas.sources import snapshots

FIRST, SECOND = datetime(2024, 1, 1), datetime(2024, 2, 1)
SCHEMA = "id STRING, value STRING, CreatedDate TIMESTAMP"


def rows(spark, run_ts, *pairs):
    return spark.createDataFrame([(k, v, run_ts) for k, v in pairs], SCHEMA)


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def stored(spark, path, version=None):
    return content(sources.read_snapshot(spark, path, version))


def counts(result):
    return tuple(result.counts[name] for name in snapshots.COUNTS)


def test_first_and_second_sync(spark, folder):
    first = rows(spark, FIRST, ("1", "A"), ("2", "B"), ("3", None), ("4", "D"))
    result = plans.sync_table(first, folder, ["id"], run_ts=FIRST)
    assert (result.version, counts(result)) == (0, (4, 0, 0, 0))
    second = rows(spark, SECOND, ("1", "A"), ("2", "b"), ("3", "C"), ("5", "E"))
    result = plans.sync_table(second, folder, ["id"], run_ts=SECOND)
    assert (result.version, counts(result)) == (1, (1, 2, 1, 1))
    assert stored(spark, folder) == [
        ("1", "A", FIRST),
        ("2", "b", FIRST),
        ("3", "C", FIRST),
        ("5", "E", SECOND),
    ]
    assert stored(spark, folder, 0) == content(first)


def test_sync_is_idempotent(spark, folder):
    source = rows(spark, FIRST, ("1", "A"), ("2", None))
    plans.sync_table(source, folder, ["id"])
    again = plans.sync_table(source, folder, ["id"])
    assert counts(again) == (0, 0, 0, 2)
    assert stored(spark, folder) == content(source)


def test_null_unsafe_comparison_misses_changes_from_null(spark, folder):
    plans.sync_table(rows(spark, FIRST, ("1", None), ("2", "B")), folder, ["id"])
    result = plans.sync_table(
        rows(spark, FIRST, ("1", "A"), ("2", "b")), folder, ["id"], null_safe=False
    )
    assert counts(result) == (0, 1, 0, 1)


def test_stamped_column_counts_only_when_not_ignored(spark, folder):
    plans.sync_table(rows(spark, FIRST, ("1", "A")), folder, ["id"])
    result = plans.sync_table(rows(spark, SECOND, ("1", "A")), folder, ["id"], ignore_columns=())
    assert counts(result) == (0, 1, 0, 0)
    assert stored(spark, folder) == [("1", "A", SECOND)]


def test_null_keys(spark, folder):
    source = rows(spark, FIRST, ("1", "A"), (None, "X"), (None, "Y"))
    result = plans.sync_table(source, folder, ["id"], on_duplicate="dedupe")
    assert counts(result) == (1, 0, 0, 0)
    assert [r.value for r in result.null_keyed.orderBy("value").collect()] == ["X", "Y"]
    target = rows(spark, FIRST, (None, "X"), ("1", "A"), ("2", "B"))
    changes = ops.classify(target, source, ["id"])
    assert tuple(ops.change_counts(changes).first()) == (0, 0, 2, 1)


def test_duplicates_stop_or_are_removed(spark, folder):
    source = rows(spark, FIRST, ("1", "B"), ("1", "A"), ("2", "C"))
    with pytest.raises(ops.DuplicateKeysError, match="'id': '1'"):
        plans.sync_table(source, folder, ["id"])
    assert snapshots.latest_version(spark, folder) is None
    result = plans.sync_table(source, folder, ["id"], on_duplicate="dedupe")
    assert [tuple(r) for r in result.duplicates.collect()] == [("1", 2)]
    assert [r[:2] for r in stored(spark, folder)] == [("1", "A"), ("2", "C")]


def test_dedupe_order_and_columns(spark):
    df = spark.createDataFrame([(1, 5, "x"), (1, 7, "a"), (2, 1, "z")], "k INT, n INT, s STRING")
    assert ops.dedupe_by_key(df, ["k"]).columns == df.columns
    newest = ops.dedupe_by_key(df, ["k"], [F.col("n").desc()])
    assert content(newest) == [(1, 7, "a"), (2, 1, "z")]
    assert ops.duplicate_keys(df, ["k"]).collect()[0].asDict() == {"k": 1, "duplicate_count": 2}
    nulls = spark.createDataFrame([(None,), (None,)], "k INT")
    assert ops.duplicate_keys(nulls, ["k"]).count() == 1
    assert ops.dedupe_by_key(nulls, ["k"]).count() == 1


def test_check_unique_returns_the_input_when_unique(spark):
    df = spark.range(3)
    unique, report = ops.check_unique(df, ["id"])
    assert unique is df and report.count() == 0
    with pytest.raises(ValueError):
        ops.check_unique(df, ["id"], on_duplicate="ignore")


def test_keys_are_required(spark, folder):
    df = spark.range(1)
    for call in (
        lambda: ops.classify(df, df, []),
        lambda: ops.duplicate_keys(df, []),
        lambda: ops.count_inserted(df, df, []),
        lambda: plans.sync_table(df, folder, []),
    ):
        with pytest.raises(ValueError, match="key"):
            call()


def test_table_of_keys_only_never_updates(spark, folder):
    plans.sync_table(spark.range(3), folder, ["id"])
    result = plans.sync_table(spark.range(1, 4), folder, ["id"])
    assert counts(result) == (1, 0, 1, 2)
    assert stored(spark, folder) == [(1,), (2,), (3,)]


def test_empty_sides(spark, folder):
    empty = rows(spark, FIRST)
    assert counts(plans.sync_table(empty, folder, ["id"])) == (0, 0, 0, 0)
    assert counts(plans.sync_table(rows(spark, FIRST, ("1", "A")), folder, ["id"])) == (1, 0, 0, 0)
    assert counts(plans.sync_table(empty, folder, ["id"])) == (0, 0, 1, 0)
    assert stored(spark, folder) == []


def test_upsert_without_deletes_and_scope(spark, folder):
    schema = "id STRING, parent STRING, value STRING"

    def table(*values):
        return spark.createDataFrame(values, schema)

    old = table(("1", "p", "A"), ("2", "p", "B"), ("3", "q", "C"))
    new = table(("1", "p", "a"))
    keep = ops.classify(old, new, ["id"], delete_missing=False)
    assert len(content(ops.apply_changes(keep))) == 3
    scope = table(("1", "p", "a"), ("9", "p", "a")).select("parent")
    scoped = ops.classify(old, new, ["id"], delete_scope=scope)
    assert content(ops.apply_changes(scoped)) == [("1", "p", "a"), ("3", "q", "C")]
    assert tuple(ops.change_counts(scoped).first()) == (0, 1, 1, 1)


def test_strategies(spark, folder):
    first, second = rows(spark, FIRST, ("1", "A")), rows(spark, SECOND, ("1", "B"), ("2", "C"))
    plans.sync_table(first, folder, ["id"])
    appended = plans.sync_table(second, folder, ["id"], strategy="append")
    assert counts(appended) == (2, 0, 0, 1)
    assert stored(spark, folder) == content(first.union(second))
    plans.sync_table(second, folder, ["id"], strategy="replace")
    assert stored(spark, folder) == content(second)
    with pytest.raises(ValueError):
        plans.sync_table(second, folder, ["id"], strategy="merge")


def test_column_order_of_the_table_stays(spark, folder):
    plans.sync_table(rows(spark, FIRST, ("1", "A")), folder, ["id"])
    swapped = rows(spark, FIRST, ("1", "B")).select("value", "CreatedDate", "id")
    plans.sync_table(swapped, folder, ["id"])
    assert stored(spark, folder) == [("1", "B", FIRST)]


def test_columns_of_either_side_stay(spark, folder):
    plans.sync_table(rows(spark, FIRST, ("1", "A"), ("2", "B")), folder, ["id"])
    source = spark.createDataFrame([("1", "x"), ("3", "y")], "id STRING, note STRING")
    plans.sync_table(source, folder, ["id"], delete_missing=False)
    found = sources.read_snapshot(spark, folder)
    assert found.columns == ["id", "value", "CreatedDate", "note"]
    assert sorted((r.id, r.value, r.note) for r in found.collect()) == [
        ("1", "A", "x"), ("2", "B", None), ("3", None, "y"),
    ]
    with pytest.raises(ValueError, match="note"):
        plans.sync_table(source.withColumn("note", F.lit(1)), folder, ["id"])


@pytest.mark.parametrize("strategy", ["upsert", "append", "replace"])
def test_null_keys_are_set_aside_by_every_strategy(spark, folder, strategy):
    source = rows(spark, FIRST, ("1", "A"), (None, "X"))
    result = plans.sync_table(source, folder, ["id"], strategy=strategy)
    assert stored(spark, folder) == [("1", "A", FIRST)] and result.null_keyed.count() == 1


def test_append_to_buckets_writes_a_file_for_each(spark, folder):
    source = rows(spark, FIRST, *[(str(i), "A") for i in range(200)])
    plans.sync_table(source, folder, ["id"], buckets=4)
    for number, strategy in enumerate(["append", "replace"], 1):
        plans.sync_table(source.repartition(16), folder, ["id"], strategy=strategy)
        files = [f for f in os.listdir(f"{folder}/data/version={number}") if f.endswith(".parquet")]
        assert len(files) == 4


def test_nested_names_in_a_bucketed_table(spark, folder):
    source = spark.sql("SELECT '1' AS id, named_struct('x y', 1, 'z', array(named_struct('a-b', 2))) AS s")
    plans.sync_table(source, folder, ["id"], buckets=2)
    spark.sql(f"DROP TABLE {snapshots._catalog_name(snapshots.data_path(folder, 0))}")
    assert stored(spark, folder) == content(source)


def test_old_versions_are_dropped(spark, folder):
    source = rows(spark, FIRST, ("1", "A"))
    for _ in range(3):
        plans.sync_table(source, folder, ["id"])
    sources.drop_versions(spark, folder, before=99)
    assert os.listdir(f"{folder}/data") == ["version=2"]
    assert stored(spark, folder) == content(source)
    assert plans.sync_table(source, folder, ["id"]).version == 3


def test_version_without_history_is_invisible(spark, folder):
    source = rows(spark, FIRST, ("1", "A"))
    plans.sync_table(source, folder, ["id"])
    snapshots.write_data(rows(spark, FIRST, ("9", "lost")), folder, 1)
    assert snapshots.latest_version(spark, folder) == 0
    result = plans.sync_table(rows(spark, FIRST, ("1", "B")), folder, ["id"])
    assert result.version == 1
    assert stored(spark, folder) == [("1", "B", FIRST)]


def test_history(spark, folder):
    assert sources.history(spark, folder).collect() == []
    assert sources.latest_version(spark, folder) is None
    with pytest.raises(ValueError):
        sources.read_snapshot(spark, folder)
    assert sources.create_if_absent(rows(spark, FIRST, ("1", "A")), folder) == 0
    assert sources.create_if_absent(rows(spark, FIRST, ("2", "B")), folder) == 0
    assert sources.write_snapshot(rows(spark, FIRST, ("2", "B")), folder) == 1
    got = {r.version: r.operation for r in sources.history(spark, folder).collect()}
    assert got == {0: "create", 1: "replace"}
    assert stored(spark, folder, 0) == [("1", "A", FIRST)]
    after, before = (sources.read_snapshot(spark, folder, v) for v in (1, 0))
    assert content(ops.rows_changed(after, before)) == [("2", "B", FIRST)]


def test_partition_by_day(spark, folder):
    source = rows(spark, FIRST, ("1", "A")).union(rows(spark, SECOND, ("2", "B")))
    plans.sync_table(source, folder, ["id"], day_column="CreatedDate")
    days = [d for d in os.listdir(f"{folder}/data/version=0") if d.startswith("_partition_day=")]
    assert sorted(days) == ["_partition_day=2024-01-01", "_partition_day=2024-02-01"]
    assert stored(spark, folder) == content(source)
    result = plans.sync_table(source, folder, ["id"])
    assert counts(result) == (0, 0, 0, 2) and sorted(os.listdir(f"{folder}/data/version=1"))[:2] != []
    days = sources.read_days(spark, folder, date(2024, 1, 15), date(2024, 3, 1))
    assert content(days) == content(source.filter("id = '2'"))
    assert "PartitionFilters: [isnotnull(_partition_day" in days._jdf.queryExecution().executedPlan().toString()


def test_user_column_named_like_a_day(spark, folder):
    source = rows(spark, FIRST, ("1", "A")).withColumn("by_day", F.lit("mine"))
    plans.sync_table(source, folder, ["id"], day_column="CreatedDate")
    assert content(sources.read_snapshot(spark, folder)) == content(source)
    with pytest.raises(ValueError, match="taken"):
        taken = rows(spark, FIRST, ("1", "A")).withColumn(snapshots.DAY, F.lit("mine"))
        plans.sync_table(taken, f"{folder}/other", ["id"], day_column="CreatedDate")


def test_sync_all_and_summaries(spark, folder):
    tables = {"a_df": rows(spark, FIRST, ("1", "A"), ("1", "B")), "b": rows(spark, FIRST, ("2", "B"))}
    keys = {"a_df": ["id"], "b": ["id"]}
    results = plans.sync_all(tables, folder, keys)
    summary = plans.summary(spark, results)
    assert {r.table: (r.version, r.inserted) for r in summary.collect()} == {"a_df": (0, 1), "b": (0, 1)}
    assert tuple(plans.total_summary(summary).first()) == (2, 0, 0, 0)
    assert sorted(os.listdir(folder)) == ["b", "data_quality__adf_a", "table_states"]
    validated = plans.validate_all(tables, keys)
    assert {n: (u.count(), d.count()) for n, (u, d) in validated.items()} == {"a_df": (1, 1), "b": (1, 0)}


def test_profile(spark):
    df = spark.createDataFrame([(7, "north"), (8, "sea"), (9, None)], "k BIGINT, place STRING")
    row = ops.profile(df, "places").first()
    assert (row.label, row.n_rows, row.n_columns, row.text_chars) == ("places", 3, 2, 8)
    assert row.json_bytes == len('{"k":7,"place":"north"}{"k":8,"place":"sea"}{"k":9}')
    assert row.schema == "struct<k:bigint,place:string>"
    assert ops.profile(df.limit(0), "none").first().n_rows == 0


def test_bucketed_table(spark, folder):
    first = rows(spark, FIRST, *[(str(i), "A") for i in range(200)])
    plans.sync_table(first, folder, ["id"], buckets=8)
    second = rows(spark, SECOND, *[(str(i), "A" if i % 2 else "B") for i in range(50, 250)])
    result = plans.sync_table(second, folder, ["id"], run_ts=SECOND)
    assert counts(result) == (50, 75, 50, 75)
    assert len(stored(spark, folder)) == 200 and stored(spark, folder, 0) == content(first)
    files = [f for f in os.listdir(f"{folder}/data/version=1") if f.endswith(".parquet")]
    assert len(files) == 8
    # A session that does not know the table finds the buckets from the history.
    name = snapshots._catalog_name(snapshots.data_path(folder, 1))
    spark.sql(f"DROP TABLE {name}")
    again = plans.sync_table(second, folder, ["id"])
    assert (again.version, counts(again)) == (2, (0, 0, 0, 200))
    with pytest.raises(ValueError):
        plans.sync_table(second, folder, ["id"], day_column="CreatedDate")


def test_bucketed_target_is_not_shuffled(spark, folder):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        source = rows(spark, FIRST, *[(str(i), "A") for i in range(100)])
        plans.sync_table(source, folder, ["id"], buckets=8)
        target = sources.read_snapshot(spark, folder)
        changes = ops.classify(target, ops.dedupe_by_key(source, ["id"]), ["id"])
        plan = changes._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") == 1 and plan.count("Exchange") == 1
    assert "Bucketed: true" in plan or "SelectedBucketsCount" in plan


def test_a_repeated_key_leaves_the_table_as_it_was(spark, folder):
    plans.sync_table(rows(spark, FIRST, ("1", "A")), folder, ["id"])
    for source in (
        rows(spark, SECOND, ("1", "B"), ("2", "C"), ("2", "D")),
        rows(spark, SECOND, ("1", "B"), (None, "C"), (None, "D")),
    ):
        for strategy in ("upsert", "replace"):
            with pytest.raises(ops.DuplicateKeysError):
                plans.sync_table(source, folder, ["id"], strategy=strategy)
            assert stored(spark, folder) == [("1", "A", FIRST)]
            assert not os.path.exists(f"{folder}/data/version=1")
    again = plans.sync_table(rows(spark, SECOND, ("1", "B"), (None, "C")), folder, ["id"])
    assert (again.version, counts(again)) == (1, (0, 1, 0, 0))


def test_the_key_gate_runs_the_source_once(spark, folder):
    plans.sync_table(rows(spark, FIRST, ("0", "A")), folder, ["id"])
    seen = spark.sparkContext.accumulator(0)

    def noted(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    source = rows(spark, SECOND, *[(str(i), "B") for i in range(50)])
    result = plans.sync_table(source.mapInPandas(noted, source.schema), folder, ["id"])
    assert counts(result) == (49, 1, 0, 0) and seen.value == 50


def test_a_hot_key_is_reduced_before_it_moves(spark):
    source = rows(spark, FIRST, *[("1", str(i)) for i in range(1000)], ("2", "x"))
    counted = ops.keys_counted(source, ["id"])
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_first" in plan
    assert sorted((r.id, r._key_rows) for r in counted.collect()) == [("1", 1000), ("2", 1)]
    with pytest.raises(ValueError, match="taken"):
        ops.keys_counted(counted, ["id"])
