"""The physical plans and the behaviour under skew that large inputs depend on."""

import json

import pytest
from pyspark.sql import functions as F

from flowatlas import operators as ops, plans, sources


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def documents(spark, folder):
    acts = [{"name": "a", "type": "ExecutePipeline"}, {"name": "b", "type": "ExecutePipeline", "dependsOn": [{"activity": "a"}]}]
    text = json.dumps({"name": "p", "properties": {"activities": acts}})
    spark.range(100).select(
        F.concat(F.lit("/d/"), F.col("id").cast("string")).alias("path"), F.lit(text).alias("value")
    ).write.parquet(folder)
    return spark.read.parquet(folder)


@pytest.fixture
def keyed(spark, folder):
    spark.range(1000).select(
        F.col("id").alias("k"), (F.col("id") % 7).alias("v"), F.lit("x").alias("s")
    ).write.parquet(f"{folder}/keyed")
    return spark.read.parquet(f"{folder}/keyed")


def test_extraction_has_no_shuffle_and_parses_once(documents):
    parsed = sources.parse_documents(documents)
    tables = plans.extraction.tables_of(parsed)
    for df in [*tables.values(), ops.activity_lookup(parsed), ops.counts_per_document(parsed)]:
        assert "Exchange" not in plan_of(df)
        # the document, and the array around it that shows where it ends
        assert optimized(df).count("from_json") == 2


def test_staged_readers_prune_columns_and_rows(spark, documents, folder):
    parsed = sources.stage(spark, sources.parse_documents(documents, inline_bytes=10**6), f"{folder}-staged")
    plan = plan_of(ops.pipelines(parsed))
    assert "PushedFilters: [IsNull(failure)]" in plan
    assert "ReadSchema: struct<PipelineName:string,failure:string>" in plan
    large = plan_of(ops.dependencies(parsed))
    assert "IsNotNull(large_key)" in large
    assert "from_json" not in large


def test_path_filter_reaches_the_scan(spark, documents):
    plan = plan_of(sources.filter_paths(documents, "7"))
    assert "StringEndsWith(path,7.json)" in plan


def test_dedupe_limits_before_the_shuffle(keyed):
    plan = plan_of(ops.dedupe_by_key(keyed, ["v"]))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.count("Exchange") == 1


def test_sync_is_one_join_with_one_exchange_per_side(spark, keyed, folder):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target = spark.read.parquet(f"{folder}/keyed")
        source = ops.dedupe_by_key(keyed.withColumn("v", F.col("v") + 1), ["k"])
        changes = ops.classify(target, source, ["k"]).observe("seen", F.count("*").alias("n"))
        plan = plan_of(ops.apply_changes(changes))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") == 1
    assert plan.count("Exchange") == 2
    assert "PushedFilters: [IsNull(k)]" in plan


def test_first_sync_has_no_join(keyed):
    plan = plan_of(ops.classify(keyed.limit(0), keyed, ["k"]))
    assert "Join" not in plan and "Exchange" not in plan


def test_counts_use_anti_joins(keyed):
    other = keyed.filter("k > 10")
    for df in (ops.count_inserted(keyed, other, ["k"]), ops.count_deleted(keyed, other, ["k"])):
        assert "LeftAnti" in optimized(df) and "LeftOuter" not in optimized(df)


def test_first_document_filters_the_scan(documents):
    plan = plan_of(plans.first_document(documents))
    assert "EqualTo(path,/d/0)" in plan and "Exchange SinglePartition" not in plan


def test_set_difference_is_one_shuffle(keyed):
    plan = plan_of(ops.rows_changed(keyed, keyed.filter("k > 10")))
    assert plan.count("Exchange") == 1 and "Join" not in plan
    assert "partial_min" in plan


def test_hot_key_with_a_third_of_all_rows(spark, folder):
    """One workflow name in a third of the documents, one duplicate key in a third of rows."""
    name = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("w"), F.col("id")))
    acts = F.array(
        F.struct(F.lit("a").alias("name"), F.lit("DatabricksNotebook").alias("type")),
        F.struct(F.concat(F.lit("b"), F.col("id") % 5).alias("name"), F.lit("DatabricksNotebook").alias("type")),
    )
    texts = spark.range(3000).select(
        F.col("id").cast("string").alias("path"),
        F.to_json(F.struct(name.alias("name"), F.struct(acts.alias("activities")).alias("properties"))).alias("value"),
    )
    tables, _ = plans.extract_all(spark, texts, staging=f"{folder}/staged")
    results = plans.sync_all(tables, f"{folder}/tables")
    assert {n: r.counts["inserted"] for n, r in results.items()} == {
        "pipelines_df": 2001,
        "activities_df": 2000 * 2 + 6,
        "dependencies_df": 0,
    }
    hot = results["pipelines_df"].duplicates.collect()
    assert [r.duplicate_count for r in hot] == [1000]
