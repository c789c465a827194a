"""Which workflows call which, to any depth."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowatlas.sources.parse import stage


def direct_calls(pipelines: DataFrame, activities: DataFrame) -> DataFrame:
    """`(caller, callee)` names, each pair once: activities whose target is a workflow.

    A callee need not be stored itself; a caller is, as its name comes from the pipelines.
    """
    targets = activities.filter("ActivityTargetType = 'Pipeline' AND ActivityTargetName IS NOT NULL")
    pairs = targets.select("ParentId", F.col("ActivityTargetName").alias("callee")).distinct()
    named = pipelines.filter("PipelineName IS NOT NULL")
    names = named.select(F.col("PipelineId").alias("ParentId"), F.col("PipelineName").alias("caller")).distinct()
    return pairs.join(names, "ParentId").select("caller", "callee").distinct()


def call_closure(spark: SparkSession, calls: DataFrame, folder: str) -> DataFrame:
    """`(caller, callee, depth)`: every workflow that one reaches, with the fewest calls needed.

    Each round follows one more call from the pairs that the round before found, and keeps
    those that no round has found yet. It ends with a round that finds none, so circles settle
    and a member of one reaches itself. Rounds are as many as the longest of the shortest
    ways. Each is written below `folder`, a shared one: no round is worked out twice and a
    lost executor costs a part of one round. Pairs are keyed by both names when they are
    compared; a name that most ways lead through is a skewed join of found pairs and its few
    calls, which adaptive execution splits. Rows with a NULL name lead nowhere; repeated ones
    count once; no calls give no rows.
    """
    known = calls.filter("caller IS NOT NULL AND callee IS NOT NULL").select("caller", "callee").distinct()
    steps = stage(spark, known, f"{folder}/calls")
    following = steps.select(F.col("caller").alias("callee"), F.col("callee").alias("next"))
    found = f"{folder}/found"
    fresh = stage(spark, steps.withColumn("depth", F.lit(1)), f"{found}/round=1")
    schema = fresh.schema
    depth = 1
    while not fresh.isEmpty():
        depth += 1
        seen = spark.read.schema(schema).parquet(*[f"{found}/round={k}" for k in range(1, depth)])
        reached = fresh.join(following, "callee").select("caller", F.col("next").alias("callee")).distinct()
        unseen = reached.join(seen, ["caller", "callee"], "left_anti").withColumn("depth", F.lit(depth))
        fresh = stage(spark, unseen, f"{found}/round={depth}")
    return spark.read.schema(schema).parquet(*[f"{found}/round={k}" for k in range(1, depth + 1)])
