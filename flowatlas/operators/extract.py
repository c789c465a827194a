"""Parsed documents to pipelines, activities and dependency edges.

Every step is a projection or an explode: no shuffle at all. When the documents were
parsed with a size limit, those above it carry no links; theirs come from a join on
`(large_key, name)`, and the two results are united.
"""

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from flowatlas.functions import last_path_part, let, surrogate_key
from flowatlas.schemas import ACTIVITIES, DEPENDENCIES, PIPELINES, conform
from flowatlas.sources.parse import CALL, DATAFLOW, LINK_BITS, NOTEBOOK, valid_documents

# Type and level names in the output tables.
PIPELINE_TYPE, PIPELINE_LEVEL, ACTIVITY_LEVEL = "Pipeline", "1", "2"
TARGET_TYPES = {CALL: "Pipeline", DATAFLOW: "DataFlow"}

_SINK_MASK = (1 << LINK_BITS) - 1


def _stamp(run_ts: datetime | None) -> Column:
    """One value for the whole run when given, else the query's start time."""
    return F.current_timestamp() if run_ts is None else F.lit(run_ts)


def workflow_id() -> Column:
    """The id of a parsed document's workflow."""
    return surrogate_key("PipelineName", F.lit(PIPELINE_TYPE))


def _target_name(kind: Column, target: Column) -> Column:
    """A notebook is named by the last part of its path, others by the reference."""
    return F.when(kind == NOTEBOOK, last_path_part(target)).otherwise(F.nullif(target, F.lit("")))


def _target_id(kind: Column, name: Column, parent: Column) -> Column:
    # A notebook activity has an id even without a path.
    known = kind.isin(list(TARGET_TYPES)) & name.isNotNull()
    return F.when((kind == NOTEBOOK) | known, surrogate_key(name, kind, parent))


def _target_type(kind: Column, name: Column) -> Column:
    out = F.when(kind == NOTEBOOK, F.lit(NOTEBOOK))
    for activity_type, target_type in TARGET_TYPES.items():
        out = out.when((kind == activity_type) & name.isNotNull(), F.lit(target_type))
    return out


def derived_ids(parent: Column) -> dict[str, dict[str, Column]]:
    """Ids of each table's rows as the other columns and the workflow's id `parent` tell them.

    The target of an edge is not told: its name is not among the columns.
    """
    kind, target = F.col("ActivityType"), F.col("ActivityTargetName")
    return {
        "pipelines_df": {"PipelineId": parent},
        "activities_df": {
            "ActivityId": surrogate_key("ActivityName", kind, parent),
            "ParentId": parent,
            "ActivityTargetId": _target_id(kind, target, parent),
        },
        "dependencies_df": {
            "DependencySourceId": surrogate_key("DependencyName", "DependencySourceType", parent)
        },
    }


def pipelines(parsed: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """One row per valid document."""
    rows = valid_documents(parsed).select(
        workflow_id().alias("PipelineId"),
        "PipelineName",
        F.lit(PIPELINE_TYPE).alias("PipelineType"),
        F.lit(PIPELINE_LEVEL).alias("PipelineLevel"),
        _stamp(run_ts).alias("CreatedDate"),
    )
    return conform(rows, PIPELINES)


def activities(parsed: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """One row per included activity, repeated names included."""
    rows = valid_documents(parsed).select(workflow_id().alias("ParentId"), F.inline("nodes"))
    rows = rows.withColumn("target", _target_name(F.col("type"), F.col("target")))
    kind, target, parent = F.col("type"), F.col("target"), F.col("ParentId")
    rows = rows.select(
        surrogate_key("name", kind, parent).alias("ActivityId"),
        parent,
        F.col("name").alias("ActivityName"),
        kind.alias("ActivityType"),
        F.lit(ACTIVITY_LEVEL).alias("ActivityLevel"),
        _target_id(kind, target, parent).alias("ActivityTargetId"),
        target.alias("ActivityTargetName"),
        _target_type(kind, target).alias("ActivityTargetType"),
        _stamp(run_ts).alias("CreatedDate"),
    )
    return conform(rows, ACTIVITIES)


def _has_large(parsed: DataFrame) -> bool:
    return "large_key" in parsed.columns


def _small(parsed: DataFrame) -> DataFrame:
    documents = valid_documents(parsed)
    return documents.filter("large_key IS NULL") if _has_large(parsed) else documents


def _large(parsed: DataFrame) -> DataFrame:
    return valid_documents(parsed).filter("large_key IS NOT NULL")


def _large_lookup(parsed: DataFrame) -> DataFrame:
    """`(large_key, name) -> node` for oversize documents; the last node of a name wins."""
    nodes = _large(parsed).select("large_key", F.posexplode("nodes").alias("pos", "node"))
    # Nodes are stored last one first, so the smallest position wins.
    by_name = nodes.groupBy("large_key", F.col("node.name").alias("name"))
    return by_name.agg(F.min_by("node", "pos").alias("node"))


def _large_documents(parsed: DataFrame) -> DataFrame:
    """Oversize documents once each; copies within one file share a key."""
    return (
        _large(parsed)
        .groupBy("large_key", "path", "PipelineName")
        .agg(F.count("*").alias("copies"))
    )


def _repeat(rows: DataFrame) -> DataFrame:
    return rows.withColumn("copy", F.explode(F.expr("sequence(1L, copies)"))).drop("copy", "copies")


def activity_lookup(parsed: DataFrame) -> DataFrame:
    """Name to node within each document: the node that dependencies refer to."""
    winners = let(
        F.transform("nodes", lambda n: n["name"]),
        lambda names: F.filter(
            "nodes", lambda n, i: F.array_position(names, n["name"]) == i + 1
        ),
    )
    rows = _small(parsed).select("path", "PipelineName", F.inline(winners)).drop("wrong_type")
    if not _has_large(parsed):
        return rows
    large = _large_lookup(parsed).join(_large_documents(parsed), "large_key")
    large = large.select("path", "PipelineName", "node.*", "copies").drop("wrong_type")
    return rows.unionByName(_repeat(large))


def _inline_edges(parsed: DataFrame) -> DataFrame:
    # single numbers are exploded, so that the ends are looked up in compiled code
    links = _small(parsed).select(workflow_id().alias("ParentId"), "nodes", F.explode("links").alias("link"))
    return links.select(
        "ParentId",
        F.element_at("nodes", F.shiftright("link", LINK_BITS).cast("int")).alias("source"),
        F.element_at("nodes", F.col("link").bitwiseAND(F.lit(_SINK_MASK)).cast("int")).alias("sink"),
    )


def _large_edges(parsed: DataFrame) -> DataFrame:
    """Edges of oversize documents, `copies` telling how often each occurs."""
    lookup = _large_lookup(parsed)
    steps = _large(parsed).select("large_key", F.inline("steps"))
    wanted = steps.select("large_key", "name", F.explode("depends").alias("depends_on")).distinct()
    sinks = lookup.withColumnRenamed("node", "sink")
    sources = lookup.select(
        "large_key", F.col("name").alias("depends_on"), F.col("node").alias("source")
    )
    edges = wanted.join(sinks, ["large_key", "name"]).join(sources, ["large_key", "depends_on"])
    return edges.join(_large_documents(parsed), "large_key")


def _edges(parsed: DataFrame) -> DataFrame:
    rows = _inline_edges(parsed)
    if not _has_large(parsed):
        return rows
    large = _large_edges(parsed).select(workflow_id().alias("ParentId"), "source", "sink", "copies")
    return rows.unionByName(_repeat(large))


def dependencies(
    parsed: DataFrame, run_ts: datetime | None = None, workflow: str | None = None
) -> DataFrame:
    """One row per distinct edge of a document, between included activities.

    `workflow` names a further column with the id of the document's pipeline.
    """
    source, sink, parent = F.col("source"), F.col("sink"), F.col("ParentId")
    rows = _edges(parsed).select(
        surrogate_key(source["name"], source["type"], parent).alias("DependencySourceId"),
        surrogate_key(sink["name"], sink["type"], parent).alias("DependencyTargetId"),
        source["name"].alias("DependencyName"),
        source["type"].alias("DependencySourceType"),
        sink["type"].alias("DependencyTargetType"),
        _target_name(source["type"], source["target"]).alias("DependencySourceName"),
        _target_name(sink["type"], sink["target"]).alias("DependencyTargetName"),
        _stamp(run_ts).alias("CreatedDate"),
        parent,
    )
    edges = conform(rows.drop("ParentId"), DEPENDENCIES)
    if workflow is None:
        return edges
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in DEPENDENCIES], parent.alias(workflow))


def counts_per_document(parsed: DataFrame) -> DataFrame:
    """`(path, metric, key, n)` per document: itself, activities by type, edges."""
    kinds = F.transform("nodes", lambda n: n["type"])

    def metric(name: str, key: Column, n: Column) -> Column:
        return F.struct(
            F.lit(name).alias("metric"), key.cast("string").alias("key"), n.alias("n")
        )

    by_type = F.transform(
        F.array_distinct(kinds),
        lambda kind: metric(
            "activities",
            kind,
            F.size(F.filter(kinds, lambda other: other == kind)).cast("bigint"),
        ),
    )
    one = F.array(metric("pipelines", F.lit(None), F.lit(1).cast("bigint")))
    linked = F.when(
        F.col("links").isNotNull(),
        F.array(metric("dependencies", F.lit(None), F.size("links").cast("bigint"))),
    ).otherwise(F.array().cast("array<struct<metric:string,key:string,n:bigint>>"))
    rows = valid_documents(parsed).select("path", F.inline(F.concat(one, by_type, linked)))
    return rows.unionByName(_large_link_counts(parsed)) if _has_large(parsed) else rows


def _large_link_counts(parsed: DataFrame) -> DataFrame:
    edges = _large_edges(parsed).groupBy("large_key").agg(F.count("*").alias("n"))
    per_key = _large_documents(parsed).join(edges, "large_key", "left")
    rows = per_key.select(
        "path",
        F.lit("dependencies").alias("metric"),
        F.lit(None).cast("string").alias("key"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
        "copies",
    )
    return _repeat(rows)


def counts(parsed: DataFrame) -> DataFrame:
    """`(metric, key, n)` over all documents."""
    return counts_per_document(parsed).groupBy("metric", "key").agg(F.sum("n").alias("n"))
