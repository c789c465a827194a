"""Schemas of the three output tables, their keys, and of the documents read."""

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType


def _table(*names: str) -> StructType:
    fields = [StructField(name, StringType()) for name in names]
    return StructType(fields + [StructField("CreatedDate", TimestampType())])


# Table names, column names and column order of the output tables.
PIPELINES = _table("PipelineId", "PipelineName", "PipelineType", "PipelineLevel")
ACTIVITIES = _table(
    "ActivityId",
    "ParentId",
    "ActivityName",
    "ActivityType",
    "ActivityLevel",
    "ActivityTargetId",
    "ActivityTargetName",
    "ActivityTargetType",
)
DEPENDENCIES = _table(
    "DependencySourceId",
    "DependencyTargetId",
    "DependencyName",
    "DependencySourceType",
    "DependencyTargetType",
    "DependencySourceName",
    "DependencyTargetName",
)
TABLE_SCHEMAS = {
    "pipelines_df": PIPELINES,
    "activities_df": ACTIVITIES,
    "dependencies_df": DEPENDENCIES,
}
TABLE_KEYS = {
    "pipelines_df": ["PipelineId"],
    "activities_df": ["ActivityId", "ParentId"],
    "dependencies_df": ["DependencySourceId", "DependencyTargetId"],
}

# Columns beside the keys that hold SHA-256 ids, or NULL.
TABLE_IDS = {"activities_df": ["ActivityTargetId"]}

# Activity types extracted when the caller names none.
DEFAULT_TYPES = ["DatabricksNotebook", "ExecutePipeline", "ExecuteDataFlow"]

# Only the paths that are used. `typeProperties` stays raw text: its shape depends on
# the activity type, and a field nobody reads must not make a document invalid.
DOCUMENT = (
    "name STRING, properties STRUCT<activities: ARRAY<STRUCT<"
    "name: STRING, type: STRING, typeProperties: STRING, "
    "dependsOn: ARRAY<STRUCT<activity: STRING>>>>>"
)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select and cast the columns of `schema`, in its order."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
