"""One query per operator, each over whole given tables."""

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import fixtures
from checks.fixtures import LATER_TS, RUN_TS, table
from flowatlas import functions as fx, operators as ops, plans, sources
from flowatlas.schemas import PIPELINES, TABLE_IDS, TABLE_KEYS, TABLE_SCHEMAS, conform
from flowatlas.session import shared_folder
from flowatlas.streaming import ingest_arrivals, rejected_arrivals, remove_vanished

Query = Callable[[SparkSession, str], DataFrame]

KEY = ["o_orderkey"]
LINE_KEY = ["l_orderkey", "l_linenumber"]
GLOB = "*/[!f]?/[0-9]*[02468].json"
# Codec of landed documents and the pattern of their files: one file for each writing task.
LANDED = ("gzip", "*.json.gz")


def _parsed(spark: SparkSession, sf: str, **options) -> DataFrame:
    documents = fixtures.workflow_documents(table(spark, sf, "orders"))
    return sources.parse_documents(documents, **options)


def _untimed(df: DataFrame) -> DataFrame:
    return df.drop("CreatedDate")


def _states(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf, "orders")
    return fixtures.old_orders(orders), fixtures.new_orders(orders)


def _changes(spark: SparkSession, sf: str, **options) -> DataFrame:
    old, new = _states(spark, sf)
    return ops.classify(old, new, KEY, **options)


def _shown(rows: DataFrame, name: str) -> DataFrame:
    """The table's name and all columns of each row as one string."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in sorted(rows.columns)]
    return rows.select(F.lit(name).alias("table"), F.concat_ws("|", *shown).alias("columns"))


def _synced(spark: SparkSession, sf: str, name: str, **options) -> str:
    """A table with the old state as version 0 and a sync with the new one as version 1."""
    old, new = _states(spark, sf)
    path = shared_folder(spark, name)
    sources.create_if_absent(old, path, run_ts=RUN_TS)
    plans.sync_table(new, path, KEY, run_ts=LATER_TS, **options)
    return path


# --- sources -----------------------------------------------------------------------


def list_json_files(spark: SparkSession, sf: str) -> DataFrame:
    listing = table(spark, sf, "pages").select(
        F.regexp_replace("url", r"\.html$", ".json").alias("path"),
        F.col("url").endswith("/").alias("is_folder"),
    )
    return listing.filter(sources.json_files(F.col("path"), F.col("is_folder"))).select("path")


def list_landed_files(spark: SparkSession, sf: str) -> DataFrame:
    """A JSON file of orders for each month, beside files of another kind."""
    folder = shared_folder(spark, "listing")
    orders = table(spark, sf, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    orders.repartition("month").write.partitionBy("month").json(folder)
    orders.repartition("month").write.mode("append").partitionBy("month").parquet(folder)
    files = sources.list_files(spark, folder).filter("size > 0 AND modificationTime IS NOT NULL")
    parent = F.element_at(F.split("path", "/"), -2).alias("folder")
    return files.groupBy(parent).agg(F.count("*").alias("n_files"))


def filter_files_glob(spark: SparkSession, sf: str) -> DataFrame:
    paths = table(spark, sf, "pages").select(F.concat("url", F.lit(".json")).alias("path"))
    return sources.filter_paths(paths, GLOB)


def read_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Land every order's document, read the files whole, and count what they hold."""
    folder = shared_folder(spark, "landing")
    structs = fixtures.workflow_structs(table(spark, sf, "orders"))
    landed = structs.select("name", "properties")
    landed.write.option("maxRecordsPerFile", 1000).json(folder)
    files = sources.read_documents(spark, folder)
    lines = files.select("path", F.explode(F.split(F.rtrim("value"), "\n")).alias("value"))
    parsed = sources.valid_documents(sources.parse_documents(lines))
    return parsed.groupBy("PipelineName").agg(
        F.count("*").alias("n_documents"),
        F.sum(F.size("nodes")).alias("n_nodes"),
        F.sum(F.size("links")).alias("n_links"),
    )


def document_profile(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents")
    profiled = sources.document_profile(documents, "text")
    return profiled.select("doc_id", "n_characters", "snippet")


def parse_event_props(spark: SparkSession, sf: str) -> DataFrame:
    props = fx.parse_json("props", "k INT")
    return table(spark, sf, "events").select(
        "event_id",
        props["k"].alias("k"),
        fx.json_path("props", "$.k").alias("k_text"),
        fx.json_path("props", "$.missing").alias("absent"),
    )


# --- extract -----------------------------------------------------------------------


def extract_workflows(spark: SparkSession, sf: str) -> DataFrame:
    return _untimed(ops.pipelines(_parsed(spark, sf)))


def extract_activities(spark: SparkSession, sf: str) -> DataFrame:
    return _untimed(ops.activities(_parsed(spark, sf)))


def extract_dependencies(spark: SparkSession, sf: str) -> DataFrame:
    return _untimed(ops.dependencies(_parsed(spark, sf)))


def extract_dependencies_staged(spark: SparkSession, sf: str) -> DataFrame:
    """The same edges from staged documents, the larger half of them by the join."""
    documents = fixtures.workflow_documents(table(spark, sf, "orders"))
    tables, _ = plans.extract_all(
        spark, documents, staging=shared_folder(spark, "staged"), inline_bytes=1400
    )
    return _untimed(tables["dependencies_df"])


def call_closure(spark: SparkSession, sf: str) -> DataFrame:
    """Every workflow that one calls, directly or through others, and the fewest calls to it."""
    documents = fixtures.call_documents(table(spark, sf, "orders"))
    folder = shared_folder(spark, "calls")
    tables, _ = plans.extract_all(spark, documents, staging=f"{folder}/staging")
    calls = ops.direct_calls(tables["pipelines_df"], tables["activities_df"])
    return ops.call_closure(spark, calls, folder)


def activity_targets(spark: SparkSession, sf: str) -> DataFrame:
    targets = ["ActivityTargetId", "ActivityTargetName", "ActivityTargetType"]
    return ops.activities(_parsed(spark, sf)).select("ActivityId", "ActivityType", *targets)


def activity_lookup_last_wins(spark: SparkSession, sf: str) -> DataFrame:
    return ops.activity_lookup(_parsed(spark, sf)).drop("PipelineName")


def conformed_schemas(spark: SparkSession, sf: str) -> DataFrame:
    """Integer levels and missing dates cast to the declared types, in declared order."""
    parsed = sources.valid_documents(_parsed(spark, sf))
    loose = parsed.select(
        F.lit(1).alias("PipelineLevel"),
        F.lit(None).alias("CreatedDate"),
        F.lit("Pipeline").alias("PipelineType"),
        "PipelineName",
        fx.surrogate_key("PipelineName", F.lit("Pipeline")).alias("PipelineId"),
    )
    rows = conform(loose, PIPELINES)
    return rows.select(
        "*",
        F.typeof("PipelineLevel").alias("level_type"),
        F.typeof("CreatedDate").alias("date_type"),
    ).drop("CreatedDate")


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Edges by the types of their ends."""
    documents = fixtures.workflow_documents(table(spark, sf, "orders"))
    tables, _ = plans.extract_all(spark, documents)
    edges = tables["dependencies_df"]
    return edges.groupBy("DependencySourceType", "DependencyTargetType").agg(
        F.count("*").alias("n_edges")
    )


def filter_include_types(spark: SparkSession, sf: str) -> DataFrame:
    return _untimed(ops.activities(_parsed(spark, sf, include_types=["ExecutePipeline"])))


def filter_all_types(spark: SparkSession, sf: str) -> DataFrame:
    return _untimed(ops.activities(_parsed(spark, sf, include_types=None)))


def quarantine_documents(spark: SparkSession, sf: str) -> DataFrame:
    documents = fixtures.damaged_documents(table(spark, sf, "orders"))
    return sources.rejected_documents(sources.parse_documents(documents))


def extract_counts(spark: SparkSession, sf: str) -> DataFrame:
    return ops.counts(_parsed(spark, sf))


def extract_counts_per_document(spark: SparkSession, sf: str) -> DataFrame:
    return ops.counts_per_document(_parsed(spark, sf))


def single_document_run(spark: SparkSession, sf: str) -> DataFrame:
    """The first document that has activities."""
    documents = fixtures.workflow_documents(table(spark, sf, "orders"))
    filled = documents.filter(F.col("value").contains('"activities":[{'))
    tables, _ = plans.extract_all(spark, plans.first_document(filled))
    return _untimed(tables["activities_df"])


def single_document_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that the very first document gives; it has no activities in the given tables."""
    documents = fixtures.workflow_documents(table(spark, sf, "orders"))
    tables, _ = plans.extract_all(spark, plans.first_document(documents))
    found = [df.agg(F.count("*").alias("n")).select(F.lit(n).alias("table"), "n") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, found)


# --- checks on keys ----------------------------------------------------------------


def key_collisions(spark: SparkSession, sf: str) -> DataFrame:
    """Keys made from names with the separator in them: true duplicates and collisions."""
    joined = F.col("o_orderstatus") == "F"
    customer, priority = F.col("o_custkey").cast("string"), F.col("o_orderpriority")
    named = table(spark, sf, "orders").select(
        F.when(joined, F.concat_ws("|", customer, priority)).otherwise(customer).alias("name"),
        F.when(joined, F.lit("flow")).otherwise(F.concat_ws("|", priority, F.lit("flow"))).alias("type"),
    )
    keyed = named.withColumn("key", fx.surrogate_key("name", "type"))
    return ops.key_collisions(keyed, ["key"], ["name", "type"])


def duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    return ops.duplicate_keys(table(spark, sf, "lineitem"), LINE_KEY)


def dedupe_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return ops.dedupe_by_key(table(spark, sf, "lineitem"), LINE_KEY)


def validate_unique(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with unique text, marked where the report names their text.

    The key is a digest of the whole text, so the shuffles do not carry the texts.
    """
    documents = table(spark, sf, "documents").withColumn("text_key", fx.surrogate_key("text"))
    documents = documents.select("text_key", "doc_id", "lang", "source", "n_chars")
    unique, report = ops.check_unique(documents, ["text_key"], on_duplicate="dedupe")
    return unique.join(report, "text_key", "left")


def validate_all_tables(spark: SparkSession, sf: str) -> DataFrame:
    parsed = sources.stage(spark, _parsed(spark, sf), shared_folder(spark, "validated"))
    tables = plans.extraction.tables_of(parsed, RUN_TS)
    parts = []
    for name, (unique, report) in plans.validate_all(tables).items():
        label = F.lit(name).alias("table")
        parts.append(unique.agg(F.count("*").alias("n")).select(label, F.lit("unique").alias("part"), "n"))
        parts.append(report.agg(F.count("*").alias("n")).select(label, F.lit("duplicate").alias("part"), "n"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def dataframe_profile(spark: SparkSession, sf: str) -> DataFrame:
    parts = [
        ops.profile(table(spark, sf, name), name) for name in ("conversations", "orders", "documents")
    ]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rows.drop("json_bytes", "schema")


def dataframe_profile_bytes(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").drop("c_acctbal")
    return ops.profile(rows, "customer").select("label", "json_bytes")


# --- comparison and sync -----------------------------------------------------------


def count_inserted(spark: SparkSession, sf: str) -> DataFrame:
    return ops.count_inserted(*_states(spark, sf), KEY)


def count_deleted(spark: SparkSession, sf: str) -> DataFrame:
    return ops.count_deleted(*_states(spark, sf), KEY)


def rows_changed_except(spark: SparkSession, sf: str) -> DataFrame:
    return ops.rows_changed(*_states(spark, sf))


def change_flags(spark: SparkSession, sf: str) -> DataFrame:
    old, new = _states(spark, sf)
    values = [c for c in old.columns if c not in KEY]
    both = old.select(*KEY, F.struct(*values).alias("old")).join(
        new.select(*KEY, F.struct(*values).alias("new")), KEY
    )
    return both.select(
        *KEY,
        ops.changed("old", "new", values).alias("changed"),
        ops.changed("old", "new", values, null_safe=False).alias("changed_plain"),
    )


def change_counts(spark: SparkSession, sf: str) -> DataFrame:
    return ops.change_counts(_changes(spark, sf))


def changed_rows_preview(spark: SparkSession, sf: str) -> DataFrame:
    changed = _changes(spark, sf).filter(F.col(ops.ACTION).isin("insert", "update"))
    return changed.orderBy(*KEY).limit(10)


def merge_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return ops.apply_changes(_changes(spark, sf, delete_missing=False))


def merge_upsert_fewer_columns(spark: SparkSession, sf: str) -> DataFrame:
    """A source without a stored column leaves that column as it is."""
    old, new = _states(spark, sf)
    changes = ops.classify(old, new.drop("o_totalprice"), KEY, delete_missing=False)
    return ops.apply_changes(changes)


def merge_upsert_new_columns(spark: SparkSession, sf: str) -> DataFrame:
    """A column new in the source is NULL in rows the source does not have."""
    old, new = _states(spark, sf)
    noted = new.withColumn("o_note", F.concat("o_orderstatus", F.lit("!")))
    return ops.apply_changes(ops.classify(old, noted, KEY, delete_missing=False))


def upsert_after_append(spark: SparkSession, sf: str) -> DataFrame:
    """Keys that an append stored twice are one row again after the next upsert."""
    path = _synced(spark, sf, "append-upsert", strategy="append")
    _, new = _states(spark, sf)
    plans.sync_table(new, path, KEY, delete_missing=False, run_ts=LATER_TS)
    return sources.read_snapshot(spark, path)


def merge_append_null_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Rows with a NULL key are set aside by an append as by every strategy."""
    old, new = _states(spark, sf)
    path = shared_folder(spark, "append-null")
    sources.create_if_absent(old, path, run_ts=RUN_TS)
    key = F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey"))
    plans.sync_table(new.withColumn("o_orderkey", key), path, KEY, strategy="append")
    return sources.read_snapshot(spark, path)


def delete_missing(spark: SparkSession, sf: str) -> DataFrame:
    return ops.keep_present(*_states(spark, sf), KEY)


def merge_append(spark: SparkSession, sf: str) -> DataFrame:
    return sources.read_snapshot(spark, _synced(spark, sf, "append", strategy="append"))


def merge_replace(spark: SparkSession, sf: str) -> DataFrame:
    return sources.read_snapshot(spark, _synced(spark, sf, "replace", strategy="replace"))


def sync_table(spark: SparkSession, sf: str) -> DataFrame:
    return sources.read_snapshot(spark, _synced(spark, sf, "sync"))


def sync_table_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """A table bucketed by its key, synced twice: the stored side is not shuffled."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = shared_folder(spark, "bucketed")
    for state, run_ts in zip(_states(spark, sf), (RUN_TS, LATER_TS)):
        plans.sync_table(state, path, KEY, run_ts=run_ts, buckets=buckets)
    return sources.read_snapshot(spark, path)


def bucketed_without_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """A bucketed table that the catalog has forgotten is declared again from its files."""
    path = shared_folder(spark, "forgotten")
    _, new = _states(spark, sf)
    plans.sync_table(new, path, KEY, run_ts=RUN_TS, buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    sources.forget_version(spark, path, 0)
    return sources.read_snapshot(spark, path)


def _sync_workflows(spark: SparkSession, sf: str, name: str) -> dict[str, plans.SyncResult]:
    """Sync the tables of the old documents, then of the new; results of the second."""
    orders = table(spark, sf, "orders")
    root = shared_folder(spark, name)
    runs = [(fixtures.old_workflows(orders), RUN_TS), (fixtures.new_workflows(orders), LATER_TS)]
    for number, (documents, run_ts) in enumerate(runs):
        staging = f"{root}/staging/run={number}"
        tables, _ = plans.extract_all(spark, documents, run_ts=run_ts, staging=staging, by_workflow=True)
        results = plans.sync_all(tables, root, run_ts=run_ts)
    return results


def sync_all_tables(spark: SparkSession, sf: str) -> DataFrame:
    return plans.summary(spark, _sync_workflows(spark, sf, "sync-all"))


def sync_total_summary(spark: SparkSession, sf: str) -> DataFrame:
    return plans.total_summary(plans.summary(spark, _sync_workflows(spark, sf, "sync-total")))


def synced_activities(spark: SparkSession, sf: str) -> DataFrame:
    """Stored activities after two syncs, with the run that first saw each."""
    results = _sync_workflows(spark, sf, "sync-activities")
    rows = sources.read_snapshot(spark, results["activities_df"].path)
    return rows.withColumn("CreatedDate", F.date_format("CreatedDate", "yyyy-MM-dd"))


def synced_together(spark: SparkSession, sf: str) -> DataFrame:
    """All rows that readers see when a sync stopped after one table, and when it was completed."""
    orders = table(spark, sf, "orders")
    root = shared_folder(spark, "together")
    seen = []
    states = [(fixtures.old_workflows(orders), RUN_TS), (fixtures.new_workflows(orders), LATER_TS)]
    for number, (documents, run_ts) in enumerate(states):
        staging = f"{root}/staging/run={number}"
        tables, _ = plans.extract_all(spark, documents, run_ts=run_ts, staging=staging, by_workflow=True)
        if number:
            name = "activities_df"
            path = f"{root}/{plans.dataset_name(name)}"
            options = {"on_duplicate": "dedupe", "run_ts": run_ts, "id_columns": TABLE_IDS[name]}
            plans.sync_table(tables[name], path, TABLE_KEYS[name], **options)
            seen.append(("stopped", sources.read_group(spark, root)))
        plans.sync_all(tables, root, run_ts=run_ts)
    seen.append(("completed", sources.read_group(spark, root)))
    rows = [
        _shown(_untimed(df), name).select(F.lit(state).alias("state"), "*")
        for state, tables in seen
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


# --- stored tables -----------------------------------------------------------------


def create_if_not_exists(spark: SparkSession, sf: str) -> DataFrame:
    """The second create finds the table and leaves it as it is."""
    old, new = _states(spark, sf)
    path = shared_folder(spark, "create")
    sources.create_if_absent(old, path)
    sources.create_if_absent(new, path)
    return sources.read_snapshot(spark, path)


def snapshot_as_of(spark: SparkSession, sf: str) -> DataFrame:
    return sources.read_snapshot(spark, _synced(spark, sf, "as-of"), version=0)


def snapshot_history(spark: SparkSession, sf: str) -> DataFrame:
    rows = sources.history(spark, _synced(spark, sf, "history"))
    counts = ["inserted", "updated", "deleted", "unchanged"]
    run_day = F.date_format("run_ts", "yyyy-MM-dd").alias("run_day")
    return rows.select("version", "operation", run_day, *counts)


def version_diff(spark: SparkSession, sf: str) -> DataFrame:
    path = _synced(spark, sf, "diff")
    after, before = (sources.read_snapshot(spark, path, version) for version in (1, 0))
    return ops.rows_changed(after, before)


def partitioned_write(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_folder(spark, "by-day")
    sources.write_snapshot(table(spark, sf, "events"), path, day_column="ts")
    rows = sources.read_snapshot(spark, path, keep_day=True)
    days = F.col(sources.snapshots.DAY).cast("string")
    return rows.withColumn("by_day", days).drop(sources.snapshots.DAY)


def partitioned_sync(spark: SparkSession, sf: str) -> DataFrame:
    """A table by day, synced twice; the second sync keeps the layout, and some days are read."""
    events = table(spark, sf, "events")
    path = shared_folder(spark, "sync-by-day")
    early = events.withColumn("value", F.col("value") + 1)
    plans.sync_table(early, path, ["event_id"], run_ts=RUN_TS, day_column="ts")
    plans.sync_table(events, path, ["event_id"], run_ts=LATER_TS)
    return sources.read_days(spark, path, date(2024, 1, 5), date(2024, 1, 20))


def snapshot_history_untimed(spark: SparkSession, sf: str) -> DataFrame:
    """Versions written without a run time have the time they were written."""
    old, new = _states(spark, sf)
    path = shared_folder(spark, "untimed")
    sources.create_if_absent(old, path)
    plans.sync_table(new, path, KEY)
    timed = F.col("run_ts").isNotNull().alias("timed")
    return sources.history(spark, path).select("version", "operation", timed)


def json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """The three tables as JSON files, read back: every column of every row."""
    folder = shared_folder(spark, "json")
    parsed = sources.stage(spark, _parsed(spark, sf), f"{folder}/staging")
    plans.write_json_tables(plans.extraction.tables_of(parsed, RUN_TS), folder, LANDED[0])
    found = []
    for name, schema in TABLE_SCHEMAS.items():
        rows = _untimed(spark.read.schema(schema).json(f"{folder}/{name}"))
        found.append(_shown(rows, name))
    return reduce(DataFrame.unionByName, found)


def views_query(spark: SparkSession, sf: str) -> DataFrame:
    """Calls between workflows, by SQL over the views.

    Both sides are counted by name before they meet: names repeat across documents.
    """
    parsed = _parsed(spark, sf)
    plans.create_views(plans.extraction.tables_of(parsed, RUN_TS))
    return spark.sql(
        """
        WITH calls AS (
            SELECT ActivityTargetName AS name, count(*) AS n_calls
            FROM view_activities_df WHERE ActivityTargetType = 'Pipeline'
            GROUP BY ActivityTargetName),
        definitions AS (
            SELECT PipelineName AS name, count(*) AS n_documents
            FROM view_pipelines_df GROUP BY PipelineName)
        SELECT name, n_calls, n_documents FROM calls JOIN definitions USING (name)
        """
    )


def _ingested(
    spark: SparkSession, sf: str, name: str, max_files: int | None = None, streams: int = 1
) -> DataFrame:
    """Two arrivals of files, two runs of a stream or of one each; a stored table afterwards."""
    root = shared_folder(spark, "ingest")
    runs = zip(fixtures.arrivals(table(spark, sf, "orders")), (RUN_TS, LATER_TS))
    for number, (documents, run_ts) in enumerate(runs):
        stream = number % streams
        codec, pattern = LANDED
        landing = f"{root}/landing={stream}/arrival={number}"
        if max_files:
            # three files for bounded batches; they stay plain, so that many tasks share the file of a batch
            pattern = "*.json"
            fixtures.land_in_files(spark, documents, f"{root}/waiting={number}", landing, 3)
        else:
            documents.write.option("compression", codec).json(landing)
        ingest_arrivals(
            spark,
            f"{root}/landing={stream}",
            f"{root}/tables",
            f"{root}/checkpoint={stream}",
            per_line=True,
            run_ts=run_ts,
            max_files=max_files,
            pattern=pattern,
        )
    return _untimed(sources.read_snapshot(spark, f"{root}/tables/{plans.dataset_name(name)}"))


def incremental_ingest(spark: SparkSession, sf: str) -> DataFrame:
    return _ingested(spark, sf, "activities_df")


def incremental_ingest_bounded(spark: SparkSession, sf: str) -> DataFrame:
    """The same with one file in a batch."""
    return _ingested(spark, sf, "activities_df", max_files=1)


def incremental_edges(spark: SparkSession, sf: str) -> DataFrame:
    return _ingested(spark, sf, "dependencies_df")


def incremental_pipelines(spark: SparkSession, sf: str) -> DataFrame:
    return _ingested(spark, sf, "pipelines_df")


def incremental_two_streams(spark: SparkSession, sf: str) -> DataFrame:
    """Each arrival by a stream of its own, both beginning with batch 0."""
    return _ingested(spark, sf, "activities_df", streams=2)


def incremental_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Damaged documents as lines of landed files: how many failed for which reason."""
    root = shared_folder(spark, "damaged")
    codec, pattern = LANDED
    damaged = fixtures.damaged_documents(table(spark, sf, "orders")).select("value")
    damaged.write.option("compression", codec).text(f"{root}/waiting")
    fixtures.land(spark, f"{root}/waiting", f"{root}/landing")
    options = {"per_line": True, "run_ts": RUN_TS, "pattern": pattern}
    ingest_arrivals(spark, f"{root}/landing", f"{root}/tables", f"{root}/checkpoint", **options)
    rejected = rejected_arrivals(spark, f"{root}/tables").filter("digest IS NOT NULL AND path LIKE '%/landing/%'")
    return rejected.groupBy("failure").agg(F.count("*").alias("n"))


def incremental_late_files(spark: SparkSession, sf: str) -> DataFrame:
    """The newer state arrives first, then files of the older one, with older times."""
    root = shared_folder(spark, "late")
    old, new = fixtures.arrivals(table(spark, sf, "orders"))
    codec, pattern = LANDED
    options = {"checkpoint": f"{root}/checkpoint", "per_line": True, "pattern": pattern}
    old.write.option("compression", codec).json(f"{root}/waiting")
    new.write.option("compression", codec).json(f"{root}/landing/new")
    ingest_arrivals(spark, f"{root}/landing", f"{root}/tables", run_ts=RUN_TS, **options)
    fixtures.land(spark, f"{root}/waiting", f"{root}/landing/old")
    ingest_arrivals(spark, f"{root}/landing", f"{root}/tables", run_ts=LATER_TS, **options)
    return _untimed(sources.read_snapshot(spark, f"{root}/tables/{plans.dataset_name('activities_df')}"))


def version_diff_columns(spark: SparkSession, sf: str) -> DataFrame:
    """What the second arrival changed in the stored activities, and in which columns."""
    root = shared_folder(spark, "columns")
    codec, pattern = LANDED
    options = {"per_line": True, "run_ts": RUN_TS, "slices": 8, "pattern": pattern}
    for number, documents in enumerate(fixtures.arrivals(table(spark, sf, "orders"))):
        documents.write.option("compression", codec).json(f"{root}/landing/arrival={number}")
        ingest_arrivals(spark, f"{root}/landing", f"{root}/tables", f"{root}/checkpoint", **options)
    path = f"{root}/tables/{plans.dataset_name('activities_df')}"
    before, after = sources.read_apart(spark, path, 0, 1)
    changes = ops.column_changes(before, after, TABLE_KEYS["activities_df"])
    return changes.withColumn("changed_columns", F.array_join("changed_columns", ","))


def incremental_removed_files(spark: SparkSession, sf: str) -> DataFrame:
    """Both states arrive, then the files of the newer go: the older documents count again."""
    root = shared_folder(spark, "removed")
    old, new = fixtures.arrivals(table(spark, sf, "orders"))
    codec, pattern = LANDED
    options = {"per_line": True, "pattern": pattern}
    old.write.option("compression", codec).json(f"{root}/landing/old")
    new.write.option("compression", codec).json(f"{root}/landing/new")
    ingest_arrivals(spark, f"{root}/landing", f"{root}/tables", f"{root}/checkpoint", run_ts=RUN_TS, **options)
    sources.snapshots.delete_folder(spark, f"{root}/landing/new")
    remove_vanished(spark, f"{root}/landing", f"{root}/tables", run_ts=LATER_TS, **options)
    return _untimed(sources.read_snapshot(spark, f"{root}/tables/{plans.dataset_name('activities_df')}"))


# --- scalar functions --------------------------------------------------------------


def surrogate_key(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "").otherwise(F.col("o_orderstatus"))
    key = fx.surrogate_key(status, "o_orderpriority", F.col("o_orderkey"))
    return orders.select("o_orderkey", key.alias("surrogate_key"))


def uuid_ids(spark: SparkSession, sf: str) -> DataFrame:
    ids = table(spark, sf, "events").select(fx.random_id().alias("id"))
    return ids.agg(
        F.count("*").alias("n_rows"),
        F.countDistinct("id").alias("n_ids"),
        F.min(F.length("id")).cast("bigint").alias("shortest"),
        F.max(F.length("id")).cast("bigint").alias("longest"),
        F.count(F.when(F.substring("id", 15, 1) == "4", 1)).alias("n_version_4"),
    )


def path_last_part(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select(
        "page_id",
        fx.last_path_part("url").alias("last_part"),
        fx.last_path_part(F.regexp_replace("url", r"^.*/$", "")).alias("or_nothing"),
    )


def pretty_json(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    text = fx.pretty_json(F.struct("event_id", "event_type", F.struct("user_id").alias("user")))
    return events.select("event_id", text.alias("text")).select(
        "event_id",
        F.size(F.split("text", "\n")).cast("bigint").alias("n_lines"),
        fx.json_path("text", "$.event_type").alias("event_type"),
        fx.json_path("text", "$.user.user_id").cast("bigint").alias("user_id"),
    )


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        list_json_files,
        list_landed_files,
        filter_files_glob,
        read_documents,
        document_profile,
        parse_event_props,
        extract_workflows,
        extract_activities,
        extract_dependencies,
        extract_dependencies_staged,
        call_closure,
        activity_targets,
        activity_lookup_last_wins,
        conformed_schemas,
        flagship,
        filter_include_types,
        filter_all_types,
        quarantine_documents,
        extract_counts,
        extract_counts_per_document,
        single_document_run,
        single_document_counts,
        duplicate_keys,
        key_collisions,
        dedupe_by_key,
        validate_unique,
        validate_all_tables,
        dataframe_profile,
        dataframe_profile_bytes,
        count_inserted,
        count_deleted,
        rows_changed_except,
        change_flags,
        change_counts,
        changed_rows_preview,
        merge_upsert,
        merge_upsert_fewer_columns,
        merge_upsert_new_columns,
        upsert_after_append,
        delete_missing,
        merge_append,
        merge_append_null_keys,
        merge_replace,
        sync_table,
        sync_table_bucketed,
        bucketed_without_catalog,
        sync_all_tables,
        sync_total_summary,
        synced_activities,
        synced_together,
        create_if_not_exists,
        snapshot_as_of,
        snapshot_history,
        version_diff,
        snapshot_history_untimed,
        partitioned_write,
        partitioned_sync,
        json_roundtrip,
        views_query,
        incremental_ingest,
        incremental_ingest_bounded,
        incremental_edges,
        incremental_pipelines,
        incremental_two_streams,
        incremental_quarantine,
        incremental_late_files,
        incremental_removed_files,
        version_diff_columns,
        surrogate_key,
        uuid_ids,
        path_last_part,
        pretty_json,
    )
}
