import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from flowatlas import operators as ops, plans, sources
from flowatlas.plans import sliced
from flowatlas.plans.naming import dataset_name
from flowatlas.session import shuffles_removed
from flowatlas.sources import snapshots
from flowatlas.streaming import arrivals, ingest_arrivals, listing, rejected_arrivals, remove_vanished, sync_batch

RUN_TS = datetime(2024, 1, 1)


def workflow(name, *activities):
    acts = [
        {
            "name": a,
            "type": "DatabricksNotebook",
            "typeProperties": {"notebookPath": f"/x/{a}"},
            "dependsOn": [{"activity": d} for d in depends],
        }
        for a, depends in activities
    ]
    return {"name": name, "properties": {"activities": acts}}


def land(folder, name, *documents, indent=2):
    os.makedirs(folder, exist_ok=True)
    for i, document in enumerate(documents):
        with open(f"{folder}/{name}-{i}.json", "w") as out:
            out.write(document if isinstance(document, str) else json.dumps(document, indent=indent))


def table(spark, root, name):
    return sources.read_snapshot(spark, f"{root}/tables/{dataset_name(name)}")


def run(spark, root, **options):
    checkpoint = options.pop("checkpoint", f"{root}/checkpoint")
    return ingest_arrivals(spark, f"{root}/landing", f"{root}/tables", checkpoint, run_ts=RUN_TS, **options)


def stream_id(root):
    with open(f"{root}/checkpoint/metadata") as file:
        return json.load(file)["id"]


def versions(spark, root):
    return {
        name: snapshots.latest_version(spark, f"{root}/tables/{dataset_name(name)}")
        for name in ("pipelines_df", "activities_df", "dependencies_df")
    }


def state(spark, root):
    names = {r.PipelineId: r.PipelineName for r in table(spark, root, "pipelines_df").collect()}
    acts = {(names[r.ParentId], r.ActivityName) for r in table(spark, root, "activities_df").collect()}
    edges = {(r.DependencySourceName, r.DependencyTargetName) for r in table(spark, root, "dependencies_df").collect()}
    return set(names.values()), acts, edges


@pytest.fixture
def ingested(spark, folder):
    """Workflows p and q arrived, then a new p, a new r and a broken file."""
    land(
        f"{folder}/landing",
        "first",
        workflow("p", ("a", []), ("b", ["a"]), ("c", ["b"])),
        workflow("q", ("x", []), ("y", ["x"])),
    )
    run(spark, folder)
    land(f"{folder}/landing", "second", workflow("p", ("a", []), ("c", ["a"])), workflow("r", ("z", [])), "{")
    run(spark, folder)
    return folder


def test_arrivals_replace_only_their_own_workflows(spark, ingested):
    assert state(spark, ingested) == (
        {"p", "q", "r"},
        {("p", "a"), ("p", "c"), ("q", "x"), ("q", "y"), ("r", "z")},
        {("a", "c"), ("x", "y")},
    )
    bad = rejected_arrivals(spark, f"{ingested}/tables").collect()
    assert [(os.path.basename(r.path), r.batch, len(r.digest)) for r in bad] == [("second-2.json", 1, 64)]
    assert not [f for _, _, files in os.walk(f"{ingested}/tables/staging") for f in files]


def test_run_without_arrivals_writes_nothing(spark, ingested):
    before = versions(spark, ingested)
    run(spark, ingested)
    assert versions(spark, ingested) == before


def test_replayed_batch_is_skipped(spark, ingested):
    before, content = versions(spark, ingested), state(spark, ingested)
    documents = spark.createDataFrame([("/d", json.dumps(workflow("p")))], "path STRING, value STRING")
    sync_batch(documents, 1, f"{ingested}/tables", stream_id=stream_id(ingested))
    assert (versions(spark, ingested), state(spark, ingested)) == (before, content)


def test_batch_interrupted_between_tables_is_completed(spark, ingested):
    """The batch reached pipelines and activities, then failed; the replay adds the edges."""
    root = f"{ingested}/tables"
    documents = spark.createDataFrame(
        [("/d", json.dumps(workflow("p", ("a", []), ("n", ["a"]))))], "path STRING, value STRING"
    )
    parsed = sources.parse_documents(documents)
    tables, _ = plans.extract_all(spark, documents, run_ts=RUN_TS)
    for name in ("pipelines_df", "activities_df"):
        scope = tables["pipelines_df"].selectExpr(
            "PipelineId" if name == "pipelines_df" else "PipelineId AS ParentId"
        )
        plans.sync_table(
            tables[name],
            f"{root}/{dataset_name(name)}",
            plans.sync.TABLE_KEYS[name],
            delete_scope=scope,
            batch_id=2,
        )
    assert parsed.count() == 1
    before = versions(spark, ingested)
    sync_batch(documents, 2, root, run_ts=RUN_TS)
    after = versions(spark, ingested)
    assert after["activities_df"] == before["activities_df"]
    assert after["dependencies_df"] == before["dependencies_df"] + 1
    assert state(spark, ingested)[2] == {("a", "n"), ("x", "y")}


def test_lines_and_bounded_batches(spark, folder):
    for i in range(3):
        text = "\n".join(json.dumps(workflow(f"w{i}{j}", ("a", []))) for j in range(4))
        land(f"{folder}/landing", f"file{i}", text)
    run(spark, folder, per_line=True, max_files=1)
    assert versions(spark, folder) == {n: 2 for n in versions(spark, folder)}
    assert table(spark, folder, "activities_df").count() == 12


@pytest.mark.parametrize("max_files", [None, 1])
def test_newest_document_of_a_workflow_counts(spark, folder, max_files):
    landing = f"{folder}/landing"
    land(landing, "late-name-old-time", workflow("p", ("a", []), ("b", ["a"])))
    land(landing, "early-name-new-time", workflow("p", ("a", [])))
    os.utime(f"{landing}/late-name-old-time-0.json", (1_700_000_000, 1_700_000_000))
    os.utime(f"{landing}/early-name-new-time-0.json", (1_700_000_100, 1_700_000_100))
    run(spark, folder, max_files=max_files)
    assert state(spark, folder) == ({"p"}, {("p", "a")}, set())


def test_second_stream_skips_nothing(spark, folder):
    land(f"{folder}/landing", "one", workflow("p", ("a", [])))
    first = run(spark, folder)
    land(f"{folder}/landing", "two", workflow("q", ("x", [])))
    second = run(spark, folder, checkpoint=f"{folder}/other")
    assert state(spark, folder)[0] == {"p", "q"}
    names = {"pipelines_df", "activities_df", "dependencies_df"}
    assert {r.table for r in first.collect()} == {r.table for r in second.collect()} == names
    inserted = {r.table: r.inserted for r in second.collect()}
    assert inserted["pipelines_df"] == 1 and all(r.run_ts for r in second.collect())


def slice_files(root, name):
    folder = f"{root}/tables/{dataset_name(name)}/data"
    return {os.path.join(d, f) for d, _, files in os.walk(folder) for f in files if f.endswith(".parquet")}


def test_untouched_slices_keep_their_files(spark, folder):
    land(f"{folder}/landing", "first", *[workflow(f"w{k}", ("a", []), ("b", ["a"])) for k in range(40)])
    run(spark, folder, slices=16)
    before = slice_files(folder, "activities_df")
    land(f"{folder}/landing", "second", workflow("w7", ("a", [])))
    summary = {r.table: r for r in run(spark, folder).collect() if r.batch_id == 1}
    new = slice_files(folder, "activities_df") - before
    assert len(before) == 16 and len(new) == 1 and before <= slice_files(folder, "activities_df")
    path = f"{folder}/tables/{dataset_name('activities_df')}"
    read = sources.read_snapshot(spark, path).inputFiles()
    assert len(read) == 16 and sum("version=1" in f for f in read) == 1
    assert table(spark, folder, "activities_df").count() == 79
    assert (summary["activities_df"].deleted, summary["dependencies_df"].deleted) == (1, 1)
    sources.drop_versions(spark, path, before=1)
    assert table(spark, folder, "activities_df").count() == 79


def test_stored_rows_move_once_and_meet_no_join(spark, folder):
    land(f"{folder}/landing", "first", *[workflow(f"w{k}", ("a", []), ("b", ["a"])) for k in range(40)])
    run(spark, folder)
    path = f"{folder}/tables/{dataset_name('activities_df')}"
    stored = snapshots.read_slices(spark, path, snapshots.latest_entry(spark, path))
    workflows = stored.select(snapshots.WORKFLOW).limit(3)
    changes = sliced.compared(stored, stored.limit(0), workflows, ["ActivityId", "ParentId"], 64)
    plan = changes._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    plan = sliced.compared(stored, stored, stored, ["ActivityId", "ParentId"], 64)._jdf.queryExecution().executedPlan().toString()
    # one for the union of both sides, one for the distinct workflows of the batch
    assert plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan


def test_rows_of_both_sides_are_sorted_once(spark):
    rows = spark.createDataFrame([("w", "k", 1)], f"{snapshots.WORKFLOW} STRING, id STRING, v INT")
    changes = sliced.compared(rows, rows, rows, ["id"], 4, parts=[2, 1, 1, 3])
    assert [r[ops.ACTION] for r in changes.collect()] == ["same"]
    plan = changes._jdf.queryExecution().executedPlan()
    assert plan.toString().partition("Initial Plan")[0].count(" Sort [") == 1


def sync_slices(spark, path, source, **options):
    count = sliced.slice_count(spark, path) or 1
    workflows = source.select(snapshots.WORKFLOW).distinct()
    touched = sliced.touched_slices(workflows, count)
    sliced.sync_workflows(source, path, ["id"], workflows, touched, count, lambda rows: rows, **options)
    return set(touched)


def test_slices_grow_by_splits_and_leave_the_others(spark, folder):
    path, workflow_id = f"{folder}/grown", (F.col("id") % 40).cast("string")
    rows = spark.range(400).select("id", F.lit(1).alias("value"), workflow_id.alias(snapshots.WORKFLOW))
    sync_slices(spark, path, rows)
    for count in range(2, 9):
        before = snapshots.latest_entry(spark, path)
        one = rows.filter(F.col(snapshots.WORKFLOW) == "7").withColumn("value", F.lit(count))
        touched = sync_slices(spark, path, one, slice_bytes=1)
        now = snapshots.latest_entry(spark, path)
        written = {k for k, version in now["slices"].items() if version == now["version"]}
        assert now["slice_count"] == count and len(touched) == 1
        assert written <= touched | {count - 1, sliced.parent_slice(count - 1)} | {sliced.held_in(k, count) for k in touched}
        assert all(now["slices"].get(k) == v for k, v in before["slices"].items() if k not in written | touched | {sliced.parent_slice(count - 1)})
        assert now["slice_bytes"].keys() == now["slices"].keys()
    assert written != set(now["slices"])
    for k in now["slices"]:
        stored = snapshots.read_slices(spark, path, now, [k])
        assert stored.filter(sliced.slice_of(F.col(snapshots.WORKFLOW), 8) != k).isEmpty()
    values = sources.read_snapshot(spark, path).groupBy("value").count().collect()
    assert {r["value"]: r["count"] for r in values} == {1: 390, 8: 10}
    older, newer = sources.read_apart(spark, path, 6, 7)
    assert 10 <= newer.count() < 400
    changes = ops.column_changes(older, newer, ["id"]).collect()
    assert len(changes) == 10 and all(r.change_action == "update" and r.changed_columns == ["value"] for r in changes)


def test_no_task_holds_a_whole_slice_or_workflow(spark):
    stored = spark.range(1000).select("id", F.lit("hot").alias(snapshots.WORKFLOW), F.lit(1).alias("value"))
    changes = sliced.compared(stored, stored.limit(0), stored, ["id"], 1, parts=[5], tasks=16)
    plan = changes._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan and "Join" not in plan
    rows = changes.groupBy(F.spark_partition_id().alias("task"), "change_action").count().collect()
    assert len(rows) > 1 and max(r["count"] for r in rows) < 1000 and {r.change_action for r in rows} == {"delete"}
    assert sum(r["count"] for r in rows) == 1000


def test_column_changes(spark):
    before = spark.createDataFrame([(1, "a", None), (2, "b", 1), (3, "c", 1), (None, "d", 1)], "k INT, x STRING, y INT")
    after = spark.createDataFrame([(1, "a", 5, None), (2, "b", 1, None), (4, "c", 1, True)], "k INT, x STRING, y INT, z BOOLEAN")
    found = {r.k: (r.change_action, r.changed_columns) for r in ops.column_changes(before, after, ["k"]).collect()}
    assert found == {1: ("update", ["y"]), 3: ("delete", None), 4: ("insert", None)}


def test_tables_without_slices_are_taken_over(spark, folder):
    docs = [("/d", json.dumps(workflow(n, ("a", []), ("b", ["a"])))) for n in ("p", "q")]
    documents = spark.createDataFrame(docs, "path STRING, value STRING")
    tables, _ = plans.extract_all(spark, documents, run_ts=RUN_TS)
    plans.sync_all(tables, f"{folder}/tables", run_ts=RUN_TS)
    land(f"{folder}/landing", "next", workflow("p", ("a", []), ("c", ["a"])))
    run(spark, folder)
    assert state(spark, folder) == (
        {"p", "q"}, {("p", "a"), ("p", "c"), ("q", "a"), ("q", "b")}, {("a", "b"), ("a", "c")},
    )


def test_workflow_without_activities_loses_its_rows(spark, folder):
    land(f"{folder}/landing", "first", workflow("p", ("a", []), ("b", ["a"])), workflow("q", ("x", [])))
    run(spark, folder)
    land(f"{folder}/landing", "second", workflow("p"))
    run(spark, folder)
    assert state(spark, folder) == ({"p", "q"}, {("q", "x")}, set())


def dated(folder, name, seconds):
    os.utime(f"{folder}/landing/{name}", (1_700_000_000 + seconds,) * 2)


def test_older_document_that_arrives_late_changes_nothing(spark, folder):
    land(f"{folder}/landing", "v2", workflow("p", ("a", [])))
    dated(folder, "v2-0.json", 100)
    run(spark, folder)
    land(f"{folder}/landing", "v1", workflow("p", ("a", []), ("b", ["a"])), workflow("q", ("x", [])))
    dated(folder, "v1-0.json", 0)
    dated(folder, "v1-1.json", 0)
    run(spark, folder)
    assert state(spark, folder) == ({"p", "q"}, {("p", "a"), ("q", "x")}, set())


def test_newest_document_counts_across_streams(spark, folder):
    land(f"{folder}/landing", "new", workflow("p", ("n", [])))
    dated(folder, "new-0.json", 100)
    run(spark, folder)
    land(f"{folder}/landing", "old", workflow("p", ("o", [])))
    dated(folder, "old-0.json", 0)
    run(spark, folder, checkpoint=f"{folder}/other", max_files=1)
    assert state(spark, folder)[1] == {("p", "n")}


def vanish(spark, folder, *names):
    for name in names:
        os.unlink(f"{folder}/landing/{name}")
    return {r.table: r.asDict() for r in remove_vanished(spark, f"{folder}/landing", f"{folder}/tables", run_ts=RUN_TS).collect()}


def test_workflows_of_vanished_files_go(spark, ingested):
    counts = vanish(spark, ingested, "first-1.json")
    assert state(spark, ingested) == ({"p", "r"}, {("p", "a"), ("p", "c"), ("r", "z")}, {("a", "c")})
    assert {t: c["deleted"] for t, c in counts.items()} == {"pipelines_df": 1, "activities_df": 2, "dependencies_df": 1}
    assert vanish(spark, ingested) == {}
    run(spark, ingested)
    assert state(spark, ingested)[0] == {"p", "r"}


def test_older_document_counts_again_when_the_newer_goes(spark, folder):
    land(f"{folder}/landing", "old", workflow("p", ("a", []), ("b", ["a"])))
    land(f"{folder}/landing", "new", workflow("p", ("c", [])), workflow("q", ("x", [])))
    for name, at in (("old-0.json", 0), ("new-0.json", 100), ("new-1.json", 100)):
        dated(folder, name, at)
    run(spark, folder, max_files=1)
    assert state(spark, folder)[1] == {("p", "c"), ("q", "x")}
    vanish(spark, folder, "new-0.json")
    assert state(spark, folder) == ({"p", "q"}, {("p", "a"), ("p", "b"), ("q", "x")}, {("a", "b")})
    # the mark went with the file: a document between the two counts again
    land(f"{folder}/landing", "mid", workflow("p", ("m", [])))
    dated(folder, "mid-0.json", 50)
    run(spark, folder)
    assert state(spark, folder)[1] == {("p", "m"), ("q", "x")}


def test_losing_an_older_document_changes_no_table(spark, folder):
    land(f"{folder}/landing", "old", workflow("p", ("a", [])))
    land(f"{folder}/landing", "new", workflow("p", ("c", [])))
    dated(folder, "old-0.json", 0)
    dated(folder, "new-0.json", 100)
    run(spark, folder)
    counts = vanish(spark, folder, "old-0.json")
    assert all(c["inserted"] == c["updated"] == c["deleted"] == 0 for c in counts.values())
    assert vanish(spark, folder) == {} and state(spark, folder)[1] == {("p", "c")}


def test_documents_of_another_landing_folder_stay(spark, folder):
    land(f"{folder}/landing", "one", workflow("p", ("a", [])))
    land(f"{folder}/elsewhere", "two", workflow("q", ("x", [])))
    run(spark, folder)
    ingest_arrivals(spark, f"{folder}/elsewhere", f"{folder}/tables", f"{folder}/other", run_ts=RUN_TS)
    vanish(spark, folder, "one-0.json")
    assert state(spark, folder)[1] == {("q", "x")}


def test_replay_before_the_listing_was_written_decides_as_before(spark, folder):
    """All three tables took the batch, the listing did not; the replay adds only that."""
    land(f"{folder}/landing", "one", workflow("p", ("a", [])))
    run(spark, folder)
    before = versions(spark, folder)
    path = f"{folder}/tables/arrived_documents"
    snapshots.delete_folder(spark, f"{path}/history/version=0")
    documents = sources.read_documents(spark, f"{folder}/landing")
    sync_batch(documents, 0, f"{folder}/tables", run_ts=RUN_TS, stream_id=stream_id(folder))
    assert versions(spark, folder) == before and snapshots.latest_version(spark, path) == 0
    assert state(spark, folder)[1] == {("p", "a")}


def test_takeover_after_append_keeps_one_row_of_each_key(spark, folder):
    docs = [("/d", json.dumps(workflow("p", ("a", []), ("b", ["a"]))))]
    tables, _ = plans.extract_all(spark, spark.createDataFrame(docs, "path STRING, value STRING"), run_ts=RUN_TS)
    for _ in range(2):
        plans.sync_all(tables, f"{folder}/tables", run_ts=RUN_TS, strategy="append")
    orphan = tables["dependencies_df"].withColumns({c: F.lit("gone") for c in ("DependencySourceId", "DependencyTargetId")})
    plans.sync_table(orphan, f"{folder}/tables/{dataset_name('dependencies_df')}", plans.sync.TABLE_KEYS["dependencies_df"], strategy="append")
    land(f"{folder}/landing", "next", workflow("q", ("x", [])))
    run(spark, folder)
    assert sorted(r.ActivityName for r in table(spark, folder, "activities_df").collect()) == ["a", "b", "x"]
    assert table(spark, folder, "dependencies_df").count() == 1
    assert [r.digest for r in rejected_arrivals(spark, f"{folder}/tables").collect()] == ["gone>gone"]


def workflow_files(spark, path, version):
    """In how many files of a version each workflow lies."""
    rows = spark.read.parquet(snapshots.data_path(path, version)).withColumn("file", F.input_file_name())
    files = rows.groupBy(snapshots.WORKFLOW).agg(F.countDistinct("file").alias("n"))
    return {r[snapshots.WORKFLOW]: r.n for r in files.collect()}


def test_a_workflow_lies_in_one_part_unless_its_document_is_large(spark, folder):
    path, keys = f"{folder}/parted", ["id"]
    rows = spark.range(2000).select("id", (F.col("id") % 20).cast("string").alias(snapshots.WORKFLOW), F.lit(1).alias("value"))
    options = {"task_bytes": 1000, "listed_once": True}
    workflows = rows.select(snapshots.WORKFLOW).distinct()

    def sync(source, named, bytes_here, **more):
        sliced.sync_workflows(source, path, keys, named, {0: bytes_here}, 1, lambda r: r, **options, **more)
        entry = snapshots.latest_entry(spark, path)
        return entry["slice_widest"], workflow_files(spark, path, entry["version"])

    widest, files = sync(rows, workflows, 20_000, largest={0: 1000})
    assert widest == {0: 1000} and set(files.values()) == {1}
    # workflow 3 loses all but one row, 4 all of them, 5 comes back unchanged
    some = workflows.filter(F.col(snapshots.WORKFLOW).isin("3", "4", "5"))
    source = rows.filter((F.col(snapshots.WORKFLOW) == "5") | (F.col("id") == 3))
    widest, files = sync(source, some, 3000, largest={0: 900})
    assert widest == {0: 1000} and max(files.values()) <= 2 and "4" not in files
    counts = {r[0]: r["count"] for r in snapshots.read_slices(spark, path, snapshots.latest_entry(spark, path)).groupBy(snapshots.WORKFLOW).count().collect()}
    assert counts == {str(k): 1 if k == 3 else 100 for k in range(20) if k != 4}
    widest, files = sync(source, some, 3000, largest={0: 50_000})
    assert widest == {0: 50_000} and max(files.values()) > 2
    # how large the stored document is stays known
    widest, files = sync(source, some, 3000, largest={0: 10})
    assert widest == {0: 50_000} and max(files.values()) > 2
    assert sources.read_snapshot(spark, path).count() == 1801


def tasks_of(changes):
    """In how many tasks the rows of each workflow are, and how many there are."""
    rows = changes.withColumn("task", F.spark_partition_id())
    return rows.groupBy(snapshots.WORKFLOW).agg(F.countDistinct("task").alias("n"), F.count("*").alias("rows"))


def test_marks_of_the_batch_go_to_one_part_each(spark):
    stored = spark.range(1000).select("id", (F.col("id") % 10).cast("string").alias(snapshots.WORKFLOW))
    workflows = stored.select(snapshots.WORKFLOW).distinct()
    whole = sliced.compared(stored, stored.limit(0), workflows, ["id"], 1, parts=[8], spreads=[1], listed_once=True)
    at = tasks_of(whole)
    assert all((r.n, r.rows) == (1, 100) for r in at.collect())
    assert {r.change_action for r in whole.collect()} == {"delete"}
    spread = sliced.compared(stored, stored.limit(0), workflows, ["id"], 1, parts=[8], tasks=32, spreads=[3], listed_once=True)
    found = tasks_of(spread).collect()
    assert all(r.n <= 3 and r.rows == 100 for r in found) and max(r.n for r in found) > 1
    assert {r.change_action for r in spread.collect()} == {"delete"}


def test_newest_document_is_chosen_in_one_shuffle(spark):
    early, late = datetime(2024, 1, 1), datetime(2024, 1, 2)
    digests = [c * 64 for c in "0af"]
    columns = f"{snapshots.WORKFLOW} STRING, modified TIMESTAMP, path STRING, digest STRING"
    found = spark.createDataFrame(
        [("p", late, "x", digests[0]), ("p", late, "x", digests[2]), ("p", late, "x", digests[1]), ("q", early, "y", digests[0]),
         ("r", early, "z", digests[1]), ("s", None, "y", digests[0]), ("t", early, "z", digests[1])], columns,
    )
    stored = spark.createDataFrame(
        [("q", late, "a", digests[0]), ("r", early, "z", digests[0]), ("s", late, "a", digests[0]), ("t", early, "z", digests[1]),
         ("u", late, "a", digests[0]), ("r", None, "zz", digests[2])], columns,
    )
    first = {tuple(r) for r in listing.newest_arrived(found, None).collect()}
    assert {(r[0], r[3]) for r in first} == {("p", digests[2]), ("q", digests[0]), ("r", digests[1]), ("s", digests[0]), ("t", digests[1])}
    chosen = listing.newest_arrived(found, stored)
    assert {(r[0], r[3]) for r in chosen.collect()} == {("p", digests[2]), ("r", digests[1]), ("s", digests[0])}
    plan = listing.newest_arrived(found, stored)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def test_steps_of_a_batch_remove_their_shuffle_files(spark, folder, monkeypatch):
    land(f"{folder}/landing", "one", workflow("p", ("a", []), ("b", ["a"])), workflow("q", ("a", [])))
    seen = []

    def stage(session, df, path):
        before = set(shuffles(spark))
        staged = sources.stage(session, df.repartition(3), path)
        seen.append((session.conf.get(CLEANUP), set(shuffles(spark)) - before))
        return staged

    monkeypatch.setattr(arrivals, "stage", stage)
    run(spark, folder)
    assert len(seen) == 4 and all(step == ("true", set()) for step in seen)
    os.remove(f"{folder}/landing/one-1.json")
    remove_vanished(spark, f"{folder}/landing", f"{folder}/tables", run_ts=RUN_TS)
    assert len(seen) == 7 and all(step == ("true", set()) for step in seen)
    assert [r.PipelineName for r in table(spark, folder, "pipelines_df").collect()] == ["p"]


def shuffles(spark):
    """Numbers of the shuffles that have files."""
    tops = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    names = [file for top in tops for _, _, files in os.walk(top.getPath()) for file in files]
    return [name.split("_")[1] for name in names if name.startswith("shuffle_")]


def test_the_session_keeps_its_setting(spark, folder):
    before = spark.conf.get(CLEANUP)
    with pytest.raises(ValueError), shuffles_removed(spark):
        assert spark.conf.get(CLEANUP) == "true"
        raise ValueError
    assert spark.conf.get(CLEANUP) == before
