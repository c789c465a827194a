import gzip
import json
import os
from datetime import datetime

from pyspark.sql import functions as F

from checks import fixtures
from flowatlas import functions as fx, plans, sources
from flowatlas.operators import extract
from flowatlas.plans import sliced
from flowatlas.plans.naming import dataset_name
from flowatlas.sources import snapshots
from flowatlas.streaming import arrivals, ingest_arrivals, remove_vanished

RUN_TS = datetime(2024, 1, 1)


def test_packed_text_comes_back(spark):
    digest = "0123456789abcdef" * 4
    texts = [None, "", "a", digest, digest.upper(), digest[:-1], digest[:-1] + "\n", digest + "\n", "é" * 32, "\x00" * 64]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k INT, t STRING")
    through = fx.pack_columns(rows, ["t"]).withColumn("n", F.octet_length("t")).repartition(3, "t")
    found = {r.k: (r.t, r.n) for r in fx.unpack_columns(through, ["t"]).collect()}
    assert [found[k][0] for k in range(len(texts))] == texts
    assert found[3][1] == 33 and found[4][1] == 65 and found[0][1] is None
    assert through.select("t").distinct().count() == len(texts)


def test_packing_needs_no_pattern(spark):
    rows = spark.createDataFrame([("a",)], "t STRING")
    plan = fx.pack_columns(rows, ["t"])._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" not in plan.upper()


def test_ids_that_other_columns_tell_do_not_move(spark):
    made = fx.surrogate_key("name", "kind")
    odd = [("a", "k", "0" * 64), ("b", "k", None), (None, None, ""), ("c", None, "other")]
    rows = spark.createDataFrame(odd, "name STRING, kind STRING, id STRING")
    rows = rows.unionByName(rows.withColumn("id", made))
    derived, texts = {"id": made}, ["name", "kind", "id"]
    moved = fx.pack_columns(rows, texts, derived)
    assert sorted(len(r.id) for r in moved.filter("id IS NOT NULL").collect()) == [0] * 4 + [1, 6, 33]
    back = fx.unpack_columns(moved.repartition(3, "name"), texts, derived)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, rows.collect()))
    null = spark.createDataFrame([("a", None), ("b", "x")], "name STRING, id STRING")
    derived = {"id": F.nullif("name", F.lit("a"))}
    back = fx.unpack_columns(fx.pack_columns(null, null.columns, derived), null.columns, derived)
    assert {tuple(r) for r in back.collect()} == {("a", None), ("b", "x")}


def test_ids_of_extracted_rows_are_told_by_their_columns(spark):
    acts = [
        {"name": "a", "type": "ExecutePipeline", "typeProperties": {"pipeline": {"referenceName": "x"}}},
        {"name": "b", "type": "DatabricksNotebook", "typeProperties": {"notebookPath": "/n/"}, "dependsOn": [{"activity": "a"}]},
        {"name": "c", "type": "ExecuteDataFlow", "dependsOn": [{"activity": "b"}]},
    ]
    value = json.dumps({"name": "p", "properties": {"activities": acts}})
    documents = spark.createDataFrame([("one", value)], "path STRING, value STRING")
    tables = arrivals._with_workflow(sources.parse_documents(documents), RUN_TS)
    found = {}
    for name, derived in extract.derived_ids(F.col(snapshots.WORKFLOW)).items():
        moved = fx.pack_columns(tables[name], fx.text_columns(tables[name]), derived)
        found[name] = [len(r[c]) for r in moved.collect() for c in derived]
    assert found == {"pipelines_df": [0], "activities_df": [0] * 9, "dependencies_df": [0] * 2}


def test_of_repeated_new_rows_the_first_counts_without_a_shuffle_of_its_own(spark):
    rows = [("w", "k", "b"), ("w", "k", None), ("w", "k", "a"), ("w", "l", "z"), ("w", "l", "y")]
    source = spark.createDataFrame(rows, f"{snapshots.WORKFLOW} STRING, id STRING, value STRING")
    stored = source.filter("value = 'z'")
    found = sliced.compared(stored, source, source, ["id"], 4)
    assert {(r.id, r.value, r.change_action) for r in found.collect()} == {("k", None, "insert"), ("l", "y", "update")}


def test_compressed_files_arrive_and_vanish(spark, folder):
    def document(name):
        acts = [{"name": "a", "type": "ExecutePipeline"}, {"name": "b", "type": "ExecutePipeline", "dependsOn": [{"activity": "a"}]}]
        return json.dumps({"name": name, "properties": {"activities": acts}})

    os.makedirs(f"{folder}/landing")
    for name, lines in (("one", ["p", "q", "q"]), ("two", ["r"])):
        with gzip.open(f"{folder}/landing/{name}.json.gz", "wt") as out:
            out.write("\n".join(map(document, lines)))
    with open(f"{folder}/landing/plain.json", "w") as out:
        out.write(document("s"))
    options = {"per_line": True, "run_ts": RUN_TS, "pattern": "*.json.gz"}
    ingest_arrivals(spark, f"{folder}/landing", f"{folder}/tables", f"{folder}/checkpoint", **options)

    def stored(name):
        return sources.read_snapshot(spark, f"{folder}/tables/{dataset_name(name)}")

    assert sorted(r.PipelineName for r in stored("pipelines_df").collect()) == ["p", "q", "r"]
    assert (stored("activities_df").count(), stored("dependencies_df").count()) == (6, 3)
    assert all(".zstd." in f for f in stored("activities_df").inputFiles())
    os.rename(f"{folder}/landing/two.json.gz", f"{folder}/two")
    remove_vanished(spark, f"{folder}/landing", f"{folder}/tables", **options)
    assert sorted(r.PipelineName for r in stored("pipelines_df").collect()) == ["p", "q"]


def test_files_of_bounded_batches_are_few_and_hold_all_documents(spark, folder):
    orders = spark.range(40).selectExpr(
        "id AS o_orderkey", "IF(id = 3, NULL, id % 5) AS o_custkey", "IF(id % 2 = 0, 'F', NULL) AS o_orderstatus",
        "cast(DATE'1996-01-25' + cast(id % 9 AS INT) AS TIMESTAMP_NTZ) AS o_orderdate",
        "IF(id = 7, NULL, '2-HIGH') AS o_orderpriority",
    )
    old, _ = fixtures.arrivals(orders)
    old.write.json(f"{folder}/plain")
    fixtures.land_in_files(spark, old, f"{folder}/waiting", f"{folder}/landing", 3)
    names = os.listdir(f"{folder}/landing")
    assert len([n for n in names if n.endswith(".json")]) == 3
    lines = [sorted(r.value for r in spark.read.text(f"{folder}/{place}").collect()) for place in ("plain", "landing")]
    assert lines[0] == lines[1] and len(lines[0]) == 40


def test_json_tables_compressed(spark, folder):
    rows = spark.createDataFrame([("a", None), ("b", "1")], "k STRING, v STRING")
    plans.write_json_tables({"t": rows}, folder, "gzip")
    plans.write_json_tables({"plain": rows}, folder)
    for name, ending in (("t", ".json.gz"), ("plain", ".json")):
        assert all(f.endswith(ending) for f in os.listdir(f"{folder}/{name}") if f.startswith("part-"))
        back = spark.read.schema(rows.schema).json(f"{folder}/{name}")
        assert sorted(map(tuple, back.collect())) == [("a", None), ("b", "1")]


def test_synced_and_validated_keys_move_packed(spark, folder):
    digest = "0123456789abcdef" * 4
    rows = [(digest, "x", "b"), (digest, "x", None), (digest, None, "c"), ("plain", "x", "d"), ("plain", "x", "a")]
    source = spark.createDataFrame(rows, "k STRING, l STRING, v STRING")
    unique, report = plans.validate_all({"t": source}, {"t": ["k", "l"]})["t"]
    assert {tuple(r) for r in unique.collect()} == {(digest, "x", None), (digest, None, "c"), ("plain", "x", "a")}
    assert {tuple(r) for r in report.collect()} == {(digest, "x", 2), ("plain", "x", 2)}
    assert "unhex" in unique._jdf.queryExecution().optimizedPlan().toString()
    path = f"{folder}/t"
    for run, state in enumerate((source, source.filter("k = 'plain'").withColumn("v", F.lit("new")))):
        result = plans.sync_table(state, path, ["k", "l"], on_duplicate="dedupe", run_ts=RUN_TS)
        stored = {tuple(r) for r in sources.read_snapshot(spark, path).collect()}
        if run == 0:
            assert stored == {(digest, "x", None), ("plain", "x", "a")} and result.counts["inserted"] == 2
            assert {tuple(r) for r in result.null_keyed.collect()} == {(digest, None, "c")}
            assert {tuple(r) for r in result.duplicates.collect()} == {(digest, "x", 2), ("plain", "x", 2)}
    assert stored == {("plain", "x", "new")} and (result.counts["updated"], result.counts["deleted"]) == (1, 1)


def test_documents_of_a_workflow_are_staged_side_by_side(spark, folder):
    acts = [{"name": "a", "type": "DatabricksNotebook", "typeProperties": {"notebookPath": "/x/n"}}]
    text = [json.dumps({"name": f"w{k % 40}", "properties": {"activities": acts}}) for k in range(400)] + ["{", None]
    documents = spark.createDataFrame([(f"/{k}", t) for k, t in enumerate(text)], "path STRING, value STRING").repartition(8)
    found = {}
    for by_workflow in (False, True):
        staging = f"{folder}/{by_workflow}"
        tables, rejected = plans.extract_all(spark, documents, run_ts=RUN_TS, staging=staging, by_workflow=by_workflow)
        found[by_workflow] = {n: sorted(map(str, df.collect())) for n, df in {**tables, "rejected": rejected}.items()}
    assert found[True] == found[False] and len(found[True]["rejected"]) == 2
    staged = spark.read.parquet(f"{folder}/True").withColumn("file", F.input_file_name()).filter("PipelineName IS NOT NULL")
    files = staged.groupBy("PipelineName").agg(F.countDistinct("file").alias("n"), F.count("*").alias("rows"))
    assert {(r.n, r.rows) for r in files.collect()} == {(1, 10)}


def test_ids_beside_the_keys_move_packed(spark, folder):
    low, high = "0a" * 32, "f0" * 32
    rows = [("k", high, "x"), ("k", low, "y"), ("l", high, "z"), ("l", None, "z"), ("m", low, None)]
    source = spark.createDataFrame(rows, "k STRING, target STRING, v STRING")
    for ids in ([], ["target"]):
        path = f"{folder}/t{len(ids)}"
        options = {"on_duplicate": "dedupe", "run_ts": RUN_TS, "id_columns": ids}
        plans.sync_table(source, path, ["k"], **options)
        stored = {tuple(r) for r in sources.read_snapshot(spark, path).collect()}
        assert stored == {("k", low, "y"), ("l", None, "z"), ("m", low, None)}
        result = plans.sync_table(source.filter("k <> 'l'").withColumn("target", F.lit(high)), path, ["k"], **options)
        stored = {tuple(r) for r in sources.read_snapshot(spark, path).collect()}
        assert stored == {("k", high, "x"), ("m", high, None)}
        assert [result.counts[c] for c in ("inserted", "updated", "deleted", "unchanged")] == [0, 2, 1, 0]
