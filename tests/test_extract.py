import hashlib
import json
import os
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from flowatlas import operators as ops, plans, sources
from flowatlas.schemas import ACTIVITIES, DEPENDENCIES, PIPELINES

RUN_TS = datetime(2024, 1, 1)


def key(*parts):
    return hashlib.sha256("|".join(p for p in parts if p).encode()).hexdigest()


def notebook(name, path, *depends):
    return activity(name, "DatabricksNotebook", {"notebookPath": path}, *depends)


def call(name, ref, *depends):
    return activity(name, "ExecutePipeline", {"pipeline": {"referenceName": ref}}, *depends)


def activity(name, kind, properties=None, *depends):
    out = {"name": name, "type": kind, "dependsOn": [{"activity": d} for d in depends]}
    if properties is not None:
        out["typeProperties"] = properties
    return out


def document(name, *activities):
    return {"name": name, "properties": {"activities": list(activities)}}


def frame(spark, *values):
    rows = [
        (f"/d/{i}.json", v if v is None or isinstance(v, str) else json.dumps(v))
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, "path STRING, value STRING")


def parse(spark, *values, **options):
    return sources.parse_documents(frame(spark, *values), **options)


def failures(spark, *values, **options):
    rows = sources.rejected_documents(parse(spark, *values, **options)).collect()
    return {int(r.path.split("/")[-1].split(".")[0]): r.failure for r in rows}


def edges(parsed):
    rows = ops.dependencies(parsed, RUN_TS).collect()
    return sorted((r.DependencyName, r.DependencySourceName, r.DependencyTargetName) for r in rows)


def test_document_without_activities(spark):
    parsed = parse(spark, {"name": "test_pipeline", "properties": {"activities": []}})
    assert ops.pipelines(parsed).count() == 1
    assert ops.activities(parsed).count() == 0
    assert ops.dependencies(parsed).count() == 0


def test_schemas_and_levels(spark):
    parsed = parse(spark, document("p", notebook("n", "/a/b")))
    tables, bad = plans.extract_all(spark, frame(spark, document("p", notebook("n", "/a/b"))))
    for name, schema in [
        ("pipelines_df", PIPELINES),
        ("activities_df", ACTIVITIES),
        ("dependencies_df", DEPENDENCIES),
    ]:
        got = [(f.name, f.dataType) for f in tables[name].schema]
        assert got == [(f.name, f.dataType) for f in schema]
    assert bad.count() == 0
    assert ops.pipelines(parsed, RUN_TS).first() == (
        key("p", "Pipeline"),
        "p",
        "Pipeline",
        "1",
        RUN_TS,
    )
    assert tables["pipelines_df"].first().CreatedDate is not None


def test_targets(spark):
    pid = key("p", "Pipeline")
    parsed = parse(
        spark,
        document(
            "p",
            notebook("n1", "/Shared/x"),
            notebook("n2", ""),
            notebook("n3", "/Shared/"),
            activity("n4", "DatabricksNotebook"),
            call("c1", "other"),
            call("c2", ""),
            activity("c3", "ExecutePipeline", {}),
            activity("f1", "ExecuteDataFlow", {"dataflow": {"referenceName": "flow"}}),
            activity("f2", "ExecuteDataFlow", {"pipeline": {"referenceName": "flow"}}),
            activity("w", "Wait", {"notebookPath": "/x"}),
        ),
        include_types=None,
    )
    got = {
        r.ActivityName: (r.ActivityTargetId, r.ActivityTargetName, r.ActivityTargetType)
        for r in ops.activities(parsed).collect()
    }
    kind = "DatabricksNotebook"
    assert got == {
        "n1": (key("x", kind, pid), "x", kind),
        "n2": (key(kind, pid), None, kind),
        "n3": (key(kind, pid), "", kind),
        "n4": (key(kind, pid), None, kind),
        "c1": (key("other", "ExecutePipeline", pid), "other", "Pipeline"),
        "c2": (None, None, None),
        "c3": (None, None, None),
        "f1": (key("flow", "ExecuteDataFlow", pid), "flow", "DataFlow"),
        "f2": (None, None, None),
        "w": (None, None, None),
    }
    ids = {r.ActivityName: (r.ActivityId, r.ParentId, r.ActivityLevel) for r in ops.activities(parsed).collect()}
    assert ids["w"] == (key("w", "Wait", pid), pid, "2")


def test_type_filter(spark):
    value = document("p", notebook("n", "/x"), call("c", "q"), activity("w", "Wait"))

    def names(**options):
        rows = ops.activities(parse(spark, value, **options)).collect()
        return sorted(r.ActivityName for r in rows)

    assert names() == names(include_types=[]) == ["c", "n"]
    assert names(include_types=["Wait"]) == ["w"]
    assert names(include_types=None) == ["c", "n", "w"]


LINKED = document(
    "p",
    notebook("a", "/first"),
    call("b", "B", "a", "a", "ghost", "w"),
    activity("w", "Wait", None, "b"),
    notebook("a", "/second", "b", "a"),
    activity("b", "Wait", None, "b"),
    activity("x", None, None, "a"),
    activity(None, "DatabricksNotebook", None, "a"),
)


@pytest.mark.parametrize("inline_bytes", [None, 0, 10**6])
def test_edges(spark, inline_bytes):
    """Last of a repeated name wins; excluded activities add edges under a shared name."""
    parsed = parse(spark, LINKED, inline_bytes=inline_bytes)
    # a -> b; b -> a and a -> a from the second a; b -> b from the Wait named b.
    assert edges(parsed) == [
        ("a", "second", "B"),
        ("a", "second", "second"),
        ("b", "B", "B"),
        ("b", "B", "second"),
    ]
    lookup = {r.name: (r.type, r.target) for r in ops.activity_lookup(parsed).collect()}
    assert lookup == {"a": ("DatabricksNotebook", "/second"), "b": ("ExecutePipeline", "B")}


def test_edge_ids(spark):
    pid = key("p", "Pipeline")
    row = ops.dependencies(parse(spark, document("p", notebook("a", "/x"), call("b", "q", "a")))).first()
    assert row.DependencySourceId == key("a", "DatabricksNotebook", pid)
    assert row.DependencyTargetId == key("b", "ExecutePipeline", pid)
    assert (row.DependencySourceType, row.DependencyTargetType) == (
        "DatabricksNotebook",
        "ExecutePipeline",
    )


def test_same_name_in_two_documents_keeps_both(spark):
    parsed = parse(spark, LINKED, LINKED, LINKED)
    assert ops.pipelines(parsed).count() == 3
    assert ops.dependencies(parsed).count() == 12


def _random_document(rng):
    names = [f"n{rng.randrange(6)}" for _ in range(rng.randrange(12))]
    kinds = ["DatabricksNotebook", "ExecutePipeline", "ExecuteDataFlow", "Wait", None]
    acts = []
    for name in names:
        depends = [f"n{rng.randrange(8)}" for _ in range(rng.randrange(4))]
        properties = {"notebookPath": f"/x/{rng.randrange(5)}", "pipeline": {"referenceName": "q"}}
        acts.append(activity(name, rng.choice(kinds), properties, *depends))
    return document(f"p{rng.randrange(5)}", *acts)


def test_join_and_in_row_edges_agree(spark):
    """The two ways to find edges agree, copies within one file included."""
    rng = random.Random(7)
    values = [_random_document(rng) for _ in range(60)]
    values += values[:20]
    documents = frame(spark, *values).withColumn("path", F.lit("/one/file.json"))
    results = []
    for limit in (None, 0, 700):
        parsed = sources.parse_documents(documents, inline_bytes=limit)
        results.append(
            (
                sorted(map(tuple, ops.dependencies(parsed, RUN_TS).collect())),
                sorted(map(str, ops.activity_lookup(parsed).collect())),
                sorted(map(str, ops.counts(parsed).collect())),
                sorted(map(str, ops.counts_per_document(parsed).collect())),
            )
        )
    assert results[0] == results[1] == results[2]
    assert len(results[0][0]) > 100


def test_many_activities_of_one_name(spark):
    """One document with a name that holds most activities, by the join."""
    acts = [notebook("hub", f"/x/{i}") for i in range(3000)]
    acts += [call(f"c{i}", "q", "hub") for i in range(3000)]
    parsed = parse(spark, document("p", *acts), inline_bytes=1000)
    rows = ops.dependencies(parsed)
    assert rows.count() == 3000
    assert [tuple(r) for r in rows.select("DependencySourceName").distinct().collect()] == [("2999",)]


def test_counts(spark):
    parsed = parse(spark, LINKED, document("q", notebook("n", "/x")))
    rows = {(r.metric, r.key): r.n for r in ops.counts(parsed).collect()}
    assert rows == {
        ("pipelines", None): 2,
        ("activities", "DatabricksNotebook"): 3,
        ("activities", "ExecutePipeline"): 1,
        ("dependencies", None): 4,
    }


def test_failures(spark):
    shape = "not a JSON object of the expected shape"
    wrong = "target of the wrong type"
    cases = [
        ("", "blank text"),
        (" \n", "blank text"),
        (None, "blank text"),
        ("[1]", shape),
        ('[{"name": "p"}]', shape),
        ('"text"', shape),
        ("null", shape),
        ('{"name": "p"', shape),
        ("{'name': 'p'}", shape),
        ('{"name": "p", "properties": "x"}', shape),
        ('{"name": "p", "properties": {"activities": {"a": 1}}}', shape),
        ('{"name": "p"} and more', "text after the object"),
        ('{"name": "p"}{"name": "q"}', "text after the object"),
        ('{"name": "p"}, {"name": "q"}', "text after the object"),
        ('{"name": "p"}, "k": {"name": "q"}', "text after the object"),
        ('{"name": "p"}}', "text after the object"),
        ('{"name": "p"}]}', "text after the object"),
        ('{"name": "p", "n": NaN} x', "text after the object"),
        ('{"name": "p", "d": "NaN"} x}', "text after the object"),
        ('{"name": "Infinity"}, {"name": "q"}', "text after the object"),
        ('{"name": "p"},"end of the document":0}', "text after the object"),
        ('{"name": "p"},"0123456789abcdef"]', "text after the object"),
        ("{}", "missing name"),
        ('{"name": ""}', "missing name"),
        ('{"name": null}', "missing name"),
        (document("p", None), "null activity"),
        (notebook_document({"value": "@x", "type": "Expression"}), wrong),
        (notebook_document(["x"]), wrong),
        (notebook_document(5), wrong),
        (notebook_document(True), wrong),
        (document("p", activity("n", "DatabricksNotebook", "text")), wrong),
        (document("p", activity("c", "ExecutePipeline", {"pipeline": "x"})), wrong),
        (document("p", activity("c", "ExecutePipeline", {"pipeline": {"referenceName": {"a": 1}}})), wrong),
        (document("p", activity("f", "ExecuteDataFlow", {"dataflow": ["x"]})), wrong),
        (holes("n", "DatabricksNotebook"), "null dependency"),
    ]
    got = failures(spark, *[value for value, _ in cases])
    assert got == {i: reason for i, (_, reason) in enumerate(cases)}


def notebook_document(path):
    return document("p", notebook("n", path))


def holes(name, kind):
    return document("p", {"name": name, "type": kind, "dependsOn": [None]})


def test_not_failures(spark):
    """Odd but usable documents."""
    valid = [
        '{"name": "p"}\n',
        '\n {"name": "p"} \r\n\t',
        '{"name": "p", "properties": null}',
        '{"name": "p", "note": "}{ x"}',
        '{"name": "p", "n": NaN, "i": -Infinity}\n',
        '{"name": "p", "properties": {"activities": null}}',
        document("p", {"name": "n", "type": "DatabricksNotebook", "dependsOn": None}),
        notebook_document("[parameters('x')]"),
        notebook_document("{x}"),
        notebook_document("5"),
        notebook_document("true"),
        notebook_document(None),
        document("p", activity("w", "Wait", {"pipeline": "x"})),
        document("p", activity("w", "Wait", "text")),
        document("p", activity("c", "ExecutePipeline", {"notebookPath": {"a": 1}})),
        document("p", activity("c", "ExecutePipeline", {"pipeline": None})),
        holes("w", "Wait"),
        '{"name": "old", "name": "p"}',
    ]
    parsed = parse(spark, *valid)
    assert sources.rejected_documents(parsed).collect() == []
    names = {r.PipelineName for r in ops.pipelines(parsed).collect()}
    assert names == {"p"}


def test_text_after_an_object_that_looks_like_the_end_mark(spark):
    whole = ['{"name": "p", "_end_of_text": "x"}', '{"name": "p", "_end_of_text": {"a": [1]}}', '{"_end_of_text": 5, "name": "p"} ']
    more = ['{"name": "p"},{"_end_of_text": "x"}', '{"name": "p"},', '{"name": "p"}]', '{"name": "p"},{"a":[1', '{"name": "p"} null']
    assert failures(spark, *whole) == {}
    assert failures(spark, *more) == dict.fromkeys(range(len(more)), "text after the object")


def test_work_on_each_text_and_edge_is_kept_small(spark):
    """What lies in a text is not copied to find its end, and edges are looked up in compiled code."""
    parsed = parse(spark, LINKED)
    plan = ops.dependencies(parsed, RUN_TS)._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrayType(StringType" not in plan
    assert "explode(links" in plan and "inline(transform(links" not in plan


def test_one_bad_document_does_not_stop_the_rest(spark):
    documents = frame(spark, document("p", notebook("n", "/x")), "{")
    tables, bad = plans.extract_all(spark, documents)
    assert tables["pipelines_df"].count() == 1
    assert [r.path for r in bad.collect()] == ["/d/1.json"]
    with pytest.raises(ValueError, match="/d/1.json"):
        plans.extract_all(spark, documents, on_error="fail")
    with pytest.raises(ValueError):
        plans.extract_all(spark, documents, on_error="ignore")


def test_staged_extract_equals_direct(spark, folder):
    documents = frame(spark, LINKED, document("q", notebook("n", "/x")), "{")
    direct, _ = plans.extract_all(spark, documents, run_ts=RUN_TS)
    staged, bad = plans.extract_all(spark, documents, run_ts=RUN_TS, staging=folder, inline_bytes=400)
    for name in direct:
        assert sorted(map(str, direct[name].collect())) == sorted(map(str, staged[name].collect()))
    assert bad.count() == 1


def _land(folder, **files):
    for path, text in files.items():
        full = os.path.join(folder, path.replace("__", "/"))
        os.makedirs(os.path.dirname(full), exist_ok=True)
        with open(full, "w") as out:
            out.write(text)


def test_listing_and_reading_files(spark, folder):
    _land(
        folder,
        **{
            "a.json": json.dumps(document("a"), indent=2),
            "sub__deeper__b.json": '{"name": "b"}',
            "sub__c.JSON": "{}",
            "sub__notes.txt": "x",
        },
    )
    listing = sources.list_files(spark, folder)
    assert {os.path.basename(r.path): r.size for r in listing.collect()} == {
        "a.json": len(json.dumps(document("a"), indent=2)),
        "b.json": 13,
    }
    plan = listing._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan
    documents = sources.read_documents(spark, folder)
    got = {os.path.basename(r.path): r for r in documents.collect()}
    assert set(got) == {"a.json", "b.json"}
    assert json.loads(got["a.json"].value) == document("a")
    assert got["b.json"].size == 13 and got["b.json"].modified is not None
    only = sources.read_documents(spark, folder, pattern="deeper/*")
    assert [os.path.basename(r.path) for r in only.collect()] == ["b.json"]
    first = plans.first_document(documents).collect()
    assert [os.path.basename(r.path) for r in first] == ["a.json"]


def test_lines_as_documents(spark, folder):
    _land(folder, **{"many.json": '{"name": "a"}\n{"name": "b"}\n'})
    documents = sources.read_documents(spark, folder, per_line=True)
    assert sorted(r.PipelineName for r in ops.pipelines(sources.parse_documents(documents)).collect()) == ["a", "b"]


def test_profile_of_documents(spark):
    text = "ä" * 300
    row = sources.document_profile(frame(spark, text)).first()
    assert row.n_characters == 300 and row.snippet == "ä" * 200


def test_json_output_keeps_nulls(spark, folder):
    parsed = parse(spark, document("p", call("c", "")))
    plans.write_json_tables({"activities_df": ops.activities(parsed, RUN_TS)}, folder)
    lines = [r.value for r in spark.read.text(f"{folder}/activities_df").collect()]
    assert json.loads(lines[0])["ActivityTargetId"] is None


def test_views(spark):
    names = plans.create_views({"pipelines_df": ops.pipelines(parse(spark, document("p")))})
    assert names == ["view_pipelines_df"]
    assert spark.table("view_pipelines_df").count() == 1


def test_names():
    assert plans.dataset_name("pipelines_df") == "data_quality__adf_pipelines"
    assert plans.dataset_name("other") == "other"
    assert plans.table_name("acct", "ds") == "acct.ds"
    assert plans.arrival_path("/root/", "box/ds/2024", "f.json", "box", "ds") == "/root/ds/2024/f.json"
    with pytest.raises(ValueError):
        plans.arrival_path("/root", "box/other", "f.json", "box", "ds")
