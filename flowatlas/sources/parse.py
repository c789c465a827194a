"""JSON text to a compact record per document, with a reason for each that fails.

Output of `parse_documents`, one row per input row:

    path            as given
    document_bytes  size of the text
    PipelineName    NULL when the document failed
    nodes           included activities, last one first: (name, type, target, wrong_type)
    links           distinct dependency edges between nodes, both as positions in
                    `nodes`: source * 2^32 + target
    failure         why the document cannot be used, or NULL

With `inline_bytes` set, texts above that size have no links but

    large_key       identifies the document
    steps           (name, depends) per activity, to be joined over the cluster

The record is computed by one expression inside one generator. Filters on its columns
cannot be pushed below a generator, so the JSON text is parsed once per row.
"""

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flowatlas.functions import let, parse_json
from flowatlas.schemas import DEFAULT_TYPES, DOCUMENT

# In-row lookups compare names pairwise within a document. Above this text size a staged
# run moves the work to a shuffle join, so that one giant document cannot stall a task.
INLINE_BYTES = 256 * 1024

LINK_BITS = 32

# Activity type -> (object within typeProperties, property with the target).
NOTEBOOK, CALL, DATAFLOW = "DatabricksNotebook", "ExecutePipeline", "ExecuteDataFlow"
TARGET_PATHS = {
    NOTEBOOK: (None, "notebookPath"),
    CALL: ("pipeline", "referenceName"),
    DATAFLOW: ("dataflow", "referenceName"),
}


def _present(column: Column) -> Column:
    return column.isNotNull() & (column != "")


def _by_type(kind: Column, branches: dict[str, Column]) -> Column:
    out = None
    for name, value in branches.items():
        out = F.when(kind == name, value) if out is None else out.when(kind == name, value)
    return out


def _target(kind: Column, properties: Column) -> Column:
    return _by_type(kind, {k: F.get_json_object(properties, _path(k)) for k in TARGET_PATHS})


def _path(kind: str) -> str:
    return ".".join(["$", *filter(None, TARGET_PATHS[kind])])


def _wrong_type(kind: Column, properties: Column, target: Column) -> Column:
    """True when a value that the activity type reads has the wrong JSON type.

    Both cases are looked into only when there is a reason to: no target although there
    are properties, or a target that reads like an object, list, number or boolean and
    may or may not have been quoted.
    """
    suspicious = target.rlike(r"^([\[{]|-?[0-9]|true$|false$)")

    def unquoted(name: str) -> Column:
        value = F.try_variant_get(F.try_parse_json(properties), _path(name), "variant")
        return F.schema_of_variant(value) != "STRING"

    def no_object(name: str) -> Column:
        parent, _ = TARGET_PATHS[name]
        whole = ~properties.startswith("{")
        if parent is None:
            return whole
        return whole | ~F.get_json_object(properties, f"$.{parent}").startswith("{")

    return (
        F.when(properties.isNull() | ~kind.isin(list(TARGET_PATHS)), F.lit(False))
        .when(target.isNull(), _by_type(kind, {k: no_object(k) for k in TARGET_PATHS}))
        .when(suspicious, _by_type(kind, {k: unquoted(k) for k in TARGET_PATHS}))
    )


def _record(parsed: Column, include: list[str] | None, inline: Column | None) -> Column:
    activities = F.coalesce(parsed["properties"]["activities"], F.array())

    def included(activity: Column) -> Column:
        wanted = _present(activity["name"]) & _present(activity["type"])
        return wanted if include is None else wanted & activity["type"].isin(include)

    def node(activity: Column) -> Column:
        name, kind = activity["name"], activity["type"]
        properties = activity["typeProperties"]
        return let(
            _target(kind, properties),
            lambda target: F.struct(
                name.alias("name"),
                kind.alias("type"),
                target.alias("target"),
                _wrong_type(kind, properties, target).alias("wrong_type"),
            ),
        )

    nodes = F.transform(F.reverse(F.filter(activities, included)), node)
    return let(
        nodes,
        lambda n: let(
            F.transform(n, lambda node: node["name"]),
            lambda names: _fields(parsed, activities, n, names, inline),
        ),
    )


def _links(activities: Column, names: Column) -> Column:
    """Distinct edges as positions in `names`; a name that is not there gives 0 or NULL."""

    def links_of(activity: Column) -> Column:
        return let(
            F.array_position(names, activity["name"]),
            lambda sink: F.transform(
                _depends(activity),
                lambda d: F.shiftleft(
                    F.array_position(names, d["activity"]), LINK_BITS
                ).bitwiseOR(sink),
            ),
        )

    links = F.array_distinct(F.flatten(F.transform(activities, links_of)))
    sink_mask = F.lit((1 << LINK_BITS) - 1)
    return F.filter(links, lambda k: (k > sink_mask) & (k.bitwiseAND(sink_mask) > 0))


def _depends(activity: Column) -> Column:
    return F.coalesce(activity["dependsOn"], F.array())


# Column computed below the generator, where expressions are compiled.
_WHOLE = "_whole"
# Field of the object that marks the end of a text.
_END = "_end_of_text"


def _ends_with_object(text: Column) -> Column:
    """True when nothing but space follows the first JSON value, which is an object.

    The parser of the document stops at the end of the object. Here the text stands in an
    array before an object with its own digest: more text, or a bracket too many, gives another
    number of elements or no array, and no text can hold its own digest. Of the text's object
    no field is read, so the scan skips what is in it.
    """
    def whole(digest: Column) -> Column:
        enclosed = F.concat(F.lit("["), text, F.lit(f',{{"{_END}":"'), digest, F.lit('"}]'))
        return let(
            F.from_json(enclosed, f"array<struct<{_END}: string>>"),
            lambda found: (F.size(found) == 2) & (F.element_at(found, -1)[_END] == digest),
        )

    return F.coalesce(let(F.sha2(text, 256), whole), F.lit(False))


def _failure(parsed: Column, activities: Column, nodes: Column, names: Column) -> Column:
    def null_dependency(activity: Column) -> Column:
        holes = F.exists(activity["dependsOn"], lambda d: d.isNull())
        return holes & F.array_contains(names, activity["name"])

    return (
        F.when(parsed.isNull(), "blank text")
        .when(parsed["_corrupt"].isNotNull(), "not a JSON object of the expected shape")
        .when(~F.col(_WHOLE), "text after the object")
        .when(~F.coalesce(_present(parsed["name"]), F.lit(False)), "missing name")
        .when(F.exists(activities, lambda a: a.isNull()), "null activity")
        .when(F.exists(nodes, lambda n: n["wrong_type"]), "target of the wrong type")
        .when(F.exists(activities, null_dependency), "null dependency")
    )


def _fields(
    parsed: Column,
    activities: Column,
    nodes: Column,
    names: Column,
    inline: Column | None,
) -> Column:
    def steps() -> Column:
        return F.transform(
            activities,
            lambda a: F.struct(
                a["name"].alias("name"),
                F.transform(_depends(a), lambda d: d["activity"]).alias("depends"),
            ),
        )

    def fields(failure: Column) -> Column:
        valid = failure.isNull()
        columns = [
            F.when(valid, parsed["name"]).alias("PipelineName"),
            F.when(valid, nodes).alias("nodes"),
            F.when(valid if inline is None else valid & inline, _links(activities, names)).alias(
                "links"
            ),
            failure.alias("failure"),
        ]
        if inline is not None:
            columns.append(F.when(valid & ~inline, steps()).alias("steps"))
        return F.struct(*columns)

    return let(_failure(parsed, activities, nodes, names), fields)


def parse_documents(
    documents: DataFrame,
    include_types: Iterable[str] | None = DEFAULT_TYPES,
    inline_bytes: int | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Parse `(path, value)` rows; see the module text for the result.

    Columns named by `carry` stay beside the record.

    `include_types=None` keeps every activity type; an empty list means the defaults.
    Set `inline_bytes` when the result is going to be staged: readers then take a second
    look at the large documents, which costs nothing on a staged table and a further
    scan of the texts otherwise.
    """
    include = include_types
    if include is not None:
        include = list(include) or DEFAULT_TYPES
    inline = None
    columns = ["path", "document_bytes", *carry]
    if inline_bytes is not None:
        inline = F.coalesce(F.col("document_bytes") <= inline_bytes, F.lit(True))
        key = F.concat_ws("#", "path", F.sha2("value", 256))
        columns.append(F.when(~inline, key).alias("large_key"))
    record = let(
        parse_json("value", DOCUMENT),
        lambda parsed: _record(parsed, include, inline),
    )
    sized = documents.withColumns(
        {
            "document_bytes": F.octet_length("value").cast("bigint"),
            _WHOLE: _ends_with_object(F.col("value")),
        }
    )
    return sized.select(*columns, F.inline(F.array(record)))


def valid_documents(parsed: DataFrame) -> DataFrame:
    return parsed.filter("failure IS NULL").drop("failure")


def rejected_documents(parsed: DataFrame) -> DataFrame:
    """The quarantine: `(path, failure)` of the documents that cannot be used.

    With a carried `digest` of the text that comes along: it tells the lines of a file apart.
    """
    known = [c for c in ("path", "digest", "failure") if c in parsed.columns]
    return parsed.filter("failure IS NOT NULL").select(*known)


def require_valid(parsed: DataFrame) -> DataFrame:
    """Raise on the first unusable document instead of setting it aside."""
    bad = rejected_documents(parsed).take(1)
    if bad:
        raise ValueError(f"{bad[0]['path']}: {bad[0]['failure']}")
    return parsed


def stage(spark: SparkSession, df: DataFrame, folder: str) -> DataFrame:
    """Write to a shared folder and read back: one parse for many readers.

    The written table outlives lost executors, and the statistics on
    `document_bytes` and `failure` let later readers skip row groups.
    """
    df.write.mode("overwrite").option("compression", "zstd").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
