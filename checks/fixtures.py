"""Workflow documents and table snapshots derived from the given tables.

Each order becomes one document, by a projection: no grouping, so a key that holds many
rows costs nothing here. Rows are assigned to variants by their own values, and every
row of the table takes part.
"""

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flowatlas.session import shuffles_removed

RUN_TS = datetime(2024, 1, 1, 12)
LATER_TS = datetime(2024, 2, 1, 12)

# The older snapshot ends, and the newer one begins, with an order date.
OLD_END = "2000-07-01"
NEW_START = "1996-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _activity(
    name: str,
    kind: str,
    notebook: str = "NULL",
    call: str = "NULL",
    flow: str = "NULL",
    depends: str = "array()",
) -> str:
    def reference(value: str) -> str:
        named = f"named_struct('referenceName', cast({value} AS STRING))"
        return f"CASE WHEN {value} IS NOT NULL THEN {named} END"

    return (
        f"named_struct('name', cast({name} AS STRING), 'type', cast({kind} AS STRING), "
        f"'typeProperties', named_struct('notebookPath', cast({notebook} AS STRING), "
        f"'pipeline', {reference(call)}, 'dataflow', {reference(flow)}), "
        f"'dependsOn', transform(cast({depends} AS ARRAY<STRING>), "
        "d -> named_struct('activity', d)))"
    )


def workflow_structs(
    orders: DataFrame, flow_prefix: str = "flow_", name: str = "concat('customer_', c)"
) -> DataFrame:
    """`(path, landed, name, properties)`: the documents before they become text."""
    kinds = "array('ExecutePipeline', 'ExecuteDataFlow', 'Copy', 'DatabricksNotebook', 'Wait')"
    kind = f"element_at({kinds}, (m + i) % 5 + 1)"
    opening = _activity(
        "'open'",
        "'DatabricksNotebook'",
        notebook="CASE st WHEN 'F' THEN concat('/Shared/', p) WHEN 'O' THEN '' "
        "ELSE concat('/Shared/', p, '/') END",
    )
    step = _activity(
        "concat('step_', i)",
        kind,
        notebook=f"CASE WHEN {kind} = 'DatabricksNotebook' "
        "THEN concat('/Jobs/', p, '/job_', i) END",
        call=f"CASE WHEN {kind} = 'ExecutePipeline' AND NOT (st = 'P' AND i = 2) "
        "THEN concat('customer_', c + i) END",
        flow=f"CASE WHEN {kind} = 'ExecuteDataFlow' AND NOT (st = 'O' AND i = 3) "
        f"THEN concat('{flow_prefix}', y) END",
        depends="CASE WHEN i = 1 THEN array('open') ELSE "
        "array(concat('step_', i - 1), concat('step_', i - 1), 'ghost') END",
    )
    repeated = _activity(
        "'step_1'",
        "'ExecuteDataFlow'",
        flow=f"concat('{flow_prefix}', m)",
        depends="array(concat('step_', n))",
    )
    shadow = _activity("'open'", "'Copy'", depends="array('step_1')")
    untyped = _activity("'untyped'", "NULL", depends="array('open')")
    unnamed = _activity("NULL", "'DatabricksNotebook'", depends="array('open')")
    activities = (
        f"concat(array({opening}), transform(sequence(1, n), i -> {step}), "
        f"CASE WHEN st <> 'F' THEN array({repeated}) ELSE array() END, "
        f"array({shadow}, {untyped}, {unnamed}))"
    )
    cores = orders.sparkSession.sparkContext.defaultParallelism
    columns = orders.repartition(cores).selectExpr(
        "o_orderkey AS k",
        "o_custkey AS c",
        "o_orderstatus AS st",
        "o_orderpriority AS p",
        "o_orderdate AS landed",
        "cast(left(o_orderpriority, 1) AS INT) AS n",
        "year(o_orderdate) AS y",
        "month(o_orderdate) AS m",
    )
    # The last days of a month bring documents without activities: an empty list, no list,
    # no properties.
    day = "day(landed)"
    listed = f"CASE {day} WHEN 28 THEN slice(acts, 1, 0) WHEN 29 THEN NULL ELSE acts END"
    return columns.selectExpr("*", f"{activities} AS acts").selectExpr(
        "concat('/flows/', y, '/order_', k, '.json') AS path",
        "landed",
        f"{name} AS name",
        f"CASE WHEN {day} < 30 THEN named_struct('activities', {listed}) END AS properties",
    )


def workflow_documents(orders: DataFrame, flow_prefix: str = "flow_") -> DataFrame:
    """`(path, value)` with the JSON text of each document."""
    structs = workflow_structs(orders, flow_prefix)
    return structs.select("path", F.to_json(F.struct("name", "properties")).alias("value"))


def call_documents(orders: DataFrame) -> DataFrame:
    """`(path, value)`: workflows of customers that call others, in chains, diamonds and circles."""
    up = _activity("'up'", "'ExecutePipeline'", call="concat('customer_', c div 4)")
    aside = "CASE WHEN c % 97 = 0 THEN concat('customer_', c + 1) WHEN c < 4 THEN concat('customer_', c * 4 + 1) END"
    side = _activity("'side'", "'ExecutePipeline'", call=aside)
    columns = orders.selectExpr("o_orderkey AS k", "o_custkey AS c")
    return columns.selectExpr(
        "concat('/calls/order_', k, '.json') AS path",
        f"to_json(named_struct('name', concat('customer_', c), 'properties', "
        f"named_struct('activities', array({up}, {side})))) AS value",
    )


def damaged_documents(orders: DataFrame) -> DataFrame:
    """The documents with a different fault for each of the first days of the month."""
    structs = workflow_structs(orders)
    day = F.dayofmonth("landed")
    text = F.to_json(F.struct("name", "properties"))
    unnamed = F.to_json(F.struct("properties"))
    start = '"activities":['

    def with_first(activity: str) -> Column:
        return F.replace("text", F.lit(start), F.lit(f"{start}{activity},"))

    value = (
        F.when(day == 1, F.expr("left(text, length(text) - 3)"))
        .when(day == 2, F.col("unnamed"))
        .when(day == 3, F.concat(F.lit("["), "text", F.lit("]")))
        .when(day == 4, with_first("null"))
        .when(day == 5, with_first(_BAD_PATH))
        .when(day == 6, F.lit(" "))
        .when(day == 7, with_first(_BAD_EXCLUDED))
        .when(day == 8, F.concat("text", F.lit(" and more")))
        .when(day == 9, with_first(_BAD_CALL))
        .when(day == 10, with_first(_BAD_DEPENDENCY))
        .otherwise(F.col("text"))
    )
    rows = structs.select("path", "landed", text.alias("text"), unnamed.alias("unnamed"))
    return rows.select("path", value.alias("value"))


_BAD_PATH = (
    '{"name":"odd","type":"DatabricksNotebook","typeProperties":{"notebookPath":{"value":"x"}}}'
)
_BAD_CALL = '{"name":"odd","type":"ExecutePipeline","typeProperties":{"pipeline":"x"}}'
_BAD_EXCLUDED = '{"name":"odd","type":"Copy","typeProperties":{"pipeline":"x"}}'
_BAD_DEPENDENCY = '{"name":"odd","type":"ExecutePipeline","dependsOn":[null]}'


def old_orders(orders: DataFrame) -> DataFrame:
    """An earlier state: newer orders missing, some prices and priorities different."""
    return orders.filter(F.col("o_orderdate") < F.lit(OLD_END).cast("timestamp_ntz")).withColumns(
        {
            "o_totalprice": F.when(
                F.col("o_orderstatus") == "F", F.col("o_totalprice") + 100.0
            ).otherwise(F.col("o_totalprice")),
            "o_orderpriority": F.when(
                F.col("o_orderpriority") != "3-MEDIUM", F.col("o_orderpriority")
            ),
        }
    )


def new_orders(orders: DataFrame) -> DataFrame:
    """A later state: the oldest orders gone, one priority withdrawn."""
    return orders.filter(
        F.col("o_orderdate") >= F.lit(NEW_START).cast("timestamp_ntz")
    ).withColumn(
        "o_orderpriority",
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority")),
    )


def old_workflows(orders: DataFrame) -> DataFrame:
    return workflow_documents(
        orders.filter(F.col("o_orderdate") < F.lit(OLD_END).cast("timestamp_ntz")), "dataflow_"
    )


def new_workflows(orders: DataFrame) -> DataFrame:
    return workflow_documents(
        orders.filter(F.col("o_orderdate") >= F.lit(NEW_START).cast("timestamp_ntz"))
    )


def land(spark: SparkSession, waiting: str, landing: str) -> None:
    """Move finished files to a landing folder, as `.json` or `.json.gz` and with the times they have."""
    files = spark._jvm.org.apache.hadoop.fs
    source, target = files.Path(waiting), files.Path(landing)
    system = source.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(target)
    for status in system.listStatus(source):
        name = status.getPath().getName()
        if name.startswith("part-"):
            packed = ".gz" if name.endswith(".gz") else ""
            stem = name.removesuffix(packed).rpartition(".")[0]
            system.rename(status.getPath(), files.Path(target, f"{stem}.json{packed}"))


def land_in_files(spark: SparkSession, documents: DataFrame, waiting: str, landing: str, count: int) -> None:
    """Land documents as JSON lines in so many files at most: all tasks make the lines, few only write them."""
    lines = documents.select(F.to_json(F.struct("*")).alias("value")).repartition(count, "value")
    with shuffles_removed(spark):
        lines.write.text(waiting)
    land(spark, waiting, landing)


def arrivals(orders: DataFrame) -> list[DataFrame]:
    """`(name, properties)` of the old and the new state; in each a workflow has one document."""
    name = "concat('order_', k)"
    old = orders.filter(F.col("o_orderdate") < F.lit(OLD_END).cast("timestamp_ntz"))
    new = orders.filter(F.col("o_orderdate") >= F.lit(NEW_START).cast("timestamp_ntz"))
    states = [workflow_structs(old, "dataflow_", name), workflow_structs(new, "flow_", name)]
    return [state.select("name", "properties") for state in states]
