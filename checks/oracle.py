"""The registered queries as SQL over the given tables.

The SQL never sees JSON: it states the fixture rules on the columns and derives the
expected rows with set operations, independently of the Spark code.
"""

from checks.fixtures import NEW_START, OLD_END

_OLD = f"o_orderdate < TIMESTAMP '{OLD_END}'"
_NEW = f"o_orderdate >= TIMESTAMP '{NEW_START}'"

_PATH = "'/flows/' || year(o_orderdate) || '/order_' || o_orderkey || '.json'"

DEFAULTS = "('DatabricksNotebook', 'ExecutePipeline', 'ExecuteDataFlow')"


_BY_CUSTOMER, _BY_ORDER = "'customer_' || o_custkey", "'order_' || o_orderkey"


def _acts(where: str = "true", flow_prefix: str = "flow_", name: str = _BY_CUSTOMER) -> str:
    """CTEs `base` (one row per document) and `acts` (one row per activity)."""
    return f"""
    base AS (
        SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS st, o_orderpriority AS p,
               CAST(left(o_orderpriority, 1) AS INT) AS n, year(o_orderdate) AS y,
               month(o_orderdate) AS m, {name} AS pname,
               sha256({name} || '|Pipeline') AS pid,
               {_PATH} AS path, o_orderdate AS landed
        FROM orders WHERE {where}),
    filled AS (SELECT * FROM base WHERE day(landed) < 28),
    steps AS (
        SELECT filled.*, i, (['ExecutePipeline', 'ExecuteDataFlow', 'Copy',
                            'DatabricksNotebook', 'Wait'])[(m + i) % 5 + 1] AS kind
        FROM filled, unnest(range(1, n + 1)) AS t(i)),
    acts AS (
        SELECT k, pname, pid, path, 0 AS pos, 'open' AS name, 'DatabricksNotebook' AS type,
               CASE st WHEN 'F' THEN '/Shared/' || p WHEN 'O' THEN ''
                       ELSE '/Shared/' || p || '/' END AS target,
               CAST([] AS VARCHAR[]) AS depends
        FROM filled
        UNION ALL
        SELECT k, pname, pid, path, i, 'step_' || i, kind,
               CASE kind
               WHEN 'ExecutePipeline' THEN
                   CASE WHEN NOT (st = 'P' AND i = 2) THEN 'customer_' || (c + i) END
               WHEN 'ExecuteDataFlow' THEN
                   CASE WHEN NOT (st = 'O' AND i = 3) THEN '{flow_prefix}' || y END
               WHEN 'DatabricksNotebook' THEN '/Jobs/' || p || '/job_' || i END,
               CASE WHEN i = 1 THEN ['open']
                    ELSE ['step_' || (i - 1), 'step_' || (i - 1), 'ghost'] END
        FROM steps
        UNION ALL
        SELECT k, pname, pid, path, n + 1, 'step_1', 'ExecuteDataFlow',
               '{flow_prefix}' || m, ['step_' || n]
        FROM filled WHERE st <> 'F'
        UNION ALL
        SELECT k, pname, pid, path, n + 2, 'open', 'Copy', NULL, ['step_1'] FROM filled
        UNION ALL
        SELECT k, pname, pid, path, n + 3, 'untyped', NULL, NULL, ['open'] FROM filled
        UNION ALL
        SELECT k, pname, pid, path, n + 4, NULL, 'DatabricksNotebook', NULL, ['open'] FROM filled)
    """


def _extract(
    where: str = "true",
    flow_prefix: str = "flow_",
    types: str | None = DEFAULTS,
    name: str = _BY_CUSTOMER,
) -> str:
    """CTEs `pipelines`, `nodes` / `activities`, `lookup`, `edges` / `dependencies`."""
    wanted = f"AND type IN {types}" if types else ""
    return f"""
    {_acts(where, flow_prefix, name)},
    pipelines AS (
        SELECT pid AS PipelineId, pname AS PipelineName, 'Pipeline' AS PipelineType,
               '1' AS PipelineLevel
        FROM base),
    nodes AS (
        SELECT *, sha256(name || '|' || type || '|' || pid) AS id,
               CASE WHEN type = 'DatabricksNotebook' THEN
                    CASE WHEN target <> '' THEN string_split(target, '/')[-1] END
                    ELSE nullif(target, '') END AS tname
        FROM acts WHERE name <> '' AND type <> '' {wanted}),
    activities AS (
        SELECT id AS ActivityId, pid AS ParentId, name AS ActivityName, type AS ActivityType,
               '2' AS ActivityLevel,
               CASE WHEN type = 'DatabricksNotebook'
                      OR (type IN {DEFAULTS} AND tname IS NOT NULL)
                    THEN sha256(concat_ws('|', nullif(tname, ''), type, pid))
               END AS ActivityTargetId,
               tname AS ActivityTargetName,
               CASE WHEN type = 'DatabricksNotebook' THEN type
                    WHEN tname IS NULL THEN NULL
                    WHEN type = 'ExecutePipeline' THEN 'Pipeline'
                    WHEN type = 'ExecuteDataFlow' THEN 'DataFlow' END AS ActivityTargetType
        FROM nodes),
    lookup AS (
        SELECT * FROM nodes
        QUALIFY row_number() OVER (PARTITION BY k, name ORDER BY pos DESC) = 1),
    wanted AS (
        SELECT DISTINCT k, name AS sink, unnest(depends) AS source
        FROM acts WHERE name IS NOT NULL),
    edges AS (
        SELECT w.k, s.id AS DependencySourceId, t.id AS DependencyTargetId,
               s.name AS DependencyName, s.type AS DependencySourceType,
               t.type AS DependencyTargetType, s.tname AS DependencySourceName,
               t.tname AS DependencyTargetName
        FROM wanted w
        JOIN lookup s ON s.k = w.k AND s.name = w.source
        JOIN lookup t ON t.k = w.k AND t.name = w.sink),
    dependencies AS (SELECT * EXCLUDE (k) FROM edges)
    """


def _from_extract(body: str, **options) -> str:
    return f"WITH {_extract(**options)} {body}"


_STATES = f"""
    old AS (
        SELECT o_orderkey, o_custkey, o_orderstatus,
               CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 100.0 ELSE o_totalprice END
                   AS o_totalprice,
               o_orderdate,
               CASE WHEN o_orderpriority <> '3-MEDIUM' THEN o_orderpriority END
                   AS o_orderpriority
        FROM orders WHERE {_OLD}),
    new AS (
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
               CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END
                   AS o_orderpriority
        FROM orders WHERE {_NEW})
    """

_CHANGED = """(n.o_custkey IS DISTINCT FROM o.o_custkey
        OR n.o_orderstatus IS DISTINCT FROM o.o_orderstatus
        OR n.o_totalprice IS DISTINCT FROM o.o_totalprice
        OR n.o_orderdate IS DISTINCT FROM o.o_orderdate
        OR n.o_orderpriority IS DISTINCT FROM o.o_orderpriority)"""

_COUNTS = f"""
    SELECT count(*) FILTER (WHERE o.o_orderkey IS NULL) AS inserted,
           count(*) FILTER (WHERE o.o_orderkey = n.o_orderkey AND {_CHANGED}) AS updated,
           count(*) FILTER (WHERE n.o_orderkey IS NULL) AS deleted,
           count(*) FILTER (WHERE o.o_orderkey = n.o_orderkey AND NOT {_CHANGED}) AS unchanged
    FROM old o FULL JOIN new n ON o.o_orderkey = n.o_orderkey
    """


def _states(body: str) -> str:
    return f"WITH {_STATES} {body}"


# Key and other columns of the extracted tables.
_TABLES = {
    "pipelines": (["PipelineId"], ["PipelineName", "PipelineType", "PipelineLevel"]),
    "activities": (
        ["ActivityId", "ParentId"],
        [
            "ActivityName",
            "ActivityType",
            "ActivityLevel",
            "ActivityTargetId",
            "ActivityTargetName",
            "ActivityTargetType",
        ],
    ),
    "dependencies": (
        ["DependencySourceId", "DependencyTargetId"],
        [
            "DependencyName",
            "DependencySourceType",
            "DependencyTargetType",
            "DependencySourceName",
            "DependencyTargetName",
        ],
    ),
}


def _unique(name: str) -> str:
    keys, values = _TABLES[name]
    order = ", ".join(f"{v} NULLS FIRST" for v in values)
    return (
        f"SELECT * FROM {name} QUALIFY row_number() OVER "
        f"(PARTITION BY {', '.join(keys)} ORDER BY {order}) = 1"
    )


def _both_states(name: str) -> str:
    """CTEs `o` and `n`: a table's unique rows for the old and the new documents."""
    old = f"WITH {_extract(_OLD, 'dataflow_')} {_unique(name)}"
    new = f"WITH {_extract(_NEW)} {_unique(name)}"
    return f"o AS ({old}), n AS ({new})"


def _arrived(name: str) -> str:
    """A table after two arrivals: the later document of a workflow counts."""
    early = _extract(f"{_OLD} AND NOT ({_NEW})", "dataflow_", name=_BY_ORDER)
    late = _extract(_NEW, name=_BY_ORDER)
    return f"""
        SELECT * FROM (WITH {early} {_unique(name)})
        UNION ALL SELECT * FROM (WITH {late} {_unique(name)})"""


def _columns_changed(name: str) -> str:
    """Keys of rows that differ after the second arrival, with the columns in which they do."""
    keys, values = _TABLES[name]
    same_key = " AND ".join(f"o.{k} = n.{k}" for k in keys)
    differs = f"({' OR '.join(f'o.{v} IS DISTINCT FROM n.{v}' for v in values)})"
    named = ", ".join(f"CASE WHEN o.{v} IS DISTINCT FROM n.{v} THEN '{v}' END" for v in values)
    shown = ", ".join(f"coalesce(n.{k}, o.{k}) AS {k}" for k in keys)
    return f"""
        WITH o AS (SELECT * FROM (WITH {_extract(_OLD, "dataflow_", name=_BY_ORDER)} {_unique(name)})),
        n AS ({_arrived(name)})
        SELECT {shown},
            CASE WHEN o.{keys[0]} IS NULL THEN 'insert' WHEN n.{keys[0]} IS NULL THEN 'delete' ELSE 'update' END
                AS change_action,
            CASE WHEN o.{keys[0]} IS NOT NULL AND n.{keys[0]} IS NOT NULL THEN concat_ws(',', {named}) END
                AS changed_columns
        FROM o FULL JOIN n ON {same_key}
        WHERE o.{keys[0]} IS NULL OR n.{keys[0]} IS NULL OR {differs}"""


def _shown(name: str) -> str:
    """All columns of a table as one string."""
    columns = sorted([*_TABLES[name][0], *_TABLES[name][1]])
    shown = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in columns)
    return f"""SELECT '{name}_df' AS "table", concat_ws('|', {shown}) AS "columns" FROM {name}"""


def _table_counts(name: str) -> str:
    keys, values = _TABLES[name]
    on = " AND ".join(f"o.{key} = n.{key}" for key in keys)
    differs = " OR ".join(f"o.{v} IS DISTINCT FROM n.{v}" for v in values)
    key = keys[0]
    return f"""
    (WITH {_both_states(name)}
     SELECT '{name}_df' AS "table", CAST(1 AS BIGINT) AS version,
            count(*) FILTER (WHERE o.{key} IS NULL) AS inserted,
            count(*) FILTER (WHERE o.{key} = n.{key} AND ({differs})) AS updated,
            count(*) FILTER (WHERE n.{key} IS NULL) AS deleted,
            count(*) FILTER (WHERE o.{key} = n.{key} AND NOT ({differs})) AS unchanged
     FROM o FULL JOIN n ON {on})
    """


_SYNC_ALL = " UNION ALL ".join(_table_counts(name) for name in _TABLES)


def _validated() -> str:
    parts = []
    for name, (keys, _) in _TABLES.items():
        by = ", ".join(keys)
        parts.append(
            f"SELECT '{name}_df' AS \"table\", 'unique' AS part, count(*) AS n "
            f"FROM (SELECT DISTINCT {by} FROM {name})"
        )
        parts.append(
            f"SELECT '{name}_df', 'duplicate', count(*) "
            f"FROM (SELECT {by} FROM {name} GROUP BY {by} HAVING count(*) > 1)"
        )
    return " UNION ALL ".join(parts)


def _seen_together() -> str:
    """Rows of all tables before and after a sync: what readers of the group see."""
    parts = []
    for state, side in (("stopped", "o"), ("completed", "n")):
        for name in _TABLES:
            shown = _shown(name).replace(f"FROM {name}", f"FROM {side}")
            parts.append(f"SELECT '{state}' AS state, * FROM (WITH {_both_states(name)} {shown})")
    return " UNION ALL ".join(parts)


_CALL_CLOSURE = """
    WITH RECURSIVE customers AS (SELECT DISTINCT o_custkey AS c FROM orders),
    calls AS (
        SELECT 'customer_' || c AS caller, 'customer_' || (c // 4) AS callee FROM customers
        UNION
        SELECT 'customer_' || c, 'customer_' || (CASE WHEN c % 97 = 0 THEN c + 1 ELSE c * 4 + 1 END)
        FROM customers WHERE c % 97 = 0 OR c < 4),
    reach AS (
        SELECT caller, callee, 1 AS depth FROM calls
        UNION
        SELECT r.caller, c.callee, r.depth + 1
        FROM reach r JOIN calls c ON c.caller = r.callee WHERE r.depth < 40)
    SELECT caller, callee, min(depth) AS depth FROM reach GROUP BY caller, callee
    """

_KEY_COLLISIONS = """
    WITH named AS (
        SELECT CASE WHEN o_orderstatus = 'F' THEN concat_ws('|', o_custkey, o_orderpriority)
                    ELSE CAST(o_custkey AS VARCHAR) END AS name,
               CASE WHEN o_orderstatus = 'F' THEN 'flow'
                    ELSE concat_ws('|', o_orderpriority, 'flow') END AS type
        FROM orders)
    SELECT sha256(concat_ws('|', name, type)) AS key, count(*) AS n_rows,
           count(DISTINCT (name, type)) AS n_natural, count(DISTINCT (name, type)) > 1 AS collision
    FROM named GROUP BY key HAVING count(*) > 1
    """

_PER_DOCUMENT = """
    SELECT path, 'pipelines' AS metric, CAST(NULL AS VARCHAR) AS key, CAST(1 AS BIGINT) AS n
    FROM base
    UNION ALL
    SELECT path, 'activities', type, count(*) FROM nodes GROUP BY path, type
    UNION ALL
    SELECT base.path, 'dependencies', NULL, count(edges.k)
    FROM base LEFT JOIN edges ON base.k = edges.k GROUP BY base.path
    """

_REASONS = """
    CASE day(o_orderdate)
    WHEN 1 THEN 'not a JSON object of the expected shape'
    WHEN 2 THEN 'missing name'
    WHEN 3 THEN 'not a JSON object of the expected shape'
    WHEN 4 THEN 'null activity'
    WHEN 5 THEN 'target of the wrong type'
    WHEN 6 THEN 'blank text'
    WHEN 8 THEN 'text after the object'
    WHEN 9 THEN 'target of the wrong type'
    WHEN 10 THEN 'null dependency' END
    """

_LINE_VALUES = [
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
]

ORACLE: dict[str, str] = {
    "list_json_files": """
        SELECT regexp_replace(url, '\\.html$', '.json') AS path FROM pages
        WHERE url LIKE '%.html'""",
    "filter_files_glob": """
        SELECT url || '.json' AS path FROM pages
        WHERE url || '.json' GLOB '*/[!f]?/[0-9]*[02468].json'""",
    "read_documents": _from_extract("""
        SELECT b.pname AS PipelineName, count(*) AS n_documents,
               CAST(sum(coalesce(x.n, 0)) AS BIGINT) AS n_nodes,
               CAST(sum(coalesce(e.n, 0)) AS BIGINT) AS n_links
        FROM base b
        LEFT JOIN (SELECT k, count(*) AS n FROM nodes GROUP BY k) x ON x.k = b.k
        LEFT JOIN (SELECT k, count(*) AS n FROM edges GROUP BY k) e ON e.k = b.k
        GROUP BY b.pname"""),
    "document_profile": """
        SELECT doc_id, CAST(length(text) AS BIGINT) AS n_characters,
               substr(text, 1, 200) AS snippet
        FROM documents""",
    "parse_event_props": """
        SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k,
               json_extract_string(props, '$.k') AS k_text, CAST(NULL AS VARCHAR) AS absent
        FROM events""",
    "extract_workflows": _from_extract("SELECT * FROM pipelines"),
    "extract_activities": _from_extract("SELECT * FROM activities"),
    "extract_dependencies": _from_extract("SELECT * FROM dependencies"),
    "extract_dependencies_staged": _from_extract("SELECT * FROM dependencies"),
    "activity_targets": _from_extract("""
        SELECT ActivityId, ActivityType, ActivityTargetId, ActivityTargetName,
               ActivityTargetType FROM activities"""),
    "activity_lookup_last_wins": _from_extract("SELECT path, name, type, target FROM lookup"),
    "conformed_schemas": _from_extract("""
        SELECT *, 'string' AS level_type, 'timestamp' AS date_type FROM pipelines"""),
    "flagship": _from_extract("""
        SELECT DependencySourceType, DependencyTargetType, count(*) AS n_edges
        FROM dependencies GROUP BY ALL"""),
    "filter_include_types": _from_extract(
        "SELECT * FROM activities", types="('ExecutePipeline')"
    ),
    "filter_all_types": _from_extract("SELECT * FROM activities", types=None),
    "quarantine_documents": f"""
        SELECT {_PATH} AS path, {_REASONS} AS failure
        FROM orders WHERE {_REASONS} IS NOT NULL""",
    "extract_counts": _from_extract(
        f"SELECT metric, key, CAST(sum(n) AS BIGINT) AS n FROM ({_PER_DOCUMENT}) GROUP BY ALL"
    ),
    "extract_counts_per_document": _from_extract(_PER_DOCUMENT),
    "single_document_run": _from_extract(
        "SELECT * FROM activities",
        where=f"{_PATH} = (SELECT min({_PATH}) FROM orders WHERE day(o_orderdate) < 28)",
    ),
    "single_document_counts": _from_extract(
        " UNION ALL ".join(f"SELECT '{n}_df' AS \"table\", count(*) AS n FROM {n}" for n in _TABLES),
        where=f"{_PATH} = (SELECT min({_PATH}) FROM orders)",
    ),
    "duplicate_keys": """
        SELECT l_orderkey, l_linenumber, count(*) AS duplicate_count FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "dedupe_by_key": f"""
        SELECT * FROM lineitem QUALIFY row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY {', '.join(f'{v} NULLS FIRST' for v in _LINE_VALUES)}) = 1""",
    "validate_unique": """
        SELECT sha256(text) AS text_key, doc_id, lang, source, n_chars,
               CASE WHEN copies > 1 THEN copies END AS duplicate_count
        FROM (SELECT *, count(*) OVER (PARTITION BY text) AS copies FROM documents)
        QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id NULLS FIRST,
            lang NULLS FIRST, source NULLS FIRST, n_chars NULLS FIRST) = 1""",
    "validate_all_tables": _from_extract(_validated()),
    "dataframe_profile_bytes": """
        SELECT 'customer' AS label, CAST(sum(strlen(
            '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_nationkey":'
            || c_nationkey || ',"c_mktsegment":"' || c_mktsegment || '"}')) AS BIGINT) AS json_bytes
        FROM customer""",
    "list_landed_files": """
        SELECT 'month=' || strftime(o_orderdate, '%Y-%m') AS folder, CAST(1 AS BIGINT) AS n_files
        FROM orders GROUP BY 1""",
    "dataframe_profile": """
        SELECT 'conversations' AS label, count(*) AS n_rows, CAST(4 AS BIGINT) AS n_columns,
               CAST(sum(coalesce(length(role), 0) + coalesce(length(text), 0)) AS BIGINT)
                   AS text_chars
        FROM conversations
        UNION ALL
        SELECT 'orders', count(*), 6, CAST(sum(coalesce(length(o_orderstatus), 0)
               + coalesce(length(o_orderpriority), 0)) AS BIGINT) FROM orders
        UNION ALL
        SELECT 'documents', count(*), 5, CAST(sum(coalesce(length(text), 0)
               + coalesce(length(lang), 0) + coalesce(length(source), 0)) AS BIGINT)
        FROM documents""",
    "count_inserted": _states("""
        SELECT count(*) AS inserted FROM new
        WHERE o_orderkey NOT IN (SELECT o_orderkey FROM old)"""),
    "count_deleted": _states("""
        SELECT count(*) AS deleted FROM old
        WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new)"""),
    "rows_changed_except": _states("SELECT * FROM old EXCEPT SELECT * FROM new"),
    "change_flags": _states(f"""
        SELECT o.o_orderkey, {_CHANGED} AS changed,
               coalesce(n.o_custkey <> o.o_custkey, false)
               OR coalesce(n.o_orderstatus <> o.o_orderstatus, false)
               OR coalesce(n.o_totalprice <> o.o_totalprice, false)
               OR coalesce(n.o_orderdate <> o.o_orderdate, false)
               OR coalesce(n.o_orderpriority <> o.o_orderpriority, false) AS changed_plain
        FROM old o JOIN new n ON o.o_orderkey = n.o_orderkey"""),
    "change_counts": _states(_COUNTS),
    "changed_rows_preview": _states(f"""
        SELECT n.*, CASE WHEN o.o_orderkey IS NULL THEN 'insert' ELSE 'update' END
                   AS change_action
        FROM new n LEFT JOIN old o ON o.o_orderkey = n.o_orderkey
        WHERE o.o_orderkey IS NULL OR {_CHANGED}
        ORDER BY n.o_orderkey LIMIT 10"""),
    "merge_upsert": _states("""
        SELECT * FROM new
        UNION ALL
        SELECT * FROM old WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new)"""),
    "merge_upsert_fewer_columns": _states("""
        SELECT n.* REPLACE (o.o_totalprice AS o_totalprice)
        FROM new n LEFT JOIN old o ON o.o_orderkey = n.o_orderkey
        UNION ALL
        SELECT * FROM old WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new)"""),
    "merge_upsert_new_columns": _states("""
        SELECT *, o_orderstatus || '!' AS o_note FROM new
        UNION ALL
        SELECT *, NULL FROM old WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new)"""),
    "upsert_after_append": _states("""
        SELECT * FROM new
        UNION ALL
        SELECT * FROM old WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new)"""),
    "merge_append_null_keys": _states("""
        SELECT * FROM old UNION ALL SELECT * FROM new WHERE o_orderstatus <> 'P'"""),
    "delete_missing": _states("""
        SELECT * FROM old WHERE o_orderkey IN (SELECT o_orderkey FROM new)"""),
    "merge_append": _states("SELECT * FROM old UNION ALL SELECT * FROM new"),
    "merge_replace": _states("SELECT * FROM new"),
    "sync_table": _states("SELECT * FROM new"),
    "sync_table_bucketed": _states("SELECT * FROM new"),
    "bucketed_without_catalog": _states("SELECT * FROM new"),
    "sync_all_tables": _SYNC_ALL,
    "synced_together": _seen_together(),
    "call_closure": _CALL_CLOSURE,
    "key_collisions": _KEY_COLLISIONS,
    "sync_total_summary": f"""
        SELECT CAST(sum(inserted) AS BIGINT) AS inserted, CAST(sum(updated) AS BIGINT) AS updated,
               CAST(sum(deleted) AS BIGINT) AS deleted,
               CAST(sum(unchanged) AS BIGINT) AS unchanged
        FROM ({_SYNC_ALL})""",
    "synced_activities": f"""
        WITH {_both_states('activities')}
        SELECT n.*, CASE WHEN o.ActivityId IS NULL THEN '2024-02-01' ELSE '2024-01-01' END
                   AS CreatedDate
        FROM n LEFT JOIN o ON o.ActivityId = n.ActivityId AND o.ParentId = n.ParentId""",
    "create_if_not_exists": _states("SELECT * FROM old"),
    "snapshot_as_of": _states("SELECT * FROM old"),
    "snapshot_history": _states(f"""
        SELECT CAST(0 AS BIGINT) AS version, 'create' AS operation, '2024-01-01' AS run_day,
               CAST(NULL AS BIGINT) AS inserted, CAST(NULL AS BIGINT) AS updated,
               CAST(NULL AS BIGINT) AS deleted, CAST(NULL AS BIGINT) AS unchanged
        UNION ALL
        SELECT 1, 'upsert', '2024-02-01', inserted, updated, deleted, unchanged
        FROM ({_COUNTS})"""),
    "version_diff": _states("SELECT * FROM new EXCEPT SELECT * FROM old"),
    "partitioned_write": """
        SELECT *, strftime(ts, '%Y-%m-%d') AS by_day FROM events""",
    "partitioned_sync": """
        SELECT * FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""",
    "snapshot_history_untimed": """
        SELECT * FROM (VALUES (CAST(0 AS BIGINT), 'create', true), (1, 'upsert', true))
            AS t(version, operation, timed)""",
    "json_roundtrip": _from_extract(" UNION ALL ".join(map(_shown, _TABLES))),
    "views_query": _from_extract("""
        SELECT name, n_calls, n_documents FROM (
            SELECT ActivityTargetName AS name, count(*) AS n_calls FROM activities
            WHERE ActivityTargetType = 'Pipeline' GROUP BY 1)
        JOIN (SELECT PipelineName AS name, count(*) AS n_documents FROM pipelines GROUP BY 1)
        USING (name)"""),
    "incremental_ingest": _arrived("activities"),
    "incremental_ingest_bounded": _arrived("activities"),
    "incremental_edges": _arrived("dependencies"),
    "incremental_pipelines": _arrived("pipelines"),
    "incremental_two_streams": _arrived("activities"),
    "incremental_quarantine": f"""
        SELECT {_REASONS} AS failure, count(*) AS n FROM orders
        WHERE {_REASONS} IS NOT NULL GROUP BY 1""",
    "incremental_late_files": _arrived("activities"),
    "incremental_removed_files": f"""
        WITH {_extract(_OLD, "dataflow_", name=_BY_ORDER)} {_unique("activities")}""",
    "version_diff_columns": _columns_changed("activities"),
    "surrogate_key": """
        SELECT o_orderkey, sha256(concat_ws('|',
            CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END,
            o_orderpriority, CAST(o_orderkey AS VARCHAR))) AS surrogate_key
        FROM orders""",
    "uuid_ids": """
        SELECT count(*) AS n_rows, count(*) AS n_ids, CAST(36 AS BIGINT) AS shortest,
               CAST(36 AS BIGINT) AS longest, count(*) AS n_version_4 FROM events""",
    "path_last_part": """
        SELECT page_id, string_split(url, '/')[-1] AS last_part,
               CASE WHEN url NOT LIKE '%/' THEN string_split(url, '/')[-1] END AS or_nothing
        FROM pages""",
    "pretty_json": """
        SELECT event_id, CAST(7 AS BIGINT) AS n_lines, event_type, user_id FROM events""",
}
