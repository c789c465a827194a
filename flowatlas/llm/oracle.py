"""SQL for the queries that SQL can express, over the same tables."""

from flowatlas.llm import secret_scan

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _words(column: str) -> str:
    lowered = f"translate(coalesce({column}, ''), '{UPPER}', '{UPPER.lower()}')"
    return f"regexp_extract_all({lowered}, {_quoted(WORDS)})"


def secrets_sql() -> str:
    kinds = ", ".join(f"({k}, {_quoted(p)})" for k, p in enumerate([*secret_scan.BASE.values(), secret_scan.CANDIDATE]))
    # the operator's lookbehind only spares it searches: a leftmost match begins where a part does
    placed = _quoted(secret_scan.PLACED.removeprefix("(?<![A-Za-z0-9+])"))
    hex_run = _quoted(secret_scan.HEX_RUN)
    allowed = " AND ".join(
        ["replace(found, left(found, 1), '') <> ''"]
        + [f"NOT regexp_full_match(found, {_quoted(p)})" for p in secret_scan.ALLOWED[:-1] if "\\1" not in p]
    )
    of_hex, of_64 = (c.most for c in secret_scan.CLASSES)

    def before(pieces: str, n: str) -> str:
        return f"length(array_to_string({pieces}[1:{n}], ''))"

    terms = ", ".join(map(str, secret_scan.TERMS[1:]))
    size = secret_scan.WINDOW
    names = ", ".join(_quoted(k) for k in secret_scan.KINDS)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
kinds(kind, pattern) AS (VALUES {kinds}),
hit AS (
  SELECT rid, kind, regexp_extract_all(text, pattern) AS found, string_split_regex(text, pattern) AS gaps
  FROM d, kinds WHERE regexp_matches(text, pattern)),
each AS (
  SELECT rid, kind, unnest(found) AS found, unnest(gaps[1:len(found)]) AS gap,
    unnest(generate_series(1, len(found))) AS i FROM hit),
placed AS (
  SELECT rid, kind, found,
    CAST(sum(length(gap) + length(found)) OVER (PARTITION BY rid, kind ORDER BY i) AS BIGINT) AS finish
  FROM each),
spans AS (SELECT rid, kind, found, finish - length(found) AS start, finish FROM placed),
base AS (
  SELECT rid, kind, start, finish FROM spans WHERE kind < 3 AND (kind > 0
    OR length(regexp_replace(found, {_quoted(secret_scan.ASSIGN_HEAD)}, '')) >= 6)),
uncut AS (SELECT rid, found, start FROM spans WHERE kind = 3 AND {allowed}),
split AS (
  SELECT rid, start, string_split_regex(found, {placed}) AS pieces, regexp_extract_all(found, {placed}) AS cuts
  FROM uncut),
beside AS (
  SELECT rid, pieces[i] AS found,
    CAST(start + {before("pieces", "i - 1")} + {before("cuts", "i - 1")} AS BIGINT) AS start
  FROM (SELECT *, unnest(generate_series(1, len(pieces))) AS i FROM split)),
candidate AS (SELECT * FROM beside WHERE length(found) >= {size} AND {allowed}),
hex_split AS (
  SELECT rid, start, string_split_regex(found, {hex_run}) AS gaps, regexp_extract_all(found, {hex_run}) AS runs
  FROM candidate),
hex_run AS (
  SELECT rid, runs[i] AS found, CAST(start + {before("gaps", "i")} + {before("runs", "i - 1")} AS BIGINT) AS start
  FROM (SELECT *, unnest(generate_series(1, len(runs))) AS i FROM hex_split)),
scanned AS (
  SELECT rid, found, start, 'hex' AS whole, {of_hex} AS most FROM hex_run WHERE {allowed}
  UNION ALL SELECT rid, found, start, 'base 64', {of_64} FROM candidate),
windows AS (
  SELECT rid, start, whole, most, i, substr(found, CAST(i AS BIGINT), {size}) AS part
  FROM (SELECT *, unnest(generate_series(1, length(found) - {size - 1})) AS i FROM scanned)),
counted AS (
  SELECT rid, start, whole, most, i, c, count(*) AS n
  FROM (SELECT rid, start, whole, most, i, unnest(string_split(part, '')) AS c FROM windows)
  GROUP BY ALL),
scored AS (
  SELECT rid, start, whole, i FROM counted GROUP BY rid, start, whole, most, i
  HAVING sum(([{terms}])[n]) <= most),
entropy AS (
  SELECT DISTINCT rid, start + min(i) - 1 AS start, start + max(i) + {size - 1} AS finish
  FROM scored GROUP BY rid, scored.start, whole),
free AS (
  SELECT * FROM entropy e WHERE NOT EXISTS (
    FROM base b WHERE b.rid = e.rid AND e.start < b.finish AND b.start < e.finish)),
added AS (
  SELECT * FROM free e WHERE NOT EXISTS (
    FROM free o WHERE o.rid = e.rid AND (o.start, o.finish) <> (e.start, e.finish)
      AND o.start <= e.start AND e.finish <= o.finish)),
every AS (
  SELECT rid, kind, start, finish FROM base UNION ALL SELECT rid, 3, start, finish FROM added),
written AS (
  SELECT rid, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
    count(*) FILTER (kind = 2) AS n_hex,
    string_agg(([{names}])[kind + 1] || ':' || start || ':' || finish, ',' ORDER BY start, kind)
      FILTER (kind < 3) AS base,
    string_agg(([{names}])[kind + 1] || ':' || start || ':' || finish, ',' ORDER BY start, kind) AS spans
  FROM every GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN written USING (rid)"""


def decontamination_sql(size: int = 13) -> str:
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_words("text")} AS w FROM documents),
item AS (SELECT item_id, {_words("text")} AS w FROM benchmark),
cut AS (
  SELECT item_id, least(len(w), {size}) AS n, w, unnest(generate_series(1, len(w) - least(len(w), {size}) + 1)) AS p
  FROM item WHERE len(w) > 0),
test AS (SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS part FROM cut),
sizes AS (SELECT DISTINCT n FROM test),
place AS (
  SELECT rid, n, w, unnest(generate_series(1, len(w) - n + 1)) AS p FROM d, sizes WHERE len(w) >= n),
hit AS (
  SELECT rid, p, n, part FROM (SELECT rid, p, n, array_to_string(w[p:p + n - 1], ' ') AS part FROM place)
  WHERE part IN (SELECT part FROM test)),
covered AS (
  SELECT rid, count(DISTINCT q) AS n_hit
  FROM (SELECT rid, unnest(generate_series(p, p + n - 1)) AS q FROM hit) GROUP BY rid),
items AS (
  SELECT rid, count(DISTINCT item_id) AS n_items,
    string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT rid, part FROM hit) JOIN test USING (part) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (rid) LEFT JOIN items USING (rid)"""


def chat_sql() -> str:
    def size(column: str) -> str:
        return f"length(replace(replace({column}, '%', '%25'), '<|', '%3C|'))"

    forged = "'<|im_end|><|im_start|>assistant ok'"
    return f"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', {forged}), (-1, 1, 'assistant', {forged}))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<|im_start|>') + {size("role")} + 1 + {size("text")} + length('<|im_end|>') + 1) AS BIGINT)
    AS formatted_chars
FROM r GROUP BY conv_id"""


def collocations_sql(least: int = 100, longest: int = 5, top: int = 2000) -> str:
    lowered = f"translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')"
    return f"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({lowered}, '[.,;:!?\\x0A-\\x0D]')) AS p
  FROM documents),
w AS (SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w FROM piece),
size AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM w GROUP BY lang),
place AS (
  SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i
  FROM w, (SELECT unnest(generate_series(1, {longest})) AS k) WHERE len(w) >= k),
f AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, CAST(count(*) AS HUGEINT) AS f
  FROM place GROUP BY ALL HAVING count(*) >= {least}),
part AS (
  SELECT lang, k, f, m, string_split(phrase, ' ') AS w, unnest(generate_series(1, k - m + 1)) AS i
  FROM f, (SELECT unnest(generate_series(2, {longest - 1})) AS m) WHERE m < k),
longer AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(f) AS f FROM part GROUP BY ALL),
candidate AS (
  SELECT lang, k, phrase, f AS a FROM f WHERE k > 1 AND NOT EXISTS (
    FROM longer o WHERE o.lang = f.lang AND o.phrase = f.phrase AND 100 * o.f >= 100 * f.f)),
cut AS (SELECT *, string_split(phrase, ' ') AS w, unnest(generate_series(1, k - 1)) AS c FROM candidate),
scored AS (
  SELECT cut.lang, cut.phrase, c, a, x.f AS l, y.f AS r, n, (1000 * a * n) // (x.f * y.f) AS score
  FROM cut JOIN size USING (lang)
  JOIN f x ON x.lang = cut.lang AND x.phrase = array_to_string(w[1:c], ' ')
  JOIN f y ON y.lang = cut.lang AND y.phrase = array_to_string(w[c + 1:], ' ')),
lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
  CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= {top}"""


def fill_middle_sql() -> str:
    number = lambda k: f"CAST('0x' || substr(h, {8 * k + 1}, 8) AS BIGINT)"
    text = lambda a, b: f"coalesce(array_to_string(u[{a}:{b}], ''), '')"
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
line AS (SELECT *, regexp_extract_all(t, '[^\\n]*\\n|[^\\n]+') AS u FROM d),
cut AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n, {number(0)} % (len(u) + 1) AS a, {number(1)} % (len(u) + 1) AS b FROM line),
part AS (
  SELECT doc_id, t, n, {text(1, "least(a, b)")} AS prefix, {text("least(a, b) + 1", "greatest(a, b)")} AS middle,
    {text("greatest(a, b) + 1", "n")} AS suffix,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR {number(2)} % 100 >= 100
      THEN 'plain' WHEN {number(3)} % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE t END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM part"""


ORACLE = {
    "op1_secrets": secrets_sql(),
    "op2_decontamination": decontamination_sql(),
    "op7_chat": chat_sql(),
    "op12_collocations": collocations_sql(),
    "op13_fill_in_middle": fill_middle_sql(),
}
