"""DuckDB oracle SQL of the change-event queries.

The events are rebuilt in SQL from ``customer`` and ``orders`` by the rules
of FIXTURES.md and kept long (one row per cell); statements are assembled
with ``string_agg(... ORDER BY name)``. No code is shared with the Spark side
except the table of malformed-event kinds, which is fixture data.
"""

from __future__ import annotations

from tidewater.sources.fixtures import BAD_KINDS


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _kind_case(field: int, null_ok: bool = False) -> str:
    parts = []
    for row in BAD_KINDS:
        v = row[field]
        if v is None:
            expr = "NULL"
        elif "{k}" in v:
            head, tail = v.split("{k}", 1)
            expr = f"{_q(head)} || CAST(c_custkey AS VARCHAR) || {_q(tail)}"
        else:
            expr = _q(v)
        parts.append(f"WHEN {row[0]} THEN {expr}")
    return "CASE kind " + " ".join(parts) + " END"


# A predicate: column = number or quoted text, once or more, joined by "and". Written here
# on its own, from SURVEY L2 / L6.
_NAME, _LIT = r"[A-Za-z_]\w*", r"(?:-?\d+(?:\.\d+)?|'(?:[^']|'')*')"
_TERM = rf"{_NAME}\s*=\s*{_LIT}"
_PRED = _q(rf"^\s*{_TERM}(?:\s+(?i:and)\s+{_TERM})*\s*$")
_NAMES = _q(rf"({_NAME})\s*=\s*{_LIT}")
_VALUES = _q(rf"{_NAME}\s*=\s*({_LIT})")


def _number(x: str) -> str:
    """A number's text without leading zeros and trailing zeros of a fraction."""
    lead = rf"regexp_replace({x}, '^(-?)0+([0-9])', '\1\2')"
    return (rf"CASE WHEN position('.' IN {lead}) > 0 THEN regexp_replace({lead}, '\.?0+$', '') "
            f"ELSE {lead} END")


def _value(x: str) -> str:
    return (f"CASE WHEN starts_with({x}, '''') THEN replace(substr({x}, 2, length({x}) - 2), "
            f"'''''', '''') ELSE {_number(x)} END")


def _keyed(x: str, tag: str) -> str:
    return (f"CASE WHEN {tag} NOT IN ('String', 'Date', 'Character') "
            rf"AND regexp_matches({x}, '^-?[0-9]+(\.[0-9]+)?$') THEN {_number(x)} ELSE {x} END")


_IDENT = "'^[A-Za-z_][A-Za-z0-9_]*$'"
_BLANK = r"'^[\x00-\x20]*\z'"


def _blank(x: str) -> str:
    return f"({x} IS NULL OR regexp_matches({x}, {_BLANK}))"


def _snake(x: str) -> str:
    return (f"CASE WHEN {x} = '' THEN '' ELSE array_to_string(list_transform(string_split({x}, ''), "
            "lambda ch: CASE WHEN upper(ch) = ch AND NOT regexp_matches(ch, '^[0-9]$') "
            "THEN '_' || lower(ch) ELSE lower(ch) END), '') END")


def _literal(tag: str, v: str) -> str:
    return (f"CASE WHEN {v} IS NULL THEN NULL WHEN {tag} IN ('String', 'Date', 'Character') "
            f"THEN '''' || replace({v}, '''', '''''') || '''' ELSE {v} END")


CDC_EVENTS = f"""
cdc_ev AS (
  SELECT 'cdc' AS topic, CAST(c_custkey % 4 AS INTEGER) AS "partition",
         CAST(c_custkey * 4 + CASE WHEN c_custkey % 20 = 0 THEN 2 ELSE 0 END AS BIGINT) AS "offset",
         CAST(CASE WHEN c_custkey % 20 = 0 THEN 2 ELSE 0 END AS BIGINT) AS batch_id,
         'customer' AS table_name, 'insert' AS action, '' AS where_text,
         ['id', 'custKey', 'custName', 'acctBal', 'mktSegment', 'remark'] AS names,
         ['Long:' || c_custkey, 'Long:' || c_custkey, 'String:' || c_name,
          'BigDecimal:' || CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR),
          'String:' || c_mktsegment, 'String: '] AS cell_texts
  FROM customer WHERE c_custkey % 20 <> 10
  UNION ALL
  SELECT 'cdc', CAST(o_custkey % 4 AS INTEGER), CAST(o_orderkey * 4 + 1 AS BIGINT), CAST(1 AS BIGINT),
         'customer', CASE WHEN o_orderkey % 50 = 0 THEN 'delete' ELSE 'update' END,
         'cust_key=' || o_custkey,
         ['acctBal', 'lastOrderDate', 'remark'],
         ['BigDecimal:' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR),
          'Date:' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), 'String:']
  FROM orders
  UNION ALL
  SELECT 'cdc2', CAST(c_custkey % 4 AS INTEGER), CAST(c_custkey * 4 AS BIGINT), CAST(0 AS BIGINT),
         'customer', 'insert', '', ['custKey', 'custName'], ['Long:' || c_custkey, 'String:second']
  FROM customer WHERE c_custkey % 40 = 3
  UNION ALL
  SELECT 'accounts', CAST(c_custkey % 4 AS INTEGER), CAST(c_custkey * 2 AS BIGINT), CAST(0 AS BIGINT),
         'account', 'insert', '', ['id', 'tenant', 'note'],
         ['Long:' || c_custkey, 'Integer:0' || (c_custkey % 3), 'String:opened']
  FROM customer WHERE c_custkey % 50 = 11
  UNION ALL
  SELECT 'accounts', CAST(c_custkey % 4 AS INTEGER), CAST(c_custkey * 2 + 1 AS BIGINT), CAST(1 AS BIGINT),
         'account', 'update', 'tenant=' || (c_custkey % 3) || ' AND id=' || c_custkey,
         ['note'], ['String:changed']
  FROM customer WHERE c_custkey % 50 = 11
  UNION ALL
  SELECT 'cdc', CAST(c_custkey % 4 AS INTEGER), CAST((c_custkey * 32 + kind) * 4 + 3 AS BIGINT), CAST(1 AS BIGINT),
         {_kind_case(1)}, {_kind_case(2)}, {_kind_case(3)},
         [{_kind_case(4)}], [{_kind_case(5)}]
  FROM (SELECT c_custkey, unnest(range({len(BAD_KINDS)})) AS kind FROM customer WHERE c_custkey % 50 = 7)
),
cdc_cell AS (
  SELECT topic, "partition", "offset", unnest(names) AS name, unnest(cell_texts) AS cell FROM cdc_ev
),
cdc_cell_v AS (
  SELECT topic, "partition", "offset", name, cell,
         CASE WHEN position(':' IN cell) > 0 THEN split_part(cell, ':', 1) END AS tag,
         CASE WHEN position(':' IN cell) > 0 THEN substr(cell, position(':' IN cell) + 1) END AS raw_full,
         string_split(cell, ':')[2] AS raw_first
  FROM cdc_cell
),
cdc_cells AS (
  SELECT topic, "partition", "offset", name, {_snake('name')} AS col, tag,
         CASE WHEN {_blank('raw_full')} THEN NULL ELSE raw_full END AS v_full,
         CASE WHEN {_blank('raw_first')} THEN NULL ELSE raw_first END AS v_first
  FROM cdc_cell_v
),
cdc_cells_lit AS (
  SELECT *, {_literal('tag', 'v_full')} AS lit_full, {_literal('tag', 'v_first')} AS lit_first
  FROM cdc_cells
),
cdc_agg AS (
  SELECT topic, "partition", "offset", count(*) AS n_cells,
         bool_and(regexp_matches(col, {_IDENT})) AS cols_ok,
         string_agg(col, ',' ORDER BY name) AS col_list,
         string_agg(lit_full, ',' ORDER BY name) AS val_list,
         string_agg(col || '=' || lit_full, ',' ORDER BY name) AS set_list,
         bool_or(true) AS any_cell
  FROM cdc_cells_lit WHERE name <> 'id' AND v_full IS NOT NULL
  GROUP BY topic, "partition", "offset"
),
cdc_key AS (
  SELECT topic, "partition", "offset",
         arg_min(kv, name) FILTER (WHERE col = 'cust_key') AS key_cust,
         arg_min(kv, name) FILTER (WHERE col = 'id') AS key_id,
         arg_min(kv, name) FILTER (WHERE col = 'tenant') AS key_tenant
  FROM (SELECT *, {_keyed('v_full', 'tag')} AS kv FROM cdc_cells_lit WHERE v_full IS NOT NULL)
  GROUP BY topic, "partition", "offset"
),
cdc_pred AS (
  SELECT topic, "partition", "offset",
         regexp_extract_all(where_text, {_NAMES}, 1) AS pnames,
         list_transform(regexp_extract_all(where_text, {_VALUES}, 1), lambda x: {_value('x')}) AS pvalues
  FROM cdc_ev WHERE regexp_matches(where_text, {_PRED})
),
cdc_agg_first AS (
  SELECT topic, "partition", "offset", count(*) AS n_cells,
         string_agg(col, ',' ORDER BY name) AS col_list,
         string_agg(lit_first, ',' ORDER BY name) AS val_list,
         string_agg(col || '=' || lit_first, ',' ORDER BY name) AS set_list
  FROM cdc_cells_lit WHERE name <> 'id' AND v_first IS NOT NULL
  GROUP BY topic, "partition", "offset"
),
cdc_pre AS (
  SELECT e.topic, e."partition", e."offset", e.batch_id, e.table_name, e.where_text,
         CASE WHEN e.action = 'insert' THEN 'insert' WHEN e.action = 'update' THEN 'update'
              ELSE 'ignored' END AS route,
         coalesce(a.n_cells, 0) AS n_cells, coalesce(a.cols_ok, true) AS cols_ok,
         a.col_list, a.val_list, a.set_list,
         CASE WHEN e.table_name = 'account' THEN k.key_id || ',' || k.key_tenant
              ELSE k.key_cust END AS key_cell,
         coalesce(f.n_cells, 0) AS n_first, f.col_list AS col_first, f.val_list AS val_first,
         f.set_list AS set_first,
         coalesce(CASE WHEN e.table_name = 'account' THEN list_sort(pnames) = ['id', 'tenant']
                       ELSE pnames = ['cust_key'] END, false) AS parsed,
         CASE WHEN e.table_name = 'account'
              THEN pvalues[list_position(pnames, 'id')] || ',' || pvalues[list_position(pnames, 'tenant')]
              ELSE pvalues[1] END AS pred_key
  FROM cdc_ev e
  LEFT JOIN cdc_key k ON k.topic = e.topic AND k."partition" = e."partition" AND k."offset" = e."offset"
  LEFT JOIN cdc_pred p ON p.topic = e.topic AND p."partition" = e."partition" AND p."offset" = e."offset"
  LEFT JOIN cdc_agg a ON a.topic = e.topic AND a."partition" = e."partition" AND a."offset" = e."offset"
  LEFT JOIN cdc_agg_first f ON f.topic = e.topic AND f."partition" = e."partition" AND f."offset" = e."offset"
),
cdc_prep AS (
  SELECT *,
    CASE WHEN route = 'ignored' THEN NULL
         WHEN NOT regexp_matches(table_name, {_IDENT}) OR NOT cols_ok THEN 'bad_identifier'
         WHEN route = 'insert' AND n_cells = 0 THEN 'no_columns'
         WHEN route = 'insert' AND key_cell IS NULL THEN 'missing_key'
         WHEN route = 'update' AND {_blank('where_text')} THEN 'missing_where'
         WHEN route = 'update' AND NOT parsed THEN 'unsupported_predicate'
         WHEN route = 'update' AND n_cells = 0 THEN 'no_columns'
    END AS reason,
    CASE WHEN route = 'insert' THEN key_cell
         WHEN route = 'update' AND parsed THEN pred_key
    END AS row_key
  FROM cdc_pre
),
cdc_stmt AS (
  SELECT *,
    CASE WHEN reason IS NULL AND route = 'insert' AND n_cells > 0
           THEN 'insert into ' || table_name || '(' || col_list || ') values(' || val_list || ')'
         WHEN reason IS NULL AND route = 'update' AND n_cells > 0
           THEN 'update ' || table_name || ' set ' || set_list || ' where ' || where_text
    END AS statement,
    CASE WHEN reason IS NULL AND route = 'insert' AND n_first > 0
           THEN 'insert into ' || table_name || '(' || col_first || ') values(' || val_first || ')'
         WHEN reason IS NULL AND route = 'update' AND n_first > 0
           THEN 'update ' || table_name || ' set ' || set_first || ' where ' || where_text
    END AS statement_compat
  FROM cdc_prep
)"""

_BEFORE = """((i.batch_id, i.topic, i."partition", i."offset")
             < (v.batch_id, v.topic, v."partition", v."offset"))"""

APPLY = f"""{CDC_EVENTS},
valid AS (
  SELECT topic, "partition", "offset", batch_id, table_name, row_key, route, statement
  FROM cdc_stmt WHERE reason IS NULL AND route <> 'ignored'
),
valid_ins AS (SELECT * FROM valid WHERE route = 'insert'),
st1 AS (
  SELECT v.*,
    CASE WHEN EXISTS (SELECT 1 FROM valid_ins i WHERE i.table_name = v.table_name
                      AND i.row_key = v.row_key AND {_BEFORE})
         THEN (CASE WHEN v.route = 'insert' THEN 'error' ELSE 'applied' END)
         ELSE (CASE WHEN v.route = 'insert' THEN 'applied' ELSE 'zero_rows' END)
    END AS first_status
  FROM valid v
),
nb AS (
  SELECT b.batch_id, (SELECT min(e.batch_id) FROM cdc_ev e WHERE e.batch_id > b.batch_id) AS next_batch
  FROM (SELECT DISTINCT batch_id FROM cdc_ev) b
),
st AS (
  SELECT v.*, nb.next_batch,
    CASE WHEN first_status <> 'zero_rows' THEN NULL
         WHEN EXISTS (SELECT 1 FROM valid_ins i WHERE i.table_name = v.table_name
                      AND i.row_key = v.row_key
                      AND (nb.next_batch IS NULL OR i.batch_id <= nb.next_batch)) THEN 'applied'
         ELSE 'dead_letter' END AS retry_status
  FROM st1 v JOIN nb ON nb.batch_id = v.batch_id
)"""

ORACLE = {
    "cdc_cells": f"""
WITH {CDC_EVENTS}
SELECT topic, "partition", "offset", name, col AS "column", tag AS type,
       v_full AS value_full, v_first AS value_first,
       lit_full AS literal_full, lit_first AS literal_first
FROM cdc_cells_lit WHERE name <> 'id'""",

    "cdc_statements": f"""
WITH {CDC_EVENTS}
SELECT topic, "partition", "offset", batch_id, route, statement, statement_compat
FROM cdc_stmt WHERE statement IS NOT NULL""",

    "cdc_routes": f"""
WITH {CDC_EVENTS}
SELECT batch_id, CASE WHEN action = 'insert' THEN 'insert' WHEN action = 'update' THEN 'update'
                      ELSE 'ignored' END AS route, count(*) AS events
FROM cdc_ev GROUP BY ALL""",

    "cdc_rejects": f"""
WITH {CDC_EVENTS}
SELECT topic, "partition", "offset", batch_id, route, reason
FROM cdc_prep WHERE reason IS NOT NULL""",

    "cdc_apply_status": f"""
WITH {APPLY}
SELECT batch_id, topic, "partition", "offset", 0 AS attempt, first_status AS status,
       CASE first_status WHEN 'error' THEN 'duplicate_key' WHEN 'zero_rows' THEN 'no_matching_row' END AS reason
FROM st
UNION ALL
SELECT batch_id, topic, "partition", "offset", 1, retry_status,
       CASE WHEN retry_status = 'dead_letter' THEN 'zero_rows_after_retry' END
FROM st WHERE retry_status IS NOT NULL
UNION ALL
SELECT batch_id, topic, "partition", "offset", 0,
       CASE WHEN route = 'ignored' THEN 'ignored' ELSE 'rejected' END, reason
FROM cdc_prep WHERE reason IS NOT NULL OR route = 'ignored'""",

    "cdc_final_state": f"""
WITH {APPLY},
applied AS (
  SELECT * FROM st WHERE first_status = 'applied' OR retry_status = 'applied'
),
cells AS (
  SELECT a.table_name, a.row_key AS key, c.col AS "column", c.tag AS type, c.v_full AS value,
         CASE WHEN a.route = 'update' THEN 1 ELSE 0 END AS is_upd, a.batch_id, a.topic, a."partition",
         a."offset"
  FROM applied a JOIN cdc_cells_lit c
    ON c.topic = a.topic AND c."partition" = a."partition" AND c."offset" = a."offset"
  WHERE c.name <> 'id' AND c.v_full IS NOT NULL
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY table_name, key, "column"
                               ORDER BY is_upd DESC, batch_id DESC, topic DESC, "partition" DESC, "offset" DESC) AS rn
  FROM cells
)
SELECT table_name, key, "column", type, value FROM ranked WHERE rn = 1""",

    "cdc_retry_outcome": f"""
WITH {APPLY}
SELECT batch_id, topic, "partition", "offset", next_batch AS retry_after_batch,
       CASE WHEN retry_status = 'applied' THEN 'applied_on_retry' ELSE 'dead_letter' END AS outcome,
       statement
FROM st WHERE first_status = 'zero_rows'""",

    "cdc_dead_letter": f"""
WITH {APPLY}
SELECT batch_id, topic, "partition", "offset", 0 AS attempt, 'error' AS reason, statement
FROM st WHERE first_status = 'error'
UNION ALL
SELECT batch_id, topic, "partition", "offset", 1, 'zero_rows_after_retry', statement
FROM st WHERE retry_status = 'dead_letter'""",

}

_WIDE = ("acct_bal", "cust_key", "cust_name", "last_order_date", "mkt_segment", "note")
ORACLE["cdc_target_rows"] = (
    "WITH fs AS (" + ORACLE["cdc_final_state"] + ")\nSELECT table_name, key, "
    + ", ".join(f"max(CASE WHEN \"column\" = '{c}' THEN value END) AS {c}" for c in _WIDE)
    + ", string_agg(DISTINCT \"column\", ',' ORDER BY \"column\") FILTER (WHERE \"column\" NOT IN "
    + str(_WIDE) + ") AS unlisted"
    + "\nFROM fs GROUP BY table_name, key")

# The target after each batch (version 2b): cells of a batch and of the retries that ran after it.
ORACLE["stream_cdc_versions"] = f"""
WITH {APPLY},
seen AS (
  SELECT *, CASE WHEN first_status = 'applied' THEN 2 * batch_id
                 ELSE coalesce(2 * next_batch, 2 * (SELECT max(batch_id) FROM cdc_ev) + 1) END AS shown
  FROM st WHERE first_status = 'applied' OR retry_status = 'applied'
),
cells AS (
  SELECT a.shown, a.table_name, a.row_key AS key, c.col, c.tag, c.v_full,
         CASE WHEN a.route = 'update' THEN 1 ELSE 0 END AS is_upd, a.batch_id, a.topic, a."partition", a."offset"
  FROM seen a JOIN cdc_cells_lit c
    ON c.topic = a.topic AND c."partition" = a."partition" AND c."offset" = a."offset"
  WHERE c.name <> 'id' AND c.v_full IS NOT NULL
),
versions AS (
  SELECT DISTINCT 2 * batch_id AS v FROM cdc_ev
  UNION ALL SELECT 2 * max(batch_id) + 1 FROM cdc_ev
),
states AS (
  SELECT v, table_name, key, col, tag, v_full FROM versions JOIN cells ON shown <= v
  QUALIFY row_number() OVER (PARTITION BY v, table_name, key, col
                             ORDER BY is_upd DESC, batch_id DESC, topic DESC, "partition" DESC, "offset" DESC) = 1
),
follows AS (SELECT v, (SELECT max(w.v) FROM versions w WHERE w.v < versions.v) AS prev FROM versions)
SELECT CAST(s.v AS BIGINT) AS version, s.table_name, count(*) AS cells
FROM states s JOIN follows f ON f.v = s.v
WHERE NOT EXISTS (SELECT 1 FROM states o WHERE o.v = f.prev AND o.table_name = s.table_name AND o.key = s.key
                  AND o.col = s.col AND o.tag = s.tag AND o.v_full = s.v_full)
GROUP BY ALL"""
