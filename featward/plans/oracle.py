"""The same queries as SQL over the given tables, written independently of the DataFrame code."""

ORIGINAL = """original AS (
  SELECT o_orderkey AS id,
         CASE WHEN o_orderkey % 83 = 0 THEN NULL ELSE o_orderstatus END AS status,
         CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) AS price
  FROM orders)"""


def _restated(key: str) -> str:
    return f"""restated AS (
  SELECT {key} AS id,
         CASE WHEN o_orderkey % 79 = 0 THEN 'X' ELSE o_orderstatus END AS status,
         CAST(CAST(CASE WHEN o_orderkey % 97 = 0 THEN CAST(o_totalprice AS DECIMAL(15,2)) + 1
                        WHEN o_orderkey % 89 = 0 THEN NULL
                        ELSE CAST(o_totalprice AS DECIMAL(15,2)) END AS DECIMAL(15,2)) AS VARCHAR) AS price
  FROM orders)"""


RESTATED = _restated("CASE WHEN o_orderkey % 101 = 0 THEN -o_orderkey - 1 ELSE o_orderkey END")
VERSIONS = f"WITH {ORIGINAL}, {RESTATED}"
SAME_KEYS = f"WITH {ORIGINAL}, {_restated('o_orderkey')}"

REPORT = """
SELECT o.id AS id,
       concat_ws(', ',
         CASE WHEN o.price <> n.price THEN 'price: ' || o.price || ' -> ' || n.price END,
         CASE WHEN o.status <> n.status THEN 'status: ' || o.status || ' -> ' || n.status END) AS differences
FROM original o JOIN restated n ON o.id = n.id
WHERE o.price <> n.price OR o.status <> n.status"""

UNMATCHED = """
SELECT o.id AS id_original, CAST(NULL AS BIGINT) AS id_new, false AS id_is_different,
       o.price AS price_original, CAST(NULL AS VARCHAR) AS price_new, false AS price_is_different,
       o.status AS status_original, CAST(NULL AS VARCHAR) AS status_new, false AS status_is_different,
       CAST(1 AS BIGINT) AS n_original, CAST(0 AS BIGINT) AS n_new
FROM original o
WHERE NOT EXISTS (SELECT 1 FROM {other} n WHERE n.id = o.id AND n.price = o.price AND n.status = o.status)
UNION ALL
SELECT NULL, n.id, false, NULL, n.price, false, NULL, n.status, false, 0, 1
FROM {other} n
WHERE NOT EXISTS (SELECT 1 FROM original o WHERE n.id = o.id AND n.price = o.price AND n.status = o.status)"""

MATCHED = """
UNION ALL
SELECT o.id, n.id, false, o.price, n.price, false, o.status, n.status, false, 1, 1
FROM original o JOIN restated n ON n.id = o.id AND n.price = o.price AND n.status = o.status"""

NULL_SAFE_MATCH = """
SELECT o.id AS id_original, n.id AS id_new, false AS id_is_different,
       o.price AS price_original, n.price AS price_new, false AS price_is_different,
       o.status AS status_original, n.status AS status_new, false AS status_is_different,
       CAST(o.id IS NOT NULL AS BIGINT) AS n_original, CAST(n.id IS NOT NULL AS BIGINT) AS n_new
FROM original o FULL JOIN restated n
  ON n.id = o.id AND n.price IS NOT DISTINCT FROM o.price AND n.status IS NOT DISTINCT FROM o.status"""

POSITIONS = """,
a AS (SELECT *, row_number() OVER (ORDER BY id) - 1 AS pos FROM original),
b AS (SELECT *, row_number() OVER (ORDER BY id) - 1 AS pos FROM restated)
SELECT a.pos AS pos, 'status' AS column_name, a.status AS "self", b.status AS "other"
FROM a JOIN b ON a.pos = b.pos WHERE a.status IS DISTINCT FROM b.status
UNION ALL
SELECT a.pos, 'price', a.price, b.price
FROM a JOIN b ON a.pos = b.pos WHERE a.price IS DISTINCT FROM b.price"""

LOGISTIC_P = """round(CAST(1 AS DOUBLE) / (CAST(1 AS DOUBLE) + exp(-(
  CAST(0.04 AS DOUBLE) * l_quantity - CAST(12 AS DOUBLE) * l_discount + CAST(5 AS DOUBLE) * l_tax
  - CAST(1 AS DOUBLE)))), 6)"""

TREES = """
SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax,
       round(CAST(1 AS DOUBLE) / (CAST(1 AS DOUBLE) + exp(-(
         CASE WHEN l_quantity < CAST(25 AS DOUBLE)
              THEN CASE WHEN l_discount < CAST(0.05 AS DOUBLE) THEN CAST(-0.75 AS DOUBLE)
                        ELSE CAST(0.5 AS DOUBLE) END
              ELSE CAST(1.25 AS DOUBLE) END
         + CASE WHEN l_tax < CAST(0.04 AS DOUBLE) THEN CAST(-0.5 AS DOUBLE)
                ELSE CAST(0.25 AS DOUBLE) END))), 6) AS "PREDICTED_PROBA"
FROM lineitem"""


def _bin(p: str, default: str) -> str:
    """Bins open at the low end, but for the first: the same as the last of the closed bins."""
    return f"""CASE WHEN {p} >= CAST(0.91 AS DOUBLE) AND {p} <= CAST(1.0 AS DOUBLE) THEN 10
            WHEN {p} < CAST(0 AS DOUBLE) OR {p} > CAST(1 AS DOUBLE) OR {p} IS NULL THEN {default}
            ELSE 1 + CAST({p} >= CAST(0.10 AS DOUBLE) AS INTEGER) + CAST({p} >= CAST(0.15 AS DOUBLE) AS INTEGER)
                   + CAST({p} >= CAST(0.26 AS DOUBLE) AS INTEGER) + CAST({p} >= CAST(0.40 AS DOUBLE) AS INTEGER)
                   + CAST({p} >= CAST(0.55 AS DOUBLE) AS INTEGER) + CAST({p} >= CAST(0.66 AS DOUBLE) AS INTEGER)
                   + CAST({p} >= CAST(0.75 AS DOUBLE) AS INTEGER) + CAST({p} >= CAST(0.83 AS DOUBLE) AS INTEGER)
       END"""


SCORED = f"""
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS "CUST_ID",
       {{blank}} AS "AA_NODE_PATH_ATTR_CHAR", p AS "PREDICTED_PROBA", CAST(b AS DOUBLE) AS "BIN",
       'C' || CAST(b AS VARCHAR) AS "CLASS_ID",
       strftime(strptime('20240305', '%Y%m%d'), '%d-%b-%Y') AS "PRCSNG_DT", '71621' AS "SCNRO_ID",
       {{blank}} AS "DECISION_PATH_FEATURE_LIST"
FROM (SELECT l_orderkey, l_linenumber, p, {_bin('p', '1')} AS b
      FROM (SELECT l_orderkey, l_linenumber, {LOGISTIC_P} AS p FROM lineitem))"""

EVENT_FILES = """
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, event_type, props,
       strftime(ts, '%Y%m%d') AS prcsng_dt
FROM events"""

NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"

def _many_trees(trees: int, depth: int) -> str:
    """Every line walks down every tree: from node n to 2 n, or to 2 n + 1 where the value is not below."""
    rows = f"SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax, t, CAST(1 AS BIGINT) AS n FROM lineitem, range({trees}) r(t)"
    below = """CASE (t * 7 + n * 3 + n // 4) % 3
        WHEN 0 THEN l_quantity < 1 + (t * 13 + n * 17) % 50
        WHEN 1 THEN l_discount < CAST((t * 5 + n * 11) % 11 AS DOUBLE) / 100
        ELSE l_tax < CAST((t * 3 + n * 7) % 9 AS DOUBLE) / 100 END"""
    for _ in range(depth):
        rows = f"SELECT * REPLACE (2 * n + CASE WHEN {below} THEN 0 ELSE 1 END AS n) FROM ({rows})"
    return f"""
SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax,
       round(CAST(1 AS DOUBLE) / (CAST(1 AS DOUBLE) + exp(-margin)), 6) AS "PREDICTED_PROBA"
FROM (SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax,
             sum(CAST((t * 31 + n * 57) % 257 - 128 AS DOUBLE) / 1024) AS margin
      FROM ({rows}) GROUP BY ALL)"""


ORACLE: dict[str, str] = {
    "ingest_dated_csv": EVENT_FILES,
    "ingest_drifting_headers": """
SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, strftime(ts, '%Y%m%d') AS prcsng_dt,
       CASE WHEN day(ts) % 3 <> 2 THEN CAST(user_id AS VARCHAR) END AS user_id,
       CASE WHEN day(ts) % 3 <> 2 THEN nullif(props, '') END AS props,
       CASE WHEN day(ts) % 3 = 2 THEN CAST(length(props) AS VARCHAR) END AS "length"
FROM events""",
    "ingest_to_table": EVENT_FILES,
    "list_dated_files": "SELECT DISTINCT strftime(ts, '%Y%m%d') AS prcsng_dt FROM events",
    "list_dated_file_sizes": """
SELECT strftime(ts, '%Y%m%d') AS prcsng_dt, CAST(count(*) * 20 AS BIGINT) AS bytes, true AS as_expected
FROM events GROUP BY 1""",
    "read_date_list": EVENT_FILES,
    "align_columns": """
SELECT o_orderkey AS id, CAST(o_totalprice AS DECIMAL(15,2)) AS total_price, 'a' AS side FROM orders
UNION ALL
SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(15,2)), 'b' FROM orders""",
    "diff_cells": f"""{VERSIONS}
SELECT o.id AS id, 'status' AS column_name, o.status AS original_value, n.status AS new_value
FROM original o JOIN restated n ON o.id = n.id WHERE o.status <> n.status
UNION ALL
SELECT o.id, 'price', o.price, n.price
FROM original o JOIN restated n ON o.id = n.id WHERE o.price <> n.price""",
    "diff_cells_nullsafe": f"""{VERSIONS},
both_sides AS (
  SELECT coalesce(o.id, n.id) AS id, o.status AS os, n.status AS ns, o.price AS op, n.price AS np,
         CASE WHEN o.id IS NULL THEN 'added' WHEN n.id IS NULL THEN 'removed' ELSE 'changed' END AS change
  FROM original o FULL JOIN restated n ON o.id = n.id)
SELECT id, 'status' AS column_name, os AS original_value, ns AS new_value, change
FROM both_sides WHERE os IS DISTINCT FROM ns
UNION ALL
SELECT id, 'price', op, np, change FROM both_sides WHERE op IS DISTINCT FROM np
UNION ALL
SELECT id, NULL, NULL, NULL, change FROM both_sides
WHERE change <> 'changed' AND os IS NULL AND ns IS NULL AND op IS NULL AND np IS NULL""",
    "diff_cells_conversations": """
WITH new AS (
  SELECT conv_id, CASE WHEN role = 'system' THEN turn + 100 ELSE turn END AS turn, role,
         CASE WHEN role = 'assistant' AND turn > 2 THEN "text" || ' (edited)' ELSE "text" END AS body
  FROM conversations),
both_sides AS (
  SELECT coalesce(o.conv_id, n.conv_id) AS conv_id, coalesce(o.turn, n.turn) AS turn,
         o.role AS orole, n.role AS nrole, o."text" AS otext, n.body AS ntext,
         CASE WHEN o.conv_id IS NULL THEN 'added' WHEN n.conv_id IS NULL THEN 'removed'
              ELSE 'changed' END AS change
  FROM conversations o FULL JOIN new n ON o.conv_id = n.conv_id AND o.turn = n.turn)
SELECT conv_id, turn, 'role' AS column_name, orole AS original_value, nrole AS new_value, change
FROM both_sides WHERE orole IS DISTINCT FROM nrole
UNION ALL
SELECT conv_id, turn, 'text', otext, ntext, change FROM both_sides WHERE otext IS DISTINCT FROM ntext""",
    "diff_cells_repeated_keys": """
WITH o AS (SELECT o_orderkey AS id, o_orderstatus AS s, CAST(o_orderdate AS DATE) AS d FROM orders),
n AS (SELECT CASE WHEN l_orderkey % 50 = 0 THEN -l_orderkey ELSE l_orderkey END AS id, l_linestatus AS s,
             CAST(l_shipdate AS DATE) AS d FROM lineitem),
x AS (SELECT coalesce(o.id, n.id) AS id, o.s AS os, n.s AS ns, CAST(o.d AS VARCHAR) AS od, CAST(n.d AS VARCHAR) AS nd,
             CASE WHEN o.id IS NULL THEN 'added' WHEN n.id IS NULL THEN 'removed' ELSE 'changed' END AS change
      FROM o FULL JOIN n ON o.id = n.id)
SELECT id, 'o_orderstatus' AS column_name, os AS original_value, ns AS new_value, change
FROM x WHERE os IS DISTINCT FROM ns
UNION ALL
SELECT id, 'day', od, nd, change FROM x WHERE od IS DISTINCT FROM nd""",
    "diff_cells_digest_first": """
WITH n AS (SELECT CASE WHEN doc_id % 103 = 0 THEN -doc_id - 1 ELSE doc_id END AS doc_id,
                  CASE WHEN doc_id % 29 = 0 THEN text || ' (edited)' ELSE text END AS text,
                  CASE WHEN doc_id % 37 <> 0 THEN lang END AS lang, source,
                  CASE WHEN doc_id % 41 = 0 THEN n_chars + 1 ELSE n_chars END AS n_chars FROM documents),
x AS (SELECT coalesce(o.doc_id, n.doc_id) AS doc_id, o.text AS ot, n.text AS nt, o.lang AS ol, n.lang AS nl,
             o.source AS os, n.source AS ns, CAST(o.n_chars AS VARCHAR) AS oc, CAST(n.n_chars AS VARCHAR) AS nc,
             CASE WHEN o.doc_id IS NULL THEN 'added' WHEN n.doc_id IS NULL THEN 'removed' ELSE 'changed' END AS change
      FROM documents o FULL JOIN n ON o.doc_id = n.doc_id)
SELECT doc_id, 'text' AS column_name, ot AS original_value, nt AS new_value, change FROM x WHERE ot IS DISTINCT FROM nt
UNION ALL
SELECT doc_id, 'lang', ol, nl, change FROM x WHERE ol IS DISTINCT FROM nl
UNION ALL
SELECT doc_id, 'source', os, ns, change FROM x WHERE os IS DISTINCT FROM ns
UNION ALL
SELECT doc_id, 'n_chars', oc, nc, change FROM x WHERE oc IS DISTINCT FROM nc""",
    "diff_report_digest_first": VERSIONS + REPORT,
    "diff_bucketed": f"""{VERSIONS}
SELECT o.id AS id, 'status' AS column_name, o.status AS original_value, n.status AS new_value
FROM original o JOIN restated n ON o.id = n.id WHERE o.status <> n.status
UNION ALL
SELECT o.id, 'price', o.price, n.price
FROM original o JOIN restated n ON o.id = n.id WHERE o.price <> n.price""",
    "diff_flags_price": f"""{VERSIONS}
SELECT coalesce(o.id, n.id) AS id, o.price AS original_value, n.price AS new_value,
       CASE WHEN o.price <> n.price THEN 'DIFFERENT' ELSE 'SAME' END AS diff
FROM original o FULL JOIN restated n ON o.id = n.id""",
    "diff_report": VERSIONS + REPORT,
    "diff_report_nullsafe": f"""{VERSIONS}
SELECT coalesce(o.id, n.id) AS id,
       concat_ws(', ',
         CASE WHEN o.price IS DISTINCT FROM n.price
              THEN 'price: ' || coalesce(o.price, 'NULL') || ' -> ' || coalesce(n.price, 'NULL') END,
         CASE WHEN o.status IS DISTINCT FROM n.status
              THEN 'status: ' || coalesce(o.status, 'NULL') || ' -> ' || coalesce(n.status, 'NULL') END)
         AS differences,
       CASE WHEN o.id IS NULL THEN 'added' WHEN n.id IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM original o FULL JOIN restated n ON o.id = n.id
WHERE o.id IS NULL OR n.id IS NULL OR o.price IS DISTINCT FROM n.price OR o.status IS DISTINCT FROM n.status""",
    "diff_report_csv": f"{VERSIONS} SELECT differences FROM ({REPORT})",
    "match_rows": VERSIONS + UNMATCHED.format(other="restated") + MATCHED,
    "match_rows_nullsafe": VERSIONS + NULL_SAFE_MATCH,
    "match_rows_unmatched": VERSIONS + UNMATCHED.format(other="restated"),
    "match_rows_unmatched_self": f"WITH {ORIGINAL}" + UNMATCHED.format(other="original"),
    "row_multiset_diff": f"""{VERSIONS}
SELECT id, price, status, 'original' AS side, count(*) AS n_rows
FROM (SELECT id, price, status FROM original EXCEPT ALL SELECT id, price, status FROM restated)
GROUP BY id, price, status
UNION ALL
SELECT id, price, status, 'new', count(*)
FROM (SELECT id, price, status FROM restated EXCEPT ALL SELECT id, price, status FROM original)
GROUP BY id, price, status""",
    "row_multiset_diff_copies": """
WITH flags AS (SELECT l_returnflag AS flag, l_linestatus AS status FROM lineitem),
turned AS (SELECT l_returnflag AS flag,
                  CASE WHEN l_quantity < CAST(10 AS DOUBLE) THEN 'X' ELSE l_linestatus END AS status
           FROM lineitem)
SELECT flag, status, 'original' AS side, count(*) AS n_rows
FROM (SELECT * FROM flags EXCEPT ALL SELECT * FROM turned) GROUP BY flag, status
UNION ALL
SELECT flag, status, 'new', count(*)
FROM (SELECT * FROM turned EXCEPT ALL SELECT * FROM flags) GROUP BY flag, status""",
    "row_multiset_diff_documents": """
WITH o AS (SELECT lang, "text" FROM documents),
n AS (SELECT CASE WHEN source = 'src3' THEN 'xx' ELSE lang END AS lang, "text" FROM documents)
SELECT lang, "text", 'original' AS side, count(*) AS n_rows
FROM (SELECT * FROM o EXCEPT ALL SELECT * FROM n) GROUP BY lang, "text"
UNION ALL
SELECT lang, "text", 'new', count(*) FROM (SELECT * FROM n EXCEPT ALL SELECT * FROM o) GROUP BY lang, "text"
""",
    "compare_positional": SAME_KEYS + POSITIONS,
    "compare_csv": SAME_KEYS + POSITIONS,
    "compare_csv_inferred": """
WITH x AS (SELECT o_orderkey AS k, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos, o_orderstatus AS s FROM orders),
cells AS (
  SELECT 'price' AS column_name, pos FROM x WHERE k % 11 = 0
  UNION ALL
  SELECT 'status', pos FROM x WHERE k % 7 <> 0 AND k % 13 = 0 AND s <> 'x')
SELECT column_name, count(*) AS cells, CAST(sum(pos) AS BIGINT) AS positions FROM cells GROUP BY column_name""",
    "compare_csv_line_breaks": """
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS pos, doc_id, text FROM documents)
SELECT pos, 'text' AS column_name, text AS self, text || chr(10) || '"edited",' || chr(10) || 'twice' AS other
FROM d WHERE doc_id % 7 = 0 AND text IS NOT NULL""",
    "frames_equal": f"""{VERSIONS}
SELECT 'original, restated' AS pair,
       NOT EXISTS (SELECT * FROM original EXCEPT ALL SELECT * FROM restated)
       AND NOT EXISTS (SELECT * FROM restated EXCEPT ALL SELECT * FROM original) AS is_same
UNION ALL
SELECT 'original, original', NOT EXISTS (SELECT * FROM original EXCEPT ALL SELECT * FROM original)""",
    "frames_equal_ordered": f"""{SAME_KEYS},
a AS (SELECT *, row_number() OVER (ORDER BY id) AS pos FROM original),
b AS (SELECT *, row_number() OVER (ORDER BY id) AS pos FROM restated)
SELECT 'original, restated' AS pair, count(*) = 0 AS is_same
FROM a JOIN b ON a.pos = b.pos
WHERE a.id <> b.id OR a.status IS DISTINCT FROM b.status OR a.price IS DISTINCT FROM b.price
UNION ALL
SELECT 'original, original', count(*) = 0
FROM a JOIN a AS c ON a.pos = c.pos
WHERE a.id <> c.id OR a.status IS DISTINCT FROM c.status OR a.price IS DISTINCT FROM c.price""",
    "ordinal": """
SELECT o_custkey, o_orderkey, row_number() OVER (ORDER BY o_custkey, o_orderkey) - 1 AS pos FROM orders""",
    "score_logistic": f"""
SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax, {LOGISTIC_P} AS "PREDICTED_PROBA"
FROM lineitem""",
    "score_trees": TREES,
    "score_trees_udf": TREES,
    "score_trees_many": _many_trees(500, 6),
    "score_classifier": f"""
SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax, {LOGISTIC_P} AS "PREDICTED_PROBA"
FROM lineitem""",
    "score_trees_missing": TREES.replace("l_discount < CAST", "d IS NULL OR d < CAST")
    .replace("l_tax < CAST", "t IS NULL OR t < CAST")
    .replace("l_discount, l_tax,", "d AS l_discount, t AS l_tax,")
    .replace(
        "FROM lineitem",
        "FROM (SELECT *, CASE WHEN l_linenumber % 2 = 0 THEN l_discount END AS d, "
        "CASE WHEN l_orderkey % 3 <> 0 THEN l_tax END AS t FROM lineitem)",
    ),
    "assign_segment_bin": """
WITH l AS (SELECT l_orderkey, l_linenumber, l_suppkey, (l_orderkey * 7 + l_linenumber * 13) % 1101 AS m FROM lineitem),
bins AS (SELECT s_suppkey, place, place * 10 + s_suppkey % 7 AS low, place * 10 + s_suppkey % 7 + 4 + place * 5 % 17 AS high,
                CAST(place * 37 % 100 + 2 AS INTEGER) AS number
         FROM supplier, range(100) AS r(place) WHERE s_suppkey % 9 <> 4),
found AS (SELECT l_suppkey, m, arg_max(number, place) AS number
          FROM (SELECT DISTINCT l_suppkey, m FROM l) JOIN bins ON s_suppkey = l_suppkey AND m BETWEEN low AND high
          GROUP BY l_suppkey, m)
SELECT l_orderkey, l_linenumber, l.l_suppkey AS l_suppkey, CAST(l.m AS DOUBLE) / CAST(1000 AS DOUBLE) AS "PREDICTED_PROBA",
       coalesce(number, 1) AS "BIN"
FROM l LEFT JOIN found ON l.l_suppkey = found.l_suppkey AND l.m = found.m""",
    "assign_bin": f"""
SELECT l_orderkey, l_linenumber, p AS "PREDICTED_PROBA", {_bin('p', '1')} AS "BIN"
FROM (SELECT l_orderkey, l_linenumber,
             CAST((l_orderkey * 7 + l_linenumber * 13) % 1101 AS DOUBLE) / CAST(1000 AS DOUBLE) AS p
      FROM lineitem)""",
    "class_id": f"""
SELECT l_orderkey, l_linenumber, p AS "PREDICTED_PROBA", b AS "BIN", 'C' || CAST(b AS VARCHAR) AS "CLASS_ID"
FROM (SELECT l_orderkey, l_linenumber, p, {_bin('p', 'NULL')} AS b
      FROM (SELECT l_orderkey, l_linenumber,
                   CASE WHEN l_discount > CAST(0 AS DOUBLE)
                        THEN round(l_discount * CAST(10 AS DOUBLE), 6) END AS p
            FROM lineitem))""",
    "scored_output": SCORED.format(blank="''"),
    "scored_output_csv": SCORED.format(blank="CAST(NULL AS VARCHAR)"),
    "non_numeric_values": f"""
WITH mixed AS (
  SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN p_brand WHEN p_partkey % 7 = 0 THEN ''
    WHEN p_partkey % 11 = 0 THEN ' 12 ' WHEN p_partkey % 13 = 0 THEN '1e3'
    WHEN p_partkey % 17 = 0 THEN NULL WHEN p_partkey % 19 = 0 THEN '1,000'
    WHEN p_partkey % 23 = 0 THEN 'NaN' ELSE CAST(p_size AS VARCHAR) END AS v
  FROM part)
SELECT p_partkey, v, v AS "value", 'Non-numeric value found: ' || v AS message
FROM mixed WHERE v <> '' AND NOT regexp_matches(trim(v), '{NUMBER}')""",
    "non_numeric_documents": f"""
SELECT doc_id, "text" AS "value", 'Non-numeric value found: ' || "text" AS message
FROM documents WHERE "text" <> '' AND NOT regexp_matches(trim("text"), '{NUMBER}')""",
    "non_numeric_page_numbers": f"""
WITH p AS (SELECT page_id, regexp_extract(url, '([^/?#]*)/?([?#].*)?$', 1) AS step FROM pages)
SELECT page_id, step, step AS "value", 'Non-numeric value found: ' || step AS message
FROM p WHERE step <> '' AND NOT regexp_matches(trim(step), '{NUMBER}')""",
    "delimited_roundtrip": """
SELECT o_orderkey AS id,
       CASE WHEN o_orderkey % 3 = 0 THEN '' WHEN o_orderkey % 5 = 0 THEN NULL
            WHEN o_orderkey % 7 = 0 THEN o_orderpriority || '~' || o_orderstatus
            ELSE o_orderpriority END AS note
FROM orders""",
    "overwrite_table": f"{VERSIONS} SELECT id, status, price FROM restated",
    "read_lookback_dates": f"""
SELECT * FROM ({EVENT_FILES}) WHERE prcsng_dt BETWEEN '20240109' AND '20240115'""",
    "lookback_select": """
SELECT event_id, user_id, event_type FROM events
WHERE CAST(ts AS DATE) > DATE '2024-01-08' AND CAST(ts AS DATE) <= DATE '2024-01-15'
  AND user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
}
