"""Independent DuckDB SQL for the scenarios in ``scenarios.py``.

The oracle states each check the brute-force way the original framework
did -- a FULL OUTER JOIN (or a CROSS JOIN) of the two sides with a status
CASE per joined pair -- so it shares no logic with the Spark operators
(which count through collapsed multisets).  Only the oracle builds SQL text.
"""

from __future__ import annotations

from parity.plans.scenarios import (
    CUSTOMER_NULL_KEYS_SQL, DEST_ORDERS_SQL, HOT_LINES_OPEN_SQL, HOT_LINES_SQL, LINES_AS_DECIMAL_SQL, LINES_AS_TEXT_SQL, ORDERS_AS_INT_SQL,
    ORDERS_AS_TEXT_SQL, ORDERS_BY_PRIORITY_SQL, ORDERS_MOVED_SQL, ORDERS_SHIFTED_SQL, LINESTATUS_WITH_NULLS_SQL, NATION_RENAMED_SQL, NATION_SUBSET_SQL,
    SEGMENT_WITH_NULLS_SQL, UNION_TRIM_SQL, UNION_TRIM_SRC_FILTER,
)

_MATCH, _NO, _A, _B = "'MATCH'", "'NO MATCH'", "'NO MATCH @ ONLY TABELA A'", "'NO MATCH @ ONLY TABELA B'"


def _kt(col: str, name: str | None = None) -> str:
    name = name or col.split(".")[-1]
    return (f"CASE WHEN {col} IS NULL THEN '{name} IS NULL' ELSE '{name}=''' || "
            f"replace(CAST({col} AS VARCHAR), '''', '''''') || '''' END")


def _ktext(cols: list[str], sep: str) -> str:
    return f" || '{sep}' || ".join(_kt(c) for c in cols)


def _joined(src: str, dest: str, on: list[tuple[str, str]], pairs: list[tuple[str, str]],
            mode: str = "content") -> str:
    """SELECT of the full outer join with <c>_src / <c>_dest, status, side."""
    sel = []
    for a, b in pairs:
        sel += [f"s.{a} AS {a}_src", f"d.{b} AS {b}_dest"]
    diff = " OR ".join(f"s.{a} IS DISTINCT FROM d.{b}" for a, b in pairs)
    dnull = " AND ".join(f"d.{b} IS NULL" for _, b in pairs)
    snull = " AND ".join(f"s.{a} IS NULL" for a, _ in pairs)
    status = (f"CASE WHEN {diff} THEN {_NO} WHEN {dnull} THEN {_A} WHEN {snull} THEN {_B} ELSE {_MATCH} END"
              if mode == "content" else
              f"CASE WHEN {dnull} THEN {_A} WHEN {snull} THEN {_B} ELSE {_MATCH} END")
    cond = " AND ".join(f"s.{a} = d.{b}" for a, b in on)
    return (f"SELECT {', '.join(sel)}, s.__p AS __sp, d.__p AS __dp, {status} AS status, "
            f"CASE WHEN s.__p AND d.__p THEN 'both' WHEN s.__p THEN 'src' ELSE 'dest' END AS side "
            f"FROM (SELECT *, TRUE AS __p FROM ({src}) x) s FULL OUTER JOIN "
            f"(SELECT *, TRUE AS __p FROM ({dest}) y) d ON {cond}")


def _crossed(src: str, dest: str, pairs: list[tuple[str, str]]) -> str:
    sel = []
    for a, b in pairs:
        sel += [f"s.{a} AS {a}_src", f"d.{b} AS {b}_dest"]
    diff = " OR ".join(f"s.{a} IS DISTINCT FROM d.{b}" for a, b in pairs)
    return (f"SELECT {', '.join(sel)}, CASE WHEN {diff} THEN {_NO} ELSE {_MATCH} END AS status, "
            f"'both' AS side FROM ({src}) s CROSS JOIN ({dest}) d")


def _cols(pairs):
    out = []
    for a, b in pairs:
        out += [f"{a}_src", f"{b}_dest"]
    return ", ".join(out)


def _summary(j: str) -> str:
    return f"SELECT status, side, COUNT(*) AS n FROM ({j}) j GROUP BY status, side"


def _verdict(j: str, params: str = "N/A") -> str:
    return (f"SELECT n_differences, CASE WHEN n_differences > 0 THEN 'NOK' ELSE 'OK' END AS result, "
            f"'{params}' AS execution_parameter FROM (SELECT COUNT(*) FILTER (WHERE status <> 'MATCH') "
            f"AS n_differences FROM ({j}) j) v")


def _volume(src_count_sql: str, dest_count_sql: str, params: str = "N/A") -> str:
    params = params.replace("'", "''")
    return (f"SELECT s.src_count, d.dest_count, CASE WHEN s.src_count = d.dest_count THEN 'OK' ELSE 'NOK' END "
            f"AS result, '{params}' AS execution_parameter FROM ({src_count_sql}) s, ({dest_count_sql}) d")


def _unparen(sql: str) -> str:
    s = sql.strip()
    return s[1:-1] if s.startswith("(") and s.endswith(")") else s


FLAGSHIP = _joined("SELECT o_orderkey, o_orderstatus FROM orders", DEST_ORDERS_SQL,
                   [("o_orderkey", "o_orderkey")],
                   [("o_orderkey", "o_orderkey"), ("o_orderstatus", "o_orderstatus")])
FLAGSHIP_COLS = _cols([("o_orderkey", "o_orderkey"), ("o_orderstatus", "o_orderstatus")])

_SAME_NAMES = "SELECT o_orderkey, o_custkey + 1 AS o_custkey_1, o_custkey - 1 AS o_custkey_1_2, o_orderstatus, o_orderstatus AS o_orderstatus_2 FROM {}"
_SAME_PAIRS = [(c, c) for c in ("o_orderkey", "o_custkey_1", "o_custkey_1_2", "o_orderstatus", "o_orderstatus_2")]
_SAME = _joined(_SAME_NAMES.format("orders"), _SAME_NAMES.format(ORDERS_MOVED_SQL), [("o_orderkey", "o_orderkey")], _SAME_PAIRS)

_FINGERPRINTS = " UNION ALL ".join(f"SELECT '{name}' AS copy, * FROM ({_verdict(j)}) v" for name, j in [
    ("equal", _joined("SELECT o_orderkey, o_orderstatus FROM orders", "SELECT o_orderkey, o_orderstatus FROM orders",
                      [("o_orderkey", "o_orderkey")], [(c, c) for c in ("o_orderkey", "o_orderstatus")])),
    ("faulty", FLAGSHIP),
    ("repeated", _joined("SELECT l_orderkey, l_returnflag FROM lineitem", "SELECT l_orderkey, l_returnflag FROM lineitem",
                         [("l_orderkey", "l_orderkey")], [("l_returnflag", "l_returnflag")]))])

_CROSS_REPORT = """WITH s AS (SELECT o_orderstatus, o_orderkey, COUNT(*) AS n FROM orders GROUP BY ALL),
d AS (SELECT l_linestatus, l_orderkey, COUNT(*) AS n FROM lineitem GROUP BY ALL),
j AS (SELECT coalesce(o_orderstatus, l_linestatus) AS o_orderstatus, coalesce(o_orderkey, l_orderkey) AS o_orderkey,
        coalesce(s.n, 0) AS cs, coalesce(d.n, 0) AS cd FROM s FULL OUTER JOIN d
      ON o_orderstatus IS NOT DISTINCT FROM l_linestatus AND o_orderkey IS NOT DISTINCT FROM l_orderkey),
r AS (SELECT o_orderstatus, o_orderkey, 'src' AS side, cs AS records,
        cs * ((SELECT COUNT(*) FROM lineitem) - cd) AS pairs FROM j
      UNION ALL SELECT o_orderstatus, o_orderkey, 'dest', cd, cd * ((SELECT COUNT(*) FROM orders) - cs) FROM j)
SELECT o_orderstatus, o_orderkey, side, records, CAST(pairs AS BIGINT) AS pairs FROM r WHERE pairs > 0"""

_HOT_ROWS = f"""WITH s AS (SELECT k, v, COUNT(*) AS cs FROM {HOT_LINES_SQL} x GROUP BY k, v),
d AS (SELECT k, v, COUNT(*) AS cd FROM {HOT_LINES_OPEN_SQL} x GROUP BY k, v),
j AS (SELECT CASE WHEN s.k IS DISTINCT FROM d.k OR s.v IS DISTINCT FROM d.v THEN {_NO} WHEN d.k IS NULL AND d.v IS NULL
        THEN {_A} WHEN s.k IS NULL AND s.v IS NULL THEN {_B} ELSE {_MATCH} END AS status,
        CASE WHEN cs IS NULL THEN 'dest' WHEN cd IS NULL THEN 'src' ELSE 'both' END AS side,
        coalesce(s.v, d.v) % 7 AS v, coalesce(cs, 1) * coalesce(cd, 1) AS pairs
      FROM s FULL OUTER JOIN d ON s.k = d.k)
SELECT status, side, v, COUNT(*) AS n, CAST(SUM(pairs) AS BIGINT) AS pairs FROM j GROUP BY status, side, v"""

_AGG_SIDE = "SELECT l_orderkey, CAST(SUM(l_linenumber) AS BIGINT) AS SUM_l_linenumber FROM lineitem {w} GROUP BY l_orderkey"
_AGG_PAIRS = [("l_orderkey", "l_orderkey"), ("SUM_l_linenumber", "SUM_l_linenumber")]

_F_ORDERS = _joined("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'",
                    "SELECT DISTINCT l_orderkey FROM lineitem", [("o_orderkey", "l_orderkey")],
                    [("o_orderkey", "l_orderkey")], "reference")

_ORPHANS = _joined("SELECT o_orderkey FROM orders", "SELECT l_orderkey FROM lineitem",
                   [("o_orderkey", "l_orderkey")], [("o_orderkey", "l_orderkey")], "reference")

_LINE_KEYS = _ktext(["l_orderkey", "l_linenumber"], ", ")

_CROSS_GROUPED = _crossed("SELECT o_orderstatus, o_orderpriority FROM orders",
                          "SELECT o_orderstatus, MAX(o_orderpriority) AS MAX_o_orderpriority FROM orders "
                          "GROUP BY o_orderstatus",
                          [("o_orderstatus", "o_orderstatus"), ("o_orderpriority", "MAX_o_orderpriority")])

ORACLE = {
    "vol_orders_lineitem": _volume("SELECT COUNT(*) AS src_count FROM orders",
                                   "SELECT COUNT(*) AS dest_count FROM (SELECT DISTINCT l_orderkey FROM lineitem) x"),
    "vol_bound_param": _volume("SELECT COUNT(*) AS src_count FROM orders WHERE o_orderstatus = 'F'",
                               "SELECT COUNT(*) AS dest_count FROM orders WHERE o_orderstatus = 'F'",
                               "o_orderstatus='F'"),
    "vol_params_report": _volume(
        "SELECT COUNT(*) AS src_count FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'",
        "SELECT COUNT(*) AS dest_count FROM orders WHERE o_orderstatus = 'F'",
        "o_orderpriority='1-URGENT' | o_orderstatus='F'"),
    "con_keyed_rows": (f"SELECT {FLAGSHIP_COLS}, status, side, COUNT(*) AS pairs FROM ({FLAGSHIP}) j "
                       f"WHERE status <> 'MATCH' GROUP BY ALL"),
    "con_fingerprint": _FINGERPRINTS,
    "dup_wide": ("SELECT md5(text) AS text_md5, lang, source, COUNT(*) AS count FROM documents GROUP BY text, lang, source "
                 "HAVING COUNT(*) > 1"),
    "dml_rewrite_files": ("SELECT c_custkey, CASE WHEN c_name LIKE '%Customer#00000001%' THEN replace(c_name, "
                          "'Customer#00000001', 'Client#00000001') ELSE c_name END AS c_name, c_mktsegment, c_nationkey "
                          "FROM customer"),
    "con_cross_report": _CROSS_REPORT,
    "con_hot_rows": _HOT_ROWS,
    "con_same_names": f"SELECT {_cols(_SAME_PAIRS)}, status, side, 1 AS pairs FROM ({_SAME}) j WHERE status <> 'MATCH'",
    "con_keyed_status_counts": f"SELECT status, COUNT(*) AS n FROM ({FLAGSHIP}) j GROUP BY status",
    "con_keyed_side": _summary(FLAGSHIP),
    "con_verdict": _verdict(FLAGSHIP),
    "con_keys": f"SELECT DISTINCT {_kt('o_orderkey_src', 'o_orderkey')} AS key_fields FROM ({FLAGSHIP}) j "
                f"WHERE status <> 'MATCH'",
    "con_keyed_agg": (f"SELECT {_cols(_AGG_PAIRS)}, status, side, COUNT(*) AS pairs FROM ("
                      + _joined(_AGG_SIDE.format(w=""), _AGG_SIDE.format(w="WHERE l_returnflag <> 'N'"),
                                [("l_orderkey", "l_orderkey")], _AGG_PAIRS)
                      + ") j WHERE status <> 'MATCH' GROUP BY ALL"),
    "con_renamed_key": _summary(_joined(
        "SELECT o_custkey, COUNT(1) AS COUNT_1 FROM orders GROUP BY o_custkey",
        "SELECT user_id, COUNT(1) AS COUNT_1 FROM events GROUP BY user_id",
        [("o_custkey", "user_id")], [("o_custkey", "user_id"), ("COUNT_1", "COUNT_1")])),
    "con_composite_dupkeys": _summary(_joined(
        "SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem",
        "SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_linestatus = 'O'",
        [("l_orderkey", "l_orderkey"), ("l_linenumber", "l_linenumber")],
        [("l_orderkey", "l_orderkey"), ("l_linenumber", "l_linenumber"), ("l_returnflag", "l_returnflag")])),
    "con_star": _summary(_joined(
        "SELECT n_nationkey, n_name, n_regionkey FROM nation", _unparen(NATION_RENAMED_SQL),
        [("n_nationkey", "n_nationkey")],
        [("n_nationkey", "n_nationkey"), ("n_name", "n_name"), ("n_regionkey", "n_regionkey")])),
    "con_cross_agg": _crossed(
        "SELECT COUNT(DISTINCT o_custkey) AS COUNT_DISTINCTo_custkey FROM orders",
        "SELECT COUNT(DISTINCT c_custkey) AS COUNT_DISTINCTc_custkey FROM customer",
        [("COUNT_DISTINCTo_custkey", "COUNT_DISTINCTc_custkey")]),
    "con_cross_rows": _crossed("SELECT r_regionkey FROM region", "SELECT COUNT(1) - 1 AS COUNT_1_1 FROM region",
                               [("r_regionkey", "COUNT_1_1")]),
    "con_cross_empty": _verdict(_crossed("SELECT o_orderstatus FROM orders WHERE o_totalprice < 0",
                                         "SELECT l_linestatus FROM lineitem",
                                         [("o_orderstatus", "l_linestatus")])),
    # exact product count, grouped: sum over differing value pairs of count * count
    # (the literal row-by-row product is checked in tests at sf0.001)
    "con_cross_multiset": (
        "SELECT n_differences, CASE WHEN n_differences > 0 THEN 'NOK' ELSE 'OK' END AS result, "
        "'N/A' AS execution_parameter FROM (SELECT CAST(COALESCE(SUM(s.c * d.c), 0) AS BIGINT) AS n_differences "
        "FROM (SELECT o_orderstatus AS v, COUNT(*) AS c FROM orders GROUP BY o_orderstatus) s, "
        f"(SELECT l_linestatus AS v, COUNT(*) AS c FROM {LINESTATUS_WITH_NULLS_SQL} x GROUP BY l_linestatus) d "
        "WHERE s.v IS DISTINCT FROM d.v) t"),
    "ref_documents_labels": _summary(_joined("SELECT doc_id FROM documents", "SELECT doc_id FROM labels",
                                             [("doc_id", "doc_id")], [("doc_id", "doc_id")], "reference")),
    "ref_both_directions": _summary(_F_ORDERS),
    "ref_orphan_keys": (f"SELECT DISTINCT {_kt('o_orderkey_src', 'o_orderkey')} AS key_fields FROM ({_ORPHANS}) j "
                        f"WHERE status <> 'MATCH' AND l_orderkey_dest IS NULL"),
    "ref_dest_only": ("SELECT l_orderkey FROM (SELECT DISTINCT l_orderkey FROM lineitem) d WHERE NOT EXISTS "
                      "(SELECT 1 FROM orders o WHERE o.o_orderstatus = 'F' AND o.o_orderkey = d.l_orderkey)"),
    "ref_null_keys": _summary(_joined(_unparen(CUSTOMER_NULL_KEYS_SQL), _unparen(CUSTOMER_NULL_KEYS_SQL),
                                      [("k", "k")], [("k", "k"), ("c_name", "c_name")], "reference")),
    "cat_returnflag": ("SELECT l_returnflag, l_linestatus, COUNT(*) AS count FROM lineitem "
                       "WHERE l_returnflag NOT IN ('A', 'R') GROUP BY l_returnflag, l_linestatus"),
    "cat_catalogue_table": ("SELECT p_type, COUNT(*) AS count FROM part p WHERE NOT EXISTS (SELECT 1 FROM "
                            "(VALUES ('PROMO'), ('SMALL'), ('LARGE')) c(t) WHERE c.t = p.p_type) GROUP BY p_type"),
    "form_brand": "SELECT p_brand, COUNT(*) AS count FROM part WHERE p_brand NOT LIKE 'Brand#__' GROUP BY p_brand",
    "obg_segment": (f"SELECT c_mktsegment, COUNT(*) AS count FROM {SEGMENT_WITH_NULLS_SQL} x "
                    f"WHERE c_mktsegment IS NULL GROUP BY c_mktsegment"),
    "violation_keys": (f"SELECT {_kt('c_mktsegment')} AS key_fields FROM {SEGMENT_WITH_NULLS_SQL} x "
                       f"WHERE c_mktsegment IS NULL GROUP BY c_mktsegment"),
    "dup_lineitem": ("SELECT l_orderkey, l_linenumber, COUNT(*) AS count FROM lineitem "
                     "GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1"),
    "dup_extra_group": ("SELECT l_linenumber, l_orderkey, COUNT(*) AS count FROM lineitem "
                        "GROUP BY l_linenumber, l_orderkey HAVING COUNT(*) > 1"),
    "dup_documents_text": "SELECT text, lang, COUNT(*) AS count FROM documents GROUP BY text, lang HAVING COUNT(*) > 1",
    "dup_filtered": ("SELECT o_custkey, o_orderdate, COUNT(*) AS count FROM orders WHERE o_orderstatus = 'O' "
                     "GROUP BY o_custkey, o_orderdate HAVING COUNT(*) > 1"),
    "dup_keys": (f"SELECT {_LINE_KEYS} AS key_fields FROM lineitem GROUP BY l_orderkey, l_linenumber "
                 f"HAVING COUNT(*) > 1"),
    "union_trim_source": _volume(f"SELECT COUNT(*) AS src_count FROM lineitem WHERE {UNION_TRIM_SRC_FILTER}",
                                 f"SELECT COUNT(*) AS dest_count FROM ({UNION_TRIM_SQL}) u"),
    "union_trim_rows": f"SELECT fate, COUNT(*) AS n FROM ({UNION_TRIM_SQL}) u GROUP BY fate",
    "vol_named_params": _volume("SELECT COUNT(*) AS src_count FROM orders WHERE o_orderstatus = 'F'",
                                "SELECT COUNT(*) AS dest_count FROM lineitem WHERE l_linestatus = 'F'",
                                "o_orderstatus='F' | l_linestatus='F'"),
    "cat_param": ("SELECT n_violations, CASE WHEN n_violations > 0 THEN 'NOK' ELSE 'OK' END AS result, "
                  "'l_returnflag=''R''' AS execution_parameter FROM (SELECT COUNT(*) AS n_violations "
                  "FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus <> 'O') v"),
    "dup_param_keys": (f"SELECT {_LINE_KEYS} AS key_fields FROM lineitem WHERE l_linestatus = 'F' "
                       f"GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1"),
    "con_cross_grouped": _summary(_CROSS_GROUPED),
    "con_cross_grouped_keys": (f"SELECT DISTINCT {_kt('o_orderstatus_src', 'o_orderstatus')} || ' , ' || "
                               f"{_kt('o_orderpriority_src', 'o_orderpriority')} AS key_fields "
                               f"FROM ({_CROSS_GROUPED}) j WHERE status <> 'MATCH'"),
    "ref_star": _summary(_joined("SELECT n_nationkey, n_name, n_regionkey FROM nation", _unparen(NATION_SUBSET_SQL),
                                 [("n_nationkey", "n_nationkey")],
                                 [("n_nationkey", "n_nationkey"), ("n_name", "n_name"),
                                  ("n_regionkey", "n_regionkey")], "reference")),
    "dml_rewrite_column": ("SELECT CASE WHEN p_type LIKE '%PROMO%' THEN replace(p_type, 'PROMO', 'PROMOTION') "
                           "ELSE p_type END AS p_type, COUNT(*) AS count FROM part GROUP BY 1"),
    # every joined pair, key fields taken from the source record
    "con_keys_wide": (
        f"SELECT DISTINCT {_kt('s.o_custkey')} || ' , ' || {_kt('s.o_orderpriority')} AS key_fields "
        f"FROM orders s FULL OUTER JOIN ({DEST_ORDERS_SQL}) d ON s.o_orderkey = d.o_orderkey "
        "WHERE s.o_orderkey IS DISTINCT FROM d.o_orderkey OR s.o_orderstatus IS DISTINCT FROM d.o_orderstatus"),
    "ref_orphan_keys_wide": (
        f"SELECT DISTINCT {_kt('s.prio')} AS key_fields FROM {ORDERS_BY_PRIORITY_SQL} s "
        f"FULL OUTER JOIN {ORDERS_SHIFTED_SQL} d ON s.k = d.j WHERE (d.j IS NULL AND d.prio IS NULL) "
        "OR (s.k IS NULL AND s.prio IS NULL AND d.prio IS NULL)"),
    "ref_source_only": (f"SELECT k, c_name FROM {CUSTOMER_NULL_KEYS_SQL} s WHERE NOT EXISTS "
                        "(SELECT 1 FROM orders o WHERE o.o_custkey = s.k)"),
    "con_mixed_decimal": _summary(_joined(
        f"SELECT k, n, CAST(v AS DOUBLE) AS v FROM {LINES_AS_TEXT_SQL} x",
        f"SELECT k, n, CAST(v AS DOUBLE) AS v FROM {LINES_AS_DECIMAL_SQL} x",
        [("k", "k"), ("n", "n")], [("v", "v")])),
    "con_mixed_int": _summary(_joined(
        f"SELECT CAST(k AS BIGINT) AS k, CAST(v AS BIGINT) AS v FROM {ORDERS_AS_TEXT_SQL} x",
        f"SELECT CAST(k AS BIGINT) AS k, CAST(v AS BIGINT) AS v FROM {ORDERS_AS_INT_SQL} x",
        [("k", "k")], [("k", "k"), ("v", "v")])),
}
