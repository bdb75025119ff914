"""A configured suite over the test tables: nine definitions covering the
seven check codes, run as one plan.  Registered as ``suite_results``,
``suite_details`` and ``history``; the oracle recomputes every verdict and
key with plain SQL."""

from __future__ import annotations

import datetime as _dt
import uuid

from parity.plans import oracle as O
from parity.plans.scenarios import DEST_ORDERS_SQL, _views
from parity.plans.suite import Definition, definitions_frame, history as _history, run_suite
from parity.sinks import tables as sinks
from parity.sources.definitions import read_table

PARAMS = {"o_orderstatus": "F", "l_linestatus": "F"}

DEFINITIONS = [
    Definition(1, "VOL", "VOL", "orders", "(SELECT DISTINCT l_orderkey FROM lineitem)"),
    Definition(2, "VOL", "VOL", "orders", "orders", SOURCE_FILTER="o_orderstatus = ?", DEST_FILTER="o_orderstatus=?"),
    Definition(3, "MAP", "CON", "orders", f"({DEST_ORDERS_SQL})", "o_orderkey = o_orderkey",
               "o_orderkey, o_orderstatus", "o_orderkey, o_orderstatus", KEY_FIELDS="o_orderkey"),
    Definition(4, "MAP", "CAT", "lineitem", SOURCE_FILTER="l_returnflag NOT IN ('A', 'R')",
               KEY_FIELDS="l_returnflag, l_linestatus"),
    Definition(5, "MAP", "FORM", "part", SOURCE_FILTER="p_brand NOT LIKE 'Brand#__'", KEY_FIELDS="p_brand"),
    Definition(6, "CHTEC", "REF", "orders", "lineitem", "o_orderkey = l_orderkey", "o_orderkey", "l_orderkey",
               KEY_FIELDS="o_orderkey"),
    Definition(7, "MAP", "OBG", "customer", SOURCE_FILTER="c_name IS NULL OR c_mktsegment = ''",
               KEY_FIELDS="c_custkey"),
    Definition(8, "CHTEC", "DUP", "lineitem", SOURCE_FILTER="l_linestatus = ?",
               KEY_FIELDS="l_orderkey, l_linenumber"),
    Definition(9, "MAP", "CON", "region", "region", "", "COUNT(1)", "COUNT(1) - 1"),
]

_TABLES = ("orders", "lineitem", "part", "customer", "region")


def _run(spark, sf_dir):
    _views(spark, sf_dir, *_TABLES)
    return run_suite(spark, definitions_frame(spark, DEFINITIONS), PARAMS)


def suite_results(spark, sf_dir):
    results = _run(spark, sf_dir).final_results()
    return results.select("RESULT_ID", "TEST_ID", "RESULT", "EXECUTION_PARAMETER")


def suite_details(spark, sf_dir):
    details = _run(spark, sf_dir).final_details()
    return details.select("DETAILS_ID", "RESULT_ID", "KEY_FIELDS")


def history(spark, sf_dir):
    results, details = _run(spark, sf_dir).with_ids()
    return _history(results, details).select("RESULT_ID", "TEST_ID", "RESULT", "DETAILS_ID", "KEY_FIELDS")


def suite_mixed_case(spark, sf_dir):
    """Names written in another case than the tables', one missing parameter,
    and a set selection: results and details in one frame."""
    _views(spark, sf_dir, "nation", "region")
    members = definitions_members(spark)
    run = run_suite(spark, definitions_frame(spark, MIXED_CASE), {"R_REGIONKEY": 2}, members=members, set_ids=[1])
    results, details = run.with_ids()
    return results.join(details.select("RESULT_ID", "KEY_FIELDS"), "RESULT_ID", "left").select(
        "RESULT_ID", "TEST_ID", "RESULT", "KEY_FIELDS")


MIXED_CASE = [
    Definition(1, "MAP", "CON", "nation", "(SELECT N_NATIONKEY, CASE WHEN n_nationkey = 7 THEN 'X' ELSE n_name END "
               "AS N_NAME FROM nation)", "n_nationkey = N_NationKey", "N_NATIONKEY, n_name", "n_nationkey, N_NAME",
               KEY_FIELDS="N_NATIONKEY"),
    Definition(2, "CHTEC", "REF", "region", "nation", "R_REGIONKEY = N_REGIONKEY", "r_regionkey", "n_regionkey",
               DEST_FILTER="N_REGIONKEY <> 3", KEY_FIELDS="r_RegionKey"),
    Definition(3, "VOL", "VOL", "region", "nation", SOURCE_FILTER="absent = ?"),
    Definition(4, "VOL", "VOL", "region", "nation"),
]


def definitions_members(spark):
    """Set 1 has the first three definitions."""
    from parity.sources.local import literal_frame
    from parity import schemas
    return literal_frame(spark, [(1, 1), (1, 2), (1, 3), (2, 4)], schemas.SET_MEMBERS)


# One-table checks of three tables: (code, table, rule or filters, key fields).
# The rules read the same in both dialects but for the parameter.
FUSED = [
    ("VOL", "orders", (None, "o_orderkey >= 0"), None),
    ("VOL", "orders", ("o_orderstatus = ?", "o_orderstatus <> 'F'"), None),
    ("CAT", "orders", "o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')", "o_orderpriority"),
    ("FORM", "orders", "o_orderstatus NOT IN ('F', 'O', 'P')", "o_orderstatus"),
    ("OBG", "orders", "o_custkey IS NULL", "o_orderkey"),
    ("CAT", "orders", "o_totalprice > 495000", "o_orderkey"),
    ("FORM", "orders", "CAST(o_orderpriority AS INT) > 0", "o_orderkey"),      # fails on the data
    ("OBG", "orders", "o_orderstatus = ? AND o_totalprice < 9000", "o_custkey, o_orderstatus"),
    ("VOL", "lineitem", ("l_linenumber > 3", "l_linenumber <= 3"), None),
    ("CAT", "lineitem", "l_returnflag NOT IN ('A', 'R')", "l_returnflag, l_linestatus"),
    ("CAT", "lineitem", "l_linestatus NOT IN ('F', 'O')", "l_orderkey"),
    ("FORM", "lineitem", "l_quantity <> floor(l_quantity)", "l_orderkey, l_linenumber"),
    ("OBG", "lineitem", "l_shipdate IS NULL", "l_orderkey"),
    ("CAT", "lineitem", "l_discount > 0.1", "l_linenumber"),
    ("CAT", "lineitem", "l_tax > 0.07 AND l_quantity > 49", "l_orderkey, l_linenumber"),
    ("FORM", "lineitem", "l_linenumber NOT BETWEEN 1 AND 6", "l_linenumber"),
    ("VOL", "customer", (None, "c_acctbal > -5000"), None),
    ("OBG", "customer", "c_name IS NULL OR c_mktsegment = ''", "c_custkey"),
    ("FORM", "customer", "c_name NOT LIKE 'Customer#%'", "c_name"),
    ("CAT", "customer", "c_mktsegment NOT IN ('BUILDING', 'MACHINERY')", "c_mktsegment"),
    ("CAT", "customer", "c_acctbal < -900", "c_custkey"),
    ("FORM", "customer", "length(c_name) <> 18", None),
    ("CAT", "customer", "c_nationkey = 7", None),
]
FUSED_ERROR = 7


def fused_definitions() -> list[Definition]:
    out = []
    for test_id, (code, table, rule, keys) in enumerate(FUSED, 1):
        source, dest = rule if code == "VOL" else (rule, None)
        out.append(Definition(test_id, "MAP" if code != "VOL" else "VOL", code, table, table if code == "VOL" else None,
                              SOURCE_FILTER=source, DEST_FILTER=dest, KEY_FIELDS=keys))
    return out


def suite_fused(spark, sf_dir):
    """Checks that share one scan a table; one of them fails on the data, alone."""
    _views(spark, sf_dir, "orders", "lineitem", "customer")
    results, details = run_suite(spark, fused_definitions(), {"o_orderstatus": "F"}).with_ids()
    return _history(results, details).select("RESULT_ID", "TEST_ID", "RESULT", "EXECUTION_PARAMETER", "KEY_FIELDS")


#: Days that history_latest records a run on.
HISTORY_DAYS = ("2025-12-29", "2025-12-30", "2025-12-31")
HISTORY_ROWS = 8

RECORDED = [
    Definition(1, "MAP", "CAT", "customer", SOURCE_FILTER="c_mktsegment NOT IN ('BUILDING', 'MACHINERY')",
               KEY_FIELDS="c_mktsegment"),
    Definition(2, "VOL", "VOL", "orders", "customer"),
    Definition(3, "MAP", "CON", "nation", "(SELECT n_nationkey, CASE WHEN n_nationkey = 7 THEN 'RENAMED' ELSE n_name END "
               "AS n_name FROM nation)", "n_nationkey = n_nationkey", "n_nationkey, n_name", "n_nationkey, n_name",
               KEY_FIELDS="n_nationkey"),
    Definition(4, "MAP", "OBG", "customer", SOURCE_FILTER="c_name IS NULL", KEY_FIELDS="c_custkey"),
    Definition(5, "MAP", "CON", "region", "region", "", "COUNT(1)", "COUNT(1) - 1"),
    Definition(6, "VOL", "VOL", "region", "nation"),
]


def history_latest(spark, sf_dir):
    """Definitions and a set in control tables, run and recorded on three days,
    once of them twice, into tables partitioned by day; the newest rows from the
    second day on."""
    _views(spark, sf_dir, "customer", "orders", "nation", "region")
    db = f"history_{uuid.uuid4().hex}"
    sinks.create_tables(spark, db, by_day=True, names=["test_config_parameters", "test_rel_set_parameter",
                                                       sinks.RESULTS_TABLE, sinks.DETAILS_TABLE])
    sinks.append(definitions_frame(spark, RECORDED), f"{db}.test_config_parameters")
    for test_id in range(1, 6):     # the sixth isn't a member
        sinks.add_set_member(spark, 1, test_id, f"{db}.test_rel_set_parameter")
    results, details = f"{db}.{sinks.RESULTS_TABLE}", f"{db}.{sinks.DETAILS_TABLE}"
    for day in HISTORY_DAYS:
        run = run_suite(spark, read_table(spark, f"{db}.test_config_parameters"), set_ids=[1],
                        members=spark.table(f"{db}.test_rel_set_parameter"), timestamp=_dt.datetime.fromisoformat(f"{day} 12:00:00"))
        sinks.record(run, results, details, run_id=day)
    sinks.record(run, results, details, run_id=day)      # a retry adds nothing
    return sinks.history(spark, results, details, since=HISTORY_DAYS[1], latest=HISTORY_ROWS).select(
        "RESULT_ID", "TEST_ID", "RESULT", "DETAILS_ID", "KEY_FIELDS")


QUERIES = {"suite_mixed_case": suite_mixed_case, "suite_results": suite_results, "suite_details": suite_details,
           "history": history, "suite_fused": suite_fused, "history_latest": history_latest}


# ------------------------------------------------------------------ oracle --

def _verdict(rid: int, test_id: int, ok_condition: str, bad: str = "NOK", params: str = "N/A") -> str:
    params = params.replace("'", "''")
    return (f"SELECT CAST({rid} AS BIGINT) AS RESULT_ID, {test_id} AS TEST_ID, "
            f"CASE WHEN {ok_condition} THEN 'OK' ELSE '{bad}' END AS RESULT, '{params}' AS EXECUTION_PARAMETER")


_CON_DIFFS = f"(SELECT COUNT(*) FROM ({O.FLAGSHIP}) j WHERE status <> 'MATCH')"
_REF_DIFFS = f"(SELECT COUNT(*) FROM ({O._ORPHANS}) j WHERE status <> 'MATCH')"
_REGION_X = O._crossed("SELECT COUNT(1) AS COUNT_1 FROM region", "SELECT COUNT(1) - 1 AS COUNT_1_1 FROM region",
                       [("COUNT_1", "COUNT_1_1")])
_DUP_F = ("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_linestatus = 'F' "
          "GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1")

_RESULTS = " UNION ALL ".join([
    _verdict(1, 1, "(SELECT COUNT(*) FROM orders) = (SELECT COUNT(DISTINCT l_orderkey) FROM lineitem)"),
    _verdict(2, 2, "(SELECT COUNT(*) FROM orders WHERE o_orderstatus = 'F') = "
                   "(SELECT COUNT(*) FROM orders WHERE o_orderstatus = 'F')", params="o_orderstatus='F'"),
    _verdict(3, 3, f"{_CON_DIFFS} = 0"),
    _verdict(4, 4, "NOT EXISTS (SELECT 1 FROM lineitem WHERE l_returnflag NOT IN ('A', 'R'))"),
    _verdict(5, 5, "NOT EXISTS (SELECT 1 FROM part WHERE p_brand NOT LIKE 'Brand#__')"),
    _verdict(6, 6, f"{_REF_DIFFS} = 0"),
    _verdict(7, 7, "NOT EXISTS (SELECT 1 FROM customer WHERE c_name IS NULL OR c_mktsegment = '')"),
    _verdict(8, 8, f"NOT EXISTS ({_DUP_F})", bad="NOT OK", params="l_linestatus='F'"),
    _verdict(9, 9, f"(SELECT COUNT(*) FROM ({_REGION_X}) x WHERE status <> 'MATCH') = 0"),
])

_KEYS = " UNION ALL ".join([
    f"SELECT CAST(3 AS BIGINT) AS RESULT_ID, key_fields AS KEY_FIELDS FROM ({O.ORACLE['con_keys']}) k",
    f"SELECT CAST(4 AS BIGINT), {O._ktext(['l_returnflag', 'l_linestatus'], ', ')} FROM lineitem "
    f"WHERE l_returnflag NOT IN ('A', 'R') GROUP BY l_returnflag, l_linestatus",
    f"SELECT CAST(5 AS BIGINT), {O._kt('p_brand')} FROM part WHERE p_brand NOT LIKE 'Brand#__' GROUP BY p_brand",
    f"SELECT CAST(6 AS BIGINT), key_fields FROM ({O.ORACLE['ref_orphan_keys']}) k",
    f"SELECT CAST(7 AS BIGINT), {O._kt('c_custkey')} FROM customer WHERE c_name IS NULL OR c_mktsegment = '' "
    f"GROUP BY c_custkey",
    f"SELECT CAST(8 AS BIGINT), {O._ktext(['l_orderkey', 'l_linenumber'], ', ')} FROM ({_DUP_F}) d",
    # a failed check without key fields leaves one empty key
    f"SELECT CAST(9 AS BIGINT), '' WHERE (SELECT COUNT(*) FROM ({_REGION_X}) x WHERE status <> 'MATCH') > 0",
])

_DETAILS = (f"SELECT ROW_NUMBER() OVER (ORDER BY RESULT_ID, KEY_FIELDS) AS DETAILS_ID, RESULT_ID, KEY_FIELDS "
            f"FROM ({_KEYS}) k")

def _fused_sql() -> str:
    """Each check by a query of its own."""
    out = []
    for test_id, (code, table, rule, keys) in enumerate(FUSED, 1):
        head = f"CAST({test_id} AS BIGINT) AS RESULT_ID, {test_id} AS TEST_ID"
        params = "o_orderstatus=''F''" if "= ?" in str(rule) else "N/A"
        if test_id == FUSED_ERROR:
            out.append(f"SELECT {head}, 'ERROR' AS RESULT, 'N/A' AS EXECUTION_PARAMETER, NULL AS KEY_FIELDS")
        elif code == "VOL":
            a, b = (f"(SELECT count(*) FROM {table} WHERE {(x or 'true').replace('?', chr(39) + 'F' + chr(39))})" for x in rule)
            out.append(f"SELECT {head}, CASE WHEN {a} = {b} THEN 'OK' ELSE 'NOK' END AS RESULT, '{params}' AS EXECUTION_PARAMETER, "
                       "NULL AS KEY_FIELDS")
        else:
            bad = f"FROM {table} WHERE {rule.replace('?', chr(39) + 'F' + chr(39))}"
            text = O._ktext(keys.split(", "), ", ") if keys else "''"
            out.append(f"SELECT {head}, 'NOK', '{params}', k FROM (SELECT DISTINCT {text} AS k {bad}) x")
            out.append(f"SELECT {head}, 'OK', '{params}', NULL WHERE NOT EXISTS (SELECT 1 {bad})")
    return " UNION ALL ".join(out)


_RECORDED = f"""WITH r AS (
  SELECT 1 AS t, CASE WHEN EXISTS (SELECT 1 FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY'))
      THEN 'NOK' ELSE 'OK' END AS RESULT
  UNION ALL SELECT 2, CASE WHEN (SELECT COUNT(*) FROM orders) = (SELECT COUNT(*) FROM customer) THEN 'OK' ELSE 'NOK' END
  UNION ALL SELECT 3, CASE WHEN EXISTS (SELECT 1 FROM nation WHERE n_nationkey = 7 AND n_name <> 'RENAMED') THEN 'NOK' ELSE 'OK' END
  UNION ALL SELECT 4, CASE WHEN EXISTS (SELECT 1 FROM customer WHERE c_name IS NULL) THEN 'NOK' ELSE 'OK' END
  UNION ALL SELECT 5, 'NOK'),
k AS (
  SELECT DISTINCT 1 AS t, {O._kt('c_mktsegment')} AS KEY_FIELDS FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')
  UNION ALL SELECT 3, {O._kt('n_nationkey')} FROM nation WHERE n_nationkey = 7 AND n_name <> 'RENAMED'
  UNION ALL SELECT 4, {O._kt('c_custkey')} FROM customer WHERE c_name IS NULL
  UNION ALL SELECT 5, ''),
d AS (SELECT ROW_NUMBER() OVER (ORDER BY t, KEY_FIELDS) AS i, t, KEY_FIELDS FROM k),
days AS (SELECT * FROM (VALUES (1), (2)) v(day))
SELECT CAST(r.t + day * 5 AS BIGINT) AS RESULT_ID, r.t AS TEST_ID, r.RESULT,
  CAST(d.i + day * (SELECT COUNT(*) FROM k) AS BIGINT) AS DETAILS_ID, d.KEY_FIELDS
FROM days CROSS JOIN r LEFT JOIN d ON d.t = r.t ORDER BY RESULT_ID DESC, DETAILS_ID LIMIT {HISTORY_ROWS}"""


ORACLE = {
    "history_latest": _RECORDED,
    "suite_fused": _fused_sql(),
    "suite_mixed_case": (
        "SELECT CAST(1 AS BIGINT) AS RESULT_ID, 1 AS TEST_ID, 'NOK' AS RESULT, 'N_NATIONKEY=''' || n_nationkey || '''' "
        "AS KEY_FIELDS FROM nation WHERE n_nationkey = 7 UNION ALL "
        "SELECT 2, 2, 'NOK', 'r_RegionKey=''' || r_regionkey || '''' FROM region WHERE r_regionkey NOT IN "
        "(SELECT n_regionkey FROM nation WHERE n_regionkey <> 3) UNION ALL SELECT 3, 3, 'ERROR', NULL"),
    "suite_results": _RESULTS,
    "suite_details": _DETAILS,
    "history": (f"SELECT r.RESULT_ID, r.TEST_ID, r.RESULT, d.DETAILS_ID, d.KEY_FIELDS FROM ({_RESULTS}) r "
                f"LEFT JOIN ({_DETAILS}) d ON r.RESULT_ID = d.RESULT_ID"),
}
