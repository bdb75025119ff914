"""Checks of one relation in one scan: same answers as each on its own, one
scan a table, faults stay alone."""

import re

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from parity.plans import suite_scenarios as S
from parity.plans.fused import FusedScan, Item
from parity.plans.suite import Definition, run_suite
from parity.functions.params import bind
from parity.sources import testdata


def _outcome(run):
    results, details = run.with_ids()
    return (sorted(tuple(r) for r in results.select("RESULT_ID", "TEST_ID", "RESULT", "EXECUTION_PARAMETER", "QUERY").collect()),
            sorted(tuple(r) for r in details.select("DETAILS_ID", "RESULT_ID", "KEY_FIELDS").collect()))


def test_fused_and_single_checks_agree(spark):
    testdata.register_views(spark, SF_SMALL, ("orders", "lineitem", "customer"))
    defs, params = S.fused_definitions(), {"o_orderstatus": "F"}
    fused = _outcome(run_suite(spark, defs, params))
    alone = _outcome(run_suite(spark, defs, params, fuse=False))
    assert [r[:4] for r in fused[0]] == [r[:4] for r in alone[0]] and fused[1] == alone[1]
    assert [r[2] for r in fused[0]].count("ERROR") == 1 and fused[0][S.FUSED_ERROR - 1][2] == "ERROR"
    assert "FORM" in fused[0][S.FUSED_ERROR - 1][4]


def test_one_scan_a_table(spark):
    testdata.register_views(spark, SF_SMALL, ("orders", "lineitem", "customer"))
    run = run_suite(spark, S.fused_definitions(), {"o_orderstatus": "F"})
    scans, owners = run.fused_scans()
    assert len(scans) == 3 and len(owners) == len(S.FUSED) >= 20
    for scan in scans:
        for df in (scan.counts(), scan.keys()):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert len(re.findall(r"FileScan parquet", plan)) == 1


def test_common_condition_prunes_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("id", "id % 4 AS day", "CAST(id AS STRING) AS s").write.partitionBy("day").parquet(path)
    df = spark.read.parquet(path)
    scan = FusedScan(spark, df, [Item((i, 0), bind(f"day = ? AND {p}", {"day": 2}), i, ("id",))
                                 for i, p in enumerate(["id > 50", "s LIKE '%4'", "id < 0"])])
    assert scan.run() == {(0, 0): 12, (1, 0): 5, (2, 0): 0}
    plan = scan.counts()._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*day", plan)


def test_faulty_predicates_stand_alone(spark):
    df = spark.createDataFrame([(i, "x" if i == 3 else str(i)) for i in range(8)], "id int, s string")
    rules = ["id > 5", "CAST(s AS INT) > 2", "s = '1'", "1 / (id - 4) > 0", "id < 0", "true", "1 = 1"]
    got = FusedScan(spark, df, [Item((i, 0), bind(r, {})) for i, r in enumerate(rules)]).run()
    assert [got[i, 0] for i in (0, 2, 4, 5, 6)] == [2, 1, 0, 8, 8]
    assert "CAST" in got[1, 0].upper() and "DIV" in got[3, 0].upper()


@pytest.mark.parametrize("fuse", [True, False])
def test_odd_definitions(spark, golden, fuse):
    src, dst = golden
    tables = {"a": src, "b": dst, "none": src.where("k < 0")}
    defs = [
        Definition(1, "VOL", "VOL", "a", "b"),                                             # two scans
        Definition(2, "MAP", "CAT", "a", SOURCE_FILTER="k NOT IN (SELECT 5)", KEY_FIELDS="k"),   # not for an aggregate
        Definition(3, "MAP", "OBG", "a", SOURCE_FILTER="v IS NULL", KEY_FIELDS="n, nope"),       # unknown key field
        Definition(4, "MAP", "OBG", "a", SOURCE_FILTER="v IS NULL", KEY_FIELDS="N"),
        Definition(5, "MAP", "FORM", "b", SOURCE_FILTER="n = '{b}' OR n <> 'x = ?' AND k = ?", KEY_FIELDS="k"),
        Definition(6, "MAP", "CAT", "b", SOURCE_FILTER="1 = 1", KEY_FIELDS="n"),
        Definition(7, "MAP", "CAT", "none", SOURCE_FILTER="", KEY_FIELDS="n"),
        Definition(8, "VOL", "VOL", "none", "none"),
        Definition(9, "MAP", "CAT", "a", SOURCE_FILTER="v > 49 -- large", KEY_FIELDS="n"),
        Definition(10, "MAP", "CAT", "a", SOURCE_FILTER="v > 0) OR (v < 0", KEY_FIELDS="n"),     # no expression
    ]
    results, details = _outcome(run_suite(spark, defs, {"k": 4}, tables, fuse=fuse))
    assert [r[2] for r in results] == ["NOK", "NOK", "ERROR", "NOK", "NOK", "NOK", "OK", "OK", "NOK", "ERROR"]
    keys = {}
    for _, rid, k in details:
        keys.setdefault(rid, []).append(k)
    assert keys == {2: ["k='1'", "k='2'", "k='3'"], 4: ["N IS NULL", "N='c'"], 5: ["k='4'"],
                    6: ["n IS NULL", "n='a'", "n='b'", "n='c'", "n='d'"], 9: ["n='e'"]}


def test_registered():
    assert "suite_fused" in E.queries() and "suite_fused" in E.oracle_sql()
