"""Suite, definitions, sinks and gap-free ids."""

import pytest
from pyspark.sql import functions as F

from parity import schemas
from parity.operators.ids import with_sequential_ids
from parity.plans.suite import Definition, definitions_frame, run_suite, validate
from parity.sinks import tables as sinks
from parity.sources import definitions as D


CSV = (
    "TEST_ID;TYPE_ID;SUBTYPE_ID;SOURCE_TABLE;DEST_TABLE;JOIN_KEY;SOURCE_SELECT_FIELD;DEST_SELECT_FIELD;"
    "SOURCE_FILTER;DEST_FILTER;SOURCE_GROUPBY;DEST_GROUPBY;KEY_FIELDS\r\n"
    "1;VOL;VOL;src_t;\"SELECT *\r\nFROM dst_t\r\nWHERE k IS NOT NULL\";;;;;;;;\r\n"
    "2;MAP;CON;src_t;dst_t;k = k;k, v;k, v;;;;;k\r\n"
    "3;CHTEC;DUP;src_t;;;;;n = ?;;;;n\r\n"
)


@pytest.fixture()
def golden_views(spark, golden):
    src, dst = golden
    src.createOrReplaceTempView("src_t")
    dst.createOrReplaceTempView("dst_t")
    return src, dst


def test_read_csv_multiline_crlf(spark, tmp_path):
    p = tmp_path / "defs.csv"
    p.write_bytes(CSV.encode())
    df = D.read_csv(spark, str(p))
    rows = df.orderBy("TEST_ID").collect()
    assert [r.TEST_ID for r in rows] == [1, 2, 3]
    assert rows[0].DEST_TABLE.replace("\r", "") == "SELECT *\nFROM dst_t\nWHERE k IS NOT NULL"
    assert rows[1].JOIN_KEY == "k = k" and rows[0].JOIN_KEY is None


def test_defaults_and_set_selection(spark):
    defs = definitions_frame(spark, [Definition(2, "MAP", "CON", "a", "b", " "), Definition(1, "VOL", "VOL", "a", "b")])
    d = D.with_defaults(defs).orderBy("TEST_ID").collect()
    assert (d[0].JOIN_KEY, d[0].SOURCE_SELECT_FIELD, d[0].SOURCE_FILTER, d[0].DEST_GROUPBY) == ("1 = 1", "*", "1 = 1", "1 = 1")
    members = spark.createDataFrame([(1, 2), (7, 1)], schemas.SET_MEMBERS)
    assert [r.TEST_ID for r in D.select_by_set(defs, members, [1]).collect()] == [2]
    assert [r.TEST_ID for r in D.select_by_set(defs, members).collect()] == [1, 2]
    assert D.select_by_set(defs, members, [99]).count() == 0      # a set without members runs nothing
    empty = spark.createDataFrame([], schemas.SET_MEMBERS)
    assert [r.TEST_ID for r in D.select_by_set(defs, empty).collect()] == [1, 2]


def test_rewrite_column(spark):
    df = spark.createDataFrame([("db_old.t",), ("other.t",)], "DEST_TABLE string")
    out = [r[0] for r in D.rewrite_column(df, "DEST_TABLE", "old", "new").collect()]
    assert out == ["db_new.t", "other.t"]


def test_validate_finds_unknown_codes_and_missing_parameters():
    problems = validate([Definition(1, "X", "NOPE", "a"), Definition(2, "VOL", "VOL", "a", "b", SOURCE_FILTER="x = ?")])
    assert any("NOPE" in p for p in problems) and any("x" in p for p in problems)


def test_suite_end_to_end_with_sinks(spark, golden_views, tmp_path):
    defs = [
        Definition(1, "VOL", "VOL", "src_t", "(SELECT * FROM dst_t)"),
        Definition(2, "MAP", "CON", "src_t", "dst_t", "k = k", "k, n, v", "k, n, v", KEY_FIELDS="k"),
        Definition(3, "CHTEC", "REF", "src_t", "dst_t", "k = k", "k", "k", KEY_FIELDS="k"),
        Definition(4, "CHTEC", "DUP", "src_t", SOURCE_FILTER="n = ?", KEY_FIELDS="n", SOURCE_GROUPBY="n"),
        Definition(5, "MAP", "OBG", "src_t", SOURCE_FILTER="v IS NULL", KEY_FIELDS="n"),
        Definition(6, "MAP", "CON", "src_t", "dst_t", None, "SUM(v)", "SUM(v)"),
        Definition(7, "MAP", "CAT", "src_t", SOURCE_FILTER="n NOT IN ('a', 'b')"),
    ]
    db = "suite_test_db"
    sinks.drop_tables(spark, db)
    made = sinks.create_tables(spark, db)
    assert f"{db}.test_out_results" in made
    run = run_suite(spark, definitions_frame(spark, defs), {"n": "e"})
    res_t, det_t = f"{db}.test_out_results", f"{db}.test_out_results_details"
    sinks.record(run, res_t, det_t)
    results = {r.TEST_ID: r.RESULT for r in spark.table(res_t).collect()}
    assert results == {1: "NOK", 2: "NOK", 3: "NOK", 4: "NOT OK", 5: "NOK", 6: "NOK", 7: "NOK"}
    det = spark.table(det_t).orderBy("DETAILS_ID").collect()
    assert [r.DETAILS_ID for r in det] == list(range(1, len(det) + 1))      # gap-free
    by_result = {}
    rid_of = {r.TEST_ID: r.RESULT_ID for r in spark.table(res_t).collect()}
    for r in det:
        by_result.setdefault(r.RESULT_ID, []).append(r.KEY_FIELDS)
    assert sorted(by_result[rid_of[2]]) == sorted(["k='2'", "k='5'", "k IS NULL"])
    assert sorted(by_result[rid_of[3]]) == sorted(["k='5'", "k IS NULL"])
    assert by_result[rid_of[4]] == ["n='e'"]
    assert sorted(by_result[rid_of[5]]) == ["n IS NULL", "n='c'"]
    assert by_result[rid_of[6]] == [""]          # failed, no key fields: one empty key
    assert by_result[rid_of[7]] == [""]
    assert rid_of[1] not in by_result            # volume checks log no details
    # a second run continues the ids
    sinks.record(run_suite(spark, definitions_frame(spark, defs[:2]), {"n": "e"}), res_t, det_t)
    ids = sorted(r.RESULT_ID for r in spark.table(res_t).collect())
    assert ids == list(range(1, 10))
    dids = sorted(r.DETAILS_ID for r in spark.table(det_t).collect())
    assert dids == list(range(1, len(dids) + 1))
    hist = sinks.history(spark, res_t, det_t)
    assert hist.count() == len(dids) + 2         # the two VOL results have no details (left join)
    sinks.truncate(spark, det_t)
    assert spark.table(det_t).count() == 0
    sinks.add_set_member(spark, 1, 2, f"{db}.test_rel_set_parameter")
    assert spark.table(f"{db}.test_rel_set_parameter").collect()[0].TEST_ID == 2
    sinks.drop_tables(spark, db)


def test_error_result_when_not_strict(spark, golden_views):
    defs = [Definition(1, "MAP", "CON", "src_t", "dst_t", "k = k", "k, nope", "k, v")]
    run = run_suite(spark, defs, strict=False)
    r = run.results.collect()[0]
    assert r.RESULT == "ERROR" and "nope" in r.QUERY.lower()
    with pytest.raises(ValueError):
        run_suite(spark, [Definition(1, "X", "BAD", "src_t")])


def test_sequential_ids_are_gap_free_across_partitions(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).alias("x")).repartition(5)
    out = with_sequential_ids(df, ["x"], "seq", start=100).collect()
    assert sorted(r.seq for r in out) == list(range(100, 5100))
    assert all(r.seq == r.x + 100 for r in out)


def test_isolated_suite_turns_runtime_errors_into_error_results(spark, golden_views):
    bad_text = spark.createDataFrame([("1",), ("x",)], "k string")
    bad_text.createOrReplaceTempView("bad_text_t")
    defs = [
        Definition(1, "VOL", "VOL", "src_t", "dst_t"),
        # ANSI cast of 'x' to int fails while the job runs, not while planning
        Definition(2, "MAP", "CAT", "bad_text_t", SOURCE_FILTER="CAST(k AS INT) > 0", KEY_FIELDS="k"),
        Definition(3, "CHTEC", "DUP", "src_t", KEY_FIELDS="n"),
    ]
    run = run_suite(spark, defs, isolate=True)
    got = {r.TEST_ID: (r.RESULT, r.QUERY) for r in run.results.collect()}
    assert got[1][0] == "NOK" and got[3][0] == "NOT OK"
    assert got[2][0] == "ERROR" and "CAT" in got[2][1]
    details = {r.RESULT_ID: r.KEY_FIELDS for r in run.final_details().collect()}
    assert details == {3: "n='e'"}      # the failed check leaves no details


def test_missing_parameter_is_an_error_of_that_check_alone(spark, golden_views):
    defs = [Definition(1, "VOL", "VOL", "src_t", "dst_t", SOURCE_FILTER="k = ?"),
            Definition(2, "CHTEC", "DUP", "src_t", KEY_FIELDS="n")]
    got = {r.TEST_ID: (r.RESULT, r.QUERY) for r in run_suite(spark, defs).results.collect()}
    assert got[1][0] == "ERROR" and "k" in got[1][1] and got[2][0] == "NOT OK"


def test_run_suite_selects_by_set(spark, golden_views):
    defs = [Definition(1, "VOL", "VOL", "src_t", "dst_t"), Definition(2, "CHTEC", "DUP", "src_t", KEY_FIELDS="n")]
    members = spark.createDataFrame([(5, 2)], schemas.SET_MEMBERS)
    assert [r.TEST_ID for r in run_suite(spark, defs, members=members, set_ids=[5]).results.collect()] == [2]
    assert run_suite(spark, defs, members=members, set_ids=[6]).results.count() == 0


def test_stored_statement_runs_again(spark, golden_views):
    defs = [
        Definition(1, "VOL", "VOL", "src_t", "(SELECT * FROM dst_t)", SOURCE_FILTER="n = ?"),
        Definition(2, "MAP", "CON", "src_t", "dst_t", "k = k", "k, n, v", "k, n, v", KEY_FIELDS="k"),
        Definition(3, "CHTEC", "REF", "src_t", "dst_t", "k = k", "k", "k", KEY_FIELDS="k"),
        Definition(4, "CHTEC", "DUP", "src_t", SOURCE_FILTER="n = ?", KEY_FIELDS="n"),
        Definition(5, "MAP", "OBG", "src_t", SOURCE_FILTER="v IS NULL", KEY_FIELDS="n"),
        Definition(6, "MAP", "CON", "src_t", "dst_t", None, "SUM(v)", "SUM(v)"),
        Definition(7, "MAP", "CON", "src_t", "dst_t", "k = k", "k, MAX(v)", "k, MAX(v)", SOURCE_GROUPBY="k",
                   DEST_GROUPBY="k", KEY_FIELDS="k"),
        Definition(8, "MAP", "CAT", "src_t", SOURCE_FILTER="n NOT IN ('a', 'b')"),
    ]
    want = {1: [(1, 5)], 4: [("e", 2)], 8: [(3,)]}
    for r in run_suite(spark, definitions_frame(spark, defs), {"n": "e"}).results.collect():
        rows = [tuple(x) for x in spark.sql(r.QUERY).collect()]
        assert rows, r.TEST_ID
        if r.TEST_ID == 1:
            assert rows == [(2, 5)]
        elif r.TEST_ID in want:
            assert rows == want[r.TEST_ID]


def test_history_is_newest_first(spark, golden_views):
    db = "history_test_db"
    sinks.drop_tables(spark, db)
    sinks.create_tables(spark, db)
    res_t, det_t = f"{db}.test_out_results", f"{db}.test_out_results_details"
    defs = [Definition(1, "CHTEC", "DUP", "src_t", KEY_FIELDS="n"), Definition(2, "VOL", "VOL", "src_t", "dst_t")]
    for _ in range(2):      # two runs within a second
        sinks.record(run_suite(spark, defs), res_t, det_t)
    rows = sinks.history(spark, res_t, det_t).collect()
    assert [r.RESULT_ID for r in rows] == [4, 3, 2, 1]
    assert rows[0].TIMESTAMP > rows[-1].TIMESTAMP
    sinks.drop_tables(spark, db)
