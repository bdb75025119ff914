"""Recording as one unit, ids from the run log, history by day, two-phase
duplicates and copy-on-write rewrites."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from parity.operators import checks
from parity.operators.ids import folder_exists, shared_folder
from parity.plans.suite import Definition, history, run_suite
from parity.sinks import rewrite, tables as sinks
from parity.sources import testdata

DEFS = [Definition(1, "CHTEC", "DUP", "src_r", KEY_FIELDS="n"), Definition(2, "VOL", "VOL", "src_r", "dst_r"),
        Definition(3, "MAP", "OBG", "src_r", SOURCE_FILTER="v IS NULL", KEY_FIELDS="n"),
        Definition(4, "MAP", "CAT", "src_r", SOURCE_FILTER="v > 10", KEY_FIELDS="n, v")]


@pytest.fixture(params=[False, True], ids=["plain", "by_day"])
def store(spark, golden, request):
    for df, name in zip(golden, ("src_r", "dst_r")):
        df.createOrReplaceTempView(name)
    db = f"recording_db_{int(request.param)}"
    sinks.drop_tables(spark, db)
    sinks.create_tables(spark, db, by_day=request.param)
    yield f"{db}.{sinks.RESULTS_TABLE}", f"{db}.{sinks.DETAILS_TABLE}"
    sinks.clean(spark, f"{db}.{sinks.RESULTS_TABLE}", f"{db}.{sinks.DETAILS_TABLE}")
    sinks.drop_tables(spark, db)


def _state(spark, store):
    for t in store:
        spark.catalog.refreshTable(t)
    results = sorted((r.RESULT_ID, r.TEST_ID, r.RESULT) for r in spark.table(store[0]).collect())
    details = sorted((r.DETAILS_ID, r.RESULT_ID, r.KEY_FIELDS) for r in spark.table(store[1]).collect())
    return results, details


def _whole(spark, store, runs):
    results, details = _state(spark, store)
    assert [r[0] for r in results] == list(range(1, 4 * runs + 1))
    per_run = len(details) // runs
    assert per_run == 6 and [d[0] for d in details] == list(range(1, 6 * runs + 1))
    for r in results:
        assert sum(d[1] == r[0] for d in details) == {1: 1, 2: 0, 3: 2, 4: 3}[r[1]]


def test_a_run_recorded_twice_adds_nothing(spark, store):
    run = run_suite(spark, DEFS)
    first = [sorted(map(tuple, f.collect())) for f in sinks.record(run, *store)]
    again = [sorted(map(tuple, f.collect())) for f in sinks.record(run, *store)]
    assert first == again and len(first[0]) == 4
    _whole(spark, store, 1)
    for _ in range(2):      # another process that retries the same night
        sinks.record(run_suite(spark, DEFS), *store, run_id="night 7/x")
    _whole(spark, store, 2)
    assert not folder_exists(spark, sinks.staging_folder(spark, "night 7/x", store[0]))


@pytest.mark.parametrize("stop", ["details", "results"])
@pytest.mark.parametrize("then", ["retry", "other run", "recover"])
def test_failure_between_the_appends(spark, store, monkeypatch, stop, then):
    sinks.record(run_suite(spark, DEFS), *store)
    real = sinks.append

    def failing(df, table):
        if table == store[1 if stop == "details" else 0]:
            raise RuntimeError("lost")
        real(df, table)

    run = run_suite(spark, DEFS)
    monkeypatch.setattr(sinks, "append", failing)
    with pytest.raises(RuntimeError):
        sinks.record(run, *store)
    monkeypatch.setattr(sinks, "append", real)
    results, details = _state(spark, store)
    assert len(results) == 4 and len(details) == (6 if stop == "details" else 12)    # no verdict without its details
    shown = sinks.history(spark, *store).collect()
    assert {r.RESULT_ID for r in shown} == {1, 2, 3, 4}
    if then == "retry":
        sinks.record(run, *store)
    elif then == "other run":
        sinks.record(run_suite(spark, DEFS), *store)
    else:
        assert sinks.recover(spark, *store) and not sinks.recover(spark, *store)
    _whole(spark, store, 3 if then == "other run" else 2)


def test_failure_inside_an_append(spark, store, monkeypatch):
    real = sinks.append

    def half(df, table):
        if table == store[1]:
            real(df.where("DETAILS_ID % 2 = 0"), table)
            raise RuntimeError("lost")
        real(df, table)

    run = run_suite(spark, DEFS)
    monkeypatch.setattr(sinks, "append", half)
    with pytest.raises(RuntimeError):
        sinks.record(run, *store)
    monkeypatch.setattr(sinks, "append", real)
    sinks.record(run, *store)
    _whole(spark, store, 1)


def test_failure_before_the_log(spark, store, monkeypatch):
    real = sinks.append
    run = run_suite(spark, DEFS)
    monkeypatch.setattr(sinks, "append", lambda df, table: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        sinks.record(run, *store)
    monkeypatch.setattr(sinks, "append", real)
    assert _state(spark, store) == ([], []) and sinks.recorded(spark, run.run_id, store[0]) is None
    assert not sinks.recover(spark, *store)
    sinks.record(run_suite(spark, DEFS), *store)
    _whole(spark, store, 1)
    assert sinks.clean(spark, *store)        # the folder of the run that never was
    _whole(spark, store, 1)


def test_ids_go_on_after_a_history_without_a_log(spark, store):
    ts = dt.datetime(2024, 5, 6, 7)
    sinks.append(spark.createDataFrame([(41, 1, "q", "OK", "N/A", ts)], sinks.schemas.RESULTS), store[0])
    sinks.append(spark.createDataFrame([(8, 41, "k", ts)], sinks.schemas.DETAILS), store[1])
    for _ in range(2):
        sinks.record(run_suite(spark, DEFS), *store)
    results, details = _state(spark, store)
    assert [r[0] for r in results] == list(range(41, 50)) and [d[0] for d in details] == list(range(8, 21))


def test_next_ids_read_the_log_alone(spark, store):
    sinks.record(run_suite(spark, DEFS), *store)
    log = sinks.run_log(spark, store[0])
    plan = log._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"FileScan parquet \S+", plan)
    assert scans and all("_runs" in s for s in scans)
    jobs = []

    def watch(spark, table, column):
        jobs.append(table)
        raise AssertionError("history read")
    old, sinks.max_id = sinks.max_id, watch
    try:
        sinks.record(run_suite(spark, DEFS), *store)
    finally:
        sinks.max_id = old
    assert jobs == []
    _whole(spark, store, 2)


def test_history_reads_the_days_asked_for(spark, golden):
    for df, name in zip(golden, ("src_r", "dst_r")):
        df.createOrReplaceTempView(name)
    db = "history_days_db"
    sinks.drop_tables(spark, db)
    sinks.create_tables(spark, db, by_day=True)
    store = f"{db}.{sinks.RESULTS_TABLE}", f"{db}.{sinks.DETAILS_TABLE}"
    for day in range(1, 5):
        sinks.record(run_suite(spark, DEFS, timestamp=dt.datetime(2025, 3, day, 12)), *store)
    whole = sinks.history(spark, *store).collect()
    assert len(whole) == 28
    some = sinks.history(spark, *store, since="2025-03-03", latest=9)
    assert some.collect() == whole[:9]
    assert sinks.history(spark, *store, since=dt.date(2025, 3, 3)).collect() == whole[:14]
    assert sinks.history(spark, *store, latest=3).collect() == whole[:3]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    scans = re.findall(r"PartitionFilters: \[[^\]]*DAY[^\]]*2025-03-03[^\]]*\]", plan)
    assert len(scans) == plan.count("FileScan parquet") >= 2
    kept = spark.table(store[0]).where("DAY >= DATE'2025-03-03'").select(F.input_file_name()).distinct().collect()
    assert {re.search(r"DAY=([\d-]+)", r[0]).group(1) for r in kept} == {"2025-03-03", "2025-03-04"}
    # frames without a DAY column are filtered by TIMESTAMP
    plain = [spark.table(t).drop("DAY") for t in store]
    assert len(history(*plain, since="2025-03-04").collect()) == 7
    sinks.truncate(spark, store[0])
    assert spark.table(store[0]).count() == 0 and sinks.run_log(spark, store[0]).first()["last"] is None
    sinks.drop_tables(spark, db)
    assert not spark.catalog.tableExists(sinks.runs_table(store[0]))


# -------------------------------------------------- two-phase duplicates --

@pytest.mark.parametrize("most", [checks.MOST_HASHES, 1])
def test_two_phases_find_the_same_duplicates(spark, monkeypatch, most):
    monkeypatch.setattr(checks, "MOST_HASHES", most)
    rows = [("a", None), (None, "a"), ("a", None), (None, None), (None, None), ("b", "c"), ("bc", ""), ("x" * 9000, "y"),
            ("x" * 9000, "y"), ("x" * 9000, "z")]
    df = spark.createDataFrame(rows, "t string, u string").repartition(3)
    for cols in ("t, u", "u", "t"):
        plain, quick = (checks.duplicates(spark, df, cols, two_phase=two) for two in (False, True))
        assert sorted(plain.rows.collect(), key=repr) == sorted(quick.rows.collect(), key=repr)
        assert sorted(plain.keys.collect()) == sorted(quick.keys.collect())
        assert plain.verdict.first() == quick.verdict.first()
    none = checks.duplicates(spark, df.where("t = 'q'"), "t", two_phase=True)
    assert none.verdict.first()["result"] == "OK" and none.rows.count() == 0


def test_only_rows_of_repeated_hashes_are_shuffled(spark):
    testdata.register_views(spark, SF_SMALL, ("documents",))
    res = checks.duplicates(spark, "documents", "text, lang, source", two_phase=True)
    some = checks._repeated(spark.table("documents"), ["text", "lang", "source"])
    assert some.count() == (res.rows.agg(F.sum("count")).first()[0] or 0) < spark.table("documents").count() / 4
    plan = res.rows._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    shuffle = next(i for i, x in enumerate(lines) if "Exchange hashpartitioning(text" in x)
    assert any("BroadcastHashJoin" in x and "LeftSemi" in x for x in lines[shuffle:])


# ------------------------------------------------------ copy on write ------

def _files(path):
    return {os.path.relpath(os.path.join(d, f), path): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_rewrite_touches_affected_partitions_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(60).selectExpr("id", "CONCAT('name-', id) AS s", "IF(id % 6 = 0, NULL, id % 6) AS p", "CAST(id % 2 AS STRING) AS q")
    df.repartition(2).write.partitionBy("p", "q").parquet(path)
    before = _files(path)
    done = rewrite.rewrite_files(spark, path, "s", "name-13", "renamed-13", ["p", "q"])
    assert done.partitions == [{"p": 1, "q": 1}] or done.partitions == [{"p": 1, "q": "1"}]
    after = _files(path)
    touched = {f for f in before if f.startswith("p=1/q=1/")}
    assert {f: t for f, t in after.items() if not f.startswith("p=1/q=1/")} == {f: t for f, t in before.items() if f not in touched}
    assert not touched & set(after) and len(done.files) == 1 and "p=1/q=1" in done.files[0]
    want = {r.id: r.s.replace("name-13", "renamed-13") for r in df.collect()}
    assert {r.id: r.s for r in spark.read.parquet(path).collect()} == want
    nothing = rewrite.rewrite_files(spark, path, "s", "absent", "x", ["p", "q"])
    assert nothing == rewrite.Rewrite() and _files(path) == after
    nulls = rewrite.rewrite_files(spark, path, "s", "name-6", "six", ["p", "q"])       # 6 and 60..: p is NULL
    assert {"p": None, "q": 0} in nulls.partitions or {"p": None, "q": "0"} in nulls.partitions
    assert {r.id: r.s for r in spark.read.parquet(path).collect()} == {i: s.replace("name-6", "six") for i, s in want.items()}
    assert rewrite.clean(spark, done) and rewrite.clean(spark, nulls) and not rewrite.clean(spark, nothing)
    with pytest.raises(ValueError):
        rewrite.rewrite_files(spark, path, "q", "1", "2", ["p", "q"])


def test_rewrite_without_partitions_and_after_a_failed_swap(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "u")
    spark.createDataFrame([("a1", 1), ("b1", 2), (None, 3)], "s string, v int").write.parquet(path)
    before = _files(path)
    real = rewrite.publish
    staged = []
    monkeypatch.setattr(rewrite, "publish", lambda spark, p, s, by: staged.append(s) or (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        rewrite.rewrite_files(spark, path, "s", "a", "A")
    assert _files(path) == before and staged[0].startswith(shared_folder(spark))
    real(spark, path, staged[0])
    assert sorted(map(tuple, spark.read.parquet(path).collect()), key=repr) == sorted([("A1", 1), ("b1", 2), (None, 3)], key=repr)
