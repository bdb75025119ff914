"""Hot keys in cells, bucketed sides, fingerprints and the keyless report: the
plain answers, and the plans that make them hold at scale."""

import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from parity.operators import checks, compare
from parity.operators.side import prepare
from parity.plans import scenarios
from parity.sources import testdata

SOME = "k int, v int, w string"


def _pairs(df):
    out = Counter()
    for r in df.collect():
        out[tuple(r)[:-1]] += r["pairs"]
    return out


def _hot_frames(spark, n=3000):
    """A third of both sides on one key with n distinct values, copies, NULL keys and one-sided keys."""
    ids = spark.range(0, 3 * n, 1, 6)
    src = ids.selectExpr(f"CASE WHEN id < {n} THEN 7 WHEN id % 50 = 0 THEN NULL ELSE 100 + id % 900 END AS k", "id % 1000 AS v")
    dst = ids.selectExpr(f"CASE WHEN id < {n} THEN 7 WHEN id % 60 = 0 THEN NULL ELSE 500 + id % 900 END AS k", "id % 700 AS v")
    return src, dst


@pytest.mark.parametrize("mode", ["CON", "REF"])
@pytest.mark.parametrize("hot", [1, 100, 2000])
def test_cells_give_the_plain_rows(spark, mode, hot):
    src, dst = _hot_frames(spark, 400)
    fn = checks.content if mode == "CON" else checks.reference
    cmp = fn(spark, src, dst, "k = k", "k, v", "k, v").comparison
    plain = _pairs(cmp.rows(collapse=False, hot=10**9))
    assert cmp._hot_buckets(*[f.select("k").withColumnRenamed("k", n) for f, n in ((src, "__k0"), (dst, "__j0"))], 10**9) is None
    assert _pairs(cmp.rows(hot=hot)) == plain
    assert _pairs(cmp.rows(collapse=False, hot=hot)) == plain
    assert {(r.status, r.side): r.n for r in cmp.summary().collect()} == {
        k: sum(n for t, n in plain.items() if t[-2:] == k) for k in {t[-2:] for t in plain}}


def test_composite_and_nullable_keys_in_cells(spark):
    rows = [(k, v, w) for k in (1, 1, 1, 2, None) for v in (1, 1, 2, None) for w in ("a", None, "b")]
    src, dst = spark.createDataFrame(rows, SOME), spark.createDataFrame(rows[:-9] + [(9, 9, "z")], SOME)
    cmp = checks.content(spark, src, dst, "k = k AND v = v", "w, v", "w, v").comparison
    assert _pairs(cmp.rows(hot=2)) == _pairs(cmp.rows(collapse=False, hot=10**9))


def test_largest_task_of_a_hot_key_is_bounded(spark):
    src, dst = _hot_frames(spark)
    cmp = checks.content(spark, src, dst, "k = k", "k, v", "k, v").comparison

    def largest(rows):
        by_task = rows.groupBy(F.spark_partition_id().alias("p")).count().collect()
        return max(r["count"] for r in by_task), sum(r["count"] for r in by_task)
    most, total = largest(cmp.rows(hot=150))
    plain_most, plain_total = largest(cmp.rows(hot=10**9))
    assert total == plain_total > 600_000           # 1,000 x 700 distinct pairs of the hot key
    assert plain_most > 0.9 * total > 3 * most


def test_no_sketch_for_small_sides(spark):
    testdata.register_views(spark, SF_SMALL, ("orders",))
    side = prepare(spark, "orders", "o_orderkey")
    assert 0 < compare._estimated_bytes(side.df) < compare.SMALL_BYTES
    cmp = checks.content(spark, "orders", "orders", "o_orderkey = o_orderkey", "o_orderkey, o_custkey", "o_orderkey, o_custkey")
    assert cmp.comparison._small and cmp.rows.count() == 0


@pytest.fixture()
def bucketed(spark):
    testdata.register_views(spark, SF_SMALL, ("orders",))
    made = []
    for name, sql in (("bucketed_src", "SELECT NULLIF(o_orderkey, 5) AS o_orderkey, o_orderstatus FROM orders"),
                      ("bucketed_dest", scenarios.DEST_ORDERS_SQL.replace("SELECT o_orderkey,", "SELECT NULLIF(o_orderkey, 9) AS o_orderkey,", 1))):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(sql).write.bucketBy(8, "o_orderkey").sortBy("o_orderkey").saveAsTable(name)
        made.append(name)
    yield made
    for name in made:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _exchanges(df):
    return re.findall(r"Exchange \w+\([^\n]*", df._jdf.queryExecution().executedPlan().toString())


def test_bucketed_sides_join_without_an_exchange(spark, bucketed):
    items = "o_orderkey, o_orderstatus"
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        res = checks.content(spark, *bucketed, "o_orderkey = o_orderkey", items, items)
        assert _exchanges(res.rows) == []
        plain = checks.content(spark, *(spark.table(t).where("true").repartition(3) for t in bucketed),
                               "o_orderkey = o_orderkey", items, items)
        assert _exchanges(plain.rows) != []
        assert _pairs(res.comparison.rows()) == _pairs(plain.comparison.rows()) != Counter()
        other = checks.content(spark, *bucketed, "o_orderstatus = o_orderstatus", items, items, "o_orderkey < 40", "o_orderkey < 40")
        assert _exchanges(other.rows) != [] and other.rows.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


# ---------------------------------------------------------- fingerprints --

def _faulty(spark, src, kind):
    return {"equal": src.repartition(5), "lost": src.where("k <> 17"), "changed": src.selectExpr("k", "IF(k = 3, -1, v) AS v", "w"),
            "swapped": src.selectExpr("k", "IF(k = 3, NULL, v) AS v", "IF(k = 3, CAST(v AS STRING), w) AS w"),
            "nulls moved": src.selectExpr("k", "IF(k = 4, NULL, v) AS v", "IF(k = 4, NULL, w) AS w"),
            "more": src.union(src.where("k = 5")), "extra": src.union(src.where("k = 5").selectExpr("k + 1000", "v", "w")),
            "null key": src.selectExpr("NULLIF(k, 6) AS k", "v", "w")}[kind]


@pytest.mark.parametrize("kind", ["equal", "lost", "changed", "swapped", "nulls moved", "more", "extra", "null key"])
@pytest.mark.parametrize("ranges", [1, 64, compare.RANGES])
def test_fingerprint_verdict_is_the_exact_one(spark, kind, ranges):
    src = spark.range(300).selectExpr("CAST(id AS INT) AS k", "CAST(id * 7 % 50 AS INT) AS v", "CONCAT('w', id % 9) AS w")
    dst = _faulty(spark, src, kind)
    for a, b in ((src, dst), (dst, src), (dst, dst)):
        cmp = checks.content(spark, a, b, "k = k", "v, w", "v, w").comparison
        want = cmp.verdict().first()
        assert cmp.fingerprint_verdict(ranges).first() == want
        if kind != "more":
            assert cmp.fingerprint_verdict(ranges, unique_keys=True).first() == want


def test_equal_sides_with_two_tuples_a_key_differ(spark):
    src = spark.createDataFrame([(1, 1, "a"), (1, 2, "a"), (2, 1, "a")], SOME)
    cmp = checks.content(spark, src, src, "k = k", "v, w", "v, w").comparison
    assert cmp.fingerprint_verdict().first() == cmp.verdict().first() and cmp.verdict().first()["n_differences"] == 2
    assert cmp.differing_ranges().count() == 1 and cmp.differing_ranges(unique_keys=True).count() == 0


def test_fingerprint_reads_equal_sides_once(spark):
    testdata.register_views(spark, SF_SMALL, ("orders",))
    items = "o_orderkey, o_custkey, o_orderstatus"
    cmp = checks.content(spark, "orders", "(SELECT * FROM orders WHERE o_orderkey >= 0)", "o_orderkey = o_orderkey", items, items)
    df = cmp.comparison.fingerprint_verdict(unique_keys=True)
    assert df.first()["result"] == "OK"
    final = df._jdf.queryExecution().executedPlan().finalPhysicalPlan().toString() if hasattr(
        df._jdf.queryExecution().executedPlan(), "finalPhysicalPlan") else df._jdf.queryExecution().executedPlan().toString()
    # no exchange carries a compared column: ranges, sums and counts alone
    assert not re.search(r"Exchange hashpartitioning\([^)]*o_custkey", final)


def test_methods_of_a_content_check(spark, golden):
    src, dst = golden
    exact = checks.content(spark, src, dst, "k = k", "n, v", "n, v", key_fields="k")
    quick = checks.content(spark, src, dst, "k = k", "n, v", "n, v", key_fields="k", method="fingerprint")
    assert exact.verdict.first() == quick.verdict.first()
    assert sorted(exact.keys.collect()) == sorted(quick.keys.collect())
    with pytest.raises(ValueError):
        checks.content(spark, src, dst, "k = k", "n", "n", method="quick")
    with pytest.raises(ValueError):
        checks.content(spark, src, dst, None, "n", "n", method="fingerprint")


# --------------------------------------------------------- keyless report --

def test_cross_report_is_that_of_all_pairs(spark):
    rows = [(1, 1, "a"), (1, 1, "a"), (2, None, "b"), (None, None, None), (3, 3, "c")]
    src, dst = spark.createDataFrame(rows, SOME), spark.createDataFrame(rows[1:4] * 2 + [(9, 9, "z")], SOME)
    for a, b in ((src, dst), (src, dst.where("k < 0")), (src.where("k < 0"), dst), (src.where("k = 3"), src.where("k = 3"))):
        res = checks.content(spark, a, b, None, "v, w", "v, w")
        left, right = ([(r.v, r.w) for r in f.collect()] for f in (a, b))
        want = Counter()
        for t in set(left) | set(right):
            for side, own, other in (("src", left, right), ("dest", right, left)):
                n = own.count(t) * sum(x != t for x in other)
                if n:
                    want[(*t, side, own.count(t), n)] += 1
        assert Counter(map(tuple, res.rows.collect())) == want
        assert res.verdict.first()["n_differences"] == sum(t[-1] for t in want if t[2] == "src")


def test_cross_report_of_the_query_equals_brute_force(spark):
    got = sorted(map(tuple, scenarios.con_cross_report(spark, SF_SMALL).where("side = 'src'").collect()), key=repr)
    con = duckdb.connect()
    brute = con.execute(f"""SELECT o_orderstatus, o_orderkey, 'src', 1, count(*) FROM '{SF_SMALL}/orders.parquet' o,
        '{SF_SMALL}/lineitem.parquet' l WHERE o_orderstatus IS DISTINCT FROM l_linestatus
        OR o_orderkey IS DISTINCT FROM l_orderkey GROUP BY ALL""").fetchall()
    assert got == sorted(brute, key=repr)


def test_cross_report_reads_each_side_once(spark):
    plan = scenarios.con_cross_report(spark, SF_SMALL)
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "ReusedExchange" in text


def test_no_keys_are_broadcast_where_sides_are_large(spark, monkeypatch):
    """The keys of a large side are merged, however few bytes Spark takes them for."""
    src, dst = _hot_frames(spark, 200)
    src, dst = src.selectExpr("k", "v", "v % 3 AS w"), dst.selectExpr("k", "v", "v % 3 AS w")
    con = checks.content(spark, src, dst, "k = k", "k, v", "k, v", key_fields="w").comparison
    ref = checks.reference(spark, src, dst, "k = k", "k", "k", key_fields="w").comparison
    ways = [(c, name) for c in (con, ref) for name in ("keys", "only_in_source", "only_in_destination")]
    small = [sorted(map(tuple, getattr(c, name)().collect()), key=str) for c, name in ways]
    monkeypatch.setattr(compare, "SMALL_BYTES", 0)
    for c in (con, ref):
        c.__dict__.pop("_small", None)
    for (c, name), want in zip(ways, small):
        df = getattr(c, name)()
        assert want and sorted(map(tuple, df.collect()), key=str) == want
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
