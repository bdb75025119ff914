"""Golden results on the tiny frames of FIXTURES.md section 3."""

from collections import Counter

from pyspark.sql import functions as F

from parity.functions import columns as C
from parity.operators import checks


def _statuses(df):
    """(status, side) -> number of record pairs; rows carry a ``pairs`` count."""
    out = Counter()
    for r in df.collect():
        out[(r["status"], r["side"])] += r["pairs"] if "pairs" in r else 1
    return out


def _summary(df):
    return {(r["status"], r["side"]): r["n"] for r in df.collect()}


def test_content_keyed_rows(spark, golden):
    src, dst = golden
    res = checks.content(spark, src, dst, "k = k", "k, n, v", "k, n, v", key_fields="k")
    rows = res.comparison.rows()
    assert set(rows.columns) >= {"k_src", "k_dest", "n_src", "n_dest", "v_src", "v_dest", "status", "side"}
    got = _statuses(rows)
    # exact table of FIXTURES.md: NULL-key rows are all NULL -> ONLY A on their side
    assert got[(C.ONLY_A, "src")] == 1 and got[(C.ONLY_A, "dest")] == 1
    assert got[(C.NO_MATCH, "src")] == 2 and got[(C.NO_MATCH, "dest")] == 1
    assert got[(C.MATCH, "both")] == 2 and got[(C.NO_MATCH, "both")] == 1


def test_summary_equals_pairs(spark, golden):
    src, dst = golden
    for subtype in ("CON", "REF"):
        fn = checks.content if subtype == "CON" else checks.reference
        res = fn(spark, src, dst, "k = k", "k, n, v", "k, n, v", key_fields="k")
        pairs = Counter({k: v for k, v in _statuses(res.comparison.rows()).items()})
        assert _summary(res.comparison.summary()) == dict(pairs), subtype
    # compare only v: (3,NULL) vs (3,NULL) is an all-NULL match -> ONLY A on both
    res = checks.content(spark, src, dst, "k = k", "v", "v", key_fields="k")
    assert _summary(res.comparison.summary()) == dict(_statuses(res.comparison.rows()))


def test_collapsed_rows_equal_plain_join(spark, golden):
    src, dst = golden
    dup = src.unionByName(src)          # every source record twice: 2x2 pairs on key 5
    res = checks.content(spark, dup, dst.unionByName(dst), "k = k", "n, v", "n, v")
    collapsed = _statuses(res.comparison.rows())
    plain = _statuses(res.comparison.rows(collapse=False))
    assert collapsed == plain
    assert res.comparison.rows().count() < res.comparison.rows(collapse=False).count()
    assert _summary(res.comparison.summary()) == dict(plain)


def test_keys(spark, golden):
    src, dst = golden
    con = checks.content(spark, src, dst, "k = k", "k, n, v", "k, n, v", key_fields="k")
    assert sorted(r[0] for r in con.keys.collect()) == sorted(["k='2'", "k='5'", "k IS NULL"])
    ref = checks.reference(spark, src, dst, "k = k", "k, n, v", "k, n, v", key_fields="k")
    assert sorted(r[0] for r in ref.keys.collect()) == sorted(["k='5'", "k IS NULL"])
    assert con.verdict.first()["result"] == "NOK"


def test_volume(spark, golden):
    src, dst = golden
    v = checks.volume(spark, src, dst).verdict.first()
    assert (v["src_count"], v["dest_count"], v["result"]) == (6, 5, "NOK")


def test_cross_sum(spark, golden):
    src, dst = golden
    res = checks.content(spark, src, dst, None, "SUM(v)", "SUM(v)")
    r = res.comparison.rows().first()
    assert (r["SUM_v_src"], r["SUM_v_dest"], r["status"]) == (131, 71, C.NO_MATCH)
    assert res.verdict.first()["result"] == "NOK"


def test_cross_empty_source_is_ok(spark, golden):
    src, dst = golden
    res = checks.content(spark, src, dst, None, "v", "v", src_filter="k > 100")
    assert res.verdict.first()["result"] == "OK"
    assert res.comparison.summary().count() == 0


def test_cross_multiset_equals_brute_force(spark, golden):
    src, dst = golden
    res = checks.content(spark, src, dst, None, "n, v", "n, v", key_fields="k")
    brute = (src.alias("s").crossJoin(dst.alias("d"))
             .where(~F.col("s.n").eqNullSafe(F.col("d.n")) | ~F.col("s.v").eqNullSafe(F.col("d.v"))))
    assert res.verdict.first()["n_differences"] == brute.count()
    bkeys = {C_ for C_ in brute.select(C.key_text(["k"], [F.col("s.k")]).alias("x")).distinct().toPandas()["x"]}
    assert {r[0] for r in res.keys.collect()} == bkeys


def test_duplicates(spark, golden):
    src, _ = golden
    d = checks.duplicates(spark, src, "n")
    assert [(r["n"], r["count"]) for r in d.rows.collect()] == [("e", 2)]
    assert d.verdict.first()["result"] == "NOT OK"
    d2 = checks.duplicates(spark, src, "n", group_by="n")
    assert d2.rows.columns == ["n", "count"]
    assert [r[0] for r in d2.keys.collect()] == ["n='e'"]


def test_violations_null_key_text(spark, golden):
    src, _ = golden
    v = checks.violations(spark, src, "v IS NULL", "n")
    assert sorted(r[0] for r in v.keys.collect()) == ["n IS NULL", "n='c'"]
    assert v.verdict.first()["result"] == "NOK"


def test_mixed_types_align(spark):
    src = spark.createDataFrame([(1, 10, 1.5, "7"), (2, 20, 2.0, "8")], "k int, a int, b double, c string")
    dst = spark.sql("SELECT CAST(1 AS BIGINT) AS k, CAST(10 AS BIGINT) AS a, CAST(1.5 AS DECIMAL(10,2)) AS b, 7 AS c "
                    "UNION ALL SELECT 2, 21, 2.0, 8")
    res = checks.content(spark, src, dst, "k = k", "a, b, c", "a, b, c", key_fields="k")
    got = _summary(res.comparison.summary())
    assert got == dict(_statuses(res.comparison.rows()))
    assert got == {(C.MATCH, "both"): 1, (C.NO_MATCH, "both"): 1}
    assert [r[0] for r in res.keys.collect()] == ["k='2'"]
    cross = checks.content(spark, src, dst, None, "a", "a")
    assert cross.verdict.first()["n_differences"] == 3


def test_duplicates_neutral_group_by(spark, golden):
    src, _ = golden
    for g in ("1 = 1", "1=1", "", None):
        d = checks.duplicates(spark, src, "n", group_by=g)
        assert [(r["n"], r["count"]) for r in d.rows.collect()] == [("e", 2)]


def test_outside_catalogue_nulls_agree_with_predicate(spark, golden):
    from parity.operators.checks import outside_catalogue
    src, _ = golden
    allowed = spark.createDataFrame([("a",), ("b",), ("e",), (None,)], "n string")
    by_table = outside_catalogue(src, "n", allowed)
    by_predicate = checks.catalogue(spark, src, "n NOT IN ('a', 'b', 'e')", "n").rows
    assert [r.n for r in by_table.collect()] == [r.n for r in by_predicate.collect()] == ["c"]
    strict = outside_catalogue(src, "n", allowed, null_is_violation=True)
    assert sorted([r.n for r in strict.collect()], key=repr) == sorted(["c", None], key=repr)


def test_single_row_is_the_plans(spark, golden):
    """Neither a scalar subquery nor text that looks like an aggregate makes a side one row."""
    from parity.operators.side import prepare
    src, dst = golden
    dst.createOrReplaceTempView("golden_dst")
    assert not prepare(spark, src, "k + (SELECT max(k) FROM golden_dst)").single_row
    assert not prepare(spark, src, "concat('max(', n)").single_row
    assert not prepare(spark, src, "sum(v) OVER (PARTITION BY k)").single_row
    assert prepare(spark, src, "sum(v)").single_row and prepare(spark, src, "1 + max(v)").single_row
    res = checks.content(spark, src, dst, None, "concat('max(', n)", "n")
    assert res.verdict.first()["n_differences"] == 29
    assert dict(res.rows.groupBy("side").sum("pairs").collect()) == {"src": 29, "dest": 29}   # the report, no pairs


def test_counts_beyond_bigint(spark):
    """Folded counts whose product passes the largest BIGINT."""
    from parity.operators import compare
    from parity.operators.side import prepare
    big = [0, 1, 7, 2**31 - 1, 2**31, 2**32 - 1, 2**32 + 5, 4_000_000_000, 3 * 10**12]
    src = spark.createDataFrame([(a, b) for a in big for b in big], "c long, d long")
    for frame, want in ((src, sum(big) ** 2), (src.where("c < 100"), 8 * sum(big)), (src.where("c < 0"), 0)):
        halves = frame.agg(*[F.expr(e) for e in compare._sum_of_products("m", "c", "d")])
        assert halves.selectExpr(f"{compare._total('m')} AS m").first()["m"] == want
    out = compare._summary_from_totals(spark.sql("SELECT CAST(32000000000000000000 AS DECIMAL(38,0)) AS m"),
                                       [(C.NO_MATCH, "both", "m")])
    assert out.first()["n"] == 9223372036854775807
    assert compare.verdict_of(out.union(out)).first()["result"] == "NOK"
    assert prepare(spark, src, "count(1)").single_row


def test_mixed_types_in_all_views(spark):
    """rows, summary, verdict and keys compare as Spark's ``=`` does."""
    cases = [("STRING", "'1.5'", "DECIMAL(10,0)", "2"), ("STRING", "'3000000000'", "INT", "5"),
             ("STRING", "'2'", "DECIMAL(10,2)", "2.00"), ("DECIMAL(20,0)", "7", "DECIMAL(20,5)", "7.00000"),
             ("INT", "1", "DOUBLE", "1.5"), ("DATE", "'2024-01-01'", "TIMESTAMP", "'2024-01-01 00:00:00'"),
             ("STRING", "NULL", "INT", "NULL"), ("BIGINT", "3", "INT", "3"), ("STRING", "' 4'", "BIGINT", "4")]
    for a, x, b, y in cases:
        src = spark.sql(f"SELECT 1 AS k, CAST({x} AS {a}) AS v, 0 AS z")
        dst = spark.sql(f"SELECT 1 AS k, CAST({y} AS {b}) AS v, 0 AS z")
        want = spark.sql(f"SELECT CAST({x} AS {a}) <=> CAST({y} AS {b}) AS same").first()["same"]
        res = checks.content(spark, src, dst, "k = k", "v, z", "v, z", key_fields="k")
        assert (res.verdict.first()["result"] == "OK") == want, (a, x, b, y)
        assert _summary(res.comparison.summary()) == dict(_statuses(res.comparison.rows())), (a, x, b, y)
        assert (res.keys.count() == 0) == want
        wide = checks.content(spark, src, dst, "k = k", "v, z", "v, z", key_fields="z")
        assert (wide.keys.count() == 0) == want
        cross = checks.content(spark, src, dst, None, "v", "v")
        assert (cross.verdict.first()["result"] == "OK") == want
        ref = checks.reference(spark, src, dst, "v = v", "v", "v")
        matched = bool(want) and x != "NULL"
        assert {s for s, _ in _summary(ref.comparison.summary())} == ({C.MATCH} if matched else {C.ONLY_A} | (
            set() if x == "NULL" else {C.ONLY_B}))


def test_names_match_without_regard_to_case(spark, golden):
    src, dst = golden
    for key, select, fields in (("k = k", "K, v", "k"), ("K = k", "k, v", "K"), ("K = K", "n, V", "k, N")):
        got = checks.content(spark, src, dst, key, select, select, key_fields=fields)
        want = checks.content(spark, src, dst, "k = k", select.lower(), select.lower(), key_fields=fields.lower())
        assert _summary(got.comparison.summary()) == _summary(want.comparison.summary())
        assert {r[0].lower() for r in got.keys.collect()} == {r[0].lower() for r in want.keys.collect()}
        assert dict(_statuses(got.comparison.rows())) == dict(_statuses(want.comparison.rows()))


def test_keys_on_another_column_with_nulls(spark):
    """Key fields besides the join key, NULLs everywhere, against every joined pair."""
    import itertools
    vals = [(k, g, v) for k, g, v in itertools.product((1, 2, None), ("x", None), (5, None))]
    src = spark.createDataFrame(vals + [(3, "y", 6), (4, None, 7)], "k int, g string, v int")
    dst = spark.createDataFrame([(1, None, 5), (2, "x", None), (2, None, 5), (4, "z", 7), (6, None, 1), (7, "w", 2)],
                                "k int, g string, v int")
    s, d = src.alias("s"), dst.alias("d")
    pairs = s.join(d, F.col("s.k") == F.col("d.k"), "full_outer")
    text = C.key_text(["g"], [F.col("s.g")])
    con = checks.content(spark, src, dst, "k = k", "v", "v", key_fields="g")
    want = pairs.where(~F.col("s.v").eqNullSafe(F.col("d.v")) | F.col("d.v").isNull() | F.col("s.v").isNull())
    assert {r[0] for r in con.keys.collect()} == {r[0] for r in want.select(text).collect()}
    ref = checks.reference(spark, src, dst, "k = k", "k", "k", key_fields="g")
    gone = src.join(dst, src["k"] == dst["k"], "left_anti").select(C.key_text(["g"]))
    got = {r[0] for r in ref.keys.collect()}
    dest_only_null = dst.join(src, src["k"] == dst["k"], "left_anti").where("g IS NULL").count() > 0
    assert got == {r[0] for r in gone.collect()} | ({"g IS NULL"} if dest_only_null else set())
    only = ref.comparison.only_in_source()
    assert only.count() == src.join(dst, src["k"] == dst["k"], "left_anti").count()


def test_key_extraction_has_no_sort_aggregate(spark, golden):
    src, dst = golden
    res = checks.content(spark, src, dst, "k = k", "n, v", "n, v", key_fields="k")
    assert "SortAggregate" not in res.keys._jdf.queryExecution().executedPlan().toString()
