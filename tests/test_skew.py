"""A hot key (about 40% of the rows on one key, on both sides) and NULL keys:
pair-free counts, folded pair report and keys equal the brute-force join."""

import duckdb

from conftest import SF_SMALL
from parity.operators import checks

HOT = ("SELECT CASE WHEN l_linenumber <= 3 THEN 0 WHEN l_linenumber = 7 THEN NULL ELSE l_orderkey END AS k, "
       "l_returnflag AS f FROM read_parquet('{p}')")


def _frames(spark):
    p = f"{SF_SMALL}/lineitem.parquet"
    spark.read.parquet(p).createOrReplaceTempView("lineitem_skew_src")
    src = spark.sql("SELECT CASE WHEN l_linenumber <= 3 THEN 0 WHEN l_linenumber = 7 THEN NULL "
                    "ELSE l_orderkey END AS k, l_returnflag AS f, l_linestatus FROM lineitem_skew_src")
    return src, src.where("l_linestatus = 'O'")


def _brute():
    p = f"{SF_SMALL}/lineitem.parquet"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW s AS {HOT.format(p=p)}")
    con.execute(f"CREATE VIEW d AS SELECT k, f FROM ({HOT.format(p=p).replace('l_returnflag AS f', 'l_returnflag AS f, l_linestatus')}) x "
                "WHERE l_linestatus = 'O'")
    j = ("SELECT s.k AS sk, s.f AS sf, d.k AS dk, d.f AS df, "
         "CASE WHEN s.k IS DISTINCT FROM d.k OR s.f IS DISTINCT FROM d.f THEN 'NO MATCH' "
         "WHEN d.k IS NULL AND d.f IS NULL THEN 'NO MATCH @ ONLY TABELA A' ELSE 'MATCH' END AS status, "
         "CASE WHEN s.p AND d.p THEN 'both' WHEN s.p THEN 'src' ELSE 'dest' END AS side "
         "FROM (SELECT *, TRUE AS p FROM s) s FULL OUTER JOIN (SELECT *, TRUE AS p FROM d) d ON s.k = d.k")
    summary = dict(((st, sd), n) for st, sd, n in con.execute(
        f"SELECT status, side, COUNT(*) FROM ({j}) j GROUP BY ALL").fetchall())
    keys = {r[0] for r in con.execute(
        f"SELECT DISTINCT CASE WHEN sk IS NULL THEN 'k IS NULL' ELSE 'k=''' || CAST(sk AS VARCHAR) || '''' END "
        f"FROM ({j}) j WHERE status <> 'MATCH'").fetchall()}
    hot_pairs = con.execute(f"SELECT COUNT(*) FROM ({j}) j WHERE sk = 0").fetchone()[0]
    return summary, keys, hot_pairs


def test_hot_key_and_null_keys(spark):
    src, dst = _frames(spark)
    res = checks.content(spark, src, dst, "k = k", "k, f", "k, f", key_fields="k")
    want, want_keys, hot_pairs = _brute()
    assert hot_pairs > 1_000_000            # the hot key alone is over a million pairs
    got = {(r.status, r.side): r.n for r in res.comparison.summary().collect()}
    assert got == want
    rows = res.comparison.rows()
    folded = {}
    for r in rows.collect():
        folded[(r.status, r.side)] = folded.get((r.status, r.side), 0) + r.pairs
    assert folded == want
    assert rows.where("k_src = 0").count() <= 9      # hot key: one row per distinct (src, dest) record pair
    assert {r[0] for r in res.keys.collect()} == want_keys
