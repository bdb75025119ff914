"""Reconciliation scenarios over the driver's test tables.

Each scenario is a check the original framework would run on a migrated
table, expressed with this package's operators over the whole test tables.
Where a scenario needs a "destination" that differs from its source, the
destination is derived from the given tables by a deterministic rewrite
(rows dropped, values changed, rows added), like a faulty copy job would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parity.operators import checks
from parity.operators.checks import outside_catalogue
from parity.sources import testdata
from parity.sources.local import literal_frame

# A faulty copy of ``orders``: every 50th key lost, status nulled on every
# 41st and overwritten on every 37th, every 500th row re-inserted under a
# new key.  Shared with the oracle SQL.
DEST_ORDERS_SQL = (
    "SELECT o_orderkey, CASE WHEN o_orderkey % 41 = 0 THEN NULL "
    "WHEN o_orderkey % 37 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus "
    "FROM orders WHERE o_orderkey % 50 <> 0 "
    "UNION ALL SELECT o_orderkey + 10000000 AS o_orderkey, o_orderstatus FROM orders "
    "WHERE o_orderkey % 500 = 0")

# Lines by what became of them, joined to their order on its key as trimmed text.
UNION_TRIM_SQL = """SELECT m.fate, m.l_linenumber, o.o_orderkey, o.o_orderstatus
FROM (SELECT 'open' AS fate, l_orderkey, l_linenumber FROM lineitem
      WHERE SUBSTRING(l_linestatus, 1, 1) = 'O' AND TRIM(l_returnflag) = 'N'
      UNION ALL
      SELECT 'accepted', l_orderkey, l_linenumber FROM lineitem
      WHERE l_linestatus LIKE 'F%' AND TRIM(l_returnflag) = 'A'
      UNION ALL
      SELECT 'returned', l_orderkey, l_linenumber FROM lineitem WHERE TRIM(l_returnflag) = 'R') m
JOIN orders o ON TRIM(CAST(o.o_orderkey AS STRING)) = TRIM(CAST(m.l_orderkey AS STRING))"""

UNION_TRIM_SRC_FILTER = ("l_returnflag = 'R' OR (l_returnflag = 'A' AND l_linestatus = 'F') "
                         "OR (l_returnflag = 'N' AND l_linestatus = 'O')")

NATION_RENAMED_SQL = ("(SELECT n_nationkey, CASE WHEN n_nationkey = 7 THEN 'RENAMED' ELSE n_name END AS n_name, "
                      "n_regionkey FROM nation)")

CUSTOMER_NULL_KEYS_SQL = ("(SELECT CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_custkey END AS k, c_name "
                          "FROM customer)")

LINESTATUS_WITH_NULLS_SQL = ("(SELECT CASE WHEN l_linenumber = 7 THEN NULL ELSE l_linestatus END AS l_linestatus "
                             "FROM lineitem)")

NATION_SUBSET_SQL = "(SELECT n_nationkey, n_name, n_regionkey FROM nation WHERE n_regionkey <> 2)"

SEGMENT_WITH_NULLS_SQL = "(SELECT c_custkey, NULLIF(c_mktsegment, 'BUILDING') AS c_mktsegment FROM customer)"

ORDERS_BY_PRIORITY_SQL = "(SELECT o_orderkey AS k, o_orderpriority AS prio FROM orders)"
ORDERS_SHIFTED_SQL = ("(SELECT o_orderkey + 40 AS j, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END "
                      "AS prio FROM orders WHERE o_orderkey % 4 <> 1)")

LINES_AS_TEXT_SQL = ("(SELECT l_orderkey AS k, l_linenumber AS n, CASE WHEN l_linenumber % 3 = 0 THEN "
                     "CONCAT(CAST(CAST(l_quantity AS INT) AS STRING), '.5') ELSE "
                     "CAST(CAST(l_quantity AS INT) AS STRING) END AS v FROM lineitem)")
LINES_AS_DECIMAL_SQL = "(SELECT l_orderkey AS k, l_linenumber AS n, CAST(l_quantity AS DECIMAL(10, 0)) AS v FROM lineitem)"

ORDERS_AS_TEXT_SQL = ("(SELECT CAST(o_orderkey AS STRING) AS k, CASE WHEN o_orderkey % 7 = 0 THEN '3000000000' "
                      "ELSE CAST(o_custkey AS STRING) END AS v FROM orders)")
ORDERS_AS_INT_SQL = "(SELECT CAST(o_orderkey AS INT) AS k, CAST(o_custkey AS INT) AS v FROM orders)"

# The catalogue of allowed part types used by cat_catalogue_table.
ALLOWED_PART_TYPES = ("PROMO", "SMALL", "LARGE")


# A copy of ``orders`` with some customers changed and some rows lost.
ORDERS_MOVED_SQL = ("(SELECT o_orderkey, CASE WHEN o_orderkey % 29 = 0 THEN o_custkey + 2 ELSE o_custkey END AS o_custkey, "
                    "o_orderstatus FROM orders WHERE o_orderkey % 31 <> 0)")


# Lines dealt to one key for a good quarter of the rows, with many values under it.
HOT_LINES_SQL = ("(SELECT CASE WHEN l_linenumber <= 2 THEN 0 WHEN l_linenumber = 7 AND l_orderkey % 5 = 0 THEN NULL "
                 "ELSE l_orderkey END AS k, l_partkey % 2000 AS v FROM lineitem)")
HOT_LINES_OPEN_SQL = HOT_LINES_SQL.replace("FROM lineitem", "FROM lineitem WHERE l_linestatus = 'O'")
#: Records from which on con_hot_rows treats a bucket of keys as hot.
HOT_LINES_FROM = 1000


def _views(spark: SparkSession, sf_dir: str, *names: str) -> None:
    testdata.register_views(spark, sf_dir, names)


def _dest_orders(spark: SparkSession) -> DataFrame:
    return spark.sql(DEST_ORDERS_SQL)


# ----------------------------------------------------------------- volume --

def vol_orders_lineitem(spark, sf_dir):
    _views(spark, sf_dir, "orders", "lineitem")
    return checks.volume(spark, "orders", "(SELECT DISTINCT l_orderkey FROM lineitem)").verdict


def vol_bound_param(spark, sf_dir):
    _views(spark, sf_dir, "orders")
    return checks.volume(spark, "orders", "orders", "o_orderstatus = ?", "o_orderstatus=?",
                         params={"o_orderstatus": "F"}).verdict


def vol_params_report(spark, sf_dir):
    _views(spark, sf_dir, "orders")
    return checks.volume(spark, "orders", "orders",
                         "o_orderstatus = ? AND O_ORDERPRIORITY = ?", "o_orderstatus = ?",
                         params={"ref_date": "2025-12-31", "o_orderpriority": "1-URGENT",
                                 "o_orderstatus": "F"}).verdict


# ---------------------------------------------------------------- content --

def _flagship(spark, sf_dir):
    _views(spark, sf_dir, "orders")
    return checks.content(spark, "orders", _dest_orders(spark), "o_orderkey = o_orderkey",
                          "o_orderkey, o_orderstatus", "o_orderkey, o_orderstatus",
                          key_fields="o_orderkey")


def con_keyed_rows(spark, sf_dir):
    return _flagship(spark, sf_dir).rows


def con_keyed_status_counts(spark, sf_dir):
    s = _flagship(spark, sf_dir).comparison.summary()
    return s.groupBy("status").agg(F.sum("n").cast("bigint").alias("n"))


def con_keyed_side(spark, sf_dir):
    return _flagship(spark, sf_dir).comparison.summary()


def con_verdict(spark, sf_dir):
    return _flagship(spark, sf_dir).verdict


def con_keys(spark, sf_dir):
    return _flagship(spark, sf_dir).keys


def con_keyed_agg(spark, sf_dir):
    _views(spark, sf_dir, "lineitem")
    return checks.content(spark, "lineitem", "lineitem", "l_orderkey = l_orderkey",
                          "l_orderkey, SUM(l_linenumber)", "l_orderkey, SUM(l_linenumber)",
                          dest_filter="l_returnflag <> 'N'",
                          src_group_by="l_orderkey", dest_group_by="l_orderkey").rows


def con_renamed_key(spark, sf_dir):
    _views(spark, sf_dir, "orders", "events")
    return checks.content(spark, "orders", "events", "o_custkey = user_id",
                          "o_custkey, COUNT(1)", "user_id, COUNT(1)",
                          src_group_by="o_custkey", dest_group_by="user_id").comparison.summary()


def con_composite_dupkeys(spark, sf_dir):
    _views(spark, sf_dir, "lineitem")
    return checks.content(spark, "lineitem", "lineitem",
                          "l_orderkey = l_orderkey AND l_linenumber = l_linenumber",
                          "l_orderkey, l_linenumber, l_returnflag", "l_orderkey, l_linenumber, l_returnflag",
                          dest_filter="l_linestatus = 'O'").comparison.summary()


def con_star(spark, sf_dir):
    _views(spark, sf_dir, "nation")
    return checks.content(spark, "nation", NATION_RENAMED_SQL, "n_nationkey = n_nationkey",
                          "*", "*").comparison.summary()


def con_cross_agg(spark, sf_dir):
    _views(spark, sf_dir, "orders", "customer")
    return checks.content(spark, "orders", "customer", None,
                          "COUNT(DISTINCT o_custkey)", "COUNT(DISTINCT c_custkey)").comparison.rows()


def con_cross_rows(spark, sf_dir):
    _views(spark, sf_dir, "region")
    return checks.content(spark, "region", "region", None, "r_regionkey", "COUNT(1) - 1").comparison.rows()


def con_cross_empty(spark, sf_dir):
    _views(spark, sf_dir, "orders", "lineitem")
    return checks.content(spark, "orders", "lineitem", None, "o_orderstatus", "l_linestatus",
                          src_filter="o_totalprice < 0").verdict


def con_cross_multiset(spark, sf_dir):
    _views(spark, sf_dir, "orders", "lineitem")
    return checks.content(spark, "orders", LINESTATUS_WITH_NULLS_SQL, None,
                          "o_orderstatus", "l_linestatus").verdict


def con_cross_report(spark, sf_dir):
    """Differing tuples of two row-level sides without a join key, no pair built."""
    _views(spark, sf_dir, "orders", "lineitem")
    return checks.content(spark, "orders", "lineitem", None, "o_orderstatus, o_orderkey", "l_linestatus, l_orderkey").rows


def con_hot_rows(spark, sf_dir):
    """The pair report of a hot key, joined in cells, counted by status, side and value."""
    _views(spark, sf_dir, "lineitem")
    rows = checks.content(spark, HOT_LINES_SQL, HOT_LINES_OPEN_SQL, "k = k", "k, v", "k, v").comparison.rows(hot=HOT_LINES_FROM)
    return (rows.groupBy("status", "side", F.expr("coalesce(v_src, v_dest) % 7").alias("v"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum("pairs").alias("pairs")))


def con_fingerprint(spark, sf_dir):
    """Verdicts by fingerprints: an equal copy, a faulty one, and equal sides whose keys repeat with other values."""
    _views(spark, sf_dir, "orders", "lineitem")

    def verdict(name, src, dest, key, select):
        found = checks.content(spark, src, dest, f"{key} = {key}", select, select, method=checks.FINGERPRINT).verdict
        return found.select(F.lit(name).alias("copy"), "n_differences", "result", "execution_parameter")

    return (verdict("equal", "orders", "(SELECT o_orderstatus, o_orderkey FROM orders)", "o_orderkey", "o_orderkey, o_orderstatus")
            .unionByName(verdict("faulty", "orders", f"({DEST_ORDERS_SQL})", "o_orderkey", "o_orderkey, o_orderstatus"))
            .unionByName(verdict("repeated", "lineitem", "lineitem", "l_orderkey", "l_returnflag")))


def con_same_names(spark, sf_dir):
    """Select items that reduce to one name, and a repeated column."""
    _views(spark, sf_dir, "orders")
    items = "o_orderkey, o_custkey + 1, o_custkey - 1, o_orderstatus, o_orderstatus"
    return checks.content(spark, "orders", ORDERS_MOVED_SQL, "o_orderkey = o_orderkey", items, items,
                          key_fields="o_orderkey").rows


# -------------------------------------------------------------- reference --

def ref_documents_labels(spark, sf_dir):
    _views(spark, sf_dir, "documents", "labels")
    return checks.reference(spark, "documents", "labels", "doc_id = doc_id", "doc_id", "doc_id").comparison.summary()


def _f_orders_vs_lineitem(spark, sf_dir):
    _views(spark, sf_dir, "orders", "lineitem")
    return checks.reference(spark, "orders", "(SELECT DISTINCT l_orderkey FROM lineitem)",
                            "o_orderkey = l_orderkey", "o_orderkey", "l_orderkey",
                            src_filter="o_orderstatus = 'F'")


def ref_both_directions(spark, sf_dir):
    return _f_orders_vs_lineitem(spark, sf_dir).comparison.summary()


def ref_dest_only(spark, sf_dir):
    return _f_orders_vs_lineitem(spark, sf_dir).comparison.only_in_destination()


def ref_orphan_keys(spark, sf_dir):
    _views(spark, sf_dir, "orders", "lineitem")
    return checks.reference(spark, "orders", "lineitem", "o_orderkey = l_orderkey", "o_orderkey",
                            "l_orderkey", key_fields="o_orderkey").keys


def ref_null_keys(spark, sf_dir):
    _views(spark, sf_dir, "customer")
    return checks.reference(spark, CUSTOMER_NULL_KEYS_SQL, CUSTOMER_NULL_KEYS_SQL, "k = k",
                            "k, c_name", "k, c_name").comparison.summary()


def con_keys_wide(spark, sf_dir):
    """Offending keys given by columns that are not the join key."""
    _views(spark, sf_dir, "orders")
    return checks.content(spark, "orders", _dest_orders(spark), "o_orderkey = o_orderkey",
                          "o_orderkey, o_orderstatus", "o_orderkey, o_orderstatus",
                          key_fields="o_custkey, o_orderpriority").keys


def ref_orphan_keys_wide(spark, sf_dir):
    """Referential keys on a source column besides the join key; both sides hold it."""
    _views(spark, sf_dir, "orders")
    return checks.reference(spark, ORDERS_BY_PRIORITY_SQL, ORDERS_SHIFTED_SQL, "k = j", "k", "j",
                            key_fields="prio").keys


def ref_source_only(spark, sf_dir):
    """Source rows without a destination row, NULL keys included."""
    _views(spark, sf_dir, "customer", "orders")
    return checks.reference(spark, CUSTOMER_NULL_KEYS_SQL, "orders", "k = o_custkey", "k, c_name",
                            "o_custkey, o_orderstatus").comparison.only_in_source()


def con_mixed_decimal(spark, sf_dir):
    """Text on one side, a decimal on the other: compared as Spark's ``=`` does."""
    _views(spark, sf_dir, "lineitem")
    return checks.content(spark, LINES_AS_TEXT_SQL, LINES_AS_DECIMAL_SQL, "k = k AND n = n", "v", "v",
                          ).comparison.summary()


def con_mixed_int(spark, sf_dir):
    """A text join key and value against whole numbers, some beyond INT."""
    _views(spark, sf_dir, "orders")
    return checks.content(spark, ORDERS_AS_TEXT_SQL, ORDERS_AS_INT_SQL, "k = k", "k, v", "k, v",
                          key_fields="k").comparison.summary()


# ---------------------------------------------------- catalogue / format --

def cat_returnflag(spark, sf_dir):
    _views(spark, sf_dir, "lineitem")
    return checks.catalogue(spark, "lineitem", "l_returnflag NOT IN ('A', 'R')",
                            "l_returnflag, l_linestatus").rows


def cat_catalogue_table(spark, sf_dir):
    part = testdata.read(spark, sf_dir, "part")
    allowed = literal_frame(spark, [(t,) for t in ALLOWED_PART_TYPES], "p_type string")
    bad = outside_catalogue(part, "p_type", allowed)
    return bad.groupBy("p_type").agg(F.count(F.lit(1)).alias("count"))


def form_brand(spark, sf_dir):
    _views(spark, sf_dir, "part")
    return checks.format_check(spark, "part", "p_brand NOT LIKE 'Brand#__'", "p_brand").rows


def _segment(spark, sf_dir):
    _views(spark, sf_dir, "customer")
    return checks.mandatory(spark, SEGMENT_WITH_NULLS_SQL, "c_mktsegment IS NULL", "c_mktsegment")


def obg_segment(spark, sf_dir):
    return _segment(spark, sf_dir).rows


def violation_keys(spark, sf_dir):
    return _segment(spark, sf_dir).keys


# ------------------------------------------------------------- duplicates --

def dup_lineitem(spark, sf_dir):
    _views(spark, sf_dir, "lineitem")
    return checks.duplicates(spark, "lineitem", "l_orderkey, l_linenumber").rows


def dup_extra_group(spark, sf_dir):
    _views(spark, sf_dir, "lineitem")
    return checks.duplicates(spark, "lineitem", "l_orderkey, l_linenumber", group_by="l_linenumber").rows


def dup_documents_text(spark, sf_dir):
    _views(spark, sf_dir, "documents")
    return checks.duplicates(spark, "documents", "text, lang").rows


def dup_filtered(spark, sf_dir):
    _views(spark, sf_dir, "orders")
    return checks.duplicates(spark, "orders", "o_custkey, o_orderdate", filter="o_orderstatus = 'O'").rows


def dup_wide(spark, sf_dir):
    """Wide keys in two phases: hashes counted first, texts grouped only where a hash repeats."""
    _views(spark, sf_dir, "documents")
    rows = checks.duplicates(spark, "documents", "text, lang, source", two_phase=True).rows
    return rows.select(F.md5(F.col("text").cast("binary")).alias("text_md5"), "lang", "source", "count")


def dup_keys(spark, sf_dir):
    _views(spark, sf_dir, "lineitem")
    return checks.duplicates(spark, "lineitem", "l_orderkey, l_linenumber").keys


# ---------------------------------------------------- subquery relations --

def union_trim_source(spark, sf_dir):
    _views(spark, sf_dir, "orders", "lineitem")
    return checks.volume(spark, "lineitem", UNION_TRIM_SQL, src_filter=UNION_TRIM_SRC_FILTER).verdict


def union_trim_rows(spark, sf_dir):
    _views(spark, sf_dir, "orders", "lineitem")
    from parity.sources.relation import relation
    return relation(spark, UNION_TRIM_SQL).groupBy("fate").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------ more definition shapes --

def vol_named_params(spark, sf_dir):
    """Differently named parameters on each side."""
    _views(spark, sf_dir, "orders", "lineitem")
    return checks.volume(spark, "orders", "lineitem", "o_orderstatus = ?", "l_linestatus = ?",
                         params={"o_orderstatus": "F", "l_linestatus": "F"}).verdict


def cat_param(spark, sf_dir):
    """A catalogue rule with a runtime parameter; verdict row."""
    _views(spark, sf_dir, "lineitem")
    return checks.catalogue(spark, "lineitem", "l_returnflag = ? AND l_linestatus <> 'O'",
                            "l_returnflag, l_linestatus", params={"l_returnflag": "R"}).verdict


def dup_param_keys(spark, sf_dir):
    """Duplicate keys among the rows selected by a runtime parameter."""
    _views(spark, sf_dir, "lineitem")
    return checks.duplicates(spark, "lineitem", "l_orderkey, l_linenumber", filter="l_linestatus = ?",
                             params={"l_linestatus": "F"}).keys


def _cross_grouped(spark, sf_dir):
    _views(spark, sf_dir, "orders")
    return checks.content(spark, "orders", "orders", None, "o_orderstatus, o_orderpriority",
                          "o_orderstatus, MAX(o_orderpriority)", dest_group_by="o_orderstatus",
                          key_fields="o_orderstatus, o_orderpriority")


def con_cross_grouped(spark, sf_dir):
    """Every row against a grouped aggregate of the destination (no join key)."""
    return _cross_grouped(spark, sf_dir).comparison.summary()


def con_cross_grouped_keys(spark, sf_dir):
    return _cross_grouped(spark, sf_dir).keys


def ref_star(spark, sf_dir):
    """Referential check with blank (all-column) select lists."""
    _views(spark, sf_dir, "nation")
    return checks.reference(spark, "nation", NATION_SUBSET_SQL, "n_nationkey = n_nationkey",
                            "", "").comparison.summary()


def dml_rewrite_column(spark, sf_dir):
    """Rewrite a text column on the rows containing a pattern, then profile it."""
    from parity.sources.definitions import rewrite_column
    part = testdata.read(spark, sf_dir, "part")
    return (rewrite_column(part, "p_type", "PROMO", "PROMOTION")
            .groupBy("p_type").agg(F.count(F.lit(1)).alias("count")))


def dml_rewrite_files(spark, sf_dir):
    """A column rewritten in a stored copy of a table, partition by affected partition."""
    import uuid

    from parity.operators.ids import shared_folder
    from parity.sinks.rewrite import rewrite_files
    path = f"{shared_folder(spark)}/parity-customer-{uuid.uuid4().hex}"
    customer = testdata.read(spark, sf_dir, "customer")
    customer.write.partitionBy("c_nationkey").parquet(path)
    rewrite_files(spark, path, "c_name", "Customer#00000001", "Client#00000001", ["c_nationkey"])
    return spark.read.parquet(path).select("c_custkey", "c_name", "c_mktsegment", F.col("c_nationkey").cast("int").alias("c_nationkey"))


QUERIES = {
    "vol_orders_lineitem": vol_orders_lineitem,
    "vol_bound_param": vol_bound_param,
    "vol_params_report": vol_params_report,
    "con_keyed_rows": con_keyed_rows,
    "con_keyed_status_counts": con_keyed_status_counts,
    "con_keyed_side": con_keyed_side,
    "con_keyed_agg": con_keyed_agg,
    "con_renamed_key": con_renamed_key,
    "con_composite_dupkeys": con_composite_dupkeys,
    "con_star": con_star,
    "con_cross_agg": con_cross_agg,
    "con_cross_rows": con_cross_rows,
    "con_cross_empty": con_cross_empty,
    "con_cross_multiset": con_cross_multiset,
    "con_verdict": con_verdict,
    "con_keys": con_keys,
    "ref_documents_labels": ref_documents_labels,
    "ref_both_directions": ref_both_directions,
    "ref_orphan_keys": ref_orphan_keys,
    "ref_dest_only": ref_dest_only,
    "ref_null_keys": ref_null_keys,
    "cat_returnflag": cat_returnflag,
    "cat_catalogue_table": cat_catalogue_table,
    "form_brand": form_brand,
    "obg_segment": obg_segment,
    "violation_keys": violation_keys,
    "dup_lineitem": dup_lineitem,
    "dup_extra_group": dup_extra_group,
    "dup_documents_text": dup_documents_text,
    "dup_filtered": dup_filtered,
    "dup_keys": dup_keys,
    "union_trim_source": union_trim_source,
    "union_trim_rows": union_trim_rows,
    "vol_named_params": vol_named_params,
    "cat_param": cat_param,
    "dup_param_keys": dup_param_keys,
    "con_cross_grouped": con_cross_grouped,
    "con_cross_grouped_keys": con_cross_grouped_keys,
    "ref_star": ref_star,
    "dml_rewrite_column": dml_rewrite_column,
    "con_keys_wide": con_keys_wide,
    "ref_orphan_keys_wide": ref_orphan_keys_wide,
    "ref_source_only": ref_source_only,
    "con_mixed_decimal": con_mixed_decimal,
    "con_mixed_int": con_mixed_int,
    "con_same_names": con_same_names,
    "con_cross_report": con_cross_report,
    "con_hot_rows": con_hot_rows,
    "con_fingerprint": con_fingerprint,
    "dup_wide": dup_wide,
    "dml_rewrite_files": dml_rewrite_files,
}
