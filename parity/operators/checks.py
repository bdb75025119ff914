"""The seven checks as DataFrame operators.

Every check returns a ``CheckResult`` of lazy DataFrames:

* ``verdict`` -- one row: the check's counts, ``result`` and
  ``execution_parameter`` (the parameters applied, ``a=1 | b='x'`` or N/A);
* ``keys`` -- distinct ``key_fields`` text of the offending records;
* ``rows`` -- the check's row-level answer (differences, violating groups,
  duplicate groups), when it has one.

Nothing is collected: a caller may ``write`` the keys straight to a table.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parity.functions import columns as C
from parity.functions.params import Bound, bound_text, report
from parity.functions.text import NO_JOIN_KEY, parse_join_key, split_list, unique
from parity.operators.compare import CrossComparison, KeyedComparison
from parity.operators.ids import checkpoint_dir
from parity.operators.side import Side, prepare
from parity.sources.local import literal_frame
from parity.sources.relation import is_query, relation, strip_parens, where

VOL, CON, CAT, FORM, OBG, REF, DUP = "VOL", "CON", "CAT", "FORM", "OBG", "REF", "DUP"
EXACT, FINGERPRINT = "exact", "fingerprint"     # ways to a content check's verdict
METHODS = (EXACT, FINGERPRINT)
SUBTYPES = (VOL, CON, CAT, FORM, REF, OBG, DUP)


@dataclass(frozen=True)
class Scan:
    """A count over a relation that a check's verdict follows from: checks
    with scans of one relation can share a pass over it."""

    df: DataFrame          # the relation before its filter
    relation: tuple        # what it is: equal for the same table, query or frame
    bound: Bound           # the filter


class CheckResult:
    """Lazy outputs of one check; each DataFrame is built on first access
    (building a plan runs the analyzer, so unused outputs cost nothing)."""

    def __init__(self, subtype: str, verdict, keys, rows=None, description: str = "", comparison=None,
                 key_fields=(), execution_parameter: str = "", scans: tuple[Scan, ...] = ()):
        self.subtype = subtype
        self.scans = scans
        self.execution_parameter = execution_parameter
        self.bad_word = C.NOT_OK if subtype == DUP else C.NOK
        self.key_fields = tuple(key_fields)
        self.description = description
        self.comparison = comparison
        self._make = {"verdict": verdict, "keys": keys, "rows": rows}
        self._built: dict[str, DataFrame | None] = {}

    def _get(self, what: str):
        if what not in self._built:
            make = self._make[what]
            self._built[what] = make() if callable(make) else make
        return self._built[what]

    @property
    def verdict(self) -> DataFrame:
        return self._get("verdict")

    @property
    def keys(self) -> DataFrame:
        return self._get("keys")

    @property
    def rows(self) -> DataFrame | None:
        return self._get("rows")


# ``description`` is the check as a statement to run by hand: what the history's
# QUERY column holds.  A relation given as a frame without a name reads <DataFrame>.

def _from(x, predicate, params, tables) -> str:
    """FROM and WHERE of a relation, with parameter values written out."""
    if isinstance(x, DataFrame):
        name = next((n for n, df in (tables or {}).items() if df is x), "<DataFrame>")
    else:
        text = strip_parens(str(x))
        name = f"({text})" if is_query(text) and text not in (tables or {}) else text
    condition = bound_text(predicate, params) if isinstance(predicate, str) else None
    blank = not condition or not condition.strip() or re.sub(r"\s", "", condition) == "1=1"
    return f"FROM {name}" + ("" if blank else f" WHERE {condition}")


def _side_sql(side: Side, source: str) -> str:
    select = ", ".join(f"{e} AS `{n}`" for e, n in zip(side.all_items or ["*"], side.all_names))
    group = f" GROUP BY {', '.join(side.groups)}" if side.groups else ""
    return f"SELECT {select} {source}{group}"


def _compare_sql(subtype: str, s: Side, d: Side, on, s_from: str, d_from: str) -> str:
    both = ", ".join([*(f"s.`{n}` AS `{n}_src`" for n in s.names), *(f"d.`{n}` AS `{n}_dest`" for n in d.names)])
    all_null = [" AND ".join(f"{a}.`{n}` IS NULL" for n in names) for a, names in (("s", s.names), ("d", d.names))]
    differ = " OR ".join(f"NOT (s.`{a}` <=> d.`{b}`)" for a, b in zip(s.names, d.names))
    if not on:
        return f"SELECT {both} FROM ({_side_sql(s, s_from)}) s CROSS JOIN ({_side_sql(d, d_from)}) d WHERE {differ}"
    bad = [f"({x})" for x in ([differ] if subtype == CON else []) + all_null]
    keys = " AND ".join(f"s.`{a}` = d.`{b}`" for a, b in on)
    return (f"SELECT {both} FROM ({_side_sql(s, s_from)}) s FULL OUTER JOIN ({_side_sql(d, d_from)}) d "
            f"ON {keys} WHERE {' OR '.join(bad)}")


def _grouped_sql(source: str, columns: list[str], having: str = "") -> str:
    if not columns:
        return f"SELECT COUNT(*) AS count {source}"
    names = ", ".join(columns)
    return f"SELECT {names}, COUNT(*) AS count {source} GROUP BY {names}{having}"


def _no_keys(spark: SparkSession) -> DataFrame:
    return literal_frame(spark, [], "key_fields string")


def _keys_list(key_fields) -> list[str]:
    if key_fields is None:
        return []
    if isinstance(key_fields, str):
        return unique(split_list(key_fields))
    return unique([k.strip() for k in key_fields if k and k.strip()])


def _scan(spec, df: DataFrame, bound: Bound, predicate, tables) -> tuple[Scan, ...]:
    """The scan of a relation under a filter given as text."""
    if predicate is not None and not isinstance(predicate, str):
        return ()
    text = spec if isinstance(spec, DataFrame) else strip_parens(str(spec))
    named = text if isinstance(text, DataFrame) else (tables or {}).get(text)
    if named is not None:
        return (Scan(df, ("frame", id(named)), bound),)
    return (Scan(df, ("query", text) if is_query(text) else ("table", text.lower()), bound),)


# ------------------------------------------------------------------ VOL --

def volume(spark: SparkSession, src, dest, src_filter=None, dest_filter=None, params=None,
           tables=None) -> CheckResult:
    """Row counts of two filtered relations; OK iff equal."""
    sr, dr = relation(spark, src, tables), relation(spark, dest, tables)
    s, sb = where(spark, sr, src_filter, params)
    d, db = where(spark, dr, dest_filter, params)

    def verdict():
        sc = s.agg(F.count(F.lit(1)).alias("src_count"))
        dc = d.agg(F.count(F.lit(1)).alias("dest_count"))
        return (sc.crossJoin(dc)
                .withColumn("result", F.when(F.col("src_count") == F.col("dest_count"), C.OK).otherwise(C.NOK))
                .withColumn("execution_parameter", F.lit(report(params, sb, db))))

    text = (f"SELECT (SELECT COUNT(*) {_from(src, src_filter, params, tables)}) AS src_count, "
            f"(SELECT COUNT(*) {_from(dest, dest_filter, params, tables)}) AS dest_count")
    scans = (*_scan(src, sr, sb, src_filter, tables), *_scan(dest, dr, db, dest_filter, tables))
    return CheckResult(VOL, verdict, lambda: _no_keys(spark), description=text,
                       execution_parameter=report(params, sb, db), scans=scans if len(scans) == 2 else ())


# ------------------------------------------------------------- CON / REF --

def _compare(spark, subtype, src, dest, join_key, src_select, dest_select, src_filter, dest_filter,
             src_group_by, dest_group_by, key_fields, params, tables, method=EXACT,
             unique_keys=False) -> CheckResult:
    on = parse_join_key(join_key) if (join_key is None or isinstance(join_key, str)) else list(join_key)
    kf = _keys_list(key_fields)
    mapping = {a.lower(): b for a, b in on}
    s = prepare(spark, src, src_select, src_filter, src_group_by, params,
                extra=[a for a, _ in on] + kf, tables=tables)
    d = prepare(spark, dest, dest_select, dest_filter, dest_group_by, params,
                extra=[b for _, b in on],
                optional_extra=[mapping.get(k.lower(), k) for k in kf] if subtype == REF else (), tables=tables)
    if on:
        cmp = KeyedComparison(s, d, on, "reference" if subtype == REF else "content", tuple(kf))
    else:
        if subtype == REF:
            raise ValueError("a referential check needs a join key")
        cmp = CrossComparison(s, d, tuple(kf))
    param_text = report(params, s.bound, d.bound)

    if method not in METHODS or (method == FINGERPRINT and not on):
        raise ValueError(f"no method {method!r} for this comparison")

    def verdict():
        found = cmp.fingerprint_verdict(unique_keys=unique_keys) if method == FINGERPRINT else cmp.verdict()
        return found.withColumn("execution_parameter", F.lit(param_text))

    desc = _compare_sql(subtype, s, d, on, _from(src, src_filter, params, tables),
                        _from(dest, dest_filter, params, tables))
    return CheckResult(subtype, verdict, cmp.keys, cmp.differences, desc, cmp, kf, param_text)


def content(spark: SparkSession, src, dest, join_key=None, src_select=None, dest_select=None,
            src_filter=None, dest_filter=None, src_group_by=None, dest_group_by=None,
            key_fields=None, params=None, tables=None, method: str = EXACT,
            unique_keys: bool = False) -> CheckResult:
    """Values agree between two relations: keyed (full outer on ``join_key``)
    or, without a key, every source row against every destination row.

    ``method="fingerprint"`` (keyed) reaches the verdict by comparing hash sums
    per range of keys, and tuples only where these differ; ``unique_keys``
    promises that no source key has two tuples.  ``exact`` compares tuples alone."""
    return _compare(spark, CON, src, dest, join_key, src_select, dest_select, src_filter, dest_filter,
                    src_group_by, dest_group_by, key_fields, params, tables, method, unique_keys)


def reference(spark: SparkSession, src, dest, join_key, src_select=None, dest_select=None,
              src_filter=None, dest_filter=None, src_group_by=None, dest_group_by=None,
              key_fields=None, params=None, tables=None) -> CheckResult:
    """Referential integrity in both directions (existence only)."""
    return _compare(spark, REF, src, dest, join_key, src_select, dest_select, src_filter, dest_filter,
                    src_group_by, dest_group_by, key_fields, params, tables)


# ------------------------------------------------------ CAT / FORM / OBG --

def violations(spark: SparkSession, src, predicate, key_fields=None, params=None, subtype: str = CAT,
               tables=None) -> CheckResult:
    """Rows matching ``predicate`` are violations (catalogue, format or
    mandatory-fill rule); grouped by the key fields with their count."""
    rel = relation(spark, src, tables)
    df, b = where(spark, rel, predicate, params)
    kf = _keys_list(key_fields)

    def groups():
        if kf:
            return df.groupBy(*kf).agg(F.count(F.lit(1)).alias("count"))
        return df.agg(F.count(F.lit(1)).alias("count")).where(F.col("count") > 0)

    def verdict():
        # no grouping needed: one counting pass, partial counts per task
        return (df.agg(F.count(F.lit(1)).alias("n_violations"))
                .withColumn("result", F.when(F.col("n_violations") > 0, C.NOK).otherwise(C.OK))
                .withColumn("execution_parameter", F.lit(report(params, b))))

    def keys():
        if not kf:
            return _no_keys(spark)
        return res.rows.select(C.key_text(kf, sep=C.KEY_SEP_GROUPED).alias("key_fields"))

    res = CheckResult(subtype, verdict, keys, groups, _grouped_sql(_from(src, predicate, params, tables), kf),
                      key_fields=kf, execution_parameter=report(params, b),
                      scans=_scan(src, rel, b, predicate, tables))
    return res


def catalogue(spark, src, predicate, key_fields=None, params=None, tables=None) -> CheckResult:
    return violations(spark, src, predicate, key_fields, params, CAT, tables)


def format_check(spark, src, predicate, key_fields=None, params=None, tables=None) -> CheckResult:
    return violations(spark, src, predicate, key_fields, params, FORM, tables)


def mandatory(spark, src, predicate, key_fields=None, params=None, tables=None) -> CheckResult:
    return violations(spark, src, predicate, key_fields, params, OBG, tables)


def outside_catalogue(df: DataFrame, column: str, allowed: DataFrame, allowed_column: str | None = None,
                      null_is_violation: bool = False) -> DataFrame:
    """Rows of ``df`` whose ``column`` is not in the catalogue frame ``allowed``.

    As with the predicate form ``column NOT IN (...)``, a NULL value is no
    violation unless ``null_is_violation``; a NULL in the catalogue allows
    nothing.  Spark picks the join from its size estimates and AQE."""
    ac = allowed_column or column
    cat = allowed.select(F.col(ac).alias("__allowed")).where(F.col("__allowed").isNotNull()).distinct()
    if not null_is_violation:
        df = df.where(F.col(column).isNotNull())
    return df.join(cat, F.col(column) == F.col("__allowed"), "left_anti")


# ------------------------------------------------------------------- DUP --

#: Repeated hashes that the two-phase duplicate check broadcasts, at most (8 bytes each).
MOST_HASHES = 4_000_000


def _repeated(df: DataFrame, cols: list[str]) -> DataFrame:
    """The rows whose key may occur more than once: those whose 64-bit key hash does.

    Hashes are counted first (8 bytes a row in the exchange, partial counts in
    each task) and the repeated ones written to the shared folder; if they are
    few enough to broadcast, only rows that hold one go on.  Rows of one key
    share a hash, so no duplicate is lost; a chance collision only lets rows
    through that the exact grouping then finds single.  Beyond ``MOST_HASHES``
    repeated hashes most rows are repeats, and all go on."""
    spark = df.sparkSession
    args = [x for c in cols for x in (F.col(c).isNull(), F.col(c))]
    checkpoint_dir(spark)
    hashes = (df.groupBy(F.xxhash64(*args).alias("__h")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
              .select("__h").checkpoint(eager=True))
    if hashes.count() > MOST_HASHES:
        return df
    return df.join(F.broadcast(hashes), F.xxhash64(*args) == F.col("__h"), "left_semi")


def duplicates(spark: SparkSession, src, key_fields, filter=None, group_by=None, params=None,
               tables=None, two_phase: bool = False) -> CheckResult:
    """Key combinations occurring more than once.  Group columns are the
    extra group-by followed by the key fields, each once.

    ``two_phase`` is for wide keys (texts) that seldom repeat: key hashes are
    counted first, and only rows whose hash repeats are grouped by the key
    itself.  It runs the first phase when an answer is asked for."""
    df, b = where(spark, relation(spark, src, tables), filter, params)
    neutral = isinstance(group_by, str) and group_by.replace(" ", "") == NO_JOIN_KEY.replace(" ", "")
    cols = unique(_keys_list(None if neutral else group_by) + _keys_list(key_fields))
    if not cols:
        raise ValueError("duplicate check needs key fields")

    def groups():
        some = _repeated(df, cols) if two_phase else df
        return some.groupBy(*cols).agg(F.count(F.lit(1)).alias("count")).where(F.col("count") > 1)

    def verdict():
        return (res.rows.agg(F.count(F.lit(1)).alias("n_duplicate_groups"))
                .withColumn("result", F.when(F.col("n_duplicate_groups") > 0, C.NOT_OK).otherwise(C.OK))
                .withColumn("execution_parameter", F.lit(report(params, b))))

    def keys():
        return res.rows.select(C.key_text(cols, sep=C.KEY_SEP_GROUPED).alias("key_fields"))

    res = CheckResult(DUP, verdict, keys, groups,
                      _grouped_sql(_from(src, filter, params, tables), cols, " HAVING COUNT(*) > 1"),
                      key_fields=cols, execution_parameter=report(params, b))
    return res
