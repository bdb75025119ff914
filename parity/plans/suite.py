"""Run a set of check definitions and shape the results.

Definitions (a small control table) are read on the driver; each becomes a
check plan over its relations.  Isolated (the default), VOL, CAT, FORM and OBG
checks of one relation share a scan of it (``plans.fused``), and every other
check is a job of its own, several submitted at once: a check with key fields
computes its offending keys once, into a checkpoint, and its verdict follows
from whether there are any; the others compute their one-row verdict.  A check
that fails, on its data or in its plan, becomes an ERROR result and stops no
other.  Not isolated, all verdicts are one union and all keys another.  Offending keys
never leave the cluster: they are written to the details table by the sink.

Result ids are allocated once per run (previous maximum + the check's
position); detail ids are gap-free over (RESULT_ID, KEY_FIELDS) order.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parity import schemas
from parity.functions import columns as C
from parity.functions.params import placeholders
from parity.operators import checks
from parity.operators.ids import checkpoint_dir, with_sequential_ids
from parity.plans.fused import FusedScan, Item, first_line
from parity.sources.definitions import select_by_set, with_defaults
from parity.sources.local import literal_frame

ERROR = "ERROR"  # result of a check that could not be planned or run


@dataclass
class Definition:
    TEST_ID: int
    TYPE_ID: str | None = None
    SUBTYPE_ID: str | None = None
    SOURCE_TABLE: str | None = None
    DEST_TABLE: str | None = None
    JOIN_KEY: str | None = None
    SOURCE_SELECT_FIELD: str | None = None
    DEST_SELECT_FIELD: str | None = None
    SOURCE_FILTER: str | None = None
    DEST_FILTER: str | None = None
    SOURCE_GROUPBY: str | None = None
    DEST_GROUPBY: str | None = None
    KEY_FIELDS: str | None = None

    @classmethod
    def from_row(cls, row) -> "Definition":
        d = row.asDict() if hasattr(row, "asDict") else dict(row)
        d = {k.upper(): v for k, v in d.items()}
        return cls(**{f.name: d.get(f.name) for f in fields(cls)})

    def as_tuple(self):
        return tuple(getattr(self, f.name) for f in fields(self))


def definitions_frame(spark: SparkSession, defs: list[Definition]) -> DataFrame:
    return literal_frame(spark, [d.as_tuple() for d in defs], schemas.DEFINITIONS)


def unknown_codes(defs: list[Definition]) -> list[str]:
    return [f"test {d.TEST_ID}: unknown check code {d.SUBTYPE_ID!r}" for d in defs
            if (d.SUBTYPE_ID or "").strip().upper() not in checks.SUBTYPES]


def validate(defs: list[Definition], params=None) -> list[str]:
    """Problems found before anything runs: unknown check codes and
    placeholders without a runtime value."""
    params = {k.lower() for k in (params or {})}
    problems = unknown_codes(defs)
    for d in defs:
        for text in (d.SOURCE_FILTER, d.DEST_FILTER):
            missing = [p for p in placeholders(text) if p not in params]
            if missing:
                problems.append(f"test {d.TEST_ID}: parameters missing: {', '.join(missing)}")
    return problems


def run_check(spark: SparkSession, d: Definition, params=None, tables=None) -> checks.CheckResult:
    code = (d.SUBTYPE_ID or "").strip().upper()
    if code == checks.VOL:
        return checks.volume(spark, d.SOURCE_TABLE, d.DEST_TABLE, d.SOURCE_FILTER, d.DEST_FILTER, params, tables)
    if code in (checks.CON, checks.REF):
        fn = checks.content if code == checks.CON else checks.reference
        return fn(spark, d.SOURCE_TABLE, d.DEST_TABLE, d.JOIN_KEY, d.SOURCE_SELECT_FIELD, d.DEST_SELECT_FIELD,
                  d.SOURCE_FILTER, d.DEST_FILTER, d.SOURCE_GROUPBY, d.DEST_GROUPBY, d.KEY_FIELDS, params, tables)
    if code in (checks.CAT, checks.FORM, checks.OBG):
        return checks.violations(spark, d.SOURCE_TABLE, d.SOURCE_FILTER, d.KEY_FIELDS, params, code, tables)
    if code == checks.DUP:
        return checks.duplicates(spark, d.SOURCE_TABLE, d.KEY_FIELDS, d.SOURCE_FILTER, d.SOURCE_GROUPBY,
                                 params, tables)
    raise ValueError(f"unknown check code {d.SUBTYPE_ID!r}")


class SuiteRun:
    """Lazy outputs of a suite run.  ``results`` has the RESULTS columns,
    ``details`` (RESULT_ID, KEY_FIELDS); each is built on first use, so
    asking for the verdicts never plans the key extraction."""

    def __init__(self, spark: SparkSession, checks_: list, timestamp: _dt.datetime, isolate: bool = False,
                 fuse: bool = True):
        self._spark = self.spark = spark
        self.run_id = uuid.uuid4().hex    # names the run when it is recorded
        self.fuse = fuse
        self._checks = checks_            # (position, definition, CheckResult | error message)
        self.timestamp = timestamp
        self.isolate = isolate
        self._verdict_rows: dict[int, str] | None = None   # position -> RESULT, once isolated
        self._keys: dict[int, DataFrame] = {}              # position -> offending keys, once isolated
        self._shared_keys: list[DataFrame] = []            # keys of checks that shared a scan, per relation
        self._in_shared: set[int] = set()                  # positions whose keys are in those
        self._results: DataFrame | None = None
        self._details: DataFrame | None = None

    @property
    def results(self) -> DataFrame:
        if self._results is None and self.isolate:
            self._isolate()
        if self._results is None:
            frames = [self._safe_verdict(pos, d, res) for pos, d, res in self._checks]
            ts = F.lit(self.timestamp).cast("timestamp")
            self._results = (_union(frames).withColumn("TIMESTAMP", ts) if frames
                             else literal_frame(self._spark, [], schemas.RESULTS))
        return self._results

    def _isolate(self) -> None:
        """Run the fused scans and every other check as jobs of their own,
        concurrently; a check that fails (its plan, or bad data under ANSI
        casts, ...) becomes an ERROR result and leaves no details."""
        from concurrent.futures import ThreadPoolExecutor
        checkpoint_dir(self._spark)
        scans, fused = self.fused_scans() if self.fuse else ([], {})

        def one(item):
            pos, d, res = item
            try:
                if not isinstance(res, checks.CheckResult):
                    raise ValueError(res)
                return self._row(item, self._outcome(pos, d, res))
            except Exception as e:  # noqa: BLE001 -- recorded as the check's result
                return self._row(item, ERROR, first_line(e))

        alone = [item for item in self._checks if item[0] not in fused]
        with ThreadPoolExecutor(max_workers=max(1, min(8, len(alone) + len(scans)))) as pool:
            counted = [pool.submit(self._counted, scan) for scan in scans]
            rows = list(pool.map(one, alone))
            counts = {owner: n for done in counted for owner, n in done.result().items()}
        rows += [self._fused_row(item, [counts[o] for o in fused[item[0]]]) for item in self._checks if item[0] in fused]
        rows.sort()
        self._verdict_rows = {r[0]: r[3] for r in rows}
        ts = F.lit(self.timestamp).cast("timestamp")
        schema = "RESULT_ID long, TEST_ID int, QUERY string, RESULT string, EXECUTION_PARAMETER string"
        self._results = literal_frame(self._spark, rows, schema).withColumn("TIMESTAMP", ts)

    @staticmethod
    def _row(item, result: str, fault: str = "") -> tuple:
        pos, d, res = item
        if result == ERROR:
            return pos, d.TEST_ID, f"{d.SUBTYPE_ID}: {fault}", ERROR, "N/A"
        return pos, d.TEST_ID, res.description, result, res.execution_parameter

    # -- scans that several checks share ------------------------------------
    def fused_scans(self) -> tuple[list[FusedScan], dict[int, list[tuple]]]:
        """The scans that answer every check of a relation that two or more
        checks count, and position -> owners of the counts a verdict takes."""
        by_relation: dict[tuple, set[int]] = {}
        for pos, _, res in self._checks:
            for scan in res.scans if isinstance(res, checks.CheckResult) else ():
                by_relation.setdefault(scan.relation, set()).add(pos)
        shared = {pos for some in by_relation.values() if len(some) > 1 for pos in some}
        items: dict[tuple, tuple[DataFrame, list[Item]]] = {}
        owners: dict[int, list[tuple]] = {}
        for pos, d, res in self._checks:
            if pos not in shared:
                continue
            mine = []
            for k, scan in enumerate(res.scans):
                df = items[scan.relation][0] if scan.relation in items else scan.df
                item = Item((pos, k), scan.bound, pos, res.key_fields)
                if FusedScan(self._spark, df, []).accepts(item):
                    mine.append((scan.relation, df, item))
            if len(mine) == len(res.scans):        # else the check runs on its own
                owners[pos] = [i.owner for _, _, i in mine]
                for key, df, item in mine:
                    items.setdefault(key, (df, []))[1].append(item)
        return [FusedScan(self._spark, df, some) for df, some in items.values()], owners

    def _counted(self, scan: FusedScan) -> dict[tuple, int | str]:
        """Counts of a scan; then the keys of its failed checks, in one pass."""
        counts = scan.run()
        failed = [i for i in scan.items if i.key_fields and isinstance(counts[i.owner], int) and counts[i.owner] > 0]
        if failed:
            keys = scan.keys(failed).checkpoint(eager=True)
            self._shared_keys.append(keys)
            self._in_shared.update(i.result_id for i in failed)
        return counts

    def _fused_row(self, item, counts: list[int | str]) -> tuple:
        res = item[2]
        faults = [n for n in counts if isinstance(n, str)]
        if faults:
            return self._row(item, ERROR, faults[0])
        bad = counts[0] != counts[1] if res.subtype == checks.VOL else counts[0] > 0
        return self._row(item, res.bad_word if bad else C.OK)

    def _outcome(self, pos: int, d: Definition, res: checks.CheckResult) -> str:
        """RESULT of one check.  Keys, where the check has key fields, are
        computed once: any key means a difference.  Only a referential check
        can differ without a key (destination rows with no source)."""
        if not res.key_fields or res.subtype == checks.VOL:
            return self._verdict(pos, d, res).first()["RESULT"]
        keys = res.keys.select(F.lit(pos).cast("long").alias("RESULT_ID"),
                               F.col("key_fields").alias("KEY_FIELDS")).checkpoint(eager=True)
        if not keys.isEmpty():
            self._keys[pos] = keys
            return res.bad_word
        return self._verdict(pos, d, res).first()["RESULT"] if res.subtype == checks.REF else C.OK

    @property
    def details(self) -> DataFrame:
        if self._details is None and self.isolate and self._verdict_rows is None:
            self._isolate()
        if self._details is None:
            frames = list(self._shared_keys)
            for pos, d, res in self._checks:
                if not isinstance(res, checks.CheckResult) or res.subtype == checks.VOL or pos in self._in_shared:
                    continue
                try:
                    if self._verdict_rows is not None:
                        frame = self._known_details(pos, res, self._verdict_rows[pos])
                    else:
                        frame = _details(res, self._verdict(pos, d, res), F.lit(pos).cast("long"))
                except Exception:  # noqa: BLE001 -- the check's plan fails; its result says ERROR
                    continue
                if frame is not None:
                    frames.append(frame)
            self._details = (_union(frames) if frames
                             else literal_frame(self._spark, [], "RESULT_ID long, KEY_FIELDS string"))
        return self._details

    def _known_details(self, pos: int, res: checks.CheckResult, result: str) -> DataFrame | None:
        """Details when the verdict is known: none for an OK check; the keys
        already computed; one empty-key row for a failed check without any."""
        if result in (C.OK, ERROR):
            return None
        if pos in self._keys:
            return self._keys[pos]
        return literal_frame(self._spark, [(pos, "")], "RESULT_ID long, KEY_FIELDS string")

    def _safe_verdict(self, pos: int, d: Definition, res) -> DataFrame:
        """The verdict row, or an ERROR row when the check's plan cannot be
        built (unknown column, bad expression, ...)."""
        if isinstance(res, checks.CheckResult):
            try:
                return self._verdict(pos, d, res)
            except Exception as e:  # noqa: BLE001 -- recorded as the check's result
                res = first_line(e)
        return self._verdict(pos, d, res)

    def _verdict(self, pos: int, d: Definition, res) -> DataFrame:
        rid = F.lit(pos).cast("long").alias("RESULT_ID")
        test_id = F.lit(d.TEST_ID).cast("int").alias("TEST_ID")
        if isinstance(res, checks.CheckResult):
            return res.verdict.select(rid, test_id, F.lit(res.description).alias("QUERY"),
                                      F.col("result").alias("RESULT"),
                                      F.col("execution_parameter").alias("EXECUTION_PARAMETER"))
        return self._spark.range(1).select(rid, test_id, F.lit(f"{d.SUBTYPE_ID}: {res}").alias("QUERY"),
                                           F.lit(ERROR).alias("RESULT"), F.lit("N/A").alias("EXECUTION_PARAMETER"))

    def final_results(self, result_base: DataFrame | None = None) -> DataFrame:
        """Results with RESULT_ID offset by the one-row ``result_base`` (the
        previous maximum id; 0 when None)."""
        return self._offset(self.results, result_base)

    def final_details(self, result_base: DataFrame | None = None,
                      details_base: DataFrame | None = None) -> DataFrame:
        """Details with gap-free DETAILS_ID after ``details_base`` in
        (RESULT_ID, KEY_FIELDS) order."""
        details = self._offset(self.details, result_base)
        start = F.lit(1).cast("long")
        if details_base is not None:
            db = details_base.select(F.col(details_base.columns[0]).cast("long").alias("__db"))
            details = details.crossJoin(F.broadcast(db))
            start = F.col("__db") + 1
        details = with_sequential_ids(details, ["RESULT_ID", "KEY_FIELDS"], "DETAILS_ID", start)
        ts = F.lit(self.timestamp).cast("timestamp")
        return details.select("DETAILS_ID", "RESULT_ID", "KEY_FIELDS", ts.alias("TIMESTAMP"))

    def with_ids(self, result_base: DataFrame | None = None, details_base: DataFrame | None = None):
        return self.final_results(result_base), self.final_details(result_base, details_base)

    @staticmethod
    def _offset(df: DataFrame, base: DataFrame | None) -> DataFrame:
        if base is None:
            return df
        rb = base.select(F.col(base.columns[0]).cast("long").alias("__rb"))
        return (df.crossJoin(F.broadcast(rb))
                .withColumn("RESULT_ID", F.col("RESULT_ID") + F.col("__rb")).drop("__rb"))


def run_suite(spark: SparkSession, definitions, params=None, tables=None, strict: bool = True,
              isolate: bool = True, members: DataFrame | None = None, set_ids=None, fuse: bool = True,
              timestamp: _dt.datetime | None = None) -> SuiteRun:
    """Prepare every definition's check (in TEST_ID order); plans are run
    when the results or details are asked for.

    ``members`` (SET_ID, TEST_ID) and ``set_ids`` select the definitions to
    run, as ``select_by_set`` does.  ``strict`` rejects the whole run when a
    definition has an unknown check code, before anything executes.  Any other
    fault of a definition -- a parameter without a value, a relation or column
    that can't be resolved, data that a cast rejects -- yields an ``ERROR``
    result carrying the message.  ``isolate`` (default) runs each check as its
    own job, several at once; ``isolate=False`` plans all verdicts as one union.
    ``fuse`` (default) lets isolated VOL, CAT, FORM and OBG checks of one
    relation share a scan; results and details are the same without it.
    ``timestamp`` is the run's TIMESTAMP (default: now).
    """
    if not isinstance(definitions, DataFrame) and members is not None:
        definitions = definitions_frame(spark, list(definitions))
    if isinstance(definitions, DataFrame):
        chosen = select_by_set(definitions, members, set_ids)
        rows = with_defaults(chosen).orderBy("TEST_ID").collect()   # control table: small
        defs = [Definition.from_row(r) for r in rows]
    else:
        defs = sorted(definitions, key=lambda d: d.TEST_ID)
    problems = unknown_codes(defs)
    if strict and problems:
        raise ValueError("; ".join(problems))
    prepared = []
    for pos, d in enumerate(defs, start=1):
        try:
            res = run_check(spark, d, params, tables)
        except Exception as e:  # noqa: BLE001 -- recorded as the check's result
            res = first_line(e)
        prepared.append((pos, d, res))
    return SuiteRun(spark, prepared, timestamp or _dt.datetime.now(), isolate, fuse)


def _details(res: checks.CheckResult, verdict: DataFrame, rid) -> DataFrame:
    """Distinct offending keys.  A failed check with no key text gets one
    empty-key row so the failure is visible in the details too: always when
    it has no key fields, and for a referential check whose differences are
    all destination-only rows with a key."""
    empty_row = verdict.where(F.col("RESULT") != C.OK).select(rid.alias("RESULT_ID"), F.lit("").alias("KEY_FIELDS"))
    has_keys = bool(res.key_fields)
    if not has_keys:
        return empty_row
    keys = res.keys.select(rid.alias("RESULT_ID"), F.col("key_fields").alias("KEY_FIELDS"))
    if res.subtype != checks.REF:
        return keys          # a bad verdict always leaves at least one key row
    n_keys = keys.agg(F.count(F.lit(1)).alias("__nk"))
    return keys.unionByName(empty_row.crossJoin(n_keys).where(F.col("__nk") == 0).drop("__nk"))


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def history(results: DataFrame, details: DataFrame, since=None, latest: int | None = None) -> DataFrame:
    """Verdicts with their details, newest first (of one time, the larger RESULT_ID first).

    ``since`` (a date) leaves out earlier days: where the frames have a DAY
    column, both are filtered by it, so partitions of earlier days aren't read.
    ``latest`` takes the first rows alone, by a top-n of each task."""
    if since is not None:
        results, details = (f.where(F.col(schemas.DAY) >= F.lit(since).cast("date")) if schemas.DAY in f.columns
                            else f.where(F.col("TIMESTAMP") >= F.lit(since).cast("timestamp"))
                            if "TIMESTAMP" in f.columns else f for f in (results, details))
    d = details.select("DETAILS_ID", "RESULT_ID", "KEY_FIELDS")
    if latest is not None:      # every verdict gives a row at least, so no older one can be among the first
        results = results.orderBy(F.desc("TIMESTAMP"), F.desc("RESULT_ID")).limit(latest)
    out = (results.join(d, "RESULT_ID", "left")
           .orderBy(F.desc("TIMESTAMP"), F.desc("RESULT_ID"), F.col("DETAILS_ID")))
    return out if latest is None else out.limit(latest)
