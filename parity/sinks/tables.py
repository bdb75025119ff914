"""Control and result tables in the session catalog.

The result tables are append-only histories, by default partitioned by the day
of the run when made with ``by_day``.  ``record`` appends a suite run to them
as one unit, though Parquet tables have no transactions:

1. Ids are allocated from the run log (``<results table>_runs``, one row a run
   with the first ids and counts of its rows), never by reading the history.
2. Verdicts and details, ids included, are written to a folder of the run in
   the shared folder.  Until then nothing has happened: a retry begins anew.
3. One row is appended to the run log.  That is the commit: it says which run
   it is, which ids it has and how many.
4. Details, then verdicts, are appended from the folder: whatever rows with the
   run's ids a table lacks.  Doing it again adds nothing, so a writer that
   stopped half way is finished by the next call (``record`` or ``recover``).

5. The folder is removed, which says that the run is finished.

So a run recorded twice (the same ``run_id``) adds nothing, a verdict never
stands without its details, and ids have no gaps.  One writer per table at a
time, as before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from parity import schemas
from parity.operators.ids import folder_exists, remove_folder, shared_folder
from parity.plans.suite import SuiteRun
from parity.sources.local import literal_frame

RESULTS_TABLE = "test_out_results"
DETAILS_TABLE = "test_out_results_details"
#: Partition column of history tables made with ``by_day``.
DAY = schemas.DAY
_HISTORY = (RESULTS_TABLE, DETAILS_TABLE)


def _name(name: str, database: str | None) -> str:
    return f"{database}.{name}" if database else name


def runs_table(results_table: str) -> str:
    """The run log that belongs to a results table."""
    return f"{results_table}_runs"


def create_tables(spark: SparkSession, database: str | None = None, fmt: str = "parquet",
                  names=None, by_day: bool = False) -> list[str]:
    """CREATE TABLE IF NOT EXISTS for the control/result tables.  With
    ``by_day`` the two history tables get a DAY column and are partitioned by it."""
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    made = []
    for name, schema in schemas.TABLES.items():
        if names and name not in names:
            continue
        full = _name(name, database)
        if not spark.catalog.tableExists(full):
            if by_day and name in _HISTORY:
                columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
                spark.sql(f"CREATE TABLE {full} ({columns}, {DAY} date) USING {fmt} PARTITIONED BY ({DAY})")
            else:
                spark.catalog.createTable(full, source=fmt, schema=schema)
        made.append(full)
    return made


def drop_tables(spark: SparkSession, database: str | None = None, names=None) -> None:
    for name in schemas.TABLES:
        if names and name not in names:
            continue
        spark.sql(f"DROP TABLE IF EXISTS {_name(name, database)}")
        if name == RESULTS_TABLE:
            spark.sql(f"DROP TABLE IF EXISTS {runs_table(_name(name, database))}")


def truncate(spark: SparkSession, table: str) -> None:
    """Remove all rows; the run log of a results table goes with them."""
    spark.sql(f"TRUNCATE TABLE {table}")
    if spark.catalog.tableExists(runs_table(table)):
        spark.sql(f"TRUNCATE TABLE {runs_table(table)}")


def append(df: DataFrame, table: str) -> None:
    """Append by column name, in the table's column order; a DAY column that
    ``df`` lacks is the day of its TIMESTAMP."""
    cols = df.sparkSession.table(table).columns
    if DAY in cols and DAY not in df.columns:
        df = df.withColumn(DAY, F.to_date("TIMESTAMP"))
    df.select(*cols).write.mode("append").insertInto(table)


def max_id(spark: SparkSession, table: str, column: str) -> DataFrame:
    """One-row frame: the largest id already used (0 for an empty table)."""
    return spark.table(table).agg(F.coalesce(F.max(column), F.lit(0)).cast("long").alias("max_id"))


def add_set_member(spark: SparkSession, set_id: int, test_id: int,
                   table: str = "test_rel_set_parameter") -> None:
    append(literal_frame(spark, [(set_id, test_id)], schemas.SET_MEMBERS), table)


# ------------------------------------------------------------ recording --

_LOG = ["RESULT_BASE", "DETAILS_BASE", "N_RESULTS", "N_DETAILS", "TIMESTAMP", "RUN_ID"]


def _runs(spark: SparkSession, results_table: str) -> DataFrame:
    name = runs_table(results_table)
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, source="parquet", schema=schemas.RUNS)
    else:
        spark.catalog.refreshTable(name)
    return spark.table(name)


def run_log(spark: SparkSession, results_table: str, run_id: str | None = None) -> DataFrame:
    """One row: ``last``, the last logged run (whose ids end where the next
    begin), and ``mine``, the run of that id; each NULL if there is none."""
    entry = F.struct(*_LOG)
    return _runs(spark, results_table).agg(F.max(entry).alias("last"),
                                           F.max(F.when(F.col("RUN_ID") == F.lit(run_id), entry)).alias("mine"))


def recorded(spark: SparkSession, run_id: str, results_table: str = RESULTS_TABLE) -> Row | None:
    """The run's row of the run log, or None."""
    return run_log(spark, results_table, run_id).first()["mine"]


def _staging(spark: SparkSession, results_table: str) -> str:
    return f"{shared_folder(spark)}/parity-runs/{_safe(results_table)}"


def _safe(name: str) -> str:
    return "".join(c if c.isalnum() or c in "-_." else "_" for c in name)


def staging_folder(spark: SparkSession, run_id: str, results_table: str = RESULTS_TABLE) -> str:
    """Where a run's rows wait to be appended; it is removed once they are."""
    return f"{_staging(spark, results_table)}/{_safe(run_id)}"


def record(run: SuiteRun, results_table: str = RESULTS_TABLE, details_table: str = DETAILS_TABLE,
           run_id: str | None = None):
    """Append a suite run to the history tables, all of it once; returns the
    appended frames.

    ``run_id`` names the run for retries (default: the ``SuiteRun``'s own id):
    a run of that id that is logged already isn't recorded again, only finished
    if it wasn't."""
    spark = run.spark
    run_id = run_id or run.run_id
    log = run_log(spark, results_table, run_id).first()
    if log["last"] is not None:
        _finish(spark, log["last"], results_table, details_table)
    row = log["mine"]
    if row is None:
        rbase, dbase = _bases(spark, log["last"], results_table, details_table)
        results, details = run.with_ids(literal_frame(spark, [(rbase,)], "max_id long"),
                                        literal_frame(spark, [(dbase,)], "max_id long"))
        folder = staging_folder(spark, run_id, results_table)
        staged = {"details": details, "results": results}
        for what, df in staged.items():
            df.write.mode("overwrite").parquet(f"{folder}/{what}")
            staged[what] = _staged(spark, folder, what)
        entry = (rbase, dbase, staged["results"].count(), staged["details"].count(), run.timestamp, run_id)
        row = Row(*_LOG)(*entry)
        append(literal_frame(spark, [tuple(row[c] for c in schemas.RUNS.names)], schemas.RUNS), runs_table(results_table))
        for (table, what, *_) in _ids(row, results_table, details_table):     # new ids: no table has any of them
            append(staged[what], table)
        remove_folder(spark, folder)
    return tuple(_own(spark, row, table, column, base, n)
                 for table, _, column, base, n in _ids(row, results_table, details_table)[::-1])


def _bases(spark: SparkSession, last: Row | None, results_table: str, details_table: str) -> tuple[int, int]:
    if last is not None:
        return last["RESULT_BASE"] + last["N_RESULTS"], last["DETAILS_BASE"] + last["N_DETAILS"]
    # no run logged yet: a history from before the log is read this once
    return (max_id(spark, results_table, "RESULT_ID").first()[0], max_id(spark, details_table, "DETAILS_ID").first()[0])


def recover(spark: SparkSession, results_table: str = RESULTS_TABLE, details_table: str = DETAILS_TABLE) -> bool:
    """Finish the last logged run if its writer stopped before the end (earlier
    ones were finished before it was logged); whether there was anything to do."""
    last = run_log(spark, results_table).first()["last"]
    return last is not None and _finish(spark, last, results_table, details_table)


def _staged(spark: SparkSession, folder: str, what: str) -> DataFrame:
    schema = schemas.RESULTS if what == "results" else schemas.DETAILS
    return spark.read.schema(schema).parquet(f"{folder}/{what}")


def _ids(row: Row, results_table: str, details_table: str) -> list[tuple]:
    """(table, folder, id column, first id - 1, rows), in the order of appending."""
    return [(details_table, "details", "DETAILS_ID", row["DETAILS_BASE"], row["N_DETAILS"]),
            (results_table, "results", "RESULT_ID", row["RESULT_BASE"], row["N_RESULTS"])]


def _own(spark: SparkSession, row: Row, table: str, column: str, base: int, n: int) -> DataFrame:
    """The run's rows of a history table: its ids (row groups are skipped by
    their statistics), on its day where the table is partitioned."""
    spark.catalog.refreshTable(table)
    mine = spark.table(table).where((F.col(column) > base) & (F.col(column) <= base + n))
    return mine.where(F.col(DAY) == F.to_date(F.lit(row["TIMESTAMP"]))) if DAY in mine.columns else mine


def _finish(spark: SparkSession, row: Row, results_table: str, details_table: str) -> bool:
    """Append what the tables lack of a logged run, details before verdicts.  A
    run whose folder is gone was finished."""
    folder = staging_folder(spark, row["RUN_ID"], results_table)
    if not folder_exists(spark, folder):
        return False
    for table, what, column, base, n in _ids(row, results_table, details_table):
        own = _own(spark, row, table, column, base, n)
        have = own.count()
        if have < n:
            staged = _staged(spark, folder, what)
            append(staged.join(own.select(column), column, "left_anti") if have else staged, table)
    remove_folder(spark, folder)
    return True


def clean(spark: SparkSession, results_table: str = RESULTS_TABLE, details_table: str = DETAILS_TABLE) -> bool:
    """Finish the last run, then remove every folder left of runs that never
    came to be logged; whether there was one."""
    recover(spark, results_table, details_table)
    return remove_folder(spark, _staging(spark, results_table))


def history(spark: SparkSession, results_table: str = RESULTS_TABLE,
            details_table: str = DETAILS_TABLE, since=None, latest: int | None = None) -> DataFrame:
    """Verdicts with their details, newest first: of the days from ``since`` on
    (partitions before it aren't read), the ``latest`` rows alone."""
    from parity.plans.suite import history as _history
    for t in (results_table, details_table):
        spark.catalog.refreshTable(t)       # appends may come from another session (streams)
    return _history(spark.table(results_table), spark.table(details_table), since, latest)
