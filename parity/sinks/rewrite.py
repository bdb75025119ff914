"""Rewriting a column of a stored Parquet table, copy on write.

``UPDATE t SET c = REPLACE(c, old, new) WHERE c LIKE '%old%'`` for a folder of
Parquet files.  Files that hold no affected row are left alone:

1. ``_metadata.file_path`` of the affected rows says which files they are in
   (one column is read, and files whose statistics exclude the rows are skipped).
2. The partitions of these files are rewritten into the shared folder.
3. The staged rows replace exactly those partitions, by dynamic partition
   overwrite: each partition's new files are moved in when the whole job has
   succeeded.  Every other partition keeps its files, names included.

A folder without partitions is one partition.  If nothing is affected, nothing
is written.  A failure before step 3 leaves the table as it was; after one in
step 3, ``publish`` repeats that step from the staged rows.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parity.operators.ids import remove_folder, shared_folder
from parity.sources.definitions import rewrite_column


@dataclass
class Rewrite:
    """What a rewrite did: the affected files, their partitions, and the folder
    of the rows staged for these (None where nothing was affected)."""

    files: list[str] = field(default_factory=list)
    partitions: list[dict] = field(default_factory=list)
    staged: str | None = None


def affected(df: DataFrame, column: str, old: str, partition_by: list[str] = ()) -> DataFrame:
    """``file_path`` and partition values of the files with a row that holds ``old``."""
    return (df.where(F.col(column).contains(old))
            .select(F.col("_metadata.file_path").alias("file_path"), *partition_by).distinct())


def _in_partitions(partitions: list[dict]) -> Column:
    """Literal condition on partition columns, which prunes the scan's files."""
    cond = F.lit(False)
    for p in partitions:
        one = F.lit(True)
        for name, value in p.items():
            one = one & (F.col(name).isNull() if value is None else F.col(name) == F.lit(value))
        cond = cond | one
    return cond


def publish(spark: SparkSession, path: str, staged: str, partition_by: list[str] = ()) -> None:
    """Replace the partitions of the staged rows."""
    writer = spark.read.schema(spark.read.parquet(staged).schema).parquet(staged).write.mode("overwrite")
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.parquet(path)


def rewrite_files(spark: SparkSession, path: str, column: str, old: str, new: str,
                  partition_by: list[str] = ()) -> Rewrite:
    """Replace ``old`` by ``new`` in ``column`` of the table in ``path``."""
    partition_by = list(partition_by)
    if column.lower() in {p.lower() for p in partition_by}:
        raise ValueError(f"{column} is a partition column: its rows would move")
    df = spark.read.parquet(path)
    found = affected(df, column, old, partition_by).collect()     # as many as there are files
    if not found:
        return Rewrite()
    partitions = [dict(p) for p in dict.fromkeys(tuple((c, r[c]) for c in partition_by) for r in found)]
    rows = df.where(_in_partitions(partitions)) if partition_by else df
    staged = f"{shared_folder(spark)}/parity-rewrite-{uuid.uuid4().hex}"
    rewrite_column(rows, column, old, new).write.parquet(staged)
    publish(spark, path, staged, partition_by)
    return Rewrite(sorted(r["file_path"] for r in found), partitions if partition_by else [], staged)


def clean(spark: SparkSession, done: Rewrite) -> bool:
    """Remove the staged rows of a published rewrite."""
    return done.staged is not None and remove_folder(spark, done.staged)
