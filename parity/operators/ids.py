"""Gap-free sequential ids over a large DataFrame without a single-partition window.

``row_number()`` over an unpartitioned window moves every row into one task.
Instead: sort (range-partitioned), cut the lineage with a reliable
checkpoint so the order is fixed even if an executor is lost, count rows per
partition (one small row per partition), turn the counts into offsets, and
give each row offset + its position inside its partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; only where
    that is unset, a folder beside the warehouse, which driver and executors
    share by definition.  The same path in every session."""
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    return (configured or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints").rstrip("/")


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder, set from ``shared_folder`` if it has none."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_folder(spark))
    return sc.getCheckpointDir()


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def folder_exists(spark: SparkSession, path: str) -> bool:
    files, folder = _folder(spark, path)
    return files.exists(folder)


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder of the shared storage; whether there was one."""
    files, folder = _folder(spark, path)
    return files.delete(folder, True)


def with_sequential_ids(df: DataFrame, order_by: list, id_col: str, start: Column | int = 1) -> DataFrame:
    """Add ``id_col`` = start, start+1, ... in ``order_by`` order (ties broken
    arbitrarily but stably).  ``start`` may be a Column over a one-row frame's
    value joined in beforehand, or an int.  The sorted rows are checkpointed in
    a job of their own; Spark removes the files once the frame is unreachable
    if ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set."""
    checkpoint_dir(df.sparkSession)
    ordered = df.orderBy(*order_by).checkpoint(eager=True)
    tagged = (ordered.withColumn("__pid", F.spark_partition_id())
              .withColumn("__pos", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)))
    counts = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    # one row per partition: a single-partition window over them is bounded
    offsets = counts.select("__pid", (F.sum("__n").over(Window.orderBy("__pid")) - F.col("__n")).alias("__off"))
    start_col = start if isinstance(start, Column) else F.lit(int(start))
    return (tagged.join(F.broadcast(offsets), "__pid")
            .withColumn(id_col, (start_col + F.col("__off") + F.col("__pos")).cast("long"))
            .drop("__pid", "__pos", "__off"))
