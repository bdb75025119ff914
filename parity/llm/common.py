"""Helpers the operators share: reading tables, the shared folder, rereading."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space that separates words: space and 0x09-0x0D.
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"

# NUL .. 0x7F white space of ``str.split`` that is not in SPACES
_EXTRA_SPACES = ("\x1c", "\x1d", "\x1e", "\x1f")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only where that is unset (tests, notebooks) the folder given to
    ``setCheckpointDir`` is used, and without one a folder beside the
    warehouse, which driver and executors share by definition."""
    conf = spark.sparkContext.getConf()
    base = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
    return base.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Folders that ``written`` has made, by application.
_WRITTEN: dict[str, list[str]] = {}


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: cuts the lineage,
    survives a lost executor, and fixes the rows that several later branches
    read.  ``drop_written`` removes the folder."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def let_go(spark: SparkSession) -> None:
    """Collect the driver's garbage, so that Spark removes the shuffle files of
    jobs whose results are written; else they stay until its heap is full."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def drop_written(spark: SparkSession) -> int:
    """Remove the folders of intermediate tables that this application has
    written, once the results that read them are stored; returns their number."""
    made = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return sum(path(p).getFileSystem(conf).delete(path(p), True) for p in made)


def doc_columns(docs: DataFrame) -> DataFrame:
    """doc_id and text alone (null text -> empty), whatever else the table has."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def crc_remainder(mod: int, key: str = "doc_id") -> Column:
    """crc32(key as text) mod ``mod``; a null key counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(mod))


def lower_ascii(text: str) -> str:
    """A-Z to a-z and nothing else (code points keep their places)."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def words_of(text: str) -> list[str]:
    """Words ``[^\\x20\\x09-\\x0D]+``."""
    if text.isascii() and not any(c in text for c in _EXTRA_SPACES):
        return text.split()
    for c in "\t\n\x0b\f\r":
        if c in text:
            text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def texts(batch: pa.RecordBatch, column: str = "text") -> Iterator[str]:
    """Python strings of a column, a slice at a time so that a batch of long
    texts isn't held twice; null -> empty."""
    col = batch.column(batch.schema.get_field_index(column))
    for at in range(0, len(col), 512):
        for t in col.slice(at, 512).to_pylist():
            yield t or ""


def batches(rows: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(rows[f.name], f.type) for f in schema], schema=schema)
