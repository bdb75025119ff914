"""The driver's parquet test tables (``<sf_dir>/<name>.parquet``)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# (session, view name) -> path the temp view currently points at
_REGISTERED: dict[tuple[int, str], str] = {}


def path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(path(sf_dir, name))


def tables(spark: SparkSession, sf_dir: str, names=TABLES) -> dict[str, DataFrame]:
    return {n: read(spark, sf_dir, n) for n in names}


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Temp views so definitions can name the tables (and subqueries over
    them).  A view already pointing at the same file is left alone, so a
    session pays the parquet footer read once per table."""
    sid = id(getattr(spark, "_jsparkSession", spark))
    for n in names:
        p = path(sf_dir, n)
        key = (sid, n)
        if _REGISTERED.get(key) == p and spark.catalog.tableExists(n):
            continue
        read(spark, sf_dir, n).createOrReplaceTempView(n)
        _REGISTERED[key] = p
