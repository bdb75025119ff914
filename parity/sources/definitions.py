"""Check definitions: read, default, select by set, validate, edit.

Definitions are a control table (tens to thousands of rows).  They stay a
DataFrame until the suite needs them on the driver to build one plan per
check; their size is that of the configuration, never of the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parity import schemas
from parity.functions.text import ALL_COLUMNS, NEUTRAL_FILTER, NO_JOIN_KEY


def read_csv(spark: SparkSession, path: str, schema: T.StructType = schemas.DEFINITIONS) -> DataFrame:
    """Semicolon CSV with a header, CRLF line ends and quoted multi-line cells."""
    return (spark.read.option("sep", ";").option("header", True).option("multiLine", True)
            .option("quote", '"').option("escape", '"').option("ignoreTrailingWhiteSpace", False)
            .schema(schema).csv(path))


def read_table(spark: SparkSession, name: str = "test_config_parameters") -> DataFrame:
    return spark.table(name)


def _blank_to(col: str, default: str):
    return F.coalesce(F.nullif(F.trim(F.col(col)), F.lit("")), F.lit(default)).alias(col)


def with_defaults(defs: DataFrame) -> DataFrame:
    """Blank fields get neutral values: select lists ``*``, join key and
    group-bys ``1 = 1`` (none), filters ``1 = 1``.  Other columns unchanged."""
    defaults = {"SOURCE_SELECT_FIELD": ALL_COLUMNS, "DEST_SELECT_FIELD": ALL_COLUMNS,
                "JOIN_KEY": NO_JOIN_KEY, "SOURCE_GROUPBY": NO_JOIN_KEY, "DEST_GROUPBY": NO_JOIN_KEY,
                "SOURCE_FILTER": NEUTRAL_FILTER, "DEST_FILTER": NEUTRAL_FILTER}
    return defs.select(*[_blank_to(c, defaults[c]) if c in defaults else F.col(c) for c in defs.columns])


def select_by_set(defs: DataFrame, members: DataFrame | None, set_ids=None) -> DataFrame:
    """Definitions whose TEST_ID is a member of the chosen sets (all sets when
    ``set_ids`` is None), ordered by TEST_ID.  Only a table without any member
    selects every definition; chosen sets without members select none."""
    if members is None or members.isEmpty():
        return defs.orderBy("TEST_ID")
    if set_ids is not None:
        members = members.where(F.col("SET_ID").isin(list(set_ids)))
    ids = members.select("TEST_ID").distinct()
    return defs.join(ids, "TEST_ID", "left_semi").orderBy("TEST_ID")


def rewrite_column(df: DataFrame, column: str, old: str, new: str) -> DataFrame:
    """Replace ``old`` by ``new`` in ``column`` on the rows containing it (the
    notebook's ``UPDATE ... SET c = REPLACE(c, old, new) WHERE c LIKE '%old%'``),
    as a new DataFrame to be written to a new table."""
    c = F.col(column)
    return df.withColumn(column, F.when(c.contains(old), F.replace(c, F.lit(old), F.lit(new))).otherwise(c))
