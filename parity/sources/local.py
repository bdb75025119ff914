"""Small literal frames built inside the JVM.

``spark.createDataFrame(list)`` ships pickled rows and needs Python workers
to read them back; a configuration table of a few rows is better written as
literals, which Catalyst folds into a local relation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal_frame(spark: SparkSession, rows, schema) -> DataFrame:
    """Rows (tuples in schema order) as a DataFrame without a Python round trip."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    fields = schema.fields
    typed_nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
    rows = list(rows)
    if not rows:
        return spark.range(0).select(*typed_nulls)
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
