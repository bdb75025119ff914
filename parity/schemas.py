"""Schemas of the control and result tables.

Check codes are strings (VOL, CON, ...); ids are LongType so a long history
never overflows.  Column names follow the original control tables.
"""

from pyspark.sql import types as T

_S, _I, _L = T.StringType(), T.IntegerType(), T.LongType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Column names of the definitions table, in table order.
DEFINITION_COLUMNS = ("TEST_ID", "TYPE_ID", "SUBTYPE_ID", "SOURCE_TABLE", "DEST_TABLE", "JOIN_KEY",
                      "SOURCE_SELECT_FIELD", "DEST_SELECT_FIELD", "SOURCE_FILTER", "DEST_FILTER",
                      "SOURCE_GROUPBY", "DEST_GROUPBY", "KEY_FIELDS")

DEFINITIONS = _struct(("TEST_ID", _I), *[(c, _S) for c in DEFINITION_COLUMNS[1:]])
SET_MEMBERS = _struct(("SET_ID", _I), ("TEST_ID", _I))
SETS = _struct(("SET_ID", _I), ("NAME", _S), ("DESCRIPTION", _S))
CHECK_TYPES = _struct(("TYPE_ID", _S), ("NAME", _S), ("DESCRIPTION", _S))
CHECK_SUBTYPES = _struct(("SUBTYPE_ID", _S), ("NAME", _S), ("DESCRIPTION", _S))
TYPE_SUBTYPE = _struct(("TYPE_ID", _S), ("SUBTYPE_ID", _S), ("NAME", _S), ("DESCRIPTION", _S))
RESULTS = _struct(("RESULT_ID", _L), ("TEST_ID", _I), ("QUERY", _S), ("RESULT", _S),
                  ("EXECUTION_PARAMETER", _S), ("TIMESTAMP", T.TimestampType()))
# The log of recorded runs: which ids each took, and how many rows it has.
RUNS = _struct(("RUN_ID", _S), ("RESULT_BASE", _L), ("DETAILS_BASE", _L), ("N_RESULTS", _L), ("N_DETAILS", _L),
               ("TIMESTAMP", T.TimestampType()))
DAY = "DAY"     # partition column of history tables made by day
DETAILS = _struct(("DETAILS_ID", _L), ("RESULT_ID", _L), ("KEY_FIELDS", _S), ("TIMESTAMP", T.TimestampType()))

# Default names of the control and result tables, and (above) their
# column names -- the same as existing check catalogs use, so they keep working.
TABLES = {
    "test_config_parameters": DEFINITIONS,
    "test_rel_set_parameter": SET_MEMBERS,
    "test_config_set": SETS,
    "test_config_type": CHECK_TYPES,
    "test_config_subtype": CHECK_SUBTYPES,
    "test_rel_type_subtype": TYPE_SUBTYPE,
    "test_out_results": RESULTS,
    "test_out_results_details": DETAILS,
}
