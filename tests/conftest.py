import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    scratch = tempfile.mkdtemp(prefix="parity-tests-")
    s = (SparkSession.builder.master("local[4]").appName("parity-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
         .config("spark.driver.memory", "4g")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def golden(spark):
    """FIXTURES.md section 3 frames."""
    src = spark.createDataFrame(
        [(1, "a", 10), (2, "b", 20), (3, "c", None), (None, None, None), (5, "e", 50), (5, "e", 51)],
        "k int, n string, v int")
    dst = spark.createDataFrame(
        [(1, "a", 10), (2, "b", 21), (3, "c", None), (None, None, None), (4, "d", 40)],
        "k int, n string, v int")
    return src, dst
