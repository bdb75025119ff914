"""Checks on the micro-batches of a file stream."""

import os
import shutil
import tempfile

from conftest import SF_SMALL
from parity.plans.suite import Definition
from parity.sinks import tables as sinks
from parity.streaming import check_each_batch


def test_check_each_batch(spark):
    landing = tempfile.mkdtemp(prefix="parity-landing-")
    shutil.copy(os.path.join(SF_SMALL, "orders.parquet"), os.path.join(landing, "part-0.parquet"))
    schema = spark.read.parquet(landing).schema
    stream = spark.readStream.schema(schema).parquet(landing)
    db = "stream_test_db"
    sinks.drop_tables(spark, db)
    sinks.create_tables(spark, db, names=["test_out_results", "test_out_results_details"])
    defs = [
        Definition(1, "CHTEC", "DUP", "batch", KEY_FIELDS="o_custkey, o_orderdate", SOURCE_FILTER="o_orderstatus = ?"),
        Definition(2, "MAP", "OBG", "batch", SOURCE_FILTER="o_orderpriority IS NULL", KEY_FIELDS="o_orderkey"),
        Definition(3, "CHTEC", "REF", "batch", "(SELECT o_orderkey AS k FROM batch WHERE o_orderkey % 2 = 0)",
                   "o_orderkey = k", "o_orderkey", "k", KEY_FIELDS="o_orderkey"),
    ]
    q = check_each_batch(stream, defs, {"o_orderstatus": "O"}, results_table=f"{db}.test_out_results",
                         details_table=f"{db}.test_out_results_details",
                         checkpoint_location=tempfile.mkdtemp(prefix="parity-stream-ckpt-"),
                         query_name="test_checks", available_now=True)
    q.awaitTermination(300)
    assert q.exception() is None
    for t in ("test_out_results", "test_out_results_details"):
        spark.catalog.refreshTable(f"{db}.{t}")      # written from the stream's session
    results = {r.TEST_ID: r.RESULT for r in spark.table(f"{db}.test_out_results").collect()}
    assert results[2] == "OK" and results[3] == "NOK"
    odd = spark.read.parquet(landing).where("o_orderkey % 2 = 1").count()
    details = spark.table(f"{db}.test_out_results_details")
    rid = [r.RESULT_ID for r in spark.table(f"{db}.test_out_results").collect() if r.TEST_ID == 3][0]
    assert details.where(f"RESULT_ID = {rid}").count() == odd
    sinks.drop_tables(spark, db)
