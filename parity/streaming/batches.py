"""Run check definitions on every micro-batch of a stream.

Data that arrives continuously (files landing in a folder, a message topic)
can be checked as it lands: each micro-batch is exposed to the definitions
under ``batch_name`` (as a relation and as a temp view for subqueries), the
suite runs on it, and the verdicts and offending keys are appended to the
history tables.  The stream's progress lives in a folder named after the query
under the cluster's ``spark.checkpoint.dir``, the same for every session, so a
restarted stream goes on where it stopped.

Every batch is recorded once: its run is named after the streaming query and the
batch's number, so a batch replayed after a failure finds itself recorded (and
is finished, if the failure came between the appends).
"""

from __future__ import annotations

import os

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from parity.operators.ids import shared_folder
from parity.plans.suite import Definition, run_suite
from parity.sinks.tables import DETAILS_TABLE, RESULTS_TABLE, record, recorded, recover


def check_each_batch(stream: DataFrame, definitions: list[Definition], params=None, *,
                     batch_name: str = "batch", results_table: str = RESULTS_TABLE,
                     details_table: str = DETAILS_TABLE, checkpoint_location: str | None = None,
                     query_name: str = "parity_checks", available_now: bool = False):
    """Start a streaming query that checks each micro-batch; returns the
    ``StreamingQuery``.  ``available_now`` processes what is there and stops."""
    spark = stream.sparkSession
    location = checkpoint_location or os.path.join(shared_folder(spark), f"stream-{query_name}")
    defs = list(definitions)

    def process(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        # the query's own id outlives restarts and differs for a stream begun anew
        query = session.sparkContext.getLocalProperty("sql.streaming.queryId") or location
        run_id = f"{query_name}-{query}-{epoch_id}"
        if recorded(session, run_id, results_table):
            recover(session, results_table, details_table)
            return
        # every check reads the batch; keep it instead of re-reading the source
        # per check (recomputable from the source if an executor is lost)
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            batch.createOrReplaceTempView(batch_name)
            run = run_suite(session, defs, params, tables={batch_name: batch}, isolate=True)
            record(run, results_table, details_table, run_id)
        finally:
            batch.unpersist()

    writer = (stream.writeStream.queryName(query_name).foreachBatch(process)
              .option("checkpointLocation", location))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
