"""Incremental daily ingest with Structured Streaming.

The source system drops CSV files into a landing folder once a day and exactly
one run may be active at a time, without catch-up runs.  A file-source stream
with ``trigger(availableNow=True)`` is the Spark-native form of that schedule:
each run picks up exactly the files that arrived since the previous run
(tracked in the checkpoint, so a file is never ingested twice, even when a run
dies half way and is restarted), appends them to the raw zone and stops.

Checkpoints live under the shared folder the cluster names in
``spark.checkpoint.dir``, else beside the lake; nothing is kept on a machine-local disk.
The stream has a zone of its own (``STREAM``): the batch extract replaces the
raw zone, and a stream's sink must not be replaced under it.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..schema import TABLES, raw_schema
from ..session import checkpoint_dir
from ..sources.zones import MALFORMED, STREAM, filled, lines_schema


MAX_FILES_PER_BATCH = 1000
PROGRESS_KEPT = 100_000  # micro-batches of one run whose row counts are remembered


def landing_stream(spark: SparkSession, landing_dir: str, name: str, max_files: int = MAX_FILES_PER_BATCH):
    """New ``<name>*.csv`` files in ``landing_dir`` as a stream of raw (all-text) rows, and ``MALFORMED``.

    The header is checked against the declared column names
    (``enforceSchema=false``), so a file with other columns fails loudly instead
    of being read by position.  A backlog is drained in micro-batches of at most
    ``max_files`` files, each committed to the checkpoint before the next.
    """
    return filled(spark.readStream.schema(lines_schema(raw_schema(name).names))
                  .option("maxFilesPerTrigger", max_files)
                  .option("header", True).option("enforceSchema", False)
                  .option("multiLine", True).option("quote", '"').option("escape", '"')
                  .option("columnNameOfCorruptRecord", MALFORMED)
                  .option("pathGlobFilter", f"{name}*.csv")
                  .csv(landing_dir))


def stream_checkpoint(spark: SparkSession, lake: str, name: str, job: str = "parcelscope-ingest") -> str:
    """Checkpoint folder of one table's stream in one lake.

    It sits under ``spark.checkpoint.dir`` and is keyed by the sink location as
    well as the table, so two lakes never share (and corrupt) a checkpoint.
    """
    sink = os.path.join(lake, STREAM, name)
    digest = hashlib.sha1(sink.encode()).hexdigest()[:16]
    return os.path.join(checkpoint_dir(spark, lake), job, digest, name)


def ingest_table(spark: SparkSession, landing_dir: str, lake: str, name: str) -> StreamingQuery:
    """Start one run for one table: append the newly landed files to the raw zone."""
    ckpt = stream_checkpoint(spark, lake, name)
    return (landing_stream(spark, landing_dir, name).writeStream
            .format("parquet").outputMode("append")
            .option("path", os.path.join(lake, STREAM, name))
            .option("checkpointLocation", ckpt)
            .trigger(availableNow=True)
            .start())


def ingest_new_files(spark: SparkSession, landing_dir: str, lake: str, names=TABLES) -> dict[str, int]:
    """One daily run over every table; returns the rows appended per table.

    Rows are those that the run's own micro-batches report, so nothing that was stored before is read.
    """
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", str(PROGRESS_KEPT))
    appended = {}
    for name in names:
        query = ingest_table(spark, landing_dir, lake, name)
        query.awaitTermination()
        appended[name] = sum(p["numInputRows"] for p in query.recentProgress)
    return appended
