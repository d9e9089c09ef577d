"""Cleaning of the incremental ingest: raw stream -> typed batches with their quarantine.

One run cleans what the ingest appended since the last one and stops.  Every micro-batch of a table is
written to a folder of its own (``batch_id=<n>``), both sides of the quarantine in one write, and then logged with its row
counts.  A batch that was killed is run again under the same number and writes over what it left; readers only
see batches up to the last logged one.  So cards over these tables equal cards over a batch run of the same files.

Geolocation is de-duplicated over all days: the typed rows pass a keyed state store (every column is the key), which
keeps the rows seen so far in the stream's checkpoint, and only rows never seen before reach a batch; no
earlier day is read or rewritten.  Malformed lines go to a table of their own through a file sink.
"""

from __future__ import annotations

import os

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import REJECTED_FLAG, TRANSFORMS, type_geolocation
from ..schema import REJECT_REASON, SCHEMAS, TABLES, raw_schema
from ..sources.zones import (MALFORMED, PARTITIONS, STREAM, absent, audit_columns, clean_schema, clustered, lines_schema, lines_table,
                             split_lines)
from .ingest import stream_checkpoint

REFINED, REFINED_LOG = "refined_stream", "refined_log"
BATCH = "batch_id"
DEDUPLICATED = {"geolocation": type_geolocation}  # table -> typing whose whole rows are unique over all days
MAX_FILES_PER_BATCH = 1000
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_LOG_SCHEMA = "rows_after long, rows_rejected long, batch_id long"


def raw_rows(spark: SparkSession, lake: str, name: str, max_files: int = MAX_FILES_PER_BATCH) -> DataFrame:
    """The raw stream of one table as a stream."""
    return (spark.readStream.schema(lines_schema(raw_schema(name).names)).option("maxFilesPerTrigger", max_files)
            .parquet(os.path.join(lake, STREAM, name)))


def log_batch(spark: SparkSession, lake: str, name: str, batch_id: int) -> None:
    """Counts the batch from the footers of its files and makes it visible."""
    counts = {r[REJECTED_FLAG]: r["count"] for r in
              _batches(spark, lake, name).filter(F.col(BATCH) == batch_id).groupBy(REJECTED_FLAG).count().collect()}
    row = spark.createDataFrame([(counts.get(False, 0), counts.get(True, 0))], "rows_after long, rows_rejected long")
    row.coalesce(1).write.mode("overwrite").parquet(os.path.join(lake, REFINED_LOG, name, f"{BATCH}={batch_id}"))


def _write_batch(lake: str, name: str):
    def write(rows: DataFrame, batch_id: int) -> None:
        # dealing rows to ranges reads them twice; kept, they are parsed once and the state store is asked and committed once
        typed = TRANSFORMS[name](rows).flagged.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            store(typed, batch_id)
        finally:
            typed.unpersist()
        log_batch(rows.sparkSession, lake, name, batch_id)

    def store(flagged: DataFrame, batch_id: int) -> None:
        folders = [REJECTED_FLAG]
        if name in PARTITIONS:
            col, expr = PARTITIONS[name]
            flagged = flagged.withColumn(col, F.expr(expr)).repartitionByRange(col, *SCHEMAS[name].names[:1])
            folders.append(col)
        else:
            flagged = clustered(flagged, name)
        path = os.path.join(lake, REFINED, name, f"{BATCH}={batch_id}")
        flagged.write.mode("overwrite").partitionBy(*folders).parquet(path)
    return write


def refine_table(spark: SparkSession, lake: str, name: str, max_files: int = MAX_FILES_PER_BATCH) -> None:
    """One run for one table; returns when everything ingested so far is cleaned."""
    rows, lines = split_lines(raw_rows(spark, lake, name, max_files))
    if name in DEDUPLICATED:
        if spark.conf.get("spark.sql.streaming.stateStore.providerClass", STATE_STORE) != STATE_STORE:
            spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)  # state beyond the heap
        rows = DEDUPLICATED[name](rows).dropDuplicates()
    (rows.writeStream.foreachBatch(_write_batch(lake, name))
     .option("checkpointLocation", stream_checkpoint(spark, lake, name, "parcelscope-refine"))
     .trigger(availableNow=True).start().awaitTermination())
    (lines.writeStream.format("parquet").outputMode("append")
     .option("path", os.path.join(lake, REFINED, lines_table(name)))
     .option("checkpointLocation", stream_checkpoint(spark, lake, name, "parcelscope-refine-lines"))
     .trigger(availableNow=True).start().awaitTermination())


def refine_new_rows(spark: SparkSession, lake: str, names=TABLES) -> list[str]:
    """One run over every table that was ever ingested; returns their names."""
    done = []
    for name in names:
        try:
            refine_table(spark, lake, name)
        except AnalysisException as e:
            if not absent(e):
                raise
            continue
        done.append(name)
    return done


# --- reading ---------------------------------------------------------------------------------

def batch_log(spark: SparkSession, lake: str, name: str) -> DataFrame:
    """One row per committed batch: batch_id, rows_after, rows_rejected."""
    try:
        return spark.read.schema(_LOG_SCHEMA).parquet(os.path.join(lake, REFINED_LOG, name)).select(BATCH, "rows_after", "rows_rejected")
    except AnalysisException as e:
        if absent(e):
            return spark.createDataFrame([], f"{BATCH} long, rows_after long, rows_rejected long")
        raise


def last_batch(spark: SparkSession, lake: str, name: str) -> int:
    """Number of the last committed batch (they are committed in order), -1 without any."""
    last = batch_log(spark, lake, name).agg(F.max(BATCH)).first()[0]
    return -1 if last is None else last


def _batches(spark: SparkSession, lake: str, name: str) -> DataFrame:
    """Every batch written, with the quarantine columns and folders."""
    reason = [] if name in DEDUPLICATED else [T.StructField(REJECT_REASON, T.StringType(), True)]
    schema = T.StructType([*clean_schema(name).fields, *reason, T.StructField(BATCH, T.LongType(), True),
                           T.StructField(REJECTED_FLAG, T.BooleanType(), True)])
    return spark.read.schema(schema).parquet(os.path.join(lake, REFINED, name))


def read_refined(spark: SparkSession, lake: str, name: str, rejected: bool = False, with_batch: bool = False) -> DataFrame:
    """The clean rows of all committed batches, or those in quarantine; no rows where nothing was ingested."""
    last = last_batch(spark, lake, name)
    columns = clean_schema(name).names + ([REJECT_REASON] if rejected and name not in DEDUPLICATED else []) + [BATCH] * with_batch
    if last < 0:
        fields = {f.name: f for f in clean_schema(name).fields}
        return spark.createDataFrame([], T.StructType([fields.get(c, T.StructField(
            c, T.LongType() if c == BATCH else T.StringType())) for c in columns]))
    rows = _batches(spark, lake, name).filter((F.col(BATCH) <= last) & (F.col(REJECTED_FLAG) == rejected))
    return rows.select(columns)


def malformed_lines(spark: SparkSession, lake: str, name: str) -> DataFrame:
    return spark.read.schema(f"line string, {REJECT_REASON} string").parquet(os.path.join(lake, REFINED, lines_table(name)))


class RefinedTables(dict):
    """The clean tables of the stream by name, read when a card asks for them."""

    def __init__(self, spark: SparkSession, lake: str):
        super().__init__()
        self.spark, self.lake = spark, lake

    def __missing__(self, name: str) -> DataFrame:
        self[name] = read_refined(self.spark, self.lake, name)
        return self[name]


def refined_audit(spark: SparkSession, lake: str, names=TABLES) -> DataFrame:
    """S9 for the stream: per table ingested rows, clean rows, quarantined rows (malformed lines with them) and duplicates."""
    rows = []
    for name in names:  # one row of counts for each table
        try:
            raw = spark.read.schema(lines_schema(raw_schema(name).names)).parquet(os.path.join(lake, STREAM, name))
        except AnalysisException as e:
            if absent(e):
                continue
            raise
        before, lines = raw.agg(F.count(F.lit(1)), F.count(MALFORMED)).first()
        after, rejected = batch_log(spark, lake, name).agg(F.sum("rows_after"), F.sum("rows_rejected")).first()
        rows.append((name, before, after or 0, (rejected or 0) + lines))
    return audit_columns(spark.createDataFrame(rows, "table_name string, rows_before long, rows_after long, rows_rejected long"))
