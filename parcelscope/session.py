"""Session settings the engine relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

UTC = "UTC"


# Settings for a large cluster (hundreds of executors, tens of TB per job).
# Shuffle partitions are sized for the largest shuffle (~100 TB / 128 MB per
# task before coalescing) and AQE merges small ones back to the advisory size;
# skew splitting is on for joins whose one key holds a large share of rows.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "true",
    "spark.task.maxFailures": "8",
    "spark.stage.maxConsecutiveAttempts": "8",
}


def build_session(master: str | None = None, app: str = "parcelscope",
                  shuffle_partitions: int | None = None, extra: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings every job here assumes.

    * session time zone UTC: hour/day boundaries and month starts are computed on
      wall-clock time, as the warehouse does;
    * AQE on, with partition coalescing and skew-join splitting, so the shuffle
      partition count can be sized for the largest input and trimmed at runtime;
    * the web UI off (batch jobs, nothing to serve).

    Pass ``extra=CLUSTER_CONF`` on a large cluster.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": UTC,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def pin_utc(spark: SparkSession) -> None:
    """Queries compare wall-clock boundaries; make sure the session zone is UTC."""
    if spark.conf.get("spark.sql.session.timeZone", None) != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)


def checkpoint_dir(spark: SparkSession, lake: str) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``, else a folder beside the
    lake, on the lake's own file system."""
    return spark.conf.get("spark.checkpoint.dir", None) or lake.rstrip("/") + "/_checkpoints"


def work_dir(spark: SparkSession) -> str:
    """A folder that all executors share: ``spark.checkpoint.dir``, or a private one for a local master."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="parcelscope-work-")
