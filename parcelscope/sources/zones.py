"""Zones: source CSV -> raw Parquet -> clean Parquet + quarantine -> warehouse tables.

Each zone is a directory of Parquet files written by Spark (many part files,
splittable).  Writing a zone and reading it back is also where lineage is cut,
so a lost executor never recomputes more than one step.  Counting for the audit
happens on the data as it is written (``DataFrame.observe``), not in extra scans.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import REJECTED_FLAG, TRANSFORMS
from ..schema import REJECT_REASON, SCHEMAS, SORT_KEYS, TABLES, raw_schema

# Zone folder names.
RAW, CLEAN, REJECTED, WAREHOUSE = "raw_parquet", "clean_parquet", "rejected_parquet", "warehouse"
STREAM = "raw_stream"  # raw rows of the incremental ingest
STAGED = "staged_parquet"  # typed rows of a running transform, both sides of the quarantine
MANIFEST = "warehouse_manifest"  # which version of each warehouse table is the current one
AUDIT = "etl_audit"  # one row per table and daily run
MALFORMED = "_malformed"  # raw zone: the text of a line with too few or too many fields, else NULL
MALFORMED_REASON = "malformed_line"
KEPT_VERSIONS = 2  # warehouse versions left for readers that began before a switch


def absent(e: AnalysisException) -> bool:
    """Whether a read failed only because nothing is stored there."""
    return (e.getCondition() or "") in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def stored_rows(spark: SparkSession, lake: str, zone: str, name: str) -> int:
    try:
        return read_zone(spark, lake, zone, name).count()
    except AnalysisException as e:
        if absent(e):
            return 0
        raise


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder on whatever file system ``path`` names."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(jvm_path, True)


def _csv_reader(spark: SparkSession):
    # Quoted fields may span lines; a doubled quote is a literal quote.
    return (spark.read.option("header", True).option("multiLine", True)
            .option("quote", '"').option("escape", '"'))


def lines_schema(names: list[str]) -> T.StructType:
    """All-text columns and ``MALFORMED`` for the lines that do not have one field for each of them."""
    return T.StructType([T.StructField(n, T.StringType(), True) for n in [*names, MALFORMED]])


def filled(df: DataFrame) -> DataFrame:
    """Empty fields (which Spark reads as NULL) as ``''``; ``MALFORMED`` stays NULL on well-formed lines."""
    return df.na.fill("", subset=[c for c in df.columns if c != MALFORMED])


def read_raw_lines(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Every line of a source CSV: the declared columns as text, and ``MALFORMED``.

    Columns are picked by header name, so the file's column order does not
    matter, and a file without one of them is refused.  Spark reads an empty field as NULL,
    which ``filled`` turns back into ``''``; the text ``NA`` stays ``'NA'``.  A line with a field
    too few or too many cannot be matched to columns: its text goes to ``MALFORMED``.
    Multi-line CSV cannot be split inside a file: parallelism comes from the
    number of files.
    """
    header = _csv_reader(spark).csv(path).columns
    declared = raw_schema(name).names
    missing = [c for c in declared if c not in header]
    if missing:
        raise ValueError(f"{path} lacks the columns {', '.join(missing)}")
    df = _csv_reader(spark).schema(lines_schema(header)).option("columnNameOfCorruptRecord", MALFORMED).csv(path)
    return filled(df.select(*declared, MALFORMED))


def read_raw_csv(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The well-formed lines of a source CSV as the raw zone sees them: every column text, empties as ``''``."""
    return read_raw_lines(spark, path, name).filter(F.col(MALFORMED).isNull()).drop(MALFORMED)


def split_lines(raw: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(rows to clean, malformed lines with their reason) of raw-zone rows; the second is None without ``MALFORMED``."""
    if MALFORMED not in raw.columns:
        return raw, None
    bad = raw.filter(F.col(MALFORMED).isNotNull()).select(F.col(MALFORMED).alias("line"), F.lit(MALFORMED_REASON).alias(REJECT_REASON))
    return raw.filter(F.col(MALFORMED).isNull()).drop(MALFORMED), bad


def lines_table(name: str) -> str:
    """Quarantine table of the malformed lines of ``name``."""
    return f"{name}_lines"


def read_inferred_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with inferred types and empties as NULL (what the data-quality study read)."""
    return _csv_reader(spark).option("inferSchema", True).csv(path)


def source_exists(spark: SparkSession, path: str) -> bool:
    """Whether a source path is there (missing sources are skipped, not fatal)."""
    try:
        spark.read.format("text").load(path).schema  # noqa: B018 - resolves the path only
        return True
    except AnalysisException as e:
        if absent(e):
            return False
        raise


# Clean tables written in directory partitions: name -> (partition column, expression).
PARTITIONS = {"orders": ("purchase_month", "trunc(order_purchase_timestamp, 'MM')")}


def clustered(df: DataFrame, name: str) -> DataFrame:
    """Rows in tasks of disjoint ranges of the table's sort key, sorted in each.

    A hash of the whole row comes after the key, so a key that holds a large share of the
    rows is spread over as many tasks as it needs.  The files' Parquet statistics then let a filter on the
    key read only the files whose range holds it.
    """
    key = SORT_KEYS[name]
    spread = F.xxhash64(*[F.col(c) for c in df.columns])
    return df.repartitionByRange(*key, spread).sortWithinPartitions(*key)


def write_zone(df: DataFrame, path: str, name: str | None = None, observation: Observation | None = None,
               partitioned: bool = False) -> None:
    """Replace a zone directory, files clustered by the table's sort key (``clustered``).

    With ``partitioned`` a table listed in ``PARTITIONS`` (orders) is written in
    one directory per purchase month, so date-bounded questions skip whole
    months; rows are range-partitioned on (month, key), so each writer
    task covers one or two months (few files) and a month holding a third of
    all rows is still spread over many tasks.
    """
    if partitioned and name in PARTITIONS:
        col, expr = PARTITIONS[name]
        df = df.withColumn(col, F.expr(expr)).repartitionByRange(col, *SORT_KEYS[name])
        writer_df = df.sortWithinPartitions(col, *SORT_KEYS[name])
        if observation is not None:
            writer_df = writer_df.observe(observation, F.count(F.lit(1)).alias("rows"))
        writer_df.write.mode("overwrite").partitionBy(col).parquet(path)
        return
    if name in SORT_KEYS:
        df = clustered(df, name)
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("rows"))
    df.write.mode("overwrite").parquet(path)


def clean_schema(name: str) -> T.StructType:
    """Declared columns of a clean table, and its partition column."""
    extra = [T.StructField(PARTITIONS[name][0], T.DateType(), True)] if name in PARTITIONS else []
    return T.StructType([*SCHEMAS[name].fields, *extra])


def read_zone(spark: SparkSession, lake: str, zone: str, name: str) -> DataFrame:
    """Read a zone table back.

    Clean tables are read with their declared schema: a table that was written without rows has no
    file to infer one from, and is empty, not absent.  Warehouse tables are those of the current version.
    """
    if zone == WAREHOUSE:
        return warehouse_table(spark, lake, name)
    reader = spark.read.schema(clean_schema(name)) if zone == CLEAN else spark.read
    return reader.parquet(os.path.join(lake, zone, name))


def extract(spark: SparkSession, source_dir: str, lake: str, names=TABLES) -> dict[str, int]:
    """Every present ``<name>.csv`` -> raw Parquet; returns rows written per table."""
    counts = {}
    for name in names:
        src = os.path.join(source_dir, f"{name}.csv")
        if not source_exists(spark, src):
            continue
        obs = Observation(f"extract_{name}")
        write_zone(read_raw_lines(spark, src, name), os.path.join(lake, RAW, name), None, obs)
        counts[name] = obs.get["rows"]
    return counts


def transform(spark: SparkSession, lake: str, names=TABLES, zone: str = RAW) -> list[tuple[str, int, int, int]]:
    """Raw zone (or ``zone``) -> clean zone + quarantine for every table present there.

    The raw rows are read, parsed and de-duplicated once: the flagged frame goes
    to a staging folder, partitioned by the reject flag, and both zones are
    written from there, each reading its own side only; the staging folder is removed at the end.
    Malformed lines go to a quarantine table of their own.  The quarantine is
    always rewritten, so an old one never outlives a run that has no rejects.
    Returns ``(table, rows_before, rows_after, rows_rejected)``.
    """
    log = []
    for name in names:
        try:
            raw = read_zone(spark, lake, zone, name)
        except AnalysisException as e:
            if absent(e):
                continue
            raise
        o_raw, o_clean, o_rej, o_lines = (Observation(f"{side}_{name}") for side in ("input", "clean", "rejected", "lines"))
        rows, lines = split_lines(raw)
        split = TRANSFORMS[name](rows.observe(o_raw, F.count(F.lit(1)).alias("rows")))
        staged = os.path.join(lake, STAGED, name)
        split.flagged.write.mode("overwrite").partitionBy(REJECTED_FLAG).parquet(staged)
        typed = spark.read.schema(split.flagged.schema).parquet(staged)
        bad = F.col(REJECTED_FLAG)
        write_zone(typed.filter(~bad).select(split.clean.columns), os.path.join(lake, CLEAN, name), name, o_clean,
                   partitioned=True)
        write_zone(typed.filter(bad).select(split.rejected.columns), os.path.join(lake, REJECTED, name), None, o_rej)
        n_lines = 0
        if lines is not None:
            write_zone(lines, os.path.join(lake, REJECTED, lines_table(name)), None, o_lines)
            n_lines = o_lines.get["rows"]
        remove(spark, staged)
        log.append((name, o_raw.get["rows"] + n_lines, o_clean.get["rows"], o_rej.get["rows"] + n_lines))
    return log


# --- S8: the warehouse ------------------------------------------------------------------
#
# A load writes a whole new set of tables beside the current one and then appends one file to the
# manifest, which names the version, path and catalog table of each.  That file is the switch: until it is there,
# readers see the set of the last load, whatever happened to the new one.

_MANIFEST_SCHEMA = "version long, table_name string, path string, catalog_name string, rows long"


def _manifest(spark: SparkSession, lake: str) -> DataFrame:
    return spark.read.schema(_MANIFEST_SCHEMA).parquet(os.path.join(lake, MANIFEST))


def warehouse_versions(spark: SparkSession, lake: str) -> list[int]:
    """Numbers of all loads that were completed, in order."""
    try:
        return sorted(r[0] for r in _manifest(spark, lake).select("version").distinct().collect())  # one row per daily load
    except AnalysisException as e:
        if absent(e):
            return []
        raise


def _version_path(lake: str, version: int) -> str:
    return os.path.join(lake, WAREHOUSE, f"version={version:06d}")


def warehouse_table(spark: SparkSession, lake: str, name: str) -> DataFrame:
    """The table of the current version: bucketed, where this session's catalog has it so."""
    last = _manifest(spark, lake).groupBy().agg(F.max("version")).first()[0]
    entry = _manifest(spark, lake).filter((F.col("version") == (last or 0)) & (F.col("table_name") == name)).first()
    if entry is not None and entry["catalog_name"] and spark.catalog.tableExists(entry["catalog_name"]):
        return spark.table(entry["catalog_name"])
    path = entry["path"] if entry is not None else os.path.join(_version_path(lake, last or 0), name)
    return spark.read.schema(SCHEMAS[name]).parquet(path)


def _write_bucketed(df: DataFrame, name: str, path: str, catalog_name: str, buckets: int) -> None:
    key = SORT_KEYS[name]
    # one task per bucket, so one file per bucket
    (df.repartition(buckets, key[0]).write.mode("overwrite").format("parquet").bucketBy(buckets, key[0]).sortBy(*key)
     .option("path", path).saveAsTable(catalog_name))


def load_tables(spark: SparkSession, lake: str, names=TABLES, buckets: int | None = None) -> dict[str, int | None]:
    """Clean zone -> a new version of the warehouse, which replaces the last one as a whole.

    Every table of ``names`` is replaced, with no rows where the clean zone lacks it (reported as None, else the
    rows loaded); tables outside ``names`` are carried over as they are.  A load that fails half way changes
    nothing for readers, and the next one writes over what it left.

    With ``buckets`` the tables are bucketed and sorted by their key, so
    joins and aggregations on that key later read co-partitioned files without
    a shuffle (views ``wh_<table>`` name them); otherwise the files have disjoint key ranges (``clustered``).
    """
    done = warehouse_versions(spark, lake)
    version = (done[-1] if done else 0) + 1
    lake_id = hashlib.sha1(lake.encode()).hexdigest()[:8]
    entries = []
    if done:
        kept = _manifest(spark, lake).filter((F.col("version") == done[-1]) & ~F.col("table_name").isin(list(names)))
        entries = [(version, r["table_name"], r["path"], r["catalog_name"], r["rows"]) for r in kept.collect()]
    loaded: dict[str, int | None] = {}
    for name in names:
        columns = [f.name for f in SCHEMAS[name].fields]
        try:
            df, there = read_zone(spark, lake, CLEAN, name).select(columns), True
        except AnalysisException as e:
            if not absent(e):
                raise
            df, there = spark.createDataFrame([], SCHEMAS[name]), False
        path = os.path.join(_version_path(lake, version), name)
        catalog_name = f"wh_{name}_{lake_id}_{version}" if buckets else None
        if buckets:
            _write_bucketed(df, name, path, catalog_name, buckets)
        else:
            clustered(df, name).write.mode("overwrite").parquet(path)
        rows = spark.read.schema(SCHEMAS[name]).parquet(path).count()  # from the new files' footers
        loaded[name] = rows if there else None
        entries.append((version, name, path, catalog_name, rows))
    spark.createDataFrame(entries, _MANIFEST_SCHEMA).coalesce(1).write.mode("append").parquet(os.path.join(lake, MANIFEST))
    for _, name, _, catalog_name, _ in entries:
        if catalog_name and spark.catalog.tableExists(catalog_name):
            if spark.catalog.tableExists(f"wh_{name}") and spark.catalog.getTable(f"wh_{name}").tableType != "VIEW":
                spark.sql(f"DROP TABLE wh_{name}")
            spark.sql(f"CREATE OR REPLACE VIEW wh_{name} AS SELECT * FROM {catalog_name}")
    _drop_old_versions(spark, lake, [*done, version], {e[2] for e in entries})
    return loaded


def _drop_old_versions(spark: SparkSession, lake: str, versions: list[int], in_use: set[str]) -> None:
    """Removes tables of versions before the last ``KEPT_VERSIONS`` that no later one carries over."""
    old = versions[:-KEPT_VERSIONS]
    if not old:
        return
    rows = _manifest(spark, lake).collect()  # one row per table and load
    in_use = in_use | {r["path"] for r in rows if r["version"] not in old}
    for r in rows:
        if r["version"] in old and r["path"] not in in_use:
            if r["catalog_name"]:
                spark.sql(f"DROP TABLE IF EXISTS {r['catalog_name']}")
            remove(spark, r["path"])


def audit_frame(spark: SparkSession, log: list[tuple[str, int, int, int]]) -> DataFrame:
    """S9 for a finished run: one row per table from the counts observed while writing."""
    df = spark.createDataFrame(log, "table_name string, rows_before long, rows_after long, rows_rejected long")
    return audit_columns(df)


def audit_columns(df: DataFrame) -> DataFrame:
    dropped = F.col("rows_before") - F.col("rows_after")
    return df.select("table_name", "rows_before", "rows_after", "rows_rejected",
                     (dropped - F.col("rows_rejected")).alias("rows_duplicate"), dropped.alias("rows_dropped"),
                     F.when(F.col("rows_before") > 0,
                            F.round(dropped.cast("double") * F.lit(100.0) / F.col("rows_before").cast("double"), 2))
                     .otherwise(F.lit(0.0)).alias("dropped_pct"))


def etl_audit(raw: dict[str, DataFrame], split: dict) -> DataFrame:
    """S9 as a query: ``(table, before, after, rejected, dropped, dropped %)`` per table.

    Each table is read once: its flagged frame (typed rows with a ``_rejected``
    flag) yields all three counts; only a de-duplicating step (geolocation)
    needs a separate count of its input.  All tables are unioned into one
    aggregate (one partial row per table and task, one tiny reduce), and a
    constant zero row per table keeps an empty table in the report.
    """
    spark = next(iter(raw.values())).sparkSession
    zero = F.lit(0).cast("long")
    one = F.lit(1).cast("long")
    parts = [spark.createDataFrame([(name,) for name in raw], "table_name string")
             .select("table_name", zero.alias("b"), zero.alias("a"), zero.alias("r"))]
    for name, df in raw.items():
        s = split[name]
        flag = F.col(REJECTED_FLAG)
        if not getattr(s, "same_rows", True):
            parts.append(df.select(F.lit(name).alias("table_name"), one.alias("b"), zero.alias("a"), zero.alias("r")))
            before = zero
        else:
            before = one
        parts.append(s.flagged.select(F.lit(name).alias("table_name"), before.alias("b"),
                                      (~flag).cast("long").alias("a"), flag.cast("long").alias("r")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    wide = u.groupBy("table_name").agg(F.sum("b").alias("rows_before"), F.sum("a").alias("rows_after"),
                                       F.sum("r").alias("rows_rejected"))
    return audit_columns(wide)


def run_daily(spark: SparkSession, source_dir: str, lake: str, buckets: int | None = None) -> DataFrame:
    """The daily run: extract, transform, load, in that order; returns the audit.

    Only the tables extracted in this run are transformed and loaded.  A table that an
    earlier run left but whose source is absent today is emptied in every zone and
    reported with zero rows, so that cards never mix days.
    """
    extracted = extract(spark, source_dir, lake)
    log = transform(spark, lake, list(extracted))
    for name in TABLES:
        if name not in extracted and any(stored_rows(spark, lake, z, name) for z in (RAW, CLEAN, WAREHOUSE)):
            write_zone(spark.createDataFrame([], lines_schema(raw_schema(name).names)), os.path.join(lake, RAW, name))
            log += transform(spark, lake, [name])
    load_tables(spark, lake, [t for t, *_ in log], buckets=buckets)
    audit = audit_frame(spark, log)
    audit.coalesce(1).withColumn("run_at", F.current_timestamp()).write.mode("append").parquet(os.path.join(lake, AUDIT))
    return audit


def audit_history(spark: SparkSession, lake: str) -> DataFrame:
    """The audit of every daily run so far, with the time it ended."""
    return spark.read.parquet(os.path.join(lake, AUDIT))
