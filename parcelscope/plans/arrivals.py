"""A lake that the driver's tables reach in two arrivals, cleaned by the stream after each.

The registered ``stream_`` and ``rollup_`` queries read it, so the incremental path (raw stream, cleaning by batches,
state over days, stored sums) is compared with the same statements as the full cards.  The arrival of a row follows from its
key; rows of geolocation with every fifth zip code arrive on both days.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import pin_utc, work_dir
from ..sources.adapter import raw_table
from ..sources.zones import MALFORMED, STREAM
from ..streaming.refine import read_refined, refine_new_rows
from . import metrics as M
from . import rollup

# table -> whether a raw row belongs to the first and to the second arrival
ARRIVALS = {
    "orders": ("CAST(order_id AS BIGINT) % 3 <> 0", "CAST(order_id AS BIGINT) % 3 = 0"),
    "order_items": ("CAST(order_id AS BIGINT) % 2 = 0", "CAST(order_id AS BIGINT) % 2 = 1"),
    "customers": ("CAST(customer_id AS BIGINT) % 5 <> 0", "CAST(customer_id AS BIGINT) % 5 = 0"),
    "geolocation": ("CAST(geolocation_zip_code_prefix AS INT) % 2 = 0 OR CAST(geolocation_zip_code_prefix AS INT) % 5 = 0",
                    "CAST(geolocation_zip_code_prefix AS INT) % 2 = 1 OR CAST(geolocation_zip_code_prefix AS INT) % 5 = 0"),
}


def arrive(rows: DataFrame, lake: str, name: str) -> None:
    """Adds raw rows to the raw stream of a lake, as an ingest does."""
    rows.withColumn(MALFORMED, F.lit(None).cast("string")).write.mode("append").parquet(f"{lake}/{STREAM}/{name}")


def stream_lake(spark: SparkSession, sf_dir: str) -> str:
    """The lake of a directory of driver tables, built once per session."""
    pin_utc(spark)
    lakes = spark.__dict__.setdefault("_parcelscope_stream_lakes", {})
    if sf_dir not in lakes:
        lake = f"{work_dir(spark)}/parcelscope-lake-{uuid.uuid4().hex}"
        for day in (0, 1):
            for name, rules in ARRIVALS.items():
                arrive(raw_table(spark, sf_dir, name).filter(rules[day]), lake, name)
            refine_new_rows(spark, lake, list(ARRIVALS))
            rollup.update(spark, lake)
        lakes[sf_dir] = lake
    return lakes[sf_dir]


def refined(spark: SparkSession, sf_dir: str, name: str, rejected: bool = False) -> DataFrame:
    return read_refined(spark, stream_lake(spark, sf_dir), name, rejected).drop(M.PURCHASE_MONTH)


def full_card(spark: SparkSession, sf_dir: str, name: str, **params) -> DataFrame:
    """A card over the refined tables."""
    return M.QUERIES[name]({n: refined(spark, sf_dir, n) for n in ARRIVALS}, **params)


def rollup_card(spark: SparkSession, sf_dir: str, name: str, **params) -> DataFrame:
    """A card from the stored sums."""
    return rollup.CARDS[name](spark, stream_lake(spark, sf_dir), **params)
