"""Dashboard cards from stored partial aggregates, kept up to date as orders arrive.

Three small tables hold sums and counts of the delivered orders, one folder for each purchase month:

* ``months``: orders, delivery days, orders on time and late;
* ``states``: the same sums by customer state (orders of customers not known yet have none);
* ``hours``: how many orders took how many hours and days (an exact histogram, so quantiles merge).

``update`` finds the months that batches since its last run touch and computes only those anew, from their
own folders of the refined orders; all other months are neither read nor rewritten.  New customers also touch the months that
have orders without a state, and, should they repeat a known customer, all months.  Folders are replaced as a whole and the
log is written last, so a run that dies is simply run again.  Sums are of integers, and cards divide once: results
equal the full cards.
"""

from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefn import days_between, hours_between, is_late, is_on_time, pct
from ..sources.zones import absent
from ..streaming.refine import BATCH, last_batch, read_refined
from . import metrics as M

ROLLUP, LOG = "rollup", "rollup_log"
MONTH = M.PURCHASE_MONTH
SUMS = ["n_days", "day_sum", "hour_sum", "n_known", "on_time", "late"]
SCHEMAS = {
    "months": f"{', '.join(f'{c} long' for c in SUMS)}, {MONTH} date",
    "states": f"customer_state string, {', '.join(f'{c} long' for c in SUMS)}, {MONTH} date",
    "hours": f"h long, d long, n long, {MONTH} date",
}


def _sums() -> list[Column]:
    timed = F.col(M.PURCHASE).isNotNull() & F.col(M.CUSTOMER).isNotNull()
    known = F.col(M.CUSTOMER).isNotNull() & F.col(M.ESTIMATED).isNotNull()
    return [F.count_if(timed).alias("n_days"), F.sum(F.when(timed, days_between(M.PURCHASE, M.CUSTOMER)).cast("long")).alias("day_sum"),
            F.sum(F.when(timed, hours_between(M.PURCHASE, M.CUSTOMER)).cast("long")).alias("hour_sum"), F.count_if(known).alias("n_known"),
            F.count_if(known & is_on_time()).alias("on_time"), F.count_if(known & is_late()).alias("late")]


def partials(orders: DataFrame, customers: DataFrame) -> dict[str, DataFrame]:
    """The three tables for the given (delivered) orders."""
    per_customer = orders.groupBy(MONTH, "customer_id").agg(*_sums())
    states = per_customer.join(customers.select("customer_id", "customer_state"), "customer_id", "left")
    total = [F.sum(c).alias(c) for c in SUMS]
    hours = (orders.filter(F.col(M.PURCHASE).isNotNull() & F.col(M.CUSTOMER).isNotNull())
             .groupBy(MONTH, hours_between(M.PURCHASE, M.CUSTOMER).cast("long").alias("h"),
                      days_between(M.PURCHASE, M.CUSTOMER).cast("long").alias("d")).agg(F.count(F.lit(1)).alias("n")))
    return {"months": orders.groupBy(MONTH).agg(*_sums()), "states": states.groupBy(MONTH, "customer_state").agg(*total), "hours": hours}


# --- upkeep ----------------------------------------------------------------------------------

def _log(spark: SparkSession, lake: str) -> tuple[int, int]:
    """Batches of orders and customers that the stored sums cover."""
    try:
        row = spark.read.schema("run long, orders long, customers long").parquet(os.path.join(lake, LOG)).orderBy(F.desc("run")).first()
    except AnalysisException as e:
        if not absent(e):
            raise
        row = None
    return (row["orders"], row["customers"]) if row else (-1, -1)


def in_months(months: Iterable) -> Column:
    """Orders of these months (None: those without a purchase date): a filter that prunes folders."""
    months = list(months)
    some = [m for m in months if m is not None]
    out = F.col(MONTH).isin(some) if some else F.lit(False)
    return out | F.col(MONTH).isNull() if None in months else out


def touched_months(spark: SparkSession, lake: str, done: tuple[int, int], upto: tuple[int, int]) -> list | None:
    """Months whose sums batches after ``done`` change (a few hundred at most); None: all of them."""
    orders = read_refined(spark, lake, "orders", with_batch=True)
    months = {r[0] for r in orders.filter((F.col(BATCH) > done[0]) & (F.col(BATCH) <= upto[0])).select(MONTH).distinct().collect()}
    if upto[1] > done[1] and done != (-1, -1):
        customers = read_refined(spark, lake, "customers", with_batch=True).select("customer_id", BATCH)
        fresh = customers.filter(F.col(BATCH) > done[1])
        again = fresh.select("customer_id").join(customers.filter(F.col(BATCH) <= done[1]).select("customer_id"), "customer_id", "left_semi")
        if not again.isEmpty():
            return None
        months |= {r[0] for r in stored(spark, lake, "states").filter("customer_state IS NULL").select(MONTH).distinct().collect()}
    return list(months)


def update(spark: SparkSession, lake: str) -> list | None:
    """Brings the stored sums up to the last committed batches; returns the months computed (None: all)."""
    done = _log(spark, lake)
    upto = (last_batch(spark, lake, "orders"), last_batch(spark, lake, "customers"))
    if upto == done:
        return []
    months = touched_months(spark, lake, done, upto)
    if months is None or months:
        orders = read_refined(spark, lake, "orders", with_batch=True).filter(F.col(BATCH) <= upto[0])
        orders = orders.filter(F.col("order_status") == M.DELIVERED)
        if months is not None:
            orders = orders.filter(in_months(months))
        customers = read_refined(spark, lake, "customers", with_batch=True).filter(F.col(BATCH) <= upto[1])
        for name, df in partials(orders, customers).items():
            (df.repartition(MONTH).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH)
             .parquet(os.path.join(lake, ROLLUP, name)))
    spark.createDataFrame([(upto[0] + upto[1], *upto)], "run long, orders long, customers long").coalesce(1).write.mode("append").parquet(
        os.path.join(lake, LOG))
    return months


def stored(spark: SparkSession, lake: str, name: str) -> DataFrame:
    """One of the three tables; without rows before the first orders."""
    try:
        return spark.read.schema(SCHEMAS[name]).parquet(os.path.join(lake, ROLLUP, name))
    except AnalysisException as e:
        if absent(e):
            return spark.createDataFrame([], SCHEMAS[name])
        raise


# --- cards -----------------------------------------------------------------------------------

def _since(rows: DataFrame, since: str | None) -> DataFrame:
    if since is None:
        return rows
    if not since.endswith("-01"):
        raise ValueError(f"the sums are kept by month; {since} is not the first day of one")
    return rows.filter(F.col(MONTH) >= F.lit(since).cast("date"))


def delivery_stats(spark: SparkSession, lake: str) -> DataFrame:
    """1a: mean, median and 90th percentile from the merged histograms."""
    hist = stored(spark, lake, "hours").groupBy("h").agg(F.sum("n").alias("n"))
    return hist.agg(
        M._r2(M._days_from_hours(F.sum(F.col("h") * F.col("n")), F.sum("n"))).alias("avg_days"),
        M._r2(F.percentile(F.col("h"), F.lit(0.5), F.col("n")) / 24).alias("median_days"),
        M._r2(F.percentile(F.col("h"), F.lit(0.9), F.col("n")) / 24).alias("p90_days"))


def delivery_histogram(spark: SparkSession, lake: str) -> DataFrame:
    """1b."""
    return (stored(spark, lake, "hours").groupBy(M.day_bucket(F.col("d")).alias("delivery_time")).agg(F.sum("n").alias("total_orders"))
            .orderBy(M._bucket_rank(F.col("delivery_time"))))


def _punctuality(spark: SparkSession, lake: str) -> DataFrame:
    return stored(spark, lake, "months").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(a) for c, a in (
        ("n_known", "total_orders"), ("on_time", "on_time_orders"), ("late", "late_orders"))])


def on_time_counts(spark: SparkSession, lake: str) -> DataFrame:
    """1c."""
    return _punctuality(spark, lake)


def on_time_rates(spark: SparkSession, lake: str) -> DataFrame:
    """1d."""
    return _punctuality(spark, lake).select(
        M._r2(pct(F.col("on_time_orders"), F.col("total_orders"))).alias("on_time_rate"),
        M._r2(pct(F.col("late_orders"), F.col("total_orders"))).alias("late_rate"))


def monthly_delivery(spark: SparkSession, lake: str, since: str | None = M.SINCE) -> DataFrame:
    """2a, and 2c without ``since``."""
    rows = _since(stored(spark, lake, "months"), since).filter("n_days > 0")
    return rows.select(F.col(MONTH).alias("month"), M._r2(F.try_divide(F.col("day_sum").cast("double"), F.col("n_days").cast("double")))
                       .alias("avg_delivery_days")).orderBy("month")


def monthly_on_time(spark: SparkSession, lake: str, since: str | None = M.SINCE) -> DataFrame:
    """2b and 2d."""
    rows = _since(stored(spark, lake, "months"), since).filter("n_known > 0")
    return rows.select(F.col(MONTH).alias("month"), M._r2(pct(F.col("on_time"), F.col("n_known"))).alias("on_time_rate")).orderBy("month")


def _by_state(spark: SparkSession, lake: str) -> DataFrame:
    return (stored(spark, lake, "states").filter("customer_state IS NOT NULL").groupBy("customer_state")
            .agg(*[F.sum(c).alias(c) for c in SUMS]))


def state_delivery(spark: SparkSession, lake: str, min_rows: int = M.MIN_ROWS) -> DataFrame:
    """5a."""
    return (_by_state(spark, lake).filter((F.col("n_days") >= min_rows) & (F.col("n_days") > 0))
            .select("customer_state", M._r2(M._days_from_hours(F.col("hour_sum"), F.col("n_days"))).alias("avg_delivery_days"),
                    F.col("n_days").alias("total_delivered_orders")).orderBy(F.desc("avg_delivery_days"), "customer_state"))


def state_late_rate(spark: SparkSession, lake: str, min_rows: int = M.MIN_ROWS) -> DataFrame:
    """5b."""
    return (_by_state(spark, lake).filter((F.col("n_known") >= min_rows) & (F.col("n_known") > 0))
            .select("customer_state", F.col("n_known").alias("total_delivered_orders"), F.col("late").alias("late_deliveries"),
                    M._r2(pct(F.col("late"), F.col("n_known"))).alias("late_delivery_rate"))
            .orderBy(F.desc("late_delivery_rate"), "customer_state"))


CARDS = {
    "q1a_delivery_stats": delivery_stats, "q1b_delivery_histogram": delivery_histogram, "q1c_on_time_counts": on_time_counts,
    "q1d_on_time_rates": on_time_rates, "q2a_monthly_delivery": monthly_delivery, "q2b_monthly_on_time": monthly_on_time,
    "q2c_monthly_delivery_all": lambda spark, lake: monthly_delivery(spark, lake, None), "q2d_monthly_on_time": monthly_on_time,
    "q5a_state_delivery": state_delivery, "q5b_state_late_rate": state_late_rate,
}
