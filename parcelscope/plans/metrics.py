"""Delivery-performance questions over the clean tables (the dashboard cards).

Each function takes ``tables`` (name -> clean DataFrame) plus the card's
parameters, defaulting to the values the dashboard uses, and returns a lazy
DataFrame whose column names are the card's columns in snake_case.

Plan shape, chosen for very large and skewed inputs:

* Facts are *aggregated to the join-key grain before they are joined to a
  dimension* (items per order before the order join, orders per customer
  before the customer join, item rows per product before the product join).
  Partial aggregation runs map-side, so a hot order, customer, seller or
  product collapses to one row per task before anything is shuffled, and the
  dimension joins afterwards are one-to-one on unique keys.  An aggregate on
  ``order_id`` is hash-partitioned on it, so the order join that follows
  shuffles only the orders.
* Averages over item rows are carried as exact integer ``(sum, count)`` pairs
  and divided once at the end, so re-grouping does not change results.
* Dimension joins (customers, products, category names) are left to the
  planner: it broadcasts a side only when its measured size is below
  ``spark.sql.autoBroadcastJoinThreshold`` (and AQE re-checks at runtime),
  otherwise it shuffles; the aggregated fact side is already partitioned by the
  join key, so only the dimension moves.
* Global aggregates (one result row) need no shuffle beyond the final merge of
  one partial row per task; exact percentiles are taken over a histogram that
  is built with a distributed aggregate first, so no reducer receives a
  value -> count map from every task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions.timefn import (days_between, delivery_status, hours_between, is_late,
                                is_on_time, month_start, pct)
from ..operators.spread import spread_join

# The dashboard's parameter defaults and labels.
DELIVERED = "delivered"
SINCE = "2017-01-01"
MIN_ROWS = 100
TOP_SELLERS = 20
TOP_CATEGORIES = 10
DAY_BUCKETS = [(5, "0-5 Days"), (10, "6-10 Days"), (15, "11-15 Days"), (20, "16-20 Days"), (25, "21-25 Days")]
LAST_DAY_BUCKET = ">25 Days"
WEIGHT_BUCKETS = [(500, "< 0.5 kg"), (1000, "0.5 - 1 kg"), (5000, "1 - 5 kg")]
LAST_WEIGHT_BUCKET = "> 5 kg"
STAGES = [
    (1, "Payment Approval", "order_purchase_timestamp", "order_approved_at"),
    (2, "Seller Processing", "order_approved_at", "order_delivered_carrier_date"),
    (3, "Delivery to Customer", "order_delivered_carrier_date", "order_delivered_customer_date"),
]

PURCHASE = "order_purchase_timestamp"
APPROVED = "order_approved_at"
CARRIER = "order_delivered_carrier_date"
CUSTOMER = "order_delivered_customer_date"
ESTIMATED = "order_estimated_delivery_date"


def _r2(c: Column) -> Column:
    return F.round(c, 2)


def _days_from_hours(sum_hours: Column, n: Column) -> Column:
    """avg(hours) / 24 from an exact (sum, count) pair; NULL on an empty group."""
    return F.try_divide(sum_hours.cast("double"), n.cast("double")) / F.lit(24.0)


def _nn(*cols: str) -> Column:
    out = F.lit(True)
    for c in cols:
        out = out & F.col(c).isNotNull()
    return out


def delivered(tables: dict[str, DataFrame], *not_null: str) -> DataFrame:
    o = tables["orders"].filter(F.col("order_status") == DELIVERED)
    return o.filter(_nn(*not_null)) if not_null else o


# --- 1: overall delivery time and punctuality ------------------------------------

def q1a_delivery_stats(tables) -> DataFrame:
    """Mean, median and 90th percentile of delivery hours, in days.

    Exact quantiles without a single-reducer fan-in: hours are first counted
    per distinct value (a partial-then-shuffled aggregate spread over all
    reducers), then the mean and the weighted exact percentiles are taken over
    that histogram, which has one row per distinct hour (a few thousand at
    most, whatever the number of orders).
    """
    h = hours_between(PURCHASE, CUSTOMER)
    hist = (delivered(tables, PURCHASE, CUSTOMER).groupBy(h.alias("h"))
            .agg(F.count(F.lit(1)).alias("n")))
    return hist.agg(
        _r2(_days_from_hours(F.sum(F.col("h") * F.col("n")), F.sum("n"))).alias("avg_days"),
        _r2(F.percentile(F.col("h"), F.lit(0.5), F.col("n")) / 24).alias("median_days"),
        _r2(F.percentile(F.col("h"), F.lit(0.9), F.col("n")) / 24).alias("p90_days"),
    )


def day_bucket(days: Column) -> Column:
    """Days -> bucket label; negatives fall in the first bucket."""
    out = F.lit(LAST_DAY_BUCKET)
    for edge, label in reversed(DAY_BUCKETS):
        out = F.when(days <= edge, F.lit(label)).otherwise(out)
    return out


def _bucket_rank(label: Column) -> Column:
    out = F.lit(len(DAY_BUCKETS) + 1)
    for i, (_, name) in reversed(list(enumerate(DAY_BUCKETS))):
        out = F.when(label == name, F.lit(i + 1)).otherwise(out)
    return out


def q1b_delivery_histogram(tables) -> DataFrame:
    d = days_between(PURCHASE, CUSTOMER)
    return (delivered(tables, PURCHASE, CUSTOMER)
            .groupBy(day_bucket(d).alias("delivery_time"))
            .agg(F.count(F.lit(1)).alias("total_orders"))
            .orderBy(_bucket_rank(F.col("delivery_time"))))


def _punctuality(tables) -> DataFrame:
    return delivered(tables, CUSTOMER, ESTIMATED).agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_if(is_on_time()).alias("on_time_orders"),
        F.count_if(is_late()).alias("late_orders"),
    )


def q1c_on_time_counts(tables) -> DataFrame:
    return _punctuality(tables)


def q1d_on_time_rates(tables) -> DataFrame:
    p = _punctuality(tables)
    return p.select(
        _r2(pct(F.col("on_time_orders"), F.col("total_orders"))).alias("on_time_rate"),
        _r2(pct(F.col("late_orders"), F.col("total_orders"))).alias("late_rate"),
    )


# --- 2: monthly trends -------------------------------------------------------------

PURCHASE_MONTH = "purchase_month"


def since_filter(orders: DataFrame, since: str | None) -> DataFrame:
    """Purchases on or after ``since``.

    When the orders come from a month-partitioned clean zone, the implied bound
    on the month column is added as well, so whole month directories are pruned.
    """
    if since is None:
        return orders
    start = F.lit(since).cast("timestamp")
    out = orders.filter(F.col(PURCHASE) >= start)
    if PURCHASE_MONTH in orders.columns:
        out = out.filter(F.col(PURCHASE_MONTH) >= F.trunc(start, "MM"))
    return out


def q2a_monthly_delivery(tables, since: str | None = SINCE) -> DataFrame:
    o = since_filter(delivered(tables, PURCHASE, CUSTOMER), since)
    return (o.groupBy(month_start(PURCHASE).alias("month"))
            .agg(_r2(F.avg(days_between(PURCHASE, CUSTOMER))).alias("avg_delivery_days"))
            .orderBy("month"))


def q2b_monthly_on_time(tables, since: str | None = SINCE) -> DataFrame:
    o = since_filter(delivered(tables, CUSTOMER, ESTIMATED), since)
    return (o.groupBy(month_start(PURCHASE).alias("month"))
            .agg(_r2(pct(F.count_if(is_on_time()), F.count(F.lit(1)))).alias("on_time_rate"))
            .orderBy("month"))


def q2c_monthly_delivery_all(tables) -> DataFrame:
    return q2a_monthly_delivery(tables, since=None)


def q2d_monthly_on_time(tables, since: str | None = SINCE) -> DataFrame:
    """Second dashboard card with the same statement as 2b."""
    return q2b_monthly_on_time(tables, since=since)


def q2e_estimate_vs_actual(tables) -> DataFrame:
    """Each average skips its own NULLs; no NOT NULL filter."""
    return delivered(tables).agg(
        _r2(F.avg(days_between(PURCHASE, ESTIMATED))).alias("avg_estimated_days"),
        _r2(F.avg(days_between(PURCHASE, CUSTOMER))).alias("avg_actual_days"),
    )


def estimate_gap(tables) -> DataFrame:
    """Estimated vs actual delivery days and the gap between them (difference of
    the unrounded averages, then rounded), as shown next to 2e."""
    est, act = F.avg(days_between(PURCHASE, ESTIMATED)), F.avg(days_between(PURCHASE, CUSTOMER))
    return delivered(tables).agg(est.alias("e"), act.alias("a")).select(
        _r2(F.col("e")).alias("avg_estimated_days"), _r2(F.col("a")).alias("avg_actual_days"),
        _r2(F.col("e") - F.col("a")).alias("gap_days"))


def q2f_days_early(tables) -> DataFrame:
    return delivered(tables).agg(_r2(F.avg(days_between(CUSTOMER, ESTIMATED))).alias("avg_days_early"))


def trend_change(monthly: DataFrame, value_col: str, periods: int = 1) -> DataFrame:
    """Change of a monthly series against ``periods`` calendar months before: ``value``, ``prev_value``, ``change_pct``.

    The window frame is a range over the number of the month, so it holds the month that lies exactly
    ``periods`` before: a month without orders gives NULL there and shifts nothing.
    The input is one row per month (a result of 2a-2d), so the un-partitioned
    window runs over at most a few hundred rows.
    """
    number = F.year("month") * 12 + F.month("month")
    w = Window.orderBy("_number").rangeBetween(-periods, -periods)
    v = F.col("value")
    return (monthly.select("month", F.col(value_col).alias("value"), number.alias("_number"))
            .select("month", "value", F.max("value").over(w).alias("prev_value"))
            .withColumn("change_pct", _r2(pct(v - F.col("prev_value"), F.col("prev_value"))))
            .orderBy("month"))


# --- 3: reviews --------------------------------------------------------------------

def q3a_review_by_status(tables) -> DataFrame:
    """Average review score by delivery status, over joined (order, review) rows.

    Reviews are first summed per order (map-side partial aggregation), so an
    order with very many reviews never skews the join.
    """
    per_order = (tables["order_reviews"].filter(F.col("review_score").isNotNull())
                 .groupBy("order_id")
                 .agg(F.sum(F.col("review_score").cast("long")).alias("score_sum"),
                      F.count(F.lit(1)).alias("n")))
    o = delivered(tables).select("order_id", delivery_status().alias("delivery_status"))
    j = o.join(per_order, "order_id")
    return j.groupBy("delivery_status").agg(
        _r2(F.try_divide(F.sum("score_sum").cast("double"), F.sum("n").cast("double"))).alias("avg_review_score"),
        F.sum("n").alias("total_orders"),
    )


def q3b_review_rows(tables, salts: int | None = None) -> DataFrame:
    """Reviews meet their order one by one; an order with very many of them is spread (``spread_join``)."""
    r = tables["order_reviews"].filter(F.col("review_score").isNotNull()).select("order_id", "review_score", "review_id")
    o = delivered(tables).select("order_id", delivery_status().alias("delivery_status"))
    return spread_join(r, o, "order_id", "review_id", salts).select("order_id", "review_score", "delivery_status")


# --- 4: stages ---------------------------------------------------------------------

def q4a_stage_lead_time(tables) -> DataFrame:
    """Average days per stage in one scan; the three stage rows come from ``stack``.

    ``hours_between`` is NULL when either side is, so each stage's average
    covers exactly the rows where both of its timestamps exist.
    """
    o = delivered(tables)
    agg = o.agg(*[(F.avg(hours_between(a, b)) / 24).alias(f"s{i}") for i, _, a, b in STAGES])
    args = ", ".join(f"{i}, '{name}', round(s{i}, 2)" for i, name, _, _ in STAGES)
    return agg.selectExpr(f"stack({len(STAGES)}, {args}) as (sort_order, stage, avg_days)").orderBy("sort_order")


def q4b_stage_by_status(tables) -> DataFrame:
    """Stage days split On Time / Late; rows need all four timestamps."""
    o = delivered(tables, PURCHASE, APPROVED, CARRIER, CUSTOMER)
    on_time = is_on_time()
    aggs = []
    for i, _, a, b in STAGES:
        h = hours_between(a, b)
        aggs.append((F.avg(F.when(on_time, h)) / 24).alias(f"on{i}"))
        aggs.append((F.avg(F.when(~F.coalesce(on_time, F.lit(False)), h)) / 24).alias(f"late{i}"))
    args = ", ".join(f"'{name}', round(on{i}, 2), round(late{i}, 2)" for i, name, _, _ in STAGES)
    return o.agg(*aggs).selectExpr(f"stack({len(STAGES)}, {args}) as (stage, on_time_days, late_days)")


# --- item-level facts, pre-aggregated at the order grain -----------------------------

# money is summed exactly, with ten decimals, and divided once; a value that does not fit (from 10^28) is left out
MONEY_SQL = "try_cast(freight_value AS DECIMAL(38, 10))"


def items_per_order(tables, *keys: str, freight: bool = False) -> DataFrame:
    """Item rows summed per ``(order_id, *keys)``: ``n_items`` (+ freight sum/count)."""
    it = tables["order_items"]
    aggs = [F.count(F.lit(1)).alias("n_items")]
    if freight:
        aggs += [F.try_sum(F.expr(MONEY_SQL)).alias("freight_sum"),
                 F.count(F.expr(MONEY_SQL)).alias("freight_n")]
    return it.groupBy("order_id", *keys).agg(*aggs)


def _by_customer_state(per_order: DataFrame, tables, sums: list[Column]) -> DataFrame:
    """Roll order-level partial sums up to the customer, then to the state.

    The customer roll-up makes the customer join one-to-one and skew-free.
    """
    per_customer = per_order.groupBy("customer_id").agg(*sums)
    customers = tables["customers"].select("customer_id", "customer_state")
    names = [c for c in per_customer.columns if c != "customer_id"]
    return (per_customer.join(customers, "customer_id")
            .groupBy("customer_state").agg(*[F.try_sum(c).alias(c) for c in names]))


# --- 5: geography -------------------------------------------------------------------

def q5a_state_delivery(tables, min_rows: int = MIN_ROWS) -> DataFrame:
    o = delivered(tables, PURCHASE, CUSTOMER).select(
        "customer_id", hours_between(PURCHASE, CUSTOMER).alias("h"))
    s = _by_customer_state(o, tables, [F.sum("h").alias("h_sum"), F.count(F.lit(1)).alias("n")])
    return (s.filter(F.col("n") >= min_rows)
            .select("customer_state",
                    _r2(_days_from_hours(F.col("h_sum"), F.col("n"))).alias("avg_delivery_days"),
                    F.col("n").alias("total_delivered_orders"))
            .orderBy(F.desc("avg_delivery_days"), "customer_state"))


def q5b_state_late_rate(tables, min_rows: int = MIN_ROWS) -> DataFrame:
    o = delivered(tables, CUSTOMER, ESTIMATED).select(
        "customer_id", F.when(is_late(), 1).otherwise(0).alias("late"))
    s = _by_customer_state(o, tables, [F.count(F.lit(1)).alias("n"), F.sum("late").alias("late")])
    return (s.filter(F.col("n") >= min_rows)
            .select("customer_state",
                    F.col("n").alias("total_delivered_orders"),
                    F.col("late").alias("late_deliveries"),
                    _r2(pct(F.col("late"), F.col("n"))).alias("late_delivery_rate"))
            .orderBy(F.desc("late_delivery_rate"), "customer_state"))


def q5c_state_freight(tables, min_rows: int = MIN_ROWS) -> DataFrame:
    per_order = delivered(tables).select("order_id", "customer_id").join(
        items_per_order(tables, freight=True), "order_id")
    s = _by_customer_state(per_order, tables, [F.sum("n_items").alias("n"),
                                               F.try_sum("freight_sum").alias("freight_sum"),
                                               F.sum("freight_n").alias("freight_n")])
    return (s.filter(F.col("n") >= min_rows)
            .select("customer_state",
                    _r2(F.try_divide(F.col("freight_sum").cast("double"), F.col("freight_n").cast("double"))).alias("avg_freight_cost"),
                    F.col("n").alias("total_items_shipped"))
            .orderBy(F.desc("avg_freight_cost"), "customer_state"))


# --- 6: sellers ----------------------------------------------------------------------

def _seller_orders(tables, *not_null: str) -> DataFrame:
    """Distinct (seller, order) pairs with their item count, joined to delivered orders.

    An order id stored several times counts once; ``copies`` says how many rows it had.
    """
    pairs = items_per_order(tables, "seller_id")
    hours = hours_between(*not_null)
    orders = delivered(tables, *not_null).groupBy("order_id").agg(
        F.max(is_late()).alias("is_late"), F.count(F.lit(1)).alias("copies"), F.sum(hours).alias("h"))
    return orders.join(pairs, "order_id")


def _seller_late(tables, min_rows: int) -> DataFrame:
    j = _seller_orders(tables, CUSTOMER, ESTIMATED)
    return (j.groupBy("seller_id")
            .agg(F.count(F.lit(1)).alias("total_orders"),
                 F.count_if(F.col("is_late")).alias("late_deliveries"))
            .filter(F.col("total_orders") >= min_rows)
            .withColumn("late_delivery_rate", _r2(pct(F.col("late_deliveries"), F.col("total_orders")))))


def q6a_seller_late_rate(tables, min_rows: int = MIN_ROWS, top_n: int = TOP_SELLERS) -> DataFrame:
    s = _seller_late(tables, min_rows)
    return (s.select("seller_id", F.col("total_orders").alias("total_delivered_orders"),
                     "late_deliveries", "late_delivery_rate")
            .orderBy(F.desc("late_delivery_rate"), "seller_id").limit(top_n))


def q6b_seller_processing(tables, min_rows: int = MIN_ROWS, top_n: int = TOP_SELLERS) -> DataFrame:
    """Processing days weighted by item rows; orders counted once."""
    j = _seller_orders(tables, APPROVED, CARRIER)
    s = (j.groupBy("seller_id")
         .agg(F.count(F.lit(1)).alias("total_delivered_orders"),
              F.sum(F.col("h") * F.col("n_items")).alias("h_sum"),
              F.sum(F.col("n_items") * F.col("copies")).alias("n_items"))
         .filter(F.col("total_delivered_orders") >= min_rows))
    return (s.select("seller_id", "total_delivered_orders",
                     _r2(_days_from_hours(F.col("h_sum"), F.col("n_items"))).alias("avg_processing_days"))
            .orderBy(F.desc("avg_processing_days"), "seller_id").limit(top_n))


def q6c_seller_scatter(tables, min_rows: int = MIN_ROWS) -> DataFrame:
    return _seller_late(tables, min_rows).select("seller_id", "total_orders", "late_delivery_rate")


# --- 7: products -----------------------------------------------------------------------

def _product_facts(tables, salts: int | None = None) -> DataFrame:
    """Per product: item rows, item rows with a delivery time, their hour sum, late items.

    Line items are (almost) unique per (order, product), so they are joined to
    the orders as they are (those of an order with very many items spread, see ``spread_join``) and summed per
    product right after; the partial aggregate collapses a hot product before the shuffle.
    """
    items = tables["order_items"].select("order_id", "product_id", "order_item_id")
    o = delivered(tables).select("order_id", hours_between(PURCHASE, CUSTOMER).alias("h"),
                                 is_late().alias("is_late"))
    j = spread_join(items, o, "order_id", "order_item_id", salts)
    return j.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("h").alias("n_h"),
        F.sum("h").alias("h_sum"),
        F.count_if(F.col("is_late")).alias("late"),
    )


def _with_category(facts: DataFrame, tables) -> DataFrame:
    """Facts per category name, translated: the translation meets one row per category."""
    products = tables["products"].select("product_id", "product_category_name")
    names = tables["category_translation"]
    return (_rollup(facts.join(products, "product_id"), F.col("product_category_name"))
            .join(names, "product_category_name", "left")
            .withColumn("product_category", F.coalesce(F.col("product_category_name_english"), F.lit(""))))


def _rollup(df: DataFrame, key: Column) -> DataFrame:
    return df.groupBy(key).agg(F.sum("n").alias("n"), F.sum("n_h").alias("n_h"),
                               F.sum("h_sum").alias("h_sum"), F.sum("late").alias("late"))


def q7a_category_delivery(tables, min_rows: int = MIN_ROWS, top_n: int = TOP_CATEGORIES, salts: int | None = None) -> DataFrame:
    c = _rollup(_with_category(_product_facts(tables, salts), tables), F.col("product_category"))
    return (c.filter(F.col("n") >= min_rows)
            .select("product_category",
                    _r2(_days_from_hours(F.col("h_sum"), F.col("n_h"))).alias("avg_delivery_days"),
                    F.col("n").alias("total_items_sold"))
            .orderBy(F.desc("avg_delivery_days"), "product_category").limit(top_n))


def weight_bucket(w: Column) -> Column:
    """Grams -> label; NULL and anything from 5000 up fall in the last bucket."""
    out = F.lit(LAST_WEIGHT_BUCKET)
    for edge, label in reversed(WEIGHT_BUCKETS):
        out = F.when(w < edge, F.lit(label)).otherwise(out)
    return out


def q7b_weight_delivery(tables, salts: int | None = None) -> DataFrame:
    facts = _product_facts(tables, salts).join(
        tables["products"].select("product_id", "product_weight_g"), "product_id")
    c = _rollup(facts, weight_bucket(F.col("product_weight_g")).alias("weight_category"))
    return (c.select("weight_category",
                     _r2(_days_from_hours(F.col("h_sum"), F.col("n_h"))).alias("avg_delivery_days"),
                     F.col("n").alias("total_items_sold"))
            .orderBy(F.desc("avg_delivery_days"), "weight_category"))


def q7c_category_late_rate(tables, min_rows: int = MIN_ROWS, top_n: int = TOP_CATEGORIES, salts: int | None = None) -> DataFrame:
    """Denominator is every item row, undelivered-date rows included."""
    c = _rollup(_with_category(_product_facts(tables, salts), tables), F.col("product_category"))
    return (c.filter(F.col("n") >= min_rows)
            .select("product_category", F.col("n").alias("total_items_sold"),
                    F.col("late").alias("late_deliveries"),
                    _r2(pct(F.col("late"), F.col("n"))).alias("late_delivery_rate"))
            .orderBy(F.desc("late_delivery_rate"), "product_category").limit(top_n))


# --- 8: state, delivery and freight together --------------------------------------------

def _state_items(tables) -> DataFrame:
    o = delivered(tables, PURCHASE, CUSTOMER).select(
        "order_id", "customer_id",
        hours_between(PURCHASE, CUSTOMER).alias("h"),
        is_late().alias("is_late"))
    it = tables["order_items"].filter(F.col("freight_value").isNotNull())
    per_order = it.groupBy("order_id").agg(F.count(F.lit(1)).alias("n_items"),
                                           F.try_sum(F.expr(MONEY_SQL)).alias("freight_sum"))
    j = o.join(per_order, "order_id")
    n = F.col("n_items")
    return _by_customer_state(j, tables, [
        F.sum(n).alias("n"),
        F.sum(F.col("h") * n).alias("h_sum"),
        F.try_sum("freight_sum").alias("freight_sum"),
        F.sum(F.when(F.col("is_late"), n).otherwise(0)).alias("late"),
        F.sum(F.when(F.col("is_late").isNotNull(), n).otherwise(0)).alias("n_known"),
    ])


def q8a_state_delivery_freight(tables) -> DataFrame:
    """'Total orders' counts item rows, as on the dashboard."""
    s = _state_items(tables)
    return (s.select("customer_state",
                     _r2(_days_from_hours(F.col("h_sum"), F.col("n"))).alias("avg_delivery_days"),
                     _r2(F.try_divide(F.col("freight_sum").cast("double"), F.col("n").cast("double"))).alias("avg_freight_cost"),
                     F.col("n").alias("total_orders"))
            .orderBy(F.desc("avg_delivery_days"), "customer_state"))


def q8b_state_late_freight(tables) -> DataFrame:
    """Late rate is the mean of a boolean: a NULL estimate is left out of it."""
    s = _state_items(tables)
    return (s.select("customer_state", F.col("n").alias("total_orders"),
                     _r2(pct(F.col("late"), F.col("n_known"))).alias("late_delivery_rate"),
                     _r2(F.try_divide(F.col("freight_sum").cast("double"), F.col("n").cast("double"))).alias("avg_freight_cost"))
            .orderBy(F.desc("late_delivery_rate"), "customer_state"))


QUERIES = {
    "q1a_delivery_stats": q1a_delivery_stats,
    "q1b_delivery_histogram": q1b_delivery_histogram,
    "q1c_on_time_counts": q1c_on_time_counts,
    "q1d_on_time_rates": q1d_on_time_rates,
    "q2a_monthly_delivery": q2a_monthly_delivery,
    "q2b_monthly_on_time": q2b_monthly_on_time,
    "q2c_monthly_delivery_all": q2c_monthly_delivery_all,
    "q2d_monthly_on_time": q2d_monthly_on_time,
    "q2e_estimate_vs_actual": q2e_estimate_vs_actual,
    "q2f_days_early": q2f_days_early,
    "q3a_review_by_status": q3a_review_by_status,
    "q3b_review_rows": q3b_review_rows,
    "q4a_stage_lead_time": q4a_stage_lead_time,
    "q4b_stage_by_status": q4b_stage_by_status,
    "q5a_state_delivery": q5a_state_delivery,
    "q5b_state_late_rate": q5b_state_late_rate,
    "q5c_state_freight": q5c_state_freight,
    "q6a_seller_late_rate": q6a_seller_late_rate,
    "q6b_seller_processing": q6b_seller_processing,
    "q6c_seller_scatter": q6c_seller_scatter,
    "q7a_category_delivery": q7a_category_delivery,
    "q7b_weight_delivery": q7b_weight_delivery,
    "q7c_category_late_rate": q7c_category_late_rate,
    "q8a_state_delivery_freight": q8a_state_delivery_freight,
    "q8b_state_late_freight": q8b_state_late_freight,
}
