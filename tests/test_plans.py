"""Plan-shape checks on the production path (queries over written zones)."""

import os

import pytest

from parcelscope.plans import metrics as M
from parcelscope.sources import zones
from parcelscope.sources.adapter import raw_table

from conftest import SF_SMALL

NAMES = ["orders", "order_items", "customers", "products", "category_translation"]


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")  # print scans in full
    root = str(tmp_path_factory.mktemp("plans"))
    for n in NAMES:
        zones.write_zone(raw_table(spark, SF_SMALL, n), os.path.join(root, zones.RAW, n))
    zones.transform(spark, root, NAMES)
    zones.load_tables(spark, root, NAMES, buckets=4)
    yield root
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def _plan(df):
    """The final (post-AQE) physical plan as text."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def _clean(spark, lake):
    return {n: zones.read_zone(spark, lake, zones.CLEAN, n) for n in NAMES}


def test_filters_and_columns_reach_the_scan(spark, lake):
    plan = _plan(M.q2b_monthly_on_time(_clean(spark, lake), since="1998-01-01"))
    assert "EqualTo(order_status,delivered)" in plan
    assert "GreaterThanOrEqual(order_purchase_timestamp" in plan
    schema = plan[plan.index("ReadSchema: struct<"):].split(">", 1)[0]
    assert "order_id" not in schema and "order_approved_at" not in schema


def test_month_partitions_are_pruned(spark, lake):
    orders = zones.read_zone(spark, lake, zones.CLEAN, "orders")
    assert "purchase_month" in orders.columns
    plan = _plan(M.q2a_monthly_delivery({"orders": orders}, since="1998-01-01"))
    part = plan[plan.index("PartitionFilters: ["):].split("]", 1)[0]
    assert "purchase_month" in part
    months = orders.select("purchase_month").distinct().count()
    kept = orders.filter("purchase_month >= date'1998-01-01'").select("purchase_month").distinct().count()
    assert 0 < kept < months


def test_stage_breakdown_scans_once(spark, lake):
    plan = _plan(M.q4a_stage_lead_time(_clean(spark, lake)))
    assert plan.count("FileScan parquet") == 1
    assert "Union" not in plan


def test_top_k_and_no_expand(spark, lake):
    plan = _plan(M.q6a_seller_late_rate(_clean(spark, lake), min_rows=1))
    assert "TakeOrderedAndProject" in plan
    assert "Expand" not in plan


def test_bucketed_warehouse_joins_without_shuffling_facts(spark, lake):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = {n: spark.table(f"wh_{n}") for n in ["orders", "order_items", "customers"]}
        plan = _plan(M.q8a_state_delivery_freight(t))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in plan
    # items are summed per order and joined to orders inside their buckets: no order_id shuffle at all
    assert "hashpartitioning(order_id" not in plan
    # only the order-level partial sums move, to meet the customers
    assert "hashpartitioning(customer_id" in plan


def test_bucketed_warehouse_seller_pairs_stay_in_buckets(spark, lake):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = {n: spark.table(f"wh_{n}") for n in ["orders", "order_items"]}
        plan = _plan(M.q6b_seller_processing(t, min_rows=1))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # (order, seller) pairs are built and joined to orders inside the order_id buckets
    assert "hashpartitioning(order_id" not in plan
    assert "hashpartitioning(seller_id" in plan


def test_dedup_combines_before_the_shuffle(spark):
    from parcelscope.operators.clean import dedup_geolocation
    from parcelscope.sources.adapter import raw_table
    plan = _plan(dedup_geolocation(raw_table(spark, SF_SMALL, "geolocation")))
    # partial aggregate -> exchange -> final aggregate: a point repeated in every row leaves each task as one row
    lines = [ln.strip(" :+-*()0123456789") for ln in plan.splitlines()]
    aggs = [i for i, ln in enumerate(lines) if ln.startswith("HashAggregate")]
    exchanges = [i for i, ln in enumerate(lines) if ln.startswith("Exchange hashpartitioning(geolocation")]
    assert len(aggs) >= 2 and exchanges
    assert aggs[0] < exchanges[0] < aggs[-1]
