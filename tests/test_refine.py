"""The incremental path: ingest, cleaning by batches, state over days, stored sums; killed batches and random arrivals."""

import os
import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from parcelscope.operators.clean import TRANSFORMS
from parcelscope.plans import metrics as M
from parcelscope.plans import rollup
from parcelscope.plans.arrivals import arrive
from parcelscope.plans.registry import ntz
from parcelscope.schema import TABLES, raw_schema
from parcelscope.sources import zones
from parcelscope.sources.adapter import raw_table
from parcelscope.streaming import refine
from parcelscope.streaming.ingest import ingest_new_files

from conftest import SF_SMALL


def _csv(folder, name, day, rows, tail=""):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, f"{name}_{day}.csv"), "w") as f:
        f.write(",".join(raw_schema(name).names) + "\n")
        for r in rows:
            f.write(",".join(f'"{v}"' for v in r) + "\n")
        f.write(tail)


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _order(i, month, customer="c1", carrier="03", delivered="05", status="delivered"):
    m = f"2018-{month:02d}-"
    return (f"o{i}", customer, status, m + "01 10:00:00", m + "01 11:00:00", m + f"{carrier} 10:00:00", m + f"{delivered} 10:00:00", m + "09 00:00:00")


def test_ingest_clean_card_equals_the_batch_run(spark, tmpdir_path):
    """CSV files of two days through the stream, and the same rows in one batch run."""
    landing, lake, src, batch = (os.path.join(tmpdir_path, x) for x in ("landing", "lake", "src", "batch"))
    orders = [[_order(i, 1 + i % 4, f"c{i % 3}", "02" if i % 5 else "07") for i in range(k, 40, 2)] for k in (0, 1)]
    items = [[(f"o{i}", "1", "p", "s", "", "1.5", "0.75" if i % 7 else "x") for i in range(k, 40, 2)] for k in (0, 1)]
    customers = [[("c0", "u", "1", "x", "SP"), ("c1", "u", "2", "x", "RJ")], [("c2", "u", "3", "x", "SP")]]
    for day in (0, 1):
        _csv(landing, "orders", day, orders[day], tail="broken,line\n" if day else "")
        _csv(landing, "order_items", day, items[day])
        _csv(landing, "customers", day, customers[day])
        got = ingest_new_files(spark, landing, lake, ["orders", "order_items", "customers", "mql"])
        assert got == {"orders": 20 + day, "order_items": 20, "customers": 2 - day, "mql": 0}
        assert refine.refine_new_rows(spark, lake)[:2] == ["orders", "order_items"]
    for name, days in (("orders", orders), ("order_items", items), ("customers", customers)):
        _csv(src, name, "x", days[0] + days[1], tail="broken,line\n" if name == "orders" else "")
        os.rename(os.path.join(src, f"{name}_x.csv"), os.path.join(src, f"{name}.csv"))
    audit = {r.table_name: tuple(r) for r in zones.run_daily(spark, src, batch).collect()}
    assert {r.table_name: tuple(r) for r in refine.refined_audit(spark, lake, ["orders", "order_items", "customers"]).collect()} == audit
    stream = refine.RefinedTables(spark, lake)
    full = {n: zones.read_zone(spark, batch, zones.WAREHOUSE, n) for n in ("orders", "order_items", "customers")}
    for card, params in (("q8a_state_delivery_freight", {}), ("q5a_state_delivery", {"min_rows": 1}), ("q2a_monthly_delivery", {}), ("q1a_delivery_stats", {})):
        assert M.QUERIES[card](stream, **params).collect() == M.QUERIES[card](full, **params).collect(), card
    assert _same(refine.read_refined(spark, lake, "orders", rejected=True).drop("purchase_month"),
                 zones.read_zone(spark, batch, zones.REJECTED, "orders"))
    assert [r.line.strip() for r in refine.malformed_lines(spark, lake, "orders").collect()] == ["broken,line"]


def test_a_killed_batch_is_run_again_and_counts_once(spark, tmpdir_path, monkeypatch):
    lake = tmpdir_path
    rows = spark.createDataFrame([_order(i, 1 + i % 2) for i in range(10)], raw_schema("orders").names)
    arrive(rows, lake, "orders")
    refine.refine_table(spark, lake, "orders")
    arrive(rows.withColumn("order_id", F.concat(F.lit("x"), "order_id")), lake, "orders")
    real = refine.log_batch

    def dies(*args):
        raise OSError("executor and driver lost")

    monkeypatch.setattr(refine, "log_batch", dies)
    with pytest.raises(StreamingQueryException):
        refine.refine_table(spark, lake, "orders")
    # its files are there, but it is not committed
    assert refine._batches(spark, lake, "orders").count() == 20
    assert refine.read_refined(spark, lake, "orders").count() == 10 and refine.last_batch(spark, lake, "orders") == 0
    monkeypatch.setattr(refine, "log_batch", real)
    refine.refine_table(spark, lake, "orders")
    assert refine.read_refined(spark, lake, "orders").count() == 20
    assert refine.read_refined(spark, lake, "orders").select("order_id").distinct().count() == 20
    refine.refine_table(spark, lake, "orders")  # nothing new
    assert refine.last_batch(spark, lake, "orders") == 1


def test_geolocation_is_unique_over_all_days(spark, tmpdir_path, monkeypatch):
    lake = tmpdir_path
    raw = raw_table(spark, SF_SMALL, "geolocation").limit(60).cache()
    arrive(raw, lake, "geolocation")
    refine.refine_table(spark, lake, "geolocation")
    first = {f: os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(os.path.join(lake, refine.REFINED)) for f in fs if f.endswith(".parquet")}
    more = raw_table(spark, SF_SMALL, "geolocation")
    # the same point written differently is the same row once typed
    again = raw.withColumn("geolocation_lat", F.concat("geolocation_lat", F.when(F.col("geolocation_lat") != "", F.lit("0")).otherwise(F.lit(""))))
    arrive(again.unionByName(more), lake, "geolocation")
    real = refine.log_batch
    monkeypatch.setattr(refine, "log_batch", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(StreamingQueryException):
        refine.refine_table(spark, lake, "geolocation")
    monkeypatch.setattr(refine, "log_batch", real)
    refine.refine_table(spark, lake, "geolocation")
    clean, rejected = TRANSFORMS["geolocation"](more)
    assert _same(refine.read_refined(spark, lake, "geolocation"), clean)
    assert _same(refine.read_refined(spark, lake, "geolocation", rejected=True), rejected)
    after = {f: os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(os.path.join(lake, refine.REFINED)) for f in fs if f.endswith(".parquet")}
    assert first.items() <= after.items()  # the first day's files are as they were
    audit = refine.refined_audit(spark, lake, ["geolocation"]).first()
    assert audit.rows_before == 120 + more.count() and audit.rows_duplicate == audit.rows_before - clean.count() - rejected.count()


def _cards(spark, lake, tables):
    for card, params in (("q1a_delivery_stats", {}), ("q1b_delivery_histogram", {}), ("q1c_on_time_counts", {}), ("q1d_on_time_rates", {}),
                         ("q2a_monthly_delivery", {"since": "1996-03-01"}), ("q2b_monthly_on_time", {"since": "1996-03-01"}),
                         ("q2c_monthly_delivery_all", {}), ("q2d_monthly_on_time", {"since": None}), ("q5a_state_delivery", {"min_rows": 3}),
                         ("q5b_state_late_rate", {"min_rows": 3})):
        assert rollup.CARDS[card](spark, lake, **params).collect() == M.QUERIES[card](tables, **params).collect(), card


def test_stored_sums_equal_the_full_cards_after_random_arrivals(spark, tmpdir_path):
    lake = tmpdir_path
    orders = raw_table(spark, SF_SMALL, "orders").filter("order_purchase_timestamp < '1996-07'").cache()
    customers = raw_table(spark, SF_SMALL, "customers").cache()
    # some orders without a purchase date, and a customer that is stored twice
    orders = orders.withColumn("order_purchase_timestamp", F.when(F.expr("CAST(order_id AS BIGINT) % 50 = 7"), "").otherwise(F.col("order_purchase_timestamp")))
    rng = random.Random(7)
    lots = [rng.sample(range(12), 12) for _ in range(2)]
    at = [0, 0]
    for step in range(3):
        for which, (name, df, key) in enumerate((("orders", orders, "order_id"), ("customers", customers, "customer_id"))):
            n = 12 - at[which] if step == 2 else rng.randint(2, 5)
            some = lots[which][at[which]:at[which] + n]
            at[which] += n
            if some:
                arrive(df.filter(F.pmod(F.xxhash64(key), F.lit(12)).isin(some)), lake, name)
        if step == 1:
            arrive(customers.limit(3), lake, "customers")  # known customers again
        refine.refine_new_rows(spark, lake, ["orders", "customers"])
        rollup.update(spark, lake)
        if step:
            _cards(spark, lake, refine.RefinedTables(spark, lake))
    assert refine.read_refined(spark, lake, "orders").count() + refine.read_refined(spark, lake, "orders", True).count() == orders.count()
    assert rollup.update(spark, lake) == []


def _files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_only_touched_months_are_read_and_written(spark, tmpdir_path):
    lake = tmpdir_path
    names = raw_schema("orders").names
    arrive(spark.createDataFrame([("c1", "u", "1", "x", "SP")], raw_schema("customers").names), lake, "customers")
    arrive(spark.createDataFrame([_order(i, 1 + i % 6) for i in range(60)], names), lake, "orders")
    refine.refine_new_rows(spark, lake, ["orders", "customers"])
    assert len(rollup.update(spark, lake)) == 6
    before = _files(os.path.join(lake, rollup.ROLLUP))
    arrive(spark.createDataFrame([_order(100, 3), _order(101, 5, customer="late")], names), lake, "orders")
    refine.refine_new_rows(spark, lake, ["orders", "customers"])
    months = rollup.update(spark, lake)
    assert sorted(str(m) for m in months) == ["2018-03-01", "2018-05-01"]
    after = _files(os.path.join(lake, rollup.ROLLUP))
    kept = {f for f, t in before.items() if after.get(f) == t}
    assert len(kept) == 12 and not any(f"{m}" in f for f in kept for m in ("2018-03-01", "2018-05-01"))
    # what an update of these months scans: their folders only
    scanned = (refine.read_refined(spark, lake, "orders").filter(rollup.in_months(months)).select(F.input_file_name().alias("f")).distinct().collect())
    assert {r.f.split("purchase_month=")[1].split("/")[0] for r in scanned} == {"2018-03-01", "2018-05-01"}
    # the late customer touches only the month with an order that lacks a state
    arrive(spark.createDataFrame([("late", "u", "1", "x", "RJ")], raw_schema("customers").names), lake, "customers")
    refine.refine_new_rows(spark, lake, ["orders", "customers"])
    assert [str(m) for m in rollup.update(spark, lake)] == ["2018-05-01"]
    _cards(spark, lake, refine.RefinedTables(spark, lake))


def test_an_update_that_dies_is_run_again(spark, tmpdir_path, monkeypatch):
    lake = tmpdir_path
    arrive(raw_table(spark, SF_SMALL, "orders").filter("order_purchase_timestamp < '1996-07'"), lake, "orders")
    arrive(raw_table(spark, SF_SMALL, "customers"), lake, "customers")
    refine.refine_new_rows(spark, lake, list(TABLES))
    real = rollup.partials

    def half(orders, customers):
        all_three = real(orders, customers)
        return {"months": all_three["months"], "states": all_three["states"].select(F.raise_error(F.lit("lost")).alias("x"), rollup.MONTH)}

    monkeypatch.setattr(rollup, "partials", half)
    with pytest.raises(Exception, match="lost"):
        rollup.update(spark, lake)
    monkeypatch.setattr(rollup, "partials", real)
    rollup.update(spark, lake)
    _cards(spark, lake, refine.RefinedTables(spark, lake))
    with pytest.raises(ValueError):
        rollup.monthly_delivery(spark, lake, since="1996-03-05")


def test_refined_rows_are_typed_like_the_batch(spark, tmpdir_path):
    for name in ("products", "order_reviews"):
        arrive(raw_table(spark, SF_SMALL, name), tmpdir_path, name)
        refine.refine_table(spark, tmpdir_path, name)
        clean, _ = TRANSFORMS[name](raw_table(spark, SF_SMALL, name))
        assert _same(ntz(refine.read_refined(spark, tmpdir_path, name)), ntz(clean))
    assert refine.read_refined(spark, tmpdir_path, "orders").count() == 0  # never ingested


@pytest.mark.parametrize("name", ["orders", "order_items"])
def test_a_batch_is_read_once(spark, tmpdir_path, name):
    """Finding the ranges that the rows are dealt to does not read (and parse) the batch again."""
    seen = spark.sparkContext.accumulator(0)

    def counted(row):
        seen.add(1)
        return row
    rows = [_order(i, 1 + i % 6) for i in range(60)] if name == "orders" else [
        (f"o{i}", "1", "p", "s", "", "1.5", "0.75" if i % 7 else "x") for i in range(60)]
    raw = spark.createDataFrame(spark.sparkContext.parallelize(rows, 4).map(counted), raw_schema(name))
    kept = set(spark.sparkContext._jsc.getPersistentRDDs())
    refine._write_batch(tmpdir_path, name)(raw, 0)
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) <= kept  # no batch stays behind
    assert seen.value == 60
    parts = [refine.read_refined(spark, tmpdir_path, name, rejected).count() for rejected in (False, True)]
    assert sum(parts) == 60 and parts[0] > 0
