from pyspark.sql import functions as F

from parcelscope.operators.clean import (BOTH_REASONS, CARRIER_BEFORE_APPROVED, CUSTOMER_BEFORE_CARRIER,
                                         clean_geolocation, clean_orders, clean_products, clean_reviews,
                                         passthrough)
from parcelscope.schema import REJECT_REASON, raw_schema

ORDER_COLS = [f.name for f in raw_schema("orders").fields]


def _orders(spark, rows):
    return spark.createDataFrame(rows, raw_schema("orders"))


def test_orders_reject_reasons(spark):
    p = "2018-01-01 10:00:00"
    rows = [
        # id, cust, status, purchase, approved, carrier, customer, estimated
        ("ok", "c", "delivered", p, "2018-01-01 11:00:00", "2018-01-02 10:00:00", "2018-01-05 10:00:00",
         "2018-01-10 00:00:00"),
        ("carrier_first", "c", "delivered", p, "2018-01-02 11:00:00", "2018-01-02 10:00:00", "2018-01-05 10:00:00", ""),
        ("customer_first", "c", "delivered", p, "2018-01-01 11:00:00", "2018-01-03 10:00:00",
         "2018-01-02 10:00:00", ""),
        ("both", "c", "delivered", p, "2018-01-03 11:00:00", "2018-01-03 10:00:00", "2018-01-02 10:00:00", ""),
        ("equal", "c", "delivered", p, "2018-01-01 11:00:00", "2018-01-01 11:00:00", "2018-01-01 11:00:00", ""),
        ("empty_approved", "c", "delivered", p, "", "2018-01-01 09:00:00", "2018-01-02 10:00:00", ""),
        ("malformed", "c", "delivered", p, "yesterday", "2018-01-01 09:00:00", "2018-01-02 10:00:00", ""),
        ("date_only", "c", "delivered", p, "2018-01-02", "2018-01-01 09:00:00", "2018-01-02 10:00:00", ""),
        ("no_customer_date", "c", "delivered", p, "2018-01-01 11:00:00", "2018-01-02 10:00:00", "", ""),
        ("approved_before_purchase", "c", "delivered", p, "2018-01-01 09:00:00", "2018-01-02 10:00:00",
         "2018-01-03 10:00:00", ""),
    ]
    clean, rejected = clean_orders(_orders(spark, rows))
    reasons = {r.order_id: r[REJECT_REASON] for r in rejected.collect()}
    assert reasons == {"carrier_first": CARRIER_BEFORE_APPROVED, "customer_first": CUSTOMER_BEFORE_CARRIER,
                       "both": BOTH_REASONS}
    kept = {r.order_id for r in clean.collect()}
    assert kept == {r[0] for r in rows} - set(reasons)
    # unparseable text becomes NULL, never a guess
    by_id = {r.order_id: r for r in clean.collect()}
    assert by_id["malformed"].order_approved_at is None
    assert by_id["date_only"].order_approved_at is None
    assert by_id["no_customer_date"].order_delivered_customer_date is None
    assert dict(clean.dtypes)["order_purchase_timestamp"] == "timestamp"


def test_orders_split_is_a_partition_and_idempotent(spark):
    from parcelscope.sources.adapter import raw_table
    raw = raw_table(spark, "/root/testdata/sf0.001", "orders")
    clean, rejected = clean_orders(raw)
    assert clean.count() + rejected.count() == raw.count()
    again, again_rej = clean_orders(clean)
    assert again_rej.count() == 0
    assert again.exceptAll(clean).count() == 0 and clean.exceptAll(again).count() == 0


def test_counters_whole_numbers(spark):
    cols = [f.name for f in raw_schema("products").fields]
    base = dict.fromkeys(cols, "")
    rows = []
    for pid, v in [("a", "40.0"), ("b", "40"), ("c", "40.5"), ("d", ""), ("e", "x")]:
        r = dict(base, product_id=pid, product_name_lenght=v)
        rows.append(tuple(r[c] for c in cols))
    clean, rejected = clean_products(spark.createDataFrame(rows, raw_schema("products")))
    got = {r.product_id: r.product_name_lenght for r in clean.collect()}
    assert got == {"a": 40, "b": 40, "d": None, "e": None}
    assert [(r.product_id, r[REJECT_REASON]) for r in rejected.collect()] == [("c", "non_integer:product_name_lenght")]


def test_required_numbers_are_quarantined(spark):
    rows = [("o1", "1", "p", "s", "", "10.5", "2.0"), ("o2", "2", "p", "s", "", "", "2.0")]
    clean, rejected = passthrough("order_items")(spark.createDataFrame(rows, raw_schema("order_items")))
    assert [r.order_id for r in clean.collect()] == ["o1"]
    assert [r[REJECT_REASON] for r in rejected.collect()] == ["null_in_required:price"]


def test_reviews_scores(spark):
    rows = [("r1", "o1", "5", "", "", "2018-01-01 00:00:00", ""), ("r2", "o1", "", "", "", "", ""),
            ("r3", "o2", "4.0", "t", "m", "", "")]
    clean, rejected = clean_reviews(spark.createDataFrame(rows, raw_schema("order_reviews")))
    assert {r.review_id: r.review_score for r in clean.collect()} == {"r1": 5, "r2": None, "r3": 4}
    assert rejected.count() == 0


def test_geolocation_dedup_and_box(spark):
    rows = [
        ("1000", "-23.10", "-46.5", "x", "SP"),
        ("1000", "-23.10", "-46.5", "x", "SP"),   # exact duplicate
        ("1000", "-23.1", "-46.5", "x", "SP"),    # duplicate only after typing
        ("01000", "-23.1", "-46.5", "x", "SP"),   # duplicate only after zero padding
        ("2", "-35", "-75", "y", "RS"),           # corner, inclusive
        ("3", "5", "-30", "y", "RR"),             # other corner
        ("4", "5.0001", "-40", "y", "RR"),        # outside
        ("5", "", "-40", "y", "RR"),              # no latitude: rejected
        ("5", "", "-40", "y", "RR"),              # ... and de-duplicated first (NULLs equal)
    ]
    clean, rejected = clean_geolocation(spark.createDataFrame(rows, raw_schema("geolocation")))
    got = sorted((r.geolocation_zip_code_prefix, r.geolocation_lat) for r in clean.collect())
    assert got == [("00002", -35.0), ("00003", 5.0), ("01000", -23.1)]
    assert sorted(r.geolocation_zip_code_prefix for r in rejected.collect()) == ["00004", "00005"]
    # invariant: clean + rejected + duplicates = input
    assert clean.count() + rejected.count() + 4 == len(rows)


def test_malformed_numbers_are_quarantined_or_null(spark):
    """Overflow, NaN and suffixed numbers: no failure, NULL where optional, quarantine where required."""
    from parcelscope.operators.clean import TRANSFORMS
    from parcelscope.schema import raw_schema

    items = [("o1", "99999999999", "p", "s", "", "1.0", "2.0"), ("o2", "1", "p", "s", "", "NaN", "2.0"),
             ("o3", "1", "p", "s", "", "1.5d", "2.0"), ("o4", "40.5", "p", "s", "", "1.0", "2.0"),
             ("o5", "x", "p", "s", "", "1.0", "2.0"), ("o6", "1.0", "p", "s", "", "1e2", " 3 ")]
    clean, rejected = TRANSFORMS["order_items"](spark.createDataFrame(items, raw_schema("order_items")))
    assert [(r.order_id, r.order_item_id, r.price, r.freight_value) for r in clean.collect()] == [("o6", 1, 100.0, 3.0)]
    assert {r.order_id: r.reject_reason for r in rejected.collect()} == {
        "o1": "null_in_required:order_item_id", "o2": "null_in_required:price", "o3": "null_in_required:price",
        "o4": "non_integer:order_item_id", "o5": "null_in_required:order_item_id"}
    reviews = [("r1", "o1", "NaN", "", "", "", ""), ("r2", "o1", "99999999999", "", "", "", ""), ("r3", "o1", "4.0", "", "", "", "")]
    clean, rejected = TRANSFORMS["order_reviews"](spark.createDataFrame(reviews, raw_schema("order_reviews")))
    assert {r.review_id: r.review_score for r in clean.collect()} == {"r1": None, "r2": None, "r3": 4}
    assert rejected.count() == 0


def test_text_is_parsed_before_rows_are_split(spark):
    """No filter of the quarantine holds a copy of the parsing."""
    items = spark.createDataFrame([("1", "1", "p", "s", "", "2.5", "1.0"), ("1", "x", "p", "s", "", "2.5", "1.0"), ("1", "3.5", "p", "s", "", "2.5", "1.0"),
                                   ("2", "1", "p", "s", "", "NaN", "1.0"), ("2", "2", "p", "s", "", "1e30", "1.0"), ("2", "3", "p", "s", "", "2.5", "1e400")],
                                  raw_schema("order_items"))
    orders = _orders(spark, [("a", "c", "delivered", "", "2018-01-02 10:00:00", "2018-01-01 10:00:00", "x", "")])
    for split in (passthrough("order_items")(items), clean_orders(orders)):
        for side in split:
            filters = [line for line in side._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in line]
            assert filters and not any("RLIKE" in line or "gettimestamp" in line for line in filters)
    clean, rejected = passthrough("order_items")(items)
    assert [r.order_item_id for r in clean.collect()] == [1]
    assert sorted(r[REJECT_REASON] for r in rejected.collect()) == [
        "non_integer:order_item_id", "null_in_required:freight_value", "null_in_required:order_item_id", "null_in_required:price", "out_of_range:price"]
    assert clean.schema == passthrough("order_items")(items).flagged.select(clean.columns).schema
