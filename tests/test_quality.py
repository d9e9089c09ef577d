import datetime as dt

from pyspark.sql import functions as F

from parcelscope.operators import quality as Q

BASE = dt.datetime(2018, 1, 1, 12, 0, 0)


def test_gap_buckets_count_3600_twice(spark):
    gaps = [299, 300, 3600, 3601, 86400, 86401]
    rows = [(f"o{i}", "delivered", BASE, BASE + dt.timedelta(seconds=g), BASE, None) for i, g in enumerate(gaps)]
    df = spark.createDataFrame(rows, "order_id string, order_status string, order_purchase_timestamp timestamp, "
                                     "order_approved_at timestamp, order_delivered_carrier_date timestamp, "
                                     "order_delivered_customer_date timestamp")
    b = Q.violation_gap_buckets(df).first()
    assert (b.total, b.under_5_min, b.from_5_min_to_1_hour, b.from_1_hour_to_1_day, b.over_1_day) == (6, 1, 2, 3, 1)
    s = Q.violation_gap_stats(df).first()
    assert (s.min_seconds, s.max_seconds) == (299, 86401)
    v = Q.order_violations(df).first()
    assert (v.approved_before_purchase, v.carrier_before_approved, v.customer_before_carrier) == (0, 6, 0)
    assert [(r.order_status, r["count"]) for r in Q.violations_by_status(df).collect()] == [("delivered", 6)]


def test_null_profile_and_ranking(spark):
    df = spark.createDataFrame([("a", None, ""), ("b", 1, "x"), (None, None, "y"), ("d", 4, "")],
                               "k string, n int, t string")
    prof = {r.column_name: (r.null_count, r.null_pct) for r in Q.profile_nulls(Q.empty_as_null(df), "t").collect()}
    assert prof == {"k": (1, 25.0), "n": (2, 50.0), "t": (2, 50.0)}
    ranked = [r.column_name for r in Q.profile_nulls_ranked(Q.profile_nulls(df, "t")).collect()]
    assert ranked == ["k", "n"]


def test_value_counts_keep_null(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), (None, None)], "c string, d double")
    got = {(r.column_name, r.value): r["count"] for r in Q.value_counts(df, ["c", "d"]).collect()}
    assert got == {("c", "a"): 2, ("c", None): 1, ("d", "1.0"): 1, ("d", None): 2}


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (1, "x"), (2, None), (2, None), (3, "z")], "a int, b string")
    c = Q.duplicate_census({"t": df}).first()
    assert (c.total_rows, c.distinct_rows, c.duplicate_rows) == (6, 3, 3)
    g = [(r.a, r.b, r["count"]) for r in Q.duplicate_groups(df).collect()]
    assert g == [(1, "x", 3), (2, None, 2)]


def test_check_rules_single_pass(spark):
    df = spark.createDataFrame([(10.0, 1.0), (0.0, 1.0), (5.0, -1.0), (None, 2.0)], "price double, freight double")
    rules = {"price": F.col("price") <= 0, "freight": F.col("freight") < 0,
             "either": (F.col("price") <= 0) | (F.col("freight") < 0)}
    got = {r.rule: r.violations for r in Q.check_rules(df, rules, "items").collect()}
    assert got == {"price": 1, "freight": 1, "either": 2}
    assert Q.violations(df, rules).count() == 2


def test_lengths_distributions_and_items(spark):
    df = spark.createDataFrame([("1234", "SP"), ("12345", "SP"), ("01234", "RJ")], "zip string, st string")
    r = Q.profile_length(df, ["zip"], "c").first()
    assert (r.min_length, r.max_length) == (4, 5)
    assert [(x.st, x["count"]) for x in Q.distribution(df, "st").collect()] == [("SP", 2), ("RJ", 1)]
    assert [x.st for x in Q.distribution(df, "st", top_n=1).collect()] == ["SP"]
    items = spark.createDataFrame([("a",), ("a",), ("b",)], "order_id string")
    i = Q.items_per_order(items).first()
    assert (i.min_items, i.max_items, i.avg_items) == (1, 2, 1.5)
    assert [x[0] for x in Q.distinct_values(df, "st").collect()] == ["RJ", "SP"]


def test_missing_metadata(spark):
    prods = spark.createDataFrame([("p1", None), ("p2", "x")], "product_id string, product_category_name string")
    items = spark.createDataFrame([("p1",), ("p1",), ("p2",), ("p3",)], "product_id string")
    assert Q.missing_impact(items, prods, "product_id", "product_category_name").first().fact_rows == 2
    assert [r.product_id for r in Q.missing_rows(prods, "product_category_name").collect()] == ["p1"]


def test_profile_tables(spark):
    a = spark.createDataFrame([(1,), (2,)], "x int")
    b = spark.createDataFrame([(1, 2)], "x int, y int")
    got = {r.table_name: (r.n_rows, r.n_cols) for r in Q.profile_tables({"a": a, "b": b}).collect()}
    assert got == {"a": (2, 1), "b": (1, 2)}
    assert Q.profile_schema(b, "b") == [("b", 1, "x", "int"), ("b", 2, "y", "int")]
