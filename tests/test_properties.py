"""Property tests: the boundary-counting time functions and zip padding on random inputs."""

import datetime as dt

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from parcelscope.functions.timefn import days_between, hours_between, zfill

EPOCH = dt.datetime(1970, 1, 1)
stamps = st.datetimes(min_value=dt.datetime(1990, 1, 1), max_value=dt.datetime(2030, 12, 31)).map(
    lambda t: t.replace(microsecond=0))


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(stamps, stamps), min_size=1, max_size=200))
def test_boundaries_match_python_and_duckdb(spark, pairs):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a timestamp, b timestamp")
    got = {r.i: (r.h, r.d) for r in df.select("i", hours_between("a", "b").alias("h"),
                                              days_between("a", "b").alias("d")).collect()}
    con = duckdb.connect()
    for i, (a, b) in enumerate(pairs):
        secs_a, secs_b = int((a - EPOCH).total_seconds()), int((b - EPOCH).total_seconds())
        want_h = secs_b // 3600 - secs_a // 3600
        want_d = (b.date() - a.date()).days
        assert got[i] == (want_h, want_d), (a, b)
        duck = con.execute("SELECT date_diff('hour', ?::TIMESTAMP, ?::TIMESTAMP), "
                           "date_diff('day', ?::TIMESTAMP, ?::TIMESTAMP)", [a, b, a, b]).fetchone()
        assert tuple(duck) == (want_h, want_d), (a, b)


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="0123456789", max_size=8), min_size=1, max_size=100))
def test_zfill_matches_python(spark, zips):
    df = spark.createDataFrame([(i, z) for i, z in enumerate(zips)], "i int, z string")
    got = {r.i: r.p for r in df.select("i", zfill("z").alias("p")).collect()}
    assert got == {i: z.zfill(5) for i, z in enumerate(zips)}


def _py_reason(approved, carrier, customer):
    cf = approved is not None and carrier is not None and carrier < approved
    cu = carrier is not None and customer is not None and customer < carrier
    if cf and cu:
        return "carrier_before_approved AND customer_before_carrier"
    if cu:
        return "customer_before_carrier"
    if cf:
        return "carrier_before_approved"
    return None


texts = st.one_of(stamps.map(lambda t: t.strftime("%Y-%m-%d %H:%M:%S")), st.just(""), st.just("n/a"),
                  stamps.map(lambda t: t.strftime("%Y-%m-%d")))


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(texts, texts, texts), min_size=1, max_size=150))
def test_order_quarantine_rule(spark, rows):
    from parcelscope.operators.clean import clean_orders
    from parcelscope.schema import REJECT_REASON, raw_schema

    def parse(s):
        try:
            return dt.datetime.strptime(s, "%Y-%m-%d %H:%M:%S")
        except ValueError:
            return None

    raw = spark.createDataFrame([(f"o{i}", "c", "delivered", "2000-01-01 00:00:00", a, c, u, "")
                                 for i, (a, c, u) in enumerate(rows)], raw_schema("orders"))
    clean, rejected = clean_orders(raw)
    want = {f"o{i}": _py_reason(parse(a), parse(c), parse(u)) for i, (a, c, u) in enumerate(rows)}
    got = {r.order_id: r[REJECT_REASON] for r in rejected.collect()}
    got.update({r.order_id: None for r in clean.collect()})
    assert got == want


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(-40, 60), st.one_of(st.none(), st.floats(0, 10000, allow_nan=False))),
                min_size=1, max_size=150))
def test_buckets_match_python(spark, rows):
    from pyspark.sql import functions as F

    from parcelscope.plans.metrics import day_bucket, weight_bucket

    def py_day(d):
        for edge, label in [(5, "0-5 Days"), (10, "6-10 Days"), (15, "11-15 Days"), (20, "16-20 Days"),
                            (25, "21-25 Days")]:
            if d <= edge:
                return label
        return ">25 Days"

    def py_weight(w):
        if w is not None:
            for edge, label in [(500, "< 0.5 kg"), (1000, "0.5 - 1 kg"), (5000, "1 - 5 kg")]:
                if w < edge:
                    return label
        return "> 5 kg"

    df = spark.createDataFrame([(i, d, w) for i, (d, w) in enumerate(rows)], "i int, d int, w double")
    got = {r.i: (r.db, r.wb) for r in df.select("i", day_bucket(F.col("d")).alias("db"),
                                                weight_bucket(F.col("w")).alias("wb")).collect()}
    assert got == {i: (py_day(d), py_weight(w)) for i, (d, w) in enumerate(rows)}
