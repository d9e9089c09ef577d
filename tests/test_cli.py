import os

from parcelscope.__main__ import main
from parcelscope.schema import raw_schema


def _csv(path, name, rows):
    cols = [f.name for f in raw_schema(name).fields]
    with open(os.path.join(path, f"{name}.csv"), "w") as f:
        f.write(",".join(cols) + "\n")
        for r in rows:
            f.write(",".join(f'"{v}"' for v in r) + "\n")


def test_daily_then_card(spark, tmpdir_path):
    src, lake, out = (os.path.join(tmpdir_path, x) for x in ("src", "lake", "out"))
    os.makedirs(src)
    _csv(src, "orders", [
        ("o1", "c1", "delivered", "2018-01-01 10:00:00", "2018-01-01 11:00:00", "2018-01-02 10:00:00",
         "2018-01-03 10:00:00", "2018-01-10 00:00:00"),
        ("o2", "c2", "delivered", "2018-01-01 10:00:00", "2018-01-01 11:00:00", "2018-01-01 09:00:00",
         "2018-01-03 10:00:00", "2018-01-10 00:00:00"),   # carrier before approval: quarantined
    ])
    _csv(src, "order_items", [("o1", "1", "p1", "s1", "", "10.0", "2.5"), ("o2", "1", "p1", "s1", "", "10.0", "4.0")])
    _csv(src, "customers", [("c1", "u1", "123", "x", "SP"), ("c2", "u2", "456", "y", "RJ")])
    assert main(["daily", "--source", src, "--lake", lake]) == 0
    assert main(["card", "--lake", lake, "q8a_state_delivery_freight", "--out", out]) == 0
    got = [(r.customer_state, r.avg_delivery_days, r.avg_freight_cost, r.total_orders)
           for r in spark.read.parquet(out).collect()]
    assert got == [("SP", 2.0, 2.5, 1)]


def test_ingest_then_cards_from_the_stream_and_the_stored_sums(spark, tmpdir_path):
    landing, lake, out = (os.path.join(tmpdir_path, x) for x in ("landing", "lake", "out"))
    os.makedirs(landing)
    _csv(landing, "orders", [
        (f"o{i}", "c1", "delivered", "2018-01-01 10:00:00", "2018-01-01 11:00:00", "2018-01-02 10:00:00",
         f"2018-01-{3 + i:02d} 10:00:00", "2018-01-04 00:00:00") for i in range(3)])
    _csv(landing, "customers", [("c1", "u1", "123", "x", "SP")])
    assert main(["ingest", "--landing", landing, "--lake", lake]) == 0
    for n, source in enumerate(("stream", "rollup")):
        assert main(["card", "--lake", lake, "q5a_state_delivery", "--source", source, "--param", "min_rows=1", "--out", f"{out}{n}"]) == 0
        assert [tuple(r) for r in spark.read.parquet(f"{out}{n}").collect()] == [("SP", 3.0, 3)]
