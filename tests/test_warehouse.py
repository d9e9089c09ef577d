"""The warehouse: replaced as a whole, emptied tables included; malformed lines; files of disjoint key ranges."""

import os

import pyarrow.parquet as pq
import pytest

from parcelscope.schema import SCHEMAS, raw_schema
from parcelscope.sources import zones

ORDER = ("o1", "c1", "delivered", "2018-01-01 10:00:00", "2018-01-01 11:00:00", "2018-01-02 10:00:00", "2018-01-05 10:00:00",
         "2018-01-09 00:00:00")


def _csv(folder, name, rows, tail=""):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, f"{name}.csv"), "w") as f:
        f.write(",".join(raw_schema(name).names) + "\n")
        for r in rows:
            f.write(",".join(f'"{v}"' for v in r) + "\n")
        f.write(tail)


def _day(root, day, **tables):
    folder = os.path.join(root, day)
    os.makedirs(folder, exist_ok=True)
    for name, rows in tables.items():
        _csv(folder, name, rows)
    return folder


def _rows(spark, lake, name):
    return sorted(tuple(r)[0] for r in zones.read_zone(spark, lake, zones.WAREHOUSE, name).collect())


@pytest.mark.parametrize("buckets", [None, 2])
def test_a_day_without_orders_empties_them(spark, tmpdir_path, buckets):
    lake = os.path.join(tmpdir_path, "lake")
    seller = ("s1", "1", "a", "SP")
    zones.run_daily(spark, _day(tmpdir_path, "d1", orders=[ORDER], sellers=[seller]), lake, buckets=buckets)
    assert _rows(spark, lake, "orders") == ["o1"]
    audit = zones.run_daily(spark, _day(tmpdir_path, "d2", sellers=[seller]), lake, buckets=buckets)
    assert {r.table_name: r.rows_after for r in audit.collect()} == {"orders": 0, "sellers": 1}
    assert _rows(spark, lake, "orders") == [] and _rows(spark, lake, "sellers") == ["s1"]
    zones.run_daily(spark, _day(tmpdir_path, "d3", orders=[ORDER, ("o2", *ORDER[1:])]), lake, buckets=buckets)
    assert _rows(spark, lake, "orders") == ["o1", "o2"] and _rows(spark, lake, "sellers") == []
    history = zones.audit_history(spark, lake).filter("table_name = 'orders'").orderBy("run_at").collect()
    assert [r.rows_after for r in history] == [1, 0, 2]


def test_a_failed_load_leaves_the_last_one_whole(spark, tmpdir_path, monkeypatch):
    lake = os.path.join(tmpdir_path, "lake")
    s1, s2 = ("s1", "1", "a", "SP"), ("s2", "1", "a", "SP")
    zones.run_daily(spark, _day(tmpdir_path, "d1", orders=[ORDER], sellers=[s1]), lake)
    real = zones.clustered

    def fails_on_sellers(df, name):
        if name == "sellers" and "seller_id" in df.columns and loading:
            raise OSError("disk full")
        return real(df, name)

    loading = False
    zones.extract(spark, _day(tmpdir_path, "d2", orders=[("o9", *ORDER[1:])], sellers=[s2]), lake)
    zones.transform(spark, lake, ["orders", "sellers"])
    loading = True
    monkeypatch.setattr(zones, "clustered", fails_on_sellers)
    with pytest.raises(OSError):
        zones.load_tables(spark, lake, ["orders", "sellers"])
    assert _rows(spark, lake, "orders") == ["o1"] and _rows(spark, lake, "sellers") == ["s1"]
    monkeypatch.undo()
    assert zones.load_tables(spark, lake, ["orders", "sellers", "mql"]) == {"orders": 1, "sellers": 1, "mql": None}
    assert _rows(spark, lake, "orders") == ["o9"] and _rows(spark, lake, "sellers") == ["s2"] and _rows(spark, lake, "mql") == []


def test_old_versions_go_and_other_tables_are_carried_over(spark, tmpdir_path):
    lake = os.path.join(tmpdir_path, "lake")
    folder = _day(tmpdir_path, "d1", orders=[ORDER], sellers=[("s1", "1", "a", "SP")])
    zones.run_daily(spark, folder, lake)
    for _ in range(3):
        zones.load_tables(spark, lake, ["orders"])
    assert zones.warehouse_versions(spark, lake) == [1, 2, 3, 4]
    assert _rows(spark, lake, "orders") == ["o1"] and _rows(spark, lake, "sellers") == ["s1"]
    root = os.path.join(lake, zones.WAREHOUSE)
    assert [v for v in sorted(os.listdir(root)) if os.path.exists(os.path.join(root, v, "orders"))] == ["version=000003", "version=000004"]


def test_lines_with_too_few_or_too_many_fields_are_quarantined(spark, tmpdir_path):
    lake, folder = os.path.join(tmpdir_path, "lake"), os.path.join(tmpdir_path, "d1")
    _csv(folder, "sellers", [("s1", "1", "a\nb", "SP"), ("s2", "", "", "")], tail='s3,2,c\ns4,3,d,RJ,extra\ns5,4,e,MG\n')
    _csv(folder, "orders", [ORDER], tail="o2,c1\n")
    audit = {r.table_name: r for r in zones.run_daily(spark, folder, lake).collect()}
    s = audit["sellers"]
    assert (s.rows_before, s.rows_after, s.rows_rejected, s.rows_duplicate) == (5, 3, 2, 0)
    assert (audit["orders"].rows_before, audit["orders"].rows_rejected) == (2, 1)
    lines = zones.read_zone(spark, lake, zones.REJECTED, zones.lines_table("sellers")).collect()
    assert sorted((r.line.strip(), r.reject_reason) for r in lines) == [("s3,2,c", "malformed_line"), ("s4,3,d,RJ,extra", "malformed_line")]
    assert _rows(spark, lake, "sellers") == ["s1", "s2", "s5"]
    assert not os.path.exists(os.path.join(lake, zones.STAGED, "sellers"))
    # a run without such lines leaves none in the quarantine
    zones.run_daily(spark, _day(tmpdir_path, "d2", sellers=[("s1", "1", "a", "SP")]), lake)
    assert zones.read_zone(spark, lake, zones.REJECTED, zones.lines_table("sellers")).count() == 0


def _ranges(path, column):
    """[min, max] of a column in every file, from the Parquet footers."""
    out = []
    for f in sorted(os.listdir(path)):
        if f.endswith(".parquet"):
            meta = pq.ParquetFile(os.path.join(path, f)).metadata
            at = meta.schema.names.index(column)
            stats = [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
            if stats:
                out.append((min(s.min for s in stats), max(s.max for s in stats)))
    return out


def test_files_have_disjoint_key_ranges_and_hot_keys_are_split(spark, tmpdir_path):
    lake = os.path.join(tmpdir_path, "lake")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        payments = spark.range(20000).selectExpr("CAST(id % 5000 AS STRING) AS order_id", "CAST(id AS INT) AS payment_sequential", "'x' AS payment_type",
                                                 "1 AS payment_installments", "CAST(id AS DOUBLE) AS payment_value")
        zones.write_zone(payments, os.path.join(lake, zones.CLEAN, "order_payments"), "order_payments")
        geo = spark.range(30000).selectExpr("CASE WHEN id % 3 = 0 THEN '00007' ELSE lpad(CAST(id % 900 AS STRING), 5, '0') END AS geolocation_zip_code_prefix",
                                            "CAST(id AS DOUBLE) AS geolocation_lat", "0D AS geolocation_lng", "'' AS geolocation_city", "'' AS geolocation_state")
        zones.write_zone(geo, os.path.join(lake, zones.CLEAN, "geolocation"), "geolocation")
        zones.load_tables(spark, lake, ["order_payments", "geolocation"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for zone_path in (os.path.join(lake, zones.CLEAN, "order_payments"), os.path.join(zones._version_path(lake, 1), "order_payments")):
        ranges = _ranges(zone_path, "order_id")
        assert len(ranges) > 4
        for key in ("0", "1234", "4999", "777"):  # a point filter needs the row groups of one file (two at a border)
            assert sum(lo <= key <= hi for lo, hi in ranges) <= 2
        assert sum(sum(lo <= k <= hi for lo, hi in ranges) == 1 for k in map(str, range(5000))) >= 5000 - len(ranges)
    ranges = _ranges(os.path.join(zones._version_path(lake, 1), "geolocation"), "geolocation_zip_code_prefix")
    assert sum(lo <= "00007" <= hi for lo, hi in ranges) >= 2  # the hot zip code is in several files
    assert sum(lo <= "00500" <= hi for lo, hi in ranges) == 1
    files = [pq.ParquetFile(os.path.join(zones._version_path(lake, 1), "geolocation", f)).metadata.num_rows
             for f in os.listdir(os.path.join(zones._version_path(lake, 1), "geolocation")) if f.endswith(".parquet")]
    assert max(files) < 2.5 * sorted(files)[len(files) // 2]


def test_amounts_that_are_not_finite_or_too_large_are_quarantined(spark):
    from parcelscope.operators.clean import TRANSFORMS
    cols = raw_schema("order_items").names
    values = ["1e400", "-1e400", "1e30", "1e17", "0.005", "NaN", "Infinity", ""]
    raw = spark.createDataFrame([("o1", str(i), "p", "s", "", "1.0", v) for i, v in enumerate(values)], cols)
    clean, rejected = TRANSFORMS["order_items"](raw)
    assert sorted(r.freight_value for r in clean.collect()) == [0.005, 1e17]
    reasons = {r.order_item_id: r.reject_reason for r in rejected.collect()}
    assert reasons.pop(2) == "out_of_range:freight_value" and set(reasons.values()) == {"null_in_required:freight_value"}
    typed = spark.createDataFrame([("o1", 1, "p", "s", None, 1.0, float("inf"))], SCHEMAS["order_items"])
    assert TRANSFORMS["order_items"](typed).rejected.count() == 1
