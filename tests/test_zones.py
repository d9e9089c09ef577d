import os

import pytest
from pyspark.sql import functions as F

from parcelscope.operators.clean import TRANSFORMS, clean_tables
from parcelscope.plans.registry import ntz
from parcelscope.schema import TABLES
from parcelscope.sources import zones
from parcelscope.sources.adapter import raw_tables

from conftest import SF_SMALL


def test_csv_edge_cases(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "sellers.csv")
    with open(path, "w") as f:
        f.write('seller_city,seller_id,seller_zip_code_prefix,seller_state\n')
        f.write('"sao\npaulo",s1,01234,SP\n')           # quoted newline; columns out of schema order
        f.write('"say ""hi""",s2,NA,\n')               # doubled quote, literal NA, empty field
        f.write('"",s3,1234,""\n')                     # quoted empties
    df = zones.read_raw_csv(spark, path, "sellers")
    assert df.columns == ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"]
    got = {r.seller_id: r for r in df.collect()}
    assert got["s1"].seller_city == "sao\npaulo" and got["s1"].seller_zip_code_prefix == "01234"
    assert got["s2"].seller_city == 'say "hi"' and got["s2"].seller_zip_code_prefix == "NA"
    assert got["s2"].seller_state == "" and got["s3"].seller_city == "" and got["s3"].seller_state == ""
    assert not zones.source_exists(spark, os.path.join(tmpdir_path, "absent.csv"))
    assert zones.source_exists(spark, path)
    # the study's reader: inferred types, empty fields as NULL
    inferred = zones.read_inferred_csv(spark, path)
    assert dict(inferred.dtypes)["seller_id"] == "string"
    assert {r.seller_id: r.seller_state for r in inferred.collect()}["s2"] is None


def test_round_trip_csv_to_clean_zone(spark, tmpdir_path):
    """Adapter tables -> CSV files -> extract -> transform equals cleaning the adapter tables directly."""
    src = os.path.join(tmpdir_path, "src")
    lake = os.path.join(tmpdir_path, "lake")
    raw = raw_tables(spark, SF_SMALL)
    for name, df in raw.items():
        if name == "mql":
            continue  # an absent source is skipped, not fatal
        out = os.path.join(tmpdir_path, "csv_" + name)
        df.coalesce(1).write.mode("overwrite").option("header", True).option("quote", '"') \
            .option("escape", '"').option("emptyValue", '""').csv(out)
        part = [p for p in os.listdir(out) if p.endswith(".csv")][0]
        os.makedirs(src, exist_ok=True)
        os.rename(os.path.join(out, part), os.path.join(src, f"{name}.csv"))
    audit = zones.run_daily(spark, src, lake)
    rows = {r.table_name: r for r in audit.collect()}
    assert "mql" not in rows and set(rows) == set(TABLES) - {"mql"}
    expected = clean_tables({n: d for n, d in raw.items() if n != "mql"})
    for name, exp in expected.items():
        got = zones.read_zone(spark, lake, zones.CLEAN, name).select(exp.columns)
        e, g = ntz(exp), ntz(got)
        assert g.exceptAll(e).count() == 0 and e.exceptAll(g).count() == 0, name
        assert rows[name].rows_after == exp.count()
    wh = zones.read_zone(spark, lake, zones.WAREHOUSE, "orders")
    assert wh.count() == rows["orders"].rows_after
    # a second run replaces everything (idempotent)
    again = {r.table_name: r.rows_after for r in zones.run_daily(spark, src, lake).collect()}
    assert again == {k: v.rows_after for k, v in rows.items()}


def test_etl_audit_query(spark):
    from parcelscope.plans.registry import queries
    got = {r.table_name: r for r in queries()["etl_audit"](spark, SF_SMALL).collect()}
    o = got["orders"]
    assert o.rows_before == o.rows_after + o.rows_rejected
    g = got["geolocation"]
    assert g.rows_before > g.rows_after + g.rows_rejected  # duplicates dropped


def test_csv_without_a_column_is_refused(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "sellers.csv")
    with open(path, "w") as f:
        f.write("seller_id,seller_city\ns1,a\n")
    with pytest.raises(ValueError, match="seller_state"):
        zones.read_raw_csv(spark, path, "sellers")


def test_transform_reads_the_raw_zone_once(spark, tmpdir_path, monkeypatch):
    """Both zones are written from the staged rows; the counts are those of the cleaning step."""
    names = ["orders", "geolocation", "products"]
    raw = raw_tables(spark, SF_SMALL, names)
    for name, df in raw.items():
        zones.write_zone(df, os.path.join(tmpdir_path, zones.RAW, name))
    read, write = [], zones.write_zone

    def recorded(df, *args, **kwargs):
        read.extend(df.inputFiles())
        write(df, *args, **kwargs)

    monkeypatch.setattr(zones, "write_zone", recorded)
    log = zones.transform(spark, tmpdir_path, names)
    assert read and all(f"/{zones.STAGED}/" in f for f in read)
    for name, *counts in log:
        split = TRANSFORMS[name](raw[name])
        assert counts == [raw[name].count(), split.clean.count(), split.rejected.count()]
