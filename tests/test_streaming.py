import os

from parcelscope.schema import raw_schema
from parcelscope.sources import zones
from parcelscope.streaming.ingest import ingest_new_files


def _write_csv(path, rows, cols):
    with open(path, "w") as f:
        f.write(",".join(cols) + "\n")
        for r in rows:
            f.write(",".join(f'"{v}"' for v in r) + "\n")


def test_daily_ingest_is_incremental_and_exactly_once(spark, tmpdir_path):
    landing = os.path.join(tmpdir_path, "landing")
    lake = os.path.join(tmpdir_path, "lake")
    os.makedirs(landing)
    cols = [f.name for f in raw_schema("sellers").fields]
    _write_csv(os.path.join(landing, "sellers_day1.csv"), [("s1", "1234", "a", "SP"), ("s2", "", "b", "RJ")], cols)
    assert ingest_new_files(spark, landing, lake, ["sellers"]) == {"sellers": 2}
    # nothing new: nothing appended
    assert ingest_new_files(spark, landing, lake, ["sellers"]) == {"sellers": 0}
    _write_csv(os.path.join(landing, "sellers_day2.csv"), [("s3", "99", "c", "MG")], cols)
    assert ingest_new_files(spark, landing, lake, ["sellers"]) == {"sellers": 1}
    raw = zones.read_zone(spark, lake, zones.STREAM, "sellers")
    got = sorted((r.seller_id, r.seller_zip_code_prefix) for r in raw.collect())
    assert got == [("s1", "1234"), ("s2", ""), ("s3", "99")]
    # the ingested raw zone feeds the batch transform as usual
    log = dict((t, (b, a, r)) for t, b, a, r in zones.transform(spark, lake, ["sellers"], zone=zones.STREAM))
    assert log["sellers"] == (3, 3, 0)
    clean = zones.read_zone(spark, lake, zones.CLEAN, "sellers")
    assert sorted(r.seller_zip_code_prefix for r in clean.collect()) == ["00000", "00099", "01234"]


def test_every_batch_is_counted_and_batch_runs_leave_the_stream_alone(spark, tmpdir_path):
    from parcelscope.streaming import ingest
    landing, lake, src = (os.path.join(tmpdir_path, x) for x in ("landing", "lake", "src"))
    os.makedirs(landing), os.makedirs(src)
    cols = [f.name for f in raw_schema("sellers").fields]
    for i in range(110):
        _write_csv(os.path.join(landing, f"sellers_{i:03d}.csv"), [(f"s{i}", "1", "a", "SP")], cols)
    q = (ingest.landing_stream(spark, landing, "sellers", max_files=1).writeStream.format("parquet")
         .option("path", os.path.join(lake, zones.STREAM, "sellers"))
         .option("checkpointLocation", ingest.stream_checkpoint(spark, lake, "sellers")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert zones.stored_rows(spark, lake, zones.STREAM, "sellers") == 110
    _write_csv(os.path.join(src, "sellers.csv"), [("b1", "1", "a", "SP")], cols)
    zones.run_daily(spark, src, lake)
    _write_csv(os.path.join(landing, "sellers_new.csv"), [("n1", "1", "a", "SP")], cols)
    assert ingest_new_files(spark, landing, lake, ["sellers"]) == {"sellers": 1}
    assert zones.stored_rows(spark, lake, zones.STREAM, "sellers") == 111
    assert zones.read_zone(spark, lake, zones.RAW, "sellers").count() == 1


def test_a_table_absent_today_is_emptied(spark, tmpdir_path):
    src, lake, empty = (os.path.join(tmpdir_path, x) for x in ("src", "lake", "none"))
    os.makedirs(src), os.makedirs(empty)
    cols = [f.name for f in raw_schema("sellers").fields]
    _write_csv(os.path.join(src, "sellers.csv"), [("b1", "1", "a", "SP")], cols)
    assert [r.rows_after for r in zones.run_daily(spark, src, lake).collect()] == [1]
    assert [(r.table_name, r.rows_after) for r in zones.run_daily(spark, empty, lake).collect()] == [("sellers", 0)]
    assert zones.stored_rows(spark, lake, zones.WAREHOUSE, "sellers") == 0
