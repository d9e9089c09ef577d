"""The row with the next smaller key, over frequent keys and rows without one."""

import random

from pyspark.sql import functions as F

from parcelscope.llm import order_minhash as M


def _check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, codes string").repartition(5)
    got = M.with_next(df, ["text", "codes"]).withColumn("tie", F.xxhash64("text")).collect()
    assert len(got) == len(rows)
    order = sorted(got, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.tie), reverse=True)
    for r, nxt in zip(order, [*order[1:], order[0]]):
        assert (r.next_text, r.next_codes) == (nxt.text, nxt.codes), r


def test_next_rows_with_frequent_and_missing_keys(spark):
    rng = random.Random(4)
    _check(spark, [(i, f"t{i}", f"c{i}") for i in range(500)])
    _check(spark, [(rng.choice((None, 7, 7, 9, rng.randint(-50, 300))), f"t{i}", f"c{i}") for i in range(900)])
    _check(spark, [(None, f"t{i}", f"c{i}") for i in range(300)])
    _check(spark, [(3, f"t{i}", f"c{i}") for i in range(300)] + [(1 << 62, "big", "b"), (-5, "low", "l")])
    _check(spark, [(1, "only", "o")])
    assert M.with_next(spark.createDataFrame([], "doc_id long, text string, codes string"), ["text", "codes"]).count() == 0


def test_rows_without_a_key_are_dealt_to_many_tasks(spark):
    df = spark.createDataFrame([(None, f"t{i}", "c") for i in range(2000)], "doc_id long, text string, codes string")
    plan = M.with_next(df, ["text", "codes"])
    parts = plan.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = M.with_next(df, ["text", "codes"]).select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(parts) == 8 and max(r["count"] for r in parts) < 4 * 2000 / 8


def test_places_of_very_long_texts_keep_their_order(spark):
    """Words beyond 2**20 stand after those before them: a text and its halves exchanged differ."""
    n = (1 << 20) + 2000
    df = spark.range(1).select(F.lit(1).alias("doc_id"), F.array_join(F.transform(F.sequence(F.lit(0), F.lit(n)), lambda i: F.hex(i)), " ").alias("text"))
    a = M.fingerprints(df).first()
    assert len(a.codes) == M.BINS and M.EMPTY not in a.codes
    tail = df.select("doc_id", F.array_join(F.concat(F.slice(F.split("text", " "), n // 2, n), F.slice(F.split("text", " "), 1, n // 2 - 1)), " ").alias("text"))
    b = M.fingerprints(tail).first()
    same = sum(x == y for x, y in zip(a.codes, b.codes))
    assert 0.3 * M.BINS < same < 0.8 * M.BINS  # pairs across the cut change places, about half of them
