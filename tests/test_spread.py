"""Spread joins and hashed grouping: same results as the plain forms, and evenly loaded tasks."""

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from parcelscope.operators import quality as Q
from parcelscope.operators import spread
from parcelscope.plans import metrics as M
from parcelscope.plans.registry import lake_for
from parcelscope.schema import SCHEMAS, TABLES

from conftest import SF_SMALL
from test_skew import _fixture




@pytest.fixture(scope="module")
def tables(spark):
    return {n: spark.createDataFrame(r, SCHEMAS[n]) for n, r in _fixture().items()}


@pytest.fixture()
def no_help(spark):
    """Neither broadcast joins of data nor adaptive execution."""
    for k, v in (("spark.sql.adaptive.enabled", "false"), ("spark.sql.autoBroadcastJoinThreshold", "-1")):
        spark.conf.set(k, v)
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _task_rows(df):
    """Rows that every task of the last stage gives."""
    def count(batches):
        import pyarrow as pa
        n = sum(b.num_rows for b in batches)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()]), pa.array([n])], ["task", "n"])
    return sorted(r.n for r in df.mapInArrow(count, "task long, n long").collect())


def test_a_hot_order_is_spread_without_adaptive_execution(spark, no_help):
    """A third of the rows are one order's: its task stays within four times the median."""
    items = spark.range(60000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS STRING) END AS order_id", "id AS n")
    orders = spark.range(60000).selectExpr("CASE WHEN id = 0 THEN 'hot' ELSE CAST(id AS STRING) END AS order_id", "id AS o")
    plain = _task_rows(items.join(orders, "order_id"))
    even = spread.spread_join(items, orders, "order_id", "n", salts=64, sample=0.05, least=8)
    rows = _task_rows(even)
    assert plain[-1] > 4 * plain[len(plain) // 2] and rows[-1] <= 4 * rows[len(rows) // 2]
    assert sum(rows) == sum(plain) and even.columns == items.join(orders, "order_id").columns
    assert even.agg(F.sum("n"), F.sum("o")).first() == items.join(orders, "order_id").agg(F.sum("n"), F.sum("o")).first()


@pytest.mark.parametrize("card", ["q3b_review_rows", "q7a_category_delivery", "q7b_weight_delivery", "q7c_category_late_rate"])
def test_cards_are_the_same_when_spread(spark, tables, card, monkeypatch):
    monkeypatch.setattr(spread, "heavy_keys", lambda facts, key, *_: _all_heavy(facts, key))
    params = {"min_rows": 5} if card[:3] in ("q7a", "q7c") else {}
    plain = M.QUERIES[card](tables, **params)
    even = M.QUERIES[card](tables, **params, salts=7)
    assert even.columns == plain.columns
    assert sorted(map(str, even.collect())) == sorted(map(str, plain.collect()))


def _all_heavy(facts, key):
    """The keys of more than one row."""
    return facts.groupBy(key).count().filter("count > 1").select(F.col(key).alias("_heavy"))


def test_null_keys_and_small_facts(spark):
    facts = spark.createDataFrame([(None, 1), ("a", 2), ("a", 3), ("b", 4)], "k string, v int")
    dim = spark.createDataFrame([(None, 9), ("a", 8), ("a", 7)], "k string, w int")
    want = sorted(map(str, facts.join(dim, "k").collect()))
    assert sorted(map(str, spread.spread_join(facts, dim, "k", "v", salts=5, sample=1.0, least=1).collect())) == want
    assert sorted(map(str, spread.spread_join(facts, dim, "k", "v").collect())) == want  # small: joined as they are
    assert spread.planned_bytes(spark.range(10)) < spread.SPREAD_BYTES


def _census(tables):
    return {r.table_name: tuple(r) for r in Q.duplicate_census(tables).collect()}


def test_duplicates_are_the_same_with_clashing_hashes(spark, monkeypatch):
    lake = lake_for(spark, SF_SMALL, text=True)
    tables = {n: lake.typed(n) for n in TABLES if n in ("geolocation", "orders", "mql", "order_payments")}
    plain = {n: (n, df.count(), df.distinct().count()) for n, df in tables.items()}
    plain = {n: (*v, v[1] - v[2]) for n, v in plain.items()}
    top = [tuple(r) for r in Q.duplicate_groups(tables["geolocation"]).collect()]
    cols = tables["geolocation"].columns
    want = (tables["geolocation"].groupBy(*cols).count().filter("count > 1")
            .orderBy(F.desc("count"), *[F.col(c).asc_nulls_first() for c in cols]).limit(20))
    assert _census(tables) == plain and top == [tuple(r) for r in want.collect()]
    for clash in (lambda df: F.lit(1).cast("long"), lambda df: F.xxhash64(df.columns[0]) % 3):
        monkeypatch.setattr(Q, "row_groups", lambda df, count, h=clash: spread.row_groups(df, count, h))
        assert _census(tables) == plain and [tuple(r) for r in Q.duplicate_groups(tables["geolocation"]).collect()] == top


def test_duplicates_of_odd_values(spark):
    rows = [(None, 1.0), (None, 1.0), ("", -0.0), ("", 0.0), ("x", float("nan")), ("x", float("nan")), ("y", None)]
    df = spark.createDataFrame(rows, "a string, b double")
    assert _census({"t": df}) == {"t": ("t", 7, 4, 3)}
    assert _census({"t": df.filter("false")}) == {"t": ("t", 0, 0, 0)}


def test_only_rows_that_may_repeat_are_moved(spark):
    """Rows of a hash of their own reach no exchange, and no repeated hash is missed."""
    df = spark.range(20000).selectExpr("id AS a", "concat('text ', id) AS b")
    df = df.unionByName(df.filter("a % 100 = 7"))
    groups, by_hash = spread.row_groups(df, "n")
    assert "SortMergeJoin" not in groups._jdf.queryExecution().executedPlan().toString()
    assert by_hash.filter("_n > 1 AND NOT _marked").isEmpty() and by_hash.filter("_n > 1").count() == 200
    assert by_hash.filter("_n = 1 AND _marked").count() < 20  # share a bit of 2^27 with a repeated one
    assert groups.filter("n = 2").count() == 200 and groups.count() == by_hash.filter("_marked").count()
    assert _census({"t": df}) == {"t": ("t", 20200, 20000, 200)}
