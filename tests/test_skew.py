"""Hot keys: one order, seller, customer and product each hold a third of the rows.

Results of the Spark plans (pre-aggregated, skew-safe) must equal the plain
SQL statements run by DuckDB over the same rows.
"""

import datetime as dt
import math

import duckdb
import pandas as pd
import pytest

from parcelscope.plans import metrics as M
from parcelscope.plans.oracle import metric_sql
from parcelscope.schema import SCHEMAS

N_ORDERS = 240
BASE = dt.datetime(2018, 1, 1, 8, 0, 0)


def _fixture():
    orders, items, reviews = [], [], []
    for i in range(N_ORDERS):
        purchase = BASE + dt.timedelta(days=i % 200, hours=i % 24, minutes=i % 60)
        approved = None if i % 17 == 0 else purchase + dt.timedelta(hours=1 + i % 30)
        carrier = None if i % 19 == 0 else purchase + dt.timedelta(hours=30 + i % 90)
        customer = None if i % 23 == 0 else purchase + dt.timedelta(hours=100 + (i * 37) % 400)
        estimated = None if i % 29 == 0 else purchase + dt.timedelta(days=10 + i % 9)
        cust = "c0" if i % 3 == 0 else f"c{i % 40}"                       # hot customer
        orders.append((f"o{i}", cust, "delivered" if i % 7 else "shipped", purchase, approved, carrier,
                       customer, estimated))
        n_items = 1 + i % 3
        for j in range(n_items):
            seller = "s0" if (i + j) % 3 == 0 else f"s{(i + j) % 11}"      # hot seller
            product = "p0" if (i * 7 + j) % 3 == 0 else f"p{(i + j) % 25}"  # hot product
            items.append((f"o{i}", j + 1, product, seller, None, 10.0 + j, 0.25 * (1 + (i + j) % 8)))
        reviews.append((f"r{i}", f"o{i}", 1 + i % 5, "", "", None, None))
    hot_items = len(items) // 2                                          # hot order: a third of all items
    for j in range(hot_items):
        items.append(("o1", 100 + j, f"p{j % 25}", f"s{j % 11}", None, 5.0, 0.25 * (1 + j % 8)))
    for j in range(N_ORDERS // 2):
        reviews.append((f"rh{j}", "o1", 1 + j % 5, "", "", None, None))  # hot order in reviews too
    customers = [(f"c{k}", f"u{k}", f"{k:05d}", "x", f"S{k % 6}") for k in range(40)]
    products = [(f"p{k}", "" if k % 9 == 0 else f"cat{k % 5}", None, None, None,
                 None if k % 8 == 0 else 300.0 * k, None, None, None) for k in range(25)]
    names = [(f"cat{k}", f"category_{k}") for k in range(4)]
    return {"orders": orders, "order_items": items, "customers": customers, "products": products,
            "category_translation": names, "order_reviews": reviews}


@pytest.fixture(scope="module")
def both(spark):
    rows = _fixture()
    frames = {n: pd.DataFrame(r, columns=[f.name for f in SCHEMAS[n].fields]) for n, r in rows.items()}
    tables = {n: spark.createDataFrame(r, SCHEMAS[n]) for n, r in rows.items()}
    con = duckdb.connect()
    alias = {"order_items": "items", "customers": "cust", "products": "prod", "category_translation": "ct",
             "order_reviews": "rev"}
    for n, pdf in frames.items():
        con.register(f"t_{n}", pdf)
        con.execute(f"CREATE VIEW {alias.get(n, n)} AS SELECT * FROM t_{n}")
    con.execute("CREATE VIEW dlv AS SELECT * FROM orders WHERE order_status = 'delivered'")
    return tables, con


SQL = metric_sql("2018-03-01", 5, 5, 5, 5, (1, 1))
PARAMS = {"q2a_monthly_delivery": {"since": "2018-03-01"}, "q2b_monthly_on_time": {"since": "2018-03-01"},
          "q2d_monthly_on_time": {"since": "2018-03-01"}}
for _k in ("q5a_state_delivery", "q5b_state_late_rate", "q5c_state_freight", "q6a_seller_late_rate",
           "q6b_seller_processing", "q6c_seller_scatter", "q7a_category_delivery", "q7c_category_late_rate"):
    PARAMS[_k] = {"min_rows": 5}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, (dt.datetime, dt.date, pd.Timestamp)):
        return str(v)[:19]
    return repr(v)


@pytest.mark.parametrize("key", sorted(M.QUERIES))
def test_hot_keys_match_plain_sql(both, key):
    tables, con = both
    sdf = M.QUERIES[key](tables, **PARAMS.get(key, {}))
    sql = SQL[key].strip()
    if sql.startswith(","):
        sql = "WITH _unused AS (SELECT 1)" + sql
    cur = con.execute(sql)
    dcols = [c[0] for c in cur.description]
    assert sorted(dcols) == sorted(sdf.columns)
    order = [dcols.index(c) for c in sdf.columns]
    a = sorted(tuple(_norm(x) for x in r) for r in sdf.collect())
    b = sorted(tuple(_norm(r[i]) for i in order) for r in cur.fetchall())
    assert a == b
    assert len(a) > 0
