"""Derive the eleven canonical raw tables from the driver's TPC-H-like tables.

The driver ships ``orders``, ``lineitem``, ``customer``, ``supplier``,
``part`` and ``nation`` but no delivery timestamps, so every canonical column
is derived from the keys by integer arithmetic that any SQL engine can repeat
exactly (``plans/oracle.py`` holds the same rules as DuckDB SQL).  Each table
is built typed (``typed_source``) and can be rendered as the *raw zone*
(``raw_table``: every column a string, missing values ``''``) so the cleaning
step parses text exactly as it would for CSV input.

Everything is a narrow projection over a single scan, apart from two joins with
the 25-row ``nation`` table (the planner broadcasts it), a distinct over
``part.p_brand`` and two unions (duplicate geolocation points, second reviews).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timefn import TS_FORMAT, ident
from ..schema import SCHEMAS, raw_schema

DRIVER_TABLES = ("orders", "lineitem", "customer", "supplier", "part", "nation")

# Fixed values used by the derivation rules (status codes, payment types, lead origins).
STATUS_MAP = {"F": "delivered", "O": "shipped", "P": "canceled"}
PAYMENT_TYPES = ["credit_card", "boleto", "voucher", "debit_card"]
ORIGINS = ["organic_search", "paid_search", "social", "email", "direct_traffic"]
SEGMENTS = ["home_decor", "health_beauty", "car_accessories", "computers"]
LEAD_TYPES = ["online_medium", "online_big", "industry"]
UNTRANSLATED_BRANDS = ["Brand#3", "Brand#7"]


# Declared schemas of the driver tables (as Spark reads them), so a read needs
# no footer inference.
DRIVER_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}


def read_driver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table, as many tasks as the scan has splits."""
    reader = spark.read
    if name in DRIVER_SCHEMAS:
        reader = reader.schema(DRIVER_SCHEMAS[name])
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def _pick(index: Column, values: list[str]) -> Column:
    out = F.lit(values[-1])
    for i in range(len(values) - 2, -1, -1):
        out = F.when(index == i, F.lit(values[i])).otherwise(out)
    return out


def to_raw_text(df: DataFrame, name: str, float_text: tuple[str, ...] = ()) -> DataFrame:
    """A typed canonical table as source text: every column a string, NULL as ``''``.

    Timestamps use the source layout; whole numbers listed in ``float_text`` are
    written the way a float column is exported (``'40.0'``).
    """
    cols = []
    for f in raw_schema(name).fields:
        q = ident(f.name)
        t = df.schema[f.name].dataType
        if isinstance(t, T.TimestampType):
            e = f"date_format({q}, '{TS_FORMAT}')"
        elif f.name in float_text:
            e = f"CAST(CAST({q} AS DOUBLE) AS STRING)"
        else:
            e = f"CAST({q} AS STRING)"
        cols.append(f"coalesce({e}, '') AS {q}")
    return df.selectExpr(*cols)


def _conform(df: DataFrame, name: str) -> DataFrame:
    """Typed canonical columns in schema order."""
    return df.selectExpr(*[f"CAST({ident(f.name)} AS {f.dataType.simpleString()}) AS {ident(f.name)}"
                           for f in SCHEMAS[name].fields])


def _timeline_sql(k: str = "o_orderkey", orderdate: str = "o_orderdate") -> dict[str, str]:
    """The five order timestamps as flat SQL expressions of the key and order date.

    Epoch seconds are composed as plain long arithmetic and turned into
    timestamps once, so the optimizer can inline them anywhere cheaply.
    """
    purchase = f"(unix_seconds(CAST({orderdate} AS TIMESTAMP)) + ({k} * 7919) % 86400)"
    approved = f"(CASE WHEN {k} % 101 <> 0 THEN {purchase} + 60 * (({k} * 31) % 4320) END)"
    carrier = (f"(CASE WHEN {k} % 97 <> 0 THEN coalesce({approved}, {purchase}) "
               f"+ 60 * (({k} * 137) % 14400 - 720) END)")
    customer = (f"(CASE WHEN {k} % 89 <> 0 THEN coalesce({carrier}, {purchase}) "
                f"+ 60 * (({k} * 53) % 36000 - 180) END)")
    estimated = f"(CASE WHEN {k} % 103 <> 0 THEN {purchase} + 86400 * (12 + {k} % 20) END)"
    secs = {"purchase": purchase, "approved": approved, "carrier": carrier, "customer": customer,
            "estimated": estimated}
    return {n: f"timestamp_seconds({v})" for n, v in secs.items()}


def orders_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed order timeline ``k, custkey, status, purchase .. estimated``."""
    o = read_driver(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    status = " ".join(f"WHEN '{code}' THEN '{word}'" for code, word in STATUS_MAP.items())
    return o.selectExpr("o_orderkey AS k", "o_custkey AS custkey", f"CASE o_orderstatus {status} ELSE '' END AS status",
                        *[f"{v} AS {n}" for n, v in _timeline_sql().items()])


def typed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = orders_timeline(spark, sf_dir)
    return _conform(t.select(
        F.col("k").alias("order_id"),
        F.col("custkey").alias("customer_id"),
        F.col("status").alias("order_status"),
        F.col("purchase").alias("order_purchase_timestamp"),
        F.col("approved").alias("order_approved_at"),
        F.col("carrier").alias("order_delivered_carrier_date"),
        F.col("customer").alias("order_delivered_customer_date"),
        F.col("estimated").alias("order_estimated_delivery_date"),
    ), "orders")


def typed_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_driver(spark, sf_dir, "lineitem")
    return _conform(li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_quantity") * 0.25).alias("freight_value"),
    ), "order_items")


def _nation_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_driver(spark, sf_dir, "nation").select("n_nationkey", "n_name")


def typed_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_driver(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    c = c.join(_nation_names(spark, sf_dir), c.c_nationkey == F.col("n_nationkey"), "left")
    ck = F.col("c_custkey")
    return _conform(c.select(
        ck.alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        (ck % 10000).alias("customer_zip_code_prefix"),
        F.concat(F.lit("city_"), (ck % 3).cast("string")).alias("customer_city"),
        F.coalesce(F.col("n_name"), F.lit("")).alias("customer_state"),
    ), "customers")


def typed_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_driver(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    s = s.join(_nation_names(spark, sf_dir), s.s_nationkey == F.col("n_nationkey"), "left")
    sk = F.col("s_suppkey")
    return _conform(s.select(
        sk.alias("seller_id"),
        (sk % 10000).alias("seller_zip_code_prefix"),
        F.concat(F.lit("city_"), (sk % 3).cast("string")).alias("seller_city"),
        F.coalesce(F.col("n_name"), F.lit("")).alias("seller_state"),
    ), "sellers")


def typed_geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One point per customer, plus an exact copy of every fourth one."""
    c = read_driver(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    ck = F.col("c_custkey")
    rows = c.select(
        (ck % 30).alias("geolocation_zip_code_prefix"),
        F.when(ck % 150 != 149, F.lit(-38) + ck % 50).alias("geolocation_lat"),
        (F.lit(-78) + ck % 75).alias("geolocation_lng"),
        F.concat(F.lit("city_"), (ck % 3).cast("string")).alias("geolocation_city"),
        F.col("c_nationkey").alias("geolocation_state"),
        ck.alias("_c"),
    )
    dup = rows.filter(F.col("_c") % 4 == 0)
    geo = rows.unionByName(dup).drop("_c")
    return geo.select([F.col(f.name).cast("double" if f.name in ("geolocation_lat", "geolocation_lng") else "string")
                       .alias(f.name) for f in raw_schema("geolocation").fields])


def typed_order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_driver(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    k = F.col("o_orderkey")
    purchase_s = F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + (k * 7919) % 86400

    def review(prefix: str, score: Column, offset_days: Column) -> list[Column]:
        created_s = purchase_s + F.lit(86400) * offset_days
        return [
            F.concat(F.lit(prefix), k.cast("string")).alias("review_id"),
            k.cast("string").alias("order_id"),
            score.alias("review_score"),
            F.when(k % 5 == 0, F.lit("titulo")).otherwise(F.lit("")).alias("review_comment_title"),
            F.when(k % 3 == 0, F.concat(F.lit("comentario "), k.cast("string"))).otherwise(F.lit(""))
            .alias("review_comment_message"),
            F.date_trunc("day", F.timestamp_seconds(created_s)).alias("review_creation_date"),
            F.timestamp_seconds(created_s + F.lit(3600) * (k % 72)).alias("review_answer_timestamp"),
        ]

    first = o.filter(k % 11 != 0).select(*review("rv", F.when(k % 43 != 0, 1 + (k * 7) % 5), 10 + k % 15))
    second = o.filter(k % 37 == 0).select(*review("rw", 1 + (k * 3) % 5, 20 + k % 9))
    return _conform(first.unionByName(second), "order_reviews")


def typed_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_driver(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    pk = F.col("p_partkey")
    no_meta = pk % 61 == 0

    def counter(c: Column) -> Column:
        return F.when(~no_meta, c)

    return _conform(p.select(
        pk.alias("product_id"),
        F.when(no_meta, F.lit("")).otherwise(F.col("p_brand")).alias("product_category_name"),
        counter(F.length("p_name")).alias("product_name_lenght"),
        counter(F.length("p_type") * 10).alias("product_description_lenght"),
        counter(1 + pk % 5).alias("product_photos_qty"),
        F.when(pk % 53 != 0, F.col("p_size") * 125.0).alias("product_weight_g"),
        (F.col("p_size") + 10).alias("product_length_cm"),
        (F.col("p_size") % 25).alias("product_height_cm"),
        (5 + pk % 30).alias("product_width_cm"),
    ), "products")


def typed_category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    brands = (read_driver(spark, sf_dir, "part").select("p_brand")
              .filter(~F.col("p_brand").isin(UNTRANSLATED_BRANDS)).distinct())
    return _conform(brands.select(
        F.col("p_brand").alias("product_category_name"),
        F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit("brand_")).alias("product_category_name_english"),
    ), "category_translation")


def typed_order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_driver(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    k = F.col("o_orderkey")
    return _conform(o.select(
        k.alias("order_id"),
        F.lit(1).alias("payment_sequential"),
        _pick(k % 4, PAYMENT_TYPES).alias("payment_type"),
        F.when(k % 71 == 0, F.lit(0)).otherwise(1 + k % 12).alias("payment_installments"),
        F.when(k % 83 == 0, F.lit(0.0)).otherwise(F.col("o_totalprice")).alias("payment_value"),
    ), "order_payments")


def typed_mql(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_driver(spark, sf_dir, "supplier").select("s_suppkey")
    sk = F.col("s_suppkey")
    return _conform(s.select(
        F.concat(F.lit("mql_"), sk.cast("string")).alias("mql_id"),
        F.format_string("2018-%02d-%02d", 1 + sk % 12, 1 + sk % 28).alias("first_contact_date"),
        F.concat(F.lit("lp_"), (sk % 7).cast("string")).alias("landing_page_id"),
        F.when(sk % 40 == 0, F.lit("")).otherwise(_pick(sk % 5, ORIGINS)).alias("origin"),
    ), "mql")


def typed_closed_deals(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_driver(spark, sf_dir, "supplier").select("s_suppkey").filter(F.col("s_suppkey") % 3 == 0)
    sk = F.col("s_suppkey")
    return _conform(s.select(
        F.concat(F.lit("mql_"), sk.cast("string")).alias("mql_id"),
        sk.alias("seller_id"),
        F.concat(F.lit("sdr_"), (sk % 4).cast("string")).alias("sdr_id"),
        F.concat(F.lit("sr_"), (sk % 6).cast("string")).alias("sr_id"),
        F.format_string("2018-%02d-%02d 00:00:00", 1 + sk % 12, 1 + sk % 28).alias("won_date"),
        _pick(sk % 4, SEGMENTS).alias("business_segment"),
        _pick(sk % 3, LEAD_TYPES).alias("lead_type"),
        F.when(sk % 5 == 0, F.lit("")).otherwise(F.lit("cat")).alias("lead_behaviour_profile"),
        F.when(sk % 2 == 0, F.lit("")).otherwise(F.lit("True")).alias("has_company"),
        F.when(sk % 2 == 0, F.lit("")).otherwise(F.lit("False")).alias("has_gtin"),
        F.when(sk % 4 == 0, F.lit("")).otherwise(F.lit("5-20")).alias("average_stock"),
        F.when(sk % 7 == 0, F.lit("manufacturer")).otherwise(F.lit("reseller")).alias("business_type"),
        F.when(sk % 2 != 0, sk % 200).alias("declared_product_catalog_size"),
        ((sk % 10) * 1000).alias("declared_monthly_revenue"),
    ), "closed_deals")


TYPED_BUILDERS = {
    "orders": typed_orders,
    "order_items": typed_order_items,
    "sellers": typed_sellers,
    "customers": typed_customers,
    "geolocation": typed_geolocation,
    "order_reviews": typed_order_reviews,
    "products": typed_products,
    "category_translation": typed_category_translation,
    "order_payments": typed_order_payments,
    "closed_deals": typed_closed_deals,
    "mql": typed_mql,
}

# Whole-number columns the source exports as float text.
FLOAT_TEXT = {"products": ("product_name_lenght", "product_description_lenght", "product_photos_qty")}


def typed_source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A canonical table with declared types but not yet cleaned (zip codes unpadded,
    bad orders still in): what the clean zone is computed from."""
    return TYPED_BUILDERS[name](spark, sf_dir)


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The raw zone form (all text, ``''`` for missing) of one canonical table."""
    return to_raw_text(typed_source(spark, sf_dir, name), name, FLOAT_TEXT.get(name, ()))


def raw_tables(spark: SparkSession, sf_dir: str, names=None) -> dict[str, DataFrame]:
    """Lazily derived raw zone for the requested tables (all by default)."""
    return {n: raw_table(spark, sf_dir, n) for n in (names or TYPED_BUILDERS)}


# Raw cells that cannot be read, by the remainder (modulo 97) of the rule's number: table -> (number, {remainder: (column, text)}).
# A text beginning with ``+`` is appended to the cell.
MALFORMED_EVERY = 97
MALFORMED_CELLS = {
    "order_items": ("CAST(order_id AS BIGINT) + CAST(order_item_id AS INT)",
                    {0: ("price", "n/a"), 1: ("freight_value", "1e400"), 2: ("freight_value", ""), 3: ("order_item_id", "+.5"),
                     4: ("price", "NaN"), 5: ("price", "1e30")}),
    "order_reviews": ("CAST(order_id AS BIGINT)", {0: ("review_score", "3.5"), 1: ("review_score", "x")}),
    "products": ("CAST(product_id AS BIGINT)", {0: ("product_photos_qty", "2.5"), 1: ("product_name_lenght", "1,5"),
                                                2: ("product_weight_g", "-1e999")}),
    "order_payments": ("CAST(order_id AS BIGINT)", {0: ("payment_value", ""), 1: ("payment_installments", "1.5"),
                                                    2: ("payment_value", "-Infinity"), 3: ("payment_value", "1e29")}),
}


def malformed_raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The raw zone form of a table in which every 97th row has a cell of each kind of ``MALFORMED_CELLS``."""
    number, cells = MALFORMED_CELLS[name]
    cols = []
    for c in raw_schema(name).names:
        q, e = ident(c), ident(c)
        for remainder, (column, text) in cells.items():
            if column == c:
                value = f"concat({q}, '{text[1:]}')" if text.startswith("+") else f"'{text}'"
                e = f"CASE WHEN ({number}) % {MALFORMED_EVERY} = {remainder} THEN {value} ELSE {e} END"
        cols.append(f"{e} AS {q}")
    return raw_table(spark, sf_dir, name).selectExpr(*cols)
