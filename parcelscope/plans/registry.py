"""Registered queries: ``(spark, sf_dir) -> DataFrame`` over the driver tables.

Each entry derives the canonical raw zone from the driver tables
(``sources.adapter``), cleans it (``operators.clean``) and runs one question;
everything stays lazy, so Catalyst sees the whole pipeline as one plan and
prunes every column the question does not use.

Parameters are set for the driver's data, whose purchases run 1995-2001: the
monthly cards start in 1998 instead of 2017, and the HAVING thresholds are
the ones that actually filter at sf0.01.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import quality as Q
from ..operators.clean import TRANSFORMS, typed_table
from ..schema import DEAL_VALUE_COLUMNS, RULED_TABLES, SCHEMAS, TABLES
from ..session import pin_utc
from ..sources.adapter import MALFORMED_CELLS, malformed_raw_table, raw_table, typed_source
from ..sources.zones import etl_audit
from . import arrivals, oracle, rollup
from . import metrics as M

# Parameters of the registered cards (see module docstring).
SINCE = "1998-01-01"
MIN_STATE = 190
MIN_FREIGHT = 750
MIN_SELLER = 180
MIN_CATEGORY = 100
TREND_PERIODS = (2, 5)

Query = Callable[[SparkSession, str], DataFrame]


class Lake:
    """Lazily derived raw and clean tables of one scale-factor directory.

    ``text=True`` starts from the raw zone as text, so cleaning parses every
    value as it would from CSV (used by the cleaning and data-quality checks).
    ``text=False`` starts from the typed canonical tables, the way the
    dashboard reads an already typed clean zone; the cleaning rules still run.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, text: bool = True):
        pin_utc(spark)
        self.spark, self.sf_dir, self.text = spark, sf_dir, text
        self._raw: dict[str, DataFrame] = {}
        self._split: dict[str, tuple[DataFrame, DataFrame]] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            build = raw_table if self.text else typed_source
            self._raw[name] = build(self.spark, self.sf_dir, name)
        return self._raw[name]

    def split(self, name: str) -> tuple[DataFrame, DataFrame]:
        if name not in self._split:
            self._split[name] = TRANSFORMS[name](self.raw(name))
        return self._split[name]

    def clean(self, name: str) -> DataFrame:
        return self.split(name)[0]

    def rejected(self, name: str) -> DataFrame:
        return self.split(name)[1]

    def malformed(self, name: str) -> DataFrame:
        """Raw text of a table in which some cells cannot be read."""
        return malformed_raw_table(self.spark, self.sf_dir, name)

    def malformed_split(self, name: str):
        return TRANSFORMS[name](self.malformed(name))

    def tables(self, *names: str) -> dict[str, DataFrame]:
        return {n: self.clean(n) for n in names}

    def typed(self, name: str) -> DataFrame:
        """Typed but not yet quarantined or de-duplicated."""
        return typed_table(self.raw(name), name)

    def profiled(self, name: str) -> DataFrame:
        """Typed, with ``''`` read as NULL (how the study's CSV reader saw the data)."""
        return Q.empty_as_null(self.typed(name))


def lake_for(spark: SparkSession, sf_dir: str, text: bool) -> Lake:
    """One ``Lake`` per session, directory and form.

    Only the lazy table *definitions* are shared between queries (no data is
    cached): building them costs thousands of driver-to-JVM calls, which would
    otherwise be paid again by every query.
    """
    pin_utc(spark)
    per_session = spark.__dict__.setdefault("_parcelscope_lakes", {})  # lives and dies with the session
    key = (sf_dir, text)
    if key not in per_session:
        per_session[key] = Lake(spark, sf_dir, text=text)
    return per_session[key]


def ntz(df: DataFrame) -> DataFrame:
    """Timestamps as wall-clock values, independent of the reader's time zone."""
    return df.select([F.col(f.name).cast("timestamp_ntz").alias(f.name)
                      if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
                      for f in df.schema.fields])


ORDER_TABLES = ("orders",)
REVIEW_TABLES = ("orders", "order_reviews")
STATE_TABLES = ("orders", "order_items", "customers")
SELLER_TABLES = ("orders", "order_items")
PRODUCT_TABLES = ("orders", "order_items", "products", "category_translation")


def _metric(fn, needs: tuple[str, ...], **params) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(lake_for(spark, sf_dir, text=False).tables(*needs), **params)
    run.__name__ = fn.__name__
    return run


def _trend(base, value: str, periods: int) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        monthly = base(lake_for(spark, sf_dir, text=False).tables(*ORDER_TABLES), since=SINCE)
        return M.trend_change(monthly, value, periods)
    return run


def metric_queries() -> dict[str, Query]:
    return {
        "q1a_delivery_stats": _metric(M.q1a_delivery_stats, ORDER_TABLES),
        "q1b_delivery_histogram": _metric(M.q1b_delivery_histogram, ORDER_TABLES),
        "q1c_on_time_counts": _metric(M.q1c_on_time_counts, ORDER_TABLES),
        "q1d_on_time_rates": _metric(M.q1d_on_time_rates, ORDER_TABLES),
        "q2a_monthly_delivery": _metric(M.q2a_monthly_delivery, ORDER_TABLES, since=SINCE),
        "q2b_monthly_on_time": _metric(M.q2b_monthly_on_time, ORDER_TABLES, since=SINCE),
        "q2c_monthly_delivery_all": _metric(M.q2c_monthly_delivery_all, ORDER_TABLES),
        "q2d_monthly_on_time": _metric(M.q2d_monthly_on_time, ORDER_TABLES, since=SINCE),
        "q2e_estimate_vs_actual": _metric(M.q2e_estimate_vs_actual, ORDER_TABLES),
        "q2f_days_early": _metric(M.q2f_days_early, ORDER_TABLES),
        "q3a_review_by_status": _metric(M.q3a_review_by_status, REVIEW_TABLES),
        "q3b_review_rows": _metric(M.q3b_review_rows, REVIEW_TABLES),
        "q4a_stage_lead_time": _metric(M.q4a_stage_lead_time, ORDER_TABLES),
        "q4b_stage_by_status": _metric(M.q4b_stage_by_status, ORDER_TABLES),
        "q5a_state_delivery": _metric(M.q5a_state_delivery, STATE_TABLES, min_rows=MIN_STATE),
        "q5b_state_late_rate": _metric(M.q5b_state_late_rate, STATE_TABLES, min_rows=MIN_STATE),
        "q5c_state_freight": _metric(M.q5c_state_freight, STATE_TABLES, min_rows=MIN_FREIGHT),
        "q6a_seller_late_rate": _metric(M.q6a_seller_late_rate, SELLER_TABLES, min_rows=MIN_SELLER),
        "q6b_seller_processing": _metric(M.q6b_seller_processing, SELLER_TABLES, min_rows=MIN_SELLER),
        "q6c_seller_scatter": _metric(M.q6c_seller_scatter, SELLER_TABLES, min_rows=MIN_SELLER),
        "q7a_category_delivery": _metric(M.q7a_category_delivery, PRODUCT_TABLES, min_rows=MIN_CATEGORY),
        "q7b_weight_delivery": _metric(M.q7b_weight_delivery, PRODUCT_TABLES),
        "q7c_category_late_rate": _metric(M.q7c_category_late_rate, PRODUCT_TABLES, min_rows=MIN_CATEGORY),
        "q8a_state_delivery_freight": _metric(M.q8a_state_delivery_freight, STATE_TABLES),
        "q8b_state_late_freight": _metric(M.q8b_state_late_freight, STATE_TABLES),
        "estimate_gap": _metric(M.estimate_gap, ORDER_TABLES),
        "trend_delivery_days": _trend(M.q2a_monthly_delivery, "avg_delivery_days", TREND_PERIODS[0]),
        "trend_on_time_rate": _trend(M.q2b_monthly_on_time, "on_time_rate", TREND_PERIODS[1]),
    }


def metric_oracles() -> dict[str, str]:
    return oracle.metric_sql(SINCE, MIN_STATE, MIN_FREIGHT, MIN_SELLER, MIN_CATEGORY, TREND_PERIODS)


def _lake_query(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(lake_for(spark, sf_dir, text=True))
    run.__name__ = getattr(fn, "__name__", "query")
    return run


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# The range rules studied.  Key of the offending rows -> (table, rule, predicate).
RANGE_RULES = {
    "e14_violating_items": ("order_items", "price_or_freight", "price <= 0 OR freight_value < 0"),
    "e15_violating_payments": ("order_payments", "value_or_installments",
                               "payment_value <= 0 OR payment_installments <= 0"),
    "e16_violating_products": ("products", "weight_or_dimensions",
                               "product_weight_g <= 0 OR product_length_cm <= 0 OR product_height_cm <= 0 "
                               "OR product_width_cm <= 0"),
    "e17_violating_geolocation": ("geolocation", "outside_box",
                                  "geolocation_lat < -35 OR geolocation_lat > 5 "
                                  "OR geolocation_lng < -75 OR geolocation_lng > -30"),
    "e18_violating_reviews": ("order_reviews", "score_out_of_range", "review_score < 1 OR review_score > 5"),
}


def _range_checks(lake: Lake) -> DataFrame:
    return _union([Q.check_rules(lake.typed(table), {rule: F.expr(bad)}, table)
                   for table, rule, bad in RANGE_RULES.values()])


def _violating(key: str) -> Query:
    table, rule, bad = RANGE_RULES[key]
    return _lake_query(lambda lake: ntz(Q.violations(lake.typed(table), {rule: F.expr(bad)})))


def _nulls(lake: Lake) -> DataFrame:
    return _union([Q.profile_nulls(lake.profiled(t), t) for t in TABLES])


STAGE_COLS = ["order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date"]


def check_queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    for name in TABLES:
        q[f"clean_{name}"] = _lake_query(lambda lake, n=name: ntz(lake.clean(n)))
    for name in RULED_TABLES:
        q[f"{name}_rejected"] = _lake_query(lambda lake, n=name: ntz(lake.rejected(n)))
    for name in MALFORMED_CELLS:
        q[f"{name}_rejected"] = _lake_query(lambda lake, n=name: ntz(lake.malformed_split(n).rejected))
    q["etl_audit_malformed"] = _lake_query(lambda lake: etl_audit({n: lake.malformed(n) for n in MALFORMED_CELLS},
                                                                  {n: lake.malformed_split(n) for n in MALFORMED_CELLS}))
    q["etl_audit"] = _lake_query(lambda lake: etl_audit({n: lake.raw(n) for n in TABLES},
                                                        {n: lake.split(n) for n in TABLES}))
    q["e01_profile_tables"] = _lake_query(lambda lake: Q.profile_tables({n: lake.typed(n) for n in TABLES}))
    q["e03_profile_length"] = _lake_query(lambda lake: _union([
        Q.profile_length(lake.raw("customers"), ["customer_zip_code_prefix"], "customers"),
        Q.profile_length(lake.raw("geolocation"), ["geolocation_zip_code_prefix"], "geolocation")]))
    q["e04_distinct_review_scores"] = _lake_query(
        lambda lake: Q.distinct_values(lake.typed("order_reviews"), "review_score"))
    q["e05_profile_nulls"] = _lake_query(_nulls)
    q["e06_profile_nulls_ranked"] = _lake_query(lambda lake: Q.profile_nulls_ranked(_nulls(lake)))
    q["e07_nulls_by_status"] = _lake_query(lambda lake: Q.nulls_by_status(lake.profiled("orders"), STAGE_COLS))
    q["e08_missing_category_rows"] = _lake_query(lambda lake: Q.missing_rows(
        lake.profiled("products"), "product_category_name",
        ["product_id", "product_category_name", "product_name_lenght", "product_description_lenght",
         "product_photos_qty", "product_weight_g", "product_height_cm", "product_width_cm"]))
    q["e08_missing_weight_rows"] = _lake_query(lambda lake: Q.missing_rows(
        lake.profiled("products"), "product_weight_g",
        ["product_id", "product_category_name", "product_weight_g", "product_height_cm", "product_width_cm"]))
    q["e09_missing_impact"] = _lake_query(lambda lake: Q.missing_impact(
        lake.typed("order_items"), lake.profiled("products"), "product_id", "product_category_name"))
    q["e10_sample_columns"] = _lake_query(lambda lake: Q.sample_columns(
        lake.profiled("closed_deals"), ["has_company", "has_gtin", "average_stock", "declared_product_catalog_size"],
        key="mql_id"))
    q["e11_value_counts_deals"] = _lake_query(lambda lake: Q.value_counts(
        lake.profiled("closed_deals"), list(DEAL_VALUE_COLUMNS)))
    q["e11_value_counts_origin"] = _lake_query(lambda lake: Q.value_counts(lake.profiled("mql"), ["origin"]))
    q["e12_duplicate_census"] = _lake_query(
        lambda lake: Q.duplicate_census({n: lake.typed(n) for n in TABLES}))
    q["e13_duplicate_groups"] = _lake_query(lambda lake: Q.duplicate_groups(lake.typed("geolocation")))
    q["e14_range_checks"] = _lake_query(_range_checks)
    q |= {key: _violating(key) for key in RANGE_RULES}
    q["e19_order_violations"] = _lake_query(lambda lake: Q.order_violations(lake.typed("orders")))
    q["e20_violation_gap_stats"] = _lake_query(lambda lake: Q.violation_gap_stats(lake.typed("orders")))
    q["e21_violations_by_status"] = _lake_query(lambda lake: Q.violations_by_status(lake.typed("orders")))
    q["e22_violation_gap_buckets"] = _lake_query(lambda lake: Q.violation_gap_buckets(lake.typed("orders")))
    q["e23_dist_status"] = _lake_query(lambda lake: Q.distribution(lake.profiled("orders"), "order_status"))
    q["e24_dist_seller_state"] = _lake_query(
        lambda lake: Q.distribution(lake.profiled("sellers"), "seller_state", top_n=10))
    q["e25_dist_customer_state"] = _lake_query(
        lambda lake: Q.distribution(lake.profiled("customers"), "customer_state", top_n=10))
    q["e26_items_per_order"] = _lake_query(lambda lake: Q.items_per_order(lake.typed("order_items")))
    q["e27_dist_review_score"] = _lake_query(
        lambda lake: Q.distribution(lake.typed("order_reviews"), "review_score", by_value=True))
    return q


# Parameters of the cards that have some, by card.
CARD_PARAMS: dict[str, dict] = {
    "q2a_monthly_delivery": {"since": SINCE}, "q2b_monthly_on_time": {"since": SINCE}, "q2d_monthly_on_time": {"since": SINCE},
    "q5a_state_delivery": {"min_rows": MIN_STATE}, "q5b_state_late_rate": {"min_rows": MIN_STATE},
}
STREAM_TABLES = ("orders", "customers", "geolocation")


def _rollup(card: str) -> Query:
    return lambda spark, sf_dir: arrivals.rollup_card(spark, sf_dir, card, **CARD_PARAMS.get(card, {}))


def stream_queries() -> dict[str, Query]:
    """Tables and cards of the incremental path; every key answers the statement of the key that it names."""
    q: dict[str, Query] = {f"rollup_{card.split('_', 1)[0]}": _rollup(card) for card in rollup.CARDS}
    for name in STREAM_TABLES:
        q[f"stream_clean_{name}"] = lambda spark, sf_dir, n=name: ntz(arrivals.refined(spark, sf_dir, n))
    for name in RULED_TABLES:
        q[f"stream_{name}_rejected"] = lambda spark, sf_dir, n=name: ntz(arrivals.refined(spark, sf_dir, n, rejected=True))
    q["stream_q8a"] = lambda spark, sf_dir: arrivals.full_card(spark, sf_dir, "q8a_state_delivery_freight")
    return q


def stream_oracles(full: dict[str, str]) -> dict[str, str]:
    q = {f"rollup_{card.split('_', 1)[0]}": full[card] for card in rollup.CARDS}
    q |= {f"stream_clean_{name}": full[f"clean_{name}"] for name in STREAM_TABLES}
    q |= {f"stream_{name}_rejected": full[f"{name}_rejected"] for name in RULED_TABLES}
    return q | {"stream_q8a": full["q8a_state_delivery_freight"]}


def queries() -> dict[str, Query]:
    return {**metric_queries(), **check_queries(), **stream_queries()}


def oracle_sql() -> dict[str, str]:
    full = {**metric_oracles(), **oracle.check_sql(SCHEMAS)}
    return oracle.finish({**full, **stream_oracles(full)})
