"""Cleaning step: raw (all-string) tables -> typed clean tables + quarantine.

Every ``clean_*`` function takes a raw DataFrame and returns
``(clean, rejected)``.  Both are lazy projections/filters of the same input, so
Catalyst fuses the parsing into the scan; the only shuffle in the whole step is
the geolocation de-dup, which pre-aggregates map-side so a hot duplicate group
collapses before it moves.  Rows are never dropped silently: every input row is
either clean or quarantined with a reason (geolocation duplicates excepted,
which is the point of that step).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timefn import ident, parse_ts_sql, zfill_sql
from ..schema import REJECT_REASON, SCHEMAS

ORDER_TS = [
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
]

# Reject reasons of the order check.
CARRIER_BEFORE_APPROVED = "carrier_before_approved"
CUSTOMER_BEFORE_CARRIER = "customer_before_carrier"
BOTH_REASONS = "carrier_before_approved AND customer_before_carrier"

# Plausibility box for coordinates (inclusive).
LAT_RANGE = (-35.0, 5.0)
LNG_RANGE = (-75.0, -30.0)

PRODUCT_COUNTERS = ["product_name_lenght", "product_description_lenght", "product_photos_qty"]


def _is_text(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, T.StringType)


def _reads_text(df: DataFrame, name: str) -> bool:
    """Whether numbers or timestamps of table ``name`` are still text in ``df``."""
    return any(not isinstance(f.dataType, T.StringType) and _is_text(df, f.name) for f in SCHEMAS[name].fields)


# A plain decimal number; anything else ('NaN', '1.5d', 'x') is text that cannot be read.
NUMBER = "^ *[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)? *$"


def finite_sql(e: str) -> str:
    """Double expression ``e``, NULL where it is infinite or NaN (which compares as the largest number)."""
    return f"(CASE WHEN abs({e}) < CAST('Infinity' AS DOUBLE) THEN {e} END)"


def number_sql(q: str) -> str:
    """Text column ``q`` as a double, NULL where it is not a number or too large to be one (``1e400``)."""
    value = f"try_cast({q} AS DOUBLE)"
    return f"(CASE WHEN {q} rlike '{NUMBER}' AND abs({value}) < CAST('Infinity' AS DOUBLE) THEN {value} END)"


def typed_sql(df: DataFrame, name: str, overrides: dict[str, str] | None = None) -> list[str]:
    """SQL expressions projecting ``df`` onto the declared schema of ``name``.

    Strings are filled with ``''``; numbers and timestamps parse leniently (bad
    text -> NULL), whole numbers through double so ``'40.0'`` reads as 40.
    Already-typed columns pass through a plain cast.  Columns are matched by
    name, never by position.  (Expression text, so a whole projection costs one
    call into the JVM.)
    """
    overrides = overrides or {}
    out = []
    for f in SCHEMAS[name].fields:
        q = ident(f.name)
        text = _is_text(df, f.name)
        if f.name in overrides:
            e = overrides[f.name]
        elif isinstance(f.dataType, T.StringType):
            e = f"coalesce(CAST({q} AS STRING), '')"
        elif isinstance(f.dataType, T.TimestampType):
            e = parse_ts_sql(f.name) if text else f"CAST({q} AS TIMESTAMP)"
        elif isinstance(f.dataType, T.IntegerType):
            e = f"try_cast({number_sql(q)} AS INT)" if text else f"try_cast({q} AS INT)"
        elif text:
            e = number_sql(q)
        elif isinstance(f.dataType, T.DoubleType):
            e = finite_sql(f"CAST({q} AS DOUBLE)")
        else:
            e = f"CAST({q} AS {f.dataType.simpleString()})"
        out.append(f"{e} AS {q}")
    return out


def first_reason(checks: list[tuple[Column, str]]) -> Column:
    """Reason of the first failing check, NULL when every check passes."""
    out = F.lit(None).cast("string")
    for bad, reason in reversed(checks):
        out = F.when(bad, F.lit(reason)).otherwise(out)
    return out


REJECTED_FLAG = "_rejected"


class Split(tuple):
    """``(clean, rejected)`` plus the flagged frame both are filtered from.

    ``flagged`` has all columns of both and a boolean ``_rejected``; writing or
    counting it covers both sides in one pass.  ``same_rows`` tells whether
    it has one row per input row (false after de-duplication).
    """

    def __new__(cls, clean: DataFrame, rejected: DataFrame, flagged: DataFrame, same_rows: bool = True):
        obj = super().__new__(cls, (clean, rejected))
        obj.flagged, obj.same_rows = flagged, same_rows
        return obj

    @property
    def clean(self) -> DataFrame:
        return self[0]

    @property
    def rejected(self) -> DataFrame:
        return self[1]


def parsed_once(typed: DataFrame) -> DataFrame:
    """The same rows; what is asked of them afterwards reads finished values.

    A filter is otherwise moved below the projection that parses text, and every expression it names is
    then copied into it: a cell is rendered, matched and cast again for each check that looks at it, and once more
    for the output.  Nothing is moved through the one-element ``inline``.
    """
    return typed.selectExpr(f"inline(array(struct({', '.join(ident(c) for c in typed.columns)})))")


def split_by_reason(typed: DataFrame, checks: list[tuple[Column, str]], keep: list[str]) -> Split:
    """Rows failing no check are clean; the others get the first failing check's reason.

    The filters test one OR of the checks, so the optimizer never has to inline
    the reason's CASE chain (and the parsing expressions under it) into them.
    """
    any_bad = F.lit(False)
    for bad, _ in checks:
        any_bad = any_bad | bad
    clean = typed.filter(~any_bad).select(keep)
    rejected = typed.filter(any_bad).select(*keep, first_reason(checks).alias(REJECT_REASON))
    flagged = typed.select(*keep, first_reason(checks).alias(REJECT_REASON), any_bad.alias(REJECTED_FLAG))
    return Split(clean, rejected, flagged)


# Amounts of money from here on do not fit the decimal that the cards sum in (see plans.metrics).
MONEY_LIMIT = 1e28
MONEY = {"order_items": ["price", "freight_value"], "order_payments": ["payment_value"]}


def conform(raw: DataFrame, name: str, overrides: dict[str, str] | None = None,
            whole_number_cols: list[str] | None = None,
            ) -> tuple[DataFrame, DataFrame]:
    """Type a raw table by its declared schema and quarantine rows that cannot be typed.

    Reasons, first match wins: ``non_integer:<col>`` (a whole-number column holds
    a fraction, e.g. ``'40.5'``), ``null_in_required:<col>`` (a non-nullable
    number or timestamp is empty, malformed or not finite), then ``out_of_range:<col>`` (an amount too large to sum exactly).
    """
    cols = [f.name for f in SCHEMAS[name].fields]
    fraction_flags = [
        (f"coalesce({number_sql(ident(c))} % 1 != 0, false) AS {ident('_frac_' + c)}", c)
        for c in (whole_number_cols or []) if _is_text(raw, c)
    ]
    typed = raw.selectExpr(*typed_sql(raw, name, overrides), *[e for e, _ in fraction_flags])
    if _reads_text(raw, name):
        typed = parsed_once(typed)
    checks = [(F.col(f"_frac_{c}"), f"non_integer:{c}") for _, c in fraction_flags]
    checks += [(F.col(f.name).isNull(), f"null_in_required:{f.name}")
               for f in SCHEMAS[name].fields
               if not f.nullable and not isinstance(f.dataType, T.StringType)]
    checks += [(F.coalesce(F.abs(F.col(c)) >= MONEY_LIMIT, F.lit(False)), f"out_of_range:{c}") for c in MONEY.get(name, [])]
    return split_by_reason(typed, checks, cols)


# --- T1-T4: orders --------------------------------------------------------------

def order_anomalies() -> tuple[Column, Column]:
    """(carrier before approval, customer before carrier); a NULL date never flags."""
    carrier_first = F.coalesce(F.col("order_delivered_carrier_date") < F.col("order_approved_at"), F.lit(False))
    customer_first = F.coalesce(F.col("order_delivered_customer_date") < F.col("order_delivered_carrier_date"),
                                F.lit(False))
    return carrier_first, customer_first


def clean_orders(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parse the five timestamps; quarantine impossible stage orderings.

    Approval before purchase is only studied (see ``quality``), not rejected.
    """
    cols = [f.name for f in SCHEMAS["orders"].fields]
    typed = raw.selectExpr(*typed_sql(raw, "orders"))
    if _reads_text(raw, "orders"):
        typed = parsed_once(typed)
    carrier_first, customer_first = order_anomalies()
    checks = [(carrier_first & customer_first, BOTH_REASONS), (customer_first, CUSTOMER_BEFORE_CARRIER),
              (carrier_first, CARRIER_BEFORE_APPROVED)]
    return split_by_reason(typed, checks, cols)


# --- T5-T8, T12 ---------------------------------------------------------------

def clean_reviews(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Score to int (through double), creation and answer timestamps parsed."""
    return conform(raw, "order_reviews", whole_number_cols=["review_score"])


def clean_products(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Three float-text counters to int; a fractional counter is quarantined."""
    return conform(raw, "products", whole_number_cols=PRODUCT_COUNTERS)


def clean_customers(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    return conform(raw, "customers", overrides={"customer_zip_code_prefix": zfill_sql("customer_zip_code_prefix")})


def clean_sellers(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    return conform(raw, "sellers", overrides={"seller_zip_code_prefix": zfill_sql("seller_zip_code_prefix")})


def passthrough(name: str) -> Callable[[DataFrame], tuple[DataFrame, DataFrame]]:
    """Tables the source step leaves untouched: typed by schema only."""
    whole = [f.name for f in SCHEMAS[name].fields if isinstance(f.dataType, T.IntegerType)]

    def run(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
        return conform(raw, name, whole_number_cols=whole)
    run.__name__ = f"passthrough_{name}"
    return run


# --- T9-T11: geolocation --------------------------------------------------------

def _coord_sql(raw: DataFrame, c: str) -> str:
    q = ident(c)
    return f"{number_sql(q) if _is_text(raw, c) else finite_sql(f'CAST({q} AS DOUBLE)')} AS {q}"


def type_geolocation(raw: DataFrame) -> DataFrame:
    """Zip padded, coordinates parsed (bad text -> NULL); nothing dropped yet."""
    return raw.selectExpr(
        f"{zfill_sql('geolocation_zip_code_prefix')} AS geolocation_zip_code_prefix",
        _coord_sql(raw, "geolocation_lat"),
        _coord_sql(raw, "geolocation_lng"),
        "coalesce(CAST(geolocation_city AS STRING), '') AS geolocation_city",
        "coalesce(CAST(geolocation_state AS STRING), '') AS geolocation_state",
    )


def in_box(lat: str = "geolocation_lat", lng: str = "geolocation_lng") -> Column:
    """Inside the inclusive box; NULL coordinates count as outside."""
    return F.coalesce(F.col(lat).between(*LAT_RANGE) & F.col(lng).between(*LNG_RANGE), F.lit(False))


def dedup_geolocation(raw: DataFrame) -> DataFrame:
    """Fully identical rows collapse to one, after typing (NULLs compare equal).

    ``dropDuplicates`` plans a partial hash aggregate before the shuffle, so even
    a single point repeated for a third of the table leaves each map task as one row.
    """
    return type_geolocation(raw).dropDuplicates()


def clean_geolocation(raw: DataFrame) -> Split:
    """De-dup then split on the box.  The quarantine keeps the table's columns only."""
    deduped = dedup_geolocation(raw)
    flagged = deduped.select("*", (~in_box()).alias(REJECTED_FLAG))
    return Split(deduped.filter(in_box()), deduped.filter(~in_box()), flagged, same_rows=False)


# --- T13 ------------------------------------------------------------------------

TRANSFORMS: dict[str, Callable[[DataFrame], tuple[DataFrame, DataFrame]]] = {
    "orders": clean_orders,
    "order_items": passthrough("order_items"),
    "sellers": clean_sellers,
    "customers": clean_customers,
    "geolocation": clean_geolocation,
    "order_reviews": clean_reviews,
    "products": clean_products,
    "category_translation": passthrough("category_translation"),
    "order_payments": passthrough("order_payments"),
    "closed_deals": passthrough("closed_deals"),
    "mql": passthrough("mql"),
}


def run_transform(raw: dict[str, DataFrame]) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Table name -> (clean, rejected) for every raw table given."""
    return {name: TRANSFORMS[name](df) for name, df in raw.items()}


def clean_tables(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: pair[0] for name, pair in run_transform(raw).items()}


def typed_table(raw: DataFrame, name: str) -> DataFrame:
    """A raw table typed the way its cleaning step types it, before anything is
    quarantined or de-duplicated (what the data-quality study looks at)."""
    if name == "geolocation":
        return type_geolocation(raw)
    overrides = {"customers": {"customer_zip_code_prefix": zfill_sql("customer_zip_code_prefix")},
                 "sellers": {"seller_zip_code_prefix": zfill_sql("seller_zip_code_prefix")}}.get(name)
    return raw.selectExpr(*typed_sql(raw, name, overrides))
