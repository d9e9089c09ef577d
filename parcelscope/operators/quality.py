"""Data-quality profile operators (null, duplicate, range, ordering, distribution).

Each operator is one declarative aggregate over its input, never a loop of
actions: per-column statistics are computed in a single ``agg`` and turned into
rows with ``stack``; multi-table profiles are unions of per-table aggregates
that Spark runs in one job.  Outputs are small (one row per column, rule,
value or table) unless the operator lists rows on purpose.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timefn import ident, pct
from .spread import row_groups


def _lit_sql(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _stack(df: DataFrame, items: list[tuple[str, list[str]]], names: list[str]) -> DataFrame:
    """Rows ``(label, *values)`` from one-row ``df``: ``items`` = [(label, [col, ...])]."""
    args = ", ".join(", ".join([_lit_sql(label), *[ident(c) for c in cols]]) for label, cols in items)
    return df.selectExpr(f"stack({len(items)}, {args}) as ({', '.join(names)})")


def empty_as_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """``''`` -> NULL in string columns, as a CSV reader that infers types sees them."""
    cols = set(cols or df.columns)
    return df.select([F.nullif(F.col(f.name), F.lit("")).alias(f.name)
                      if f.name in cols and isinstance(f.dataType, T.StringType) else F.col(f.name)
                      for f in df.schema.fields])


# --- E1-E4 ---------------------------------------------------------------------------

def profile_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row and column count per table (one job, one partial row per task)."""
    parts = [df.select(F.lit(name).alias("table_name")) for name, df in tables.items()]
    ncols = {name: len(df.columns) for name, df in tables.items()}
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    n_cols = F.lit(None).cast("int")
    for name, n in ncols.items():
        n_cols = F.when(F.col("table_name") == name, F.lit(n)).otherwise(n_cols)
    return u.groupBy("table_name").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", n_cols)


def profile_schema(df: DataFrame, table: str) -> list[tuple[str, int, str, str]]:
    """``(table, position, column, type)`` read from the schema; no data is touched."""
    return [(table, i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]


def profile_length(df: DataFrame, cols: list[str], table: str = "") -> DataFrame:
    """Min and max text length per column."""
    aggs = []
    for c in cols:
        ln = F.length(F.col(c).cast("string"))
        aggs += [F.min(ln).alias(f"min_{c}"), F.max(ln).alias(f"max_{c}")]
    out = _stack(df.agg(*aggs), [(c, [f"min_{c}", f"max_{c}"]) for c in cols],
                 ["column_name", "min_length", "max_length"])
    return out.select(F.lit(table).alias("table_name"), "*")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """The distinct values of one column, ordered."""
    return df.select(col).distinct().orderBy(F.col(col).asc_nulls_first())


# --- E5-E9: nulls and missing metadata ------------------------------------------------

def profile_nulls(df: DataFrame, table: str = "") -> DataFrame:
    """E5: NULL count and percentage for every column, in one aggregate pass."""
    aggs = [F.count(F.lit(1)).alias("__total")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"__n{i}") for i, c in enumerate(df.columns)]
    one = df.agg(*aggs)
    out = _stack(one, [(c, [f"__n{i}", "__total"]) for i, c in enumerate(df.columns)],
                 ["column_name", "null_count", "total_rows"])
    return out.select(F.lit(table).alias("table_name"), "column_name", "null_count",
                      F.round(F.coalesce(pct(F.col("null_count"), F.col("total_rows")), F.lit(0.0)), 2)
                      .alias("null_pct"))


def profile_nulls_ranked(profile: DataFrame) -> DataFrame:
    """Only the columns that have NULLs, least affected first (the chart's data)."""
    return profile.filter(F.col("null_count") > 0).orderBy("table_name", "null_pct", "column_name")


def nulls_by_status(orders: DataFrame, cols: list[str], status: str = "order_status") -> DataFrame:
    """Per status, how many rows miss each of ``cols`` (one aggregate for all columns)."""
    aggs = [F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in cols]
    return orders.groupBy(status).agg(*aggs).orderBy(F.desc(f"{cols[0]}_nulls"), status)


def missing_rows(df: DataFrame, col: str, show: list[str] | None = None) -> DataFrame:
    """The rows where ``col`` is NULL (listing, not a sample)."""
    out = df.filter(F.col(col).isNull())
    return out.select(show) if show else out


def missing_impact(facts: DataFrame, dim: DataFrame, key: str, col: str) -> DataFrame:
    """Joined rows of facts and the dimension rows whose ``col`` is NULL.

    Both sides are counted per key first, so a hot key meets the join as one row
    and a key that is stored twice in the dimension counts twice, as in a plain inner join.
    """
    bad = dim.filter(F.col(col).isNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_d"))
    per_key = facts.groupBy(key).agg(F.count(F.lit(1)).alias("_f"))
    return per_key.join(bad, key).agg(F.coalesce(F.sum(F.col("_f") * F.col("_d")), F.lit(0)).cast("long").alias("fact_rows"))


def sample_columns(df: DataFrame, cols: list[str], key: str, n: int = 20) -> DataFrame:
    """Chosen columns of the ``n`` rows with the smallest ``key``, for a look at the data."""
    return df.orderBy(key).limit(n).select(cols)


def value_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Frequency of every value of every column in ``cols``; NULL is a value.

    One scan: each row is unfolded into ``(column, value)`` pairs with
    ``stack`` and a single partial-then-final aggregate counts them.
    """
    args = ", ".join(f"{_lit_sql(c)}, CAST({ident(c)} AS STRING)" for c in cols)
    pairs = df.selectExpr(f"stack({len(cols)}, {args}) as (column_name, value)")
    return pairs.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count"))


# --- E12-E13: duplicates -----------------------------------------------------------------

def duplicate_census(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Total rows, distinct rows and duplicates per table.

    Rows are counted by their hash first; only rows whose hash may repeat are moved and compared as a whole (``spread.row_groups``).
    Each table contributes one row.
    """
    parts = []
    for name, df in tables.items():
        repeated, by_hash = row_groups(df, "__m")
        parts.append(by_hash.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("total"), F.count_if(~F.col("_marked")).alias("unique"))
                     .crossJoin(repeated.agg(F.count(F.lit(1)).alias("groups")))  # one row each
                     .select(F.lit(name).alias("table_name"), F.col("total").alias("total_rows"),
                             (F.col("unique") + F.col("groups")).alias("distinct_rows")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.withColumn("duplicate_rows", F.col("total_rows") - F.col("distinct_rows"))


def duplicate_groups(df: DataFrame, top_n: int = 20) -> DataFrame:
    """Fully identical rows that occur more than once, most frequent first.

    A top-k report: ties on the count are broken by the row's own values so the
    selection is deterministic.  Only rows whose hash repeats are read whole.
    """
    cols = df.columns
    g = row_groups(df, "count")[0].filter(F.col("count") > 1)
    return g.orderBy(F.desc("count"), *[F.col(c).asc_nulls_first() for c in cols]).limit(top_n)


# --- E14-E18: rule checks --------------------------------------------------------------

def check_rules(df: DataFrame, rules: Mapping[str, Column], table: str = "") -> DataFrame:
    """``(rule, violations)`` for every named predicate, in one pass.

    A row violates a rule when the predicate is true; NULL counts as no violation.
    """
    names = list(rules)
    one = df.agg(*[F.count_if(F.coalesce(rules[r], F.lit(False))).alias(f"__r{i}") for i, r in enumerate(names)])
    out = _stack(one, [(r, [f"__r{i}"]) for i, r in enumerate(names)], ["rule", "violations"])
    return out.select(F.lit(table).alias("table_name"), "rule", "violations")


def violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows breaking any rule (the listing behind ``check_rules``)."""
    any_bad = F.lit(False)
    for pred in rules.values():
        any_bad = any_bad | F.coalesce(pred, F.lit(False))
    return df.filter(any_bad)


# --- E19-E22: stage ordering ------------------------------------------------------------

PURCHASE = "order_purchase_timestamp"
APPROVED = "order_approved_at"
CARRIER = "order_delivered_carrier_date"
CUSTOMER = "order_delivered_customer_date"

# The stage orderings the study checks, as (later, earlier) pairs.
ORDER_RULES = {
    "approved_before_purchase": (APPROVED, PURCHASE),
    "carrier_before_approved": (CARRIER, APPROVED),
    "customer_before_carrier": (CUSTOMER, CARRIER),
}


def _broken(rule: str) -> Column:
    later, earlier = ORDER_RULES[rule]
    return F.col(later) < F.col(earlier)


def order_violations(orders: DataFrame) -> DataFrame:
    """How many orders break each stage ordering (one aggregate, one row)."""
    return orders.agg(*[F.count_if(F.coalesce(_broken(n), F.lit(False))).alias(n) for n in ORDER_RULES])


def _carrier_gap(orders: DataFrame) -> DataFrame:
    return (orders.filter(_broken("carrier_before_approved"))
            .select("order_status", (F.unix_timestamp(APPROVED) - F.unix_timestamp(CARRIER)).alias("diff_seconds")))


def violation_gap_stats(orders: DataFrame) -> DataFrame:
    """Min / max / mean seconds by which the carrier date precedes approval."""
    g = _carrier_gap(orders)
    return g.agg(F.min("diff_seconds").alias("min_seconds"), F.max("diff_seconds").alias("max_seconds"),
                 F.avg("diff_seconds").alias("avg_seconds"))


def violations_by_status(orders: DataFrame) -> DataFrame:
    """Orders with the carrier before approval, per status."""
    return _carrier_gap(orders).groupBy("order_status").agg(F.count(F.lit(1)).alias("count"))


# Gap bucket edges in seconds (5 minutes, 1 hour, 1 day).
GAP_EDGES = (300, 3600, 86400)


def violation_gap_buckets(orders: DataFrame) -> DataFrame:
    """Gap size buckets.  The middle buckets use inclusive ``between`` on both
    ends, so a gap of exactly 3600 s is counted in two buckets, as in the study."""
    g = _carrier_gap(orders)
    s = F.col("diff_seconds")
    a, b, c = GAP_EDGES
    return g.agg(
        F.count(s).alias("total"),
        F.count_if(s < a).alias("under_5_min"),
        F.count_if(s.between(a, b)).alias("from_5_min_to_1_hour"),
        F.count_if(s.between(b, c)).alias("from_1_hour_to_1_day"),
        F.count_if(s > c).alias("over_1_day"),
    )


# --- E23-E27: distributions ---------------------------------------------------------------

def distribution(df: DataFrame, col: str, top_n: int | None = None, by_value: bool = False) -> DataFrame:
    """Rows per value; most frequent first (ties by value) or by value."""
    g = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    if by_value:
        return g.orderBy(F.col(col).asc_nulls_first())
    g = g.orderBy(F.desc("count"), F.col(col).asc_nulls_first())
    return g.limit(top_n) if top_n else g


def items_per_order(items: DataFrame, key: str = "order_id") -> DataFrame:
    """Min / max / mean items per order (two-level aggregate, partial at both levels)."""
    per = items.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.min("n").alias("min_items"), F.max("n").alias("max_items"), F.avg("n").alias("avg_items"))
