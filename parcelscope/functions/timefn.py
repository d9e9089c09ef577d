"""Column expressions shared by the cleaning step and the dashboard queries.

Everything here returns a ``Column`` built from Spark's own functions, so it
stays inside whole-stage code generation.  Timestamps are session-zone
``TIMESTAMP`` values; the engine pins the session zone to UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text layout of timestamps in the source files, and the two
# delivery status labels of the dashboard.
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
ON_TIME_LABEL = "On Time"
LATE_LABEL = "Late"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hours_between(a: str | Column, b: str | Column) -> Column:
    """Hour boundaries crossed going from ``a`` to ``b``.

    The warehouse's ``dateDiff('hour', a, b)`` counts boundaries, so
    10:59 -> 11:01 is one hour, unlike ``timestampdiff`` which counts
    elapsed whole hours.  NULL when either side is NULL.
    """
    return F.floor(F.unix_seconds(_c(b)) / 3600) - F.floor(F.unix_seconds(_c(a)) / 3600)


def days_between(a: str | Column, b: str | Column) -> Column:
    """Calendar-day boundaries crossed going from ``a`` to ``b``."""
    return F.datediff(F.to_date(_c(b)), F.to_date(_c(a)))


def month_start(c: str | Column) -> Column:
    """First day of the month as a DATE (``toStartOfMonth``)."""
    return F.trunc(_c(c), "MM")


def parse_ts(c: str | Column) -> Column:
    """Parse source text to TIMESTAMP; empty or malformed text gives NULL."""
    col = _c(c)
    return F.try_to_timestamp(col, F.lit(TS_FORMAT))


def ident(name: str) -> str:
    """A column name quoted for SQL expression text."""
    return "`" + name.replace("`", "``") + "`"


def zfill_sql(name: str, width: int = 5) -> str:
    v = f"coalesce(CAST({ident(name)} AS STRING), '')"
    return f"CASE WHEN length({v}) < {width} THEN lpad({v}, {width}, '0') ELSE {v} END"


def parse_ts_sql(name: str) -> str:
    return f"try_to_timestamp({ident(name)}, '{TS_FORMAT}')"


def zfill(c: str | Column, width: int = 5) -> Column:
    """Left-pad with zeros up to ``width`` but never cut a longer value."""
    if isinstance(c, str):
        return F.expr(zfill_sql(c, width))
    col = F.coalesce(c.cast("string"), F.lit(""))
    return F.when(F.length(col) < width, F.lpad(col, width, "0")).otherwise(col)


def is_late(delivered: str | Column = "order_delivered_customer_date",
            estimated: str | Column = "order_estimated_delivery_date") -> Column:
    """Delivered after the estimate; NULL when either date is missing."""
    return _c(delivered) > _c(estimated)


def is_on_time(delivered: str | Column = "order_delivered_customer_date",
               estimated: str | Column = "order_estimated_delivery_date") -> Column:
    return _c(delivered) <= _c(estimated)


def delivery_status(delivered: str | Column = "order_delivered_customer_date",
                    estimated: str | Column = "order_estimated_delivery_date") -> Column:
    """'On Time' when delivered by the estimate, otherwise (NULL included) 'Late'."""
    return F.when(is_on_time(delivered, estimated), F.lit(ON_TIME_LABEL)).otherwise(F.lit(LATE_LABEL))


def pct(part: Column, whole: Column) -> Column:
    """``part * 100 / whole`` in double arithmetic; NULL instead of an error on 0."""
    return F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double"))
