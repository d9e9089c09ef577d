"""Joins and groupings of rows that one key, or one width, would make costly.

``spread_join``: facts meet a dimension on a key that a few values dominate (one order with a third of all items).  The
heavy keys are found first, in a sample; their fact rows are dealt to salts by a hash of another column, and the
dimension's rows of these keys are repeated once for each salt.  No other row is repeated, and every fact row meets each
matching dimension row exactly once, whichever keys the sample finds.

``row_groups``: equal rows of a wide table.  Rows are first counted by a hash of all their columns, so only eight bytes of each
move; the rows themselves are moved and compared only where a hash repeats (or shares a bit with one that does).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAVY_KEYS = 1000  # keys that the sample may name: what is broadcast
SAMPLE, SAMPLE_ROWS = 0.01, 32  # share of the facts looked at, and how often a heavy key is seen there at least
SALTS = 64
SPREAD_BYTES = 1 << 30  # facts that the planner takes to be smaller are joined as they are
SEED = 17
MARK_BITS = 27  # bits of a row's hash that say whether the row may have an equal
BITMAP = 32768  # bits of one bitmap of ``bitmap_construct_agg``
_BUCKET = f"shiftright(_h, 15) & {(1 << MARK_BITS) // BITMAP - 1}"


def planned_bytes(df: DataFrame) -> int:
    """What the optimizer estimates a frame to hold (nothing is run)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def heavy_keys(facts: DataFrame, key: str, sample: float = SAMPLE, least: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``HEAVY_KEYS`` values of ``key``, those most frequent in a sample and seen ``least`` times there."""
    some = facts.select(key) if sample >= 1 else facts.select(key).sample(sample, SEED)
    return (some.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_seen")).filter(F.col("_seen") >= least)
            .orderBy(F.desc("_seen"), key).limit(HEAVY_KEYS).select(F.col(key).alias("_heavy")))


def spread_join(facts: DataFrame, dimension: DataFrame, key: str, by: str, salts: int | None = None, sample: float = SAMPLE,
                least: int = SAMPLE_ROWS) -> DataFrame:
    """``facts.join(dimension, key)``; heavy keys are dealt to ``salts`` (None: ``SALTS`` for facts of ``SPREAD_BYTES``, else not).

    ``by``: the column of the facts that tells rows of one key apart.  (A hash of it, not a random number: a
    task that is run again deals its rows as before.)
    """
    if salts is None:
        salts = SALTS if planned_bytes(facts) >= SPREAD_BYTES else 1
    if salts < 2:
        return facts.join(dimension, key)
    heavy = F.broadcast(heavy_keys(facts, key, sample, least))
    is_heavy = F.col("_heavy").isNotNull()
    dealt = facts.join(heavy, F.col(key) == F.col("_heavy"), "left").withColumn(
        "_salt", F.when(is_heavy, F.pmod(F.xxhash64(by), F.lit(salts)).cast("int")).otherwise(0))
    repeated = dimension.join(heavy, F.col(key) == F.col("_heavy"), "left").withColumn(
        "_salt", F.explode(F.when(is_heavy, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    return dealt.drop("_heavy").join(repeated.drop("_heavy"), [key, "_salt"]).drop("_salt")


def row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[F.col(c) for c in df.columns])


def _marks(again: DataFrame) -> DataFrame:
    """Bitmaps (``_bucket``, ``_bits``) of the low ``MARK_BITS`` of the hashes ``_h``: 16 MB, however many there are."""
    return (again.select(F.expr(_BUCKET).alias("_bucket"), F.expr(f"_h & {BITMAP - 1}").alias("_at"))
            .groupBy("_bucket").agg(F.bitmap_construct_agg("_at").alias("_bits")))


def _marked(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """``rows`` with ``_marked``: whether the bit of their hash ``_h`` is set.  Nothing is shuffled."""
    known = F.broadcast(marks.select(F.col("_bucket").alias("_b"), "_bits"))
    return (rows.join(known, F.expr(_BUCKET) == F.col("_b"), "left")
            .withColumn("_marked", F.expr(f"coalesce(shiftright(CAST(conv(hex(substring(_bits, CAST((_h & {BITMAP - 1}) / 8 AS INT) + 1, 1)), 16, 10) "
                                          "AS INT), CAST(_h & 7 AS INT)) & 1, 0) = 1")).drop("_b", "_bits"))


def row_groups(df: DataFrame, count: str, hashed=row_hash) -> tuple[DataFrame, DataFrame]:
    """(groups of equal rows among those marked, with ``count``; (``_h``, ``_n``, ``_marked``) of the hashes of all rows).

    Marked are all rows whose hash occurs more than once, and the few whose hash shares a bit with such a one; the others are
    unique.  Marks are broadcast, so an unmarked row is never moved: only its hash is.
    """
    by_hash = df.select(hashed(df).alias("_h")).groupBy("_h").agg(F.count(F.lit(1)).alias("_n"))
    marks = _marks(by_hash.filter("_n > 1"))
    rows = _marked(df.withColumn("_h", hashed(df)), marks).filter("_marked")
    return rows.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(count)), _marked(by_hash, marks)
