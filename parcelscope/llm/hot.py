"""Joins in which one key may hold a third of all rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

BROADCAST_GROUPS = 200_000  # small rows that a broadcast may hold
HEAVY = 1000  # a key is heavy with more than one in HEAVY of the grouped rows, so there are fewer than HEAVY


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, limit: int = BROADCAST_GROUPS) -> DataFrame:
    """``rows`` left-joined with ``groups``: one row for each key, ``size`` telling how many rows have it (dropped).

    Nulls in keys are equal.  The groups are written and counted: up to ``limit`` are broadcast.  Beyond, those of
    heavy keys are, fewer than ``HEAVY`` by arithmetic, and the other rows are shuffled by key, none of which
    then brings more than one in ``HEAVY`` of the rows to a task.
    """
    groups = written(groups, "groups")
    count, total = groups.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    others = [c for c in groups.columns if c not in keys]
    right = groups.select(*[F.col(k).alias(f"_key_{k}") for k in keys], *others)
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys))

    def plain(df: DataFrame) -> DataFrame:
        return df.drop(size, *[f"_key_{k}" for k in keys])

    if count <= limit:
        return plain(rows.join(F.broadcast(right), same, "left"))
    heavy = F.col(size) > total / HEAVY
    hot = F.broadcast(right.filter(heavy))
    return plain(rows.join(hot, same)).unionByName(
        plain(rows.join(hot, same, "left_anti").join(right.filter(~heavy), same, "left")))
