"""Ranks over tables of any size: a range partition, counts of its parts, prefix sums, ranks within."""

from __future__ import annotations

from collections.abc import Callable
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import staged


def numbered(df: DataFrame, keys: list[str], order: list[Column], out: str = "rank", stage: Callable[[DataFrame, str], DataFrame] = staged) -> DataFrame:
    """``df`` with each row's number from 1 within its ``keys`` in ``order``; without keys, within the table.

    Rows are dealt by range of (keys, order), so a key of any size spreads over as many parts as it fills; only rows that
    are equal in all of them share a part, and then any of them may come first. What comes before a part is the sum of
    the parts before it: one row for each key and part. Rows are written once, so that both passes see the same parts.
    Null keys form a key. No rows give no rows.
    """
    by = [*(F.col(k).asc_nulls_first() for k in keys), *order]
    rows = stage(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("__at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("__at", 33)
    sizes = rows.groupBy(*keys, part.alias("__part")).agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    if keys:
        before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
        bases = sizes.select(*keys, "__part", (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__base"))
    else:
        found = sorted(sizes.collect())  # one row a part
        sums = accumulate((r["__n"] for r in found), initial=0)
        bases = df.sparkSession.createDataFrame([(r["__part"], s - r["__first"]) for r, s in zip(found, sums, strict=False)], "__part long, __base long")
    same = part == F.col("__other_part")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__other_{k}"))
    bases = bases.select(*[F.col(c).alias(f"__other_{c.removeprefix('__')}") if c != "__base" else F.col(c) for c in bases.columns])
    return rows.join(bases, same).select(*df.columns, (F.col("__at") + F.col("__base") + 1).alias(out))


def ranked(df: DataFrame, measure: str, ties: list[str], out: str = "rank", stage: Callable[[DataFrame, str], DataFrame] = staged) -> DataFrame:
    """Ranks of the whole table by falling ``measure``: equal values share the smallest, as in ``RANK()``; null values come
    last. ``ties`` order rows of one value among parts."""
    rows = numbered(df, [], [F.desc_nulls_last(measure), *[F.col(t).asc_nulls_first() for t in ties]], "__row", stage)
    first = rows.groupBy(F.col(measure).alias("__value")).agg(F.min("__row").alias(out))
    return rows.join(first, F.col(measure).eqNullSafe(F.col("__value"))).select(*df.columns, out)
