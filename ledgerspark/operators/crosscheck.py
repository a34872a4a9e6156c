"""Amounts of the same thing from several sources: those that don't agree, and those that do under other names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def discrepancies(amounts: DataFrame, keys: list[str], tolerance: float) -> DataFrame:
    """keys, n_sources, lowest, highest, gap of the keys whose sources differ by more than ``tolerance``; ``amounts`` has
    keys, source, amount. A source's amounts of one key are added up; null amounts don't count."""
    each = amounts.where("amount is not null").groupBy(*keys, "source").agg(F.sum("amount").alias("amount"))
    found = each.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_sources"), F.min_by("source", F.struct("amount", "source")).alias("lowest"), F.max_by("source", F.struct("amount", "source")).alias("highest"), (F.max("amount") - F.min("amount")).alias("gap"))
    return found.where(F.col("gap") > tolerance)


def agreeing(left: DataFrame, right: DataFrame, keys: list[str], tolerance: float) -> DataFrame:
    """Pairs of rows of ``left`` and ``right`` (keys, head, amount) with equal keys and amounts at most ``tolerance`` apart:
    keys, head, other_head, gap.

    Amounts are cut into bands as wide as the tolerance, so a partner is in the same band or a neighbour: the right side
    is sent to three bands and the join is one of equal keys, which splits a hot one, instead of a range join.
    """
    band = F.floor(F.col("amount") / tolerance)
    mine = left.select(*keys, "head", "amount", band.alias("band"))
    other = right.select(*keys, F.col("head").alias("other_head"), F.col("amount").alias("other"), F.explode(F.array(band - 1, band, band + 1)).alias("band"))
    gap = F.abs(F.col("amount") - F.col("other"))
    return mine.join(other, [*keys, "band"]).where(gap <= tolerance).select(*keys, "head", "other_head", gap.alias("gap"))


def unmatched(left: DataFrame, right: DataFrame, keys: list[str], tolerance: float) -> DataFrame:
    """Rows of ``left`` (keys, head, amount) that no row of ``right`` agrees with under any name."""
    return left.join(agreeing(left, right, keys, tolerance).select(*keys, "head").distinct(), [*keys, "head"], "left_anti")
