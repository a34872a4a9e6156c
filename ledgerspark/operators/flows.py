"""Sector flows as a drawing needs them: numbered nodes, links by number, figures beside them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fiscal
from . import relational as rel

POOL = "Total Disbursements"
# The figures that stand beside a flow, by sector and sub-sector.
DUAL = {"interest": ("general", "Interest payments"), "repayment": ("debt", "Public debt repayment"), "health": ("social", "Health & family welfare"), "water": ("social", "Water supply & sanitation")}


def flow_levels(lines: DataFrame, keys: list[str]) -> DataFrame:
    """keys, level (0 sub-sector, 1 sector, 3 all), sector, sub_sector, amount."""
    return rel.sector_rollup(lines, keys)


def flow_nodes(levels: DataFrame, keys: list[str]) -> DataFrame:
    """keys, node, kind, name, sector, amount: the pool is 0, each sector is followed by its sub-sectors, largest first.

    Numbers are those of a walk from the top: a sector's is one more than the pool and all subtrees before it, so it
    needs their sizes only, five for each key; a sub-sector's adds its rank among its sector's, a few dozens. A sector
    whose sum is zero is left out with its sub-sectors. Equal amounts are in order of name.
    """
    subs, sectors = levels.where("level = 0"), levels.where("level = 1 AND amount <> 0").select(*keys, "sector", F.col("amount").alias("sector_amount"))
    ranked = subs.withColumn("rank", F.row_number().over(Window.partitionBy(*keys, "sector").orderBy(F.desc("amount"), "sub_sector"))).join(sectors, [*keys, "sector"])
    sizes = ranked.groupBy(*keys, "sector").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(*keys).orderBy(fiscal.sector_order(F.col("sector"))).rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select(*keys, "sector", (F.coalesce(F.sum(F.col("n") + 1).over(before), F.lit(0)) + 1).alias("first"))
    pool = levels.where("level = 3").select(*keys, F.lit(0).cast("long").alias("node"), F.lit("pool").alias("kind"), F.lit(POOL).alias("name"), F.lit(None).cast("string").alias("sector"), "amount")
    tops = first.join(sectors, [*keys, "sector"]).select(*keys, F.col("first").cast("long").alias("node"), F.lit("sector").alias("kind"), F.col("sector").alias("name"), "sector", F.col("sector_amount").alias("amount"))
    leaves = ranked.join(first, [*keys, "sector"]).select(*keys, (F.col("first") + F.col("rank")).cast("long").alias("node"), F.lit("sub_sector").alias("kind"), F.col("sub_sector").alias("name"), "sector", "amount")
    return pool.unionByName(tops).unionByName(leaves)


def flow_links(nodes: DataFrame, keys: list[str]) -> DataFrame:
    """keys, source, target, value: pool to sector and sector to sub-sector, by node numbers, values to one decimal."""
    tops = nodes.where("kind = 'sector'").select(*keys, "sector", F.col("node").alias("above"))
    rows = nodes.where("kind <> 'pool'").join(tops, [*keys, "sector"])
    source = F.when(F.col("kind") == "sector", F.lit(0).cast("long")).otherwise(F.col("above"))
    return rows.select(*keys, source.alias("source"), F.col("node").alias("target"), F.round("amount", 1).alias("value"))


def flow_figures(levels: DataFrame, keys: list[str]) -> DataFrame:
    """keys, total and the figures of ``DUAL``, 0 where there are none, to one decimal."""
    pick = lambda a, b: F.sum(F.when((F.col("level") == 0) & (F.col("sector") == a) & (F.col("sub_sector") == b), F.col("amount")))
    figures = {"total": F.sum(F.when(F.col("level") == 3, F.col("amount")))} | {name: pick(*x) for name, x in DUAL.items()}
    return levels.groupBy(*keys).agg(*[F.round(F.coalesce(c, F.lit(0)), 1).alias(n) for n, c in figures.items()])
