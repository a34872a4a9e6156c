"""What states lose where the pool that is shared shrinks: a leaderboard from two statements, an audit from three."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import values
from . import relational as rel
from .ranking import numbered

# Rows of a statement that stand for all states together.
NATIONAL = ["All States and UTs", "Total"]


def state_of(name_cell: Column) -> Column:
    """The name in a statement's cell: what follows the first dot (``12. Name``), the whole cell where none is."""
    return F.trim(F.when(name_cell.contains("."), F.regexp_extract(name_cell, "(?s)^[^.]*\\.(.*)$", 1)).otherwise(name_cell))


def joined(statements: dict[str, DataFrame]) -> DataFrame:
    """state and one number for each of ``statements``, by column name; each has name_cell and value (text).

    Only states that all statements name, with no cell null, stay. A name that stands twice in a statement counts twice.
    Blanks, dashes and what is no number are zero. A null name joins nothing.
    """
    own = [df.where("name_cell is not null and value is not null").select(state_of(F.col("name_cell")).alias("state"), values.clean_value(F.col("value"), commas=True).alias(name)) for name, df in statements.items()]
    return reduce(lambda a, b: a.join(b, "state"), own)


def with_product(rows: DataFrame) -> DataFrame:
    """Rows whose liabilities and percent are positive, with the product of the state that both come to."""
    return rows.where("liabilities > 0 and percent > 0").withColumn("gsdp", values.gsdp(F.col("liabilities"), F.col("percent")))


def squeeze_leaderboard(liabilities: DataFrame, percent: DataFrame) -> DataFrame:
    """state, gsdp, gap, rank: the largest product and with it the largest gap first, equal products by name. Products that
    differ in the last bit may come to one gap, so the gap doesn't rank. Rows of all states together stay, as the gap is a
    fixed part of the product. No common state gives no rows."""
    rows = with_product(joined({"liabilities": liabilities, "percent": percent}))
    own = rows.select("state", "gsdp", values.squeeze_gap(F.col("gsdp")).alias("gap"))
    return numbered(own, [], [F.desc("gsdp"), F.col("state")])


def squeeze_audit(devolution: DataFrame, liabilities: DataFrame, percent: DataFrame, grants: DataFrame) -> DataFrame:
    """state, gsdp, devolution, gap, intensity, grants, local_intensity, rank of every state, the largest gap first, equal
    ones by name and product. ``grants`` (pos, state, amount): the first by pos of a name in either case counts, even if
    its amount is null. A state that reports none has null grants, which differ from zero."""
    rows = with_product(joined({"devolution": devolution, "liabilities": liabilities, "percent": percent})).where(~F.col("state").isin(NATIONAL))
    first = grants.where("state is not null").groupBy(F.lower("state").alias("key")).agg(F.min_by(F.struct("amount"), "pos").alias("own"))
    rows = rows.withColumn("gap", values.devolution_gap(F.col("devolution"))).join(first, F.lower("state") == F.col("key"), "left")
    part = lambda c: 100 * F.col(c) / F.col("gsdp")
    out = rows.withColumn("grants", F.col("own.amount")).select("state", "gsdp", "devolution", "gap", part("gap").alias("intensity"), "grants", part("grants").alias("local_intensity"))
    return numbered(out, [], [F.desc("gap"), F.col("state"), F.col("gsdp")])


def audit_totals(audit: DataFrame) -> DataFrame:
    """gsdp, gap, grants, intensity of all states of an audit: one row."""
    return rel.national_totals(audit)
