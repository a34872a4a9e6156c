"""Queries over amounts of several sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import crosscheck
from ..operators.staging import staged
from .bindings import LINES, budget_lines
from .registry import query

SUMS = f"""{LINES}, sums AS (SELECT state, fy, major AS head, col_type AS source, sum(amount) AS amount FROM lines GROUP BY ALL)"""


def sums(spark, sf_dir):
    """state, fy, head, source, amount: each estimate taken for a source of its own."""
    rows = budget_lines(spark, sf_dir).groupBy("state", "fy", F.col("major").alias("head"), F.col("col_type").alias("source"))
    return rows.agg(F.sum("amount").cast("decimal(28,2)").alias("amount"))


@query("chk_01", f"WITH {SUMS} SELECT state, fy, head, count(*) AS n_sources, arg_min(source, (amount, source)) AS lowest, arg_max(source, (amount, source)) AS highest, max(amount) - min(amount) AS gap FROM sums GROUP BY ALL HAVING max(amount) - min(amount) > 5000")
def chk_01(spark, sf_dir):
    """Heads on which the sources differ."""
    return crosscheck.discrepancies(sums(spark, sf_dir), ["state", "fy", "head"], 5000)


@query("chk_02", f"WITH {SUMS} SELECT a.state, a.fy, a.head, b.head AS other_head, abs(a.amount - b.amount) AS gap FROM sums a JOIN sums b ON a.state = b.state AND a.fy = b.fy AND a.source = 're' AND b.source = 'actual' AND abs(a.amount - b.amount) <= 10")
def chk_02(spark, sf_dir):
    """Heads of two sources with nearly the same amount, whatever they are called."""
    found = staged(sums(spark, sf_dir), "sums")
    of = lambda source: found.where(F.col("source") == source).select("state", "fy", "head", "amount")
    return crosscheck.agreeing(of("re"), of("actual"), ["state", "fy"], 10)


@query("chk_03", f"WITH {SUMS} SELECT state, fy, head, amount FROM sums a WHERE source = 're' AND NOT EXISTS (SELECT 1 FROM sums b WHERE a.state = b.state AND a.fy = b.fy AND b.source = 'actual' AND abs(a.amount - b.amount) <= 100)")
def chk_03(spark, sf_dir):
    """Amounts of one source that the other has under no name."""
    found = staged(sums(spark, sf_dir), "sums")
    of = lambda source: found.where(F.col("source") == source).select("state", "fy", "head", "amount")
    return crosscheck.unmatched(of("re"), of("actual"), ["state", "fy"], 100)
