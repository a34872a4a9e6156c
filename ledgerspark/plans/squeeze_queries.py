"""Queries of the leaderboard and the audit of shrinking transfers, over statements of all customers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import squeeze
from .bindings import table
from .registry import query


def named(key):
    return F.concat(key.cast("string"), F.lit(". Customer "), key.cast("string"))


def with_total(rows):
    """A statement with its row for all states."""
    total = rows.agg(F.lit("Total").alias("name_cell"), F.sum(F.replace("value", F.lit(","), F.lit("")).try_cast("decimal(38,2)")).cast("string").alias("value"))
    return rows.unionByName(total)


def statements(spark, sf_dir):
    """Devolution, liabilities and percent of every customer, as text: amounts with commas, dashes, some cells empty or null,
    some customers twice in the last one."""
    t = lambda n: table(spark, sf_dir, n)
    given = t("orders").groupBy("o_custkey").agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("v"))
    devolution = given.select(named(F.col("o_custkey")).alias("name_cell"), F.col("v").cast("string").alias("value"))
    key, balance = F.col("c_custkey"), F.col("c_acctbal").cast("decimal(18,2)")
    owed = F.when(key % 17 == 0, None).when(key % 13 == 0, " - ").otherwise(F.format_number(balance, 2))
    liabilities = t("customer").select(named(key).alias("name_cell"), owed.alias("value"))
    pct = lambda more: F.when(key % 19 == 0, None).when(key % 23 == 0, "n.a.").otherwise(F.concat((key % 40 + more).cast("string"), F.lit(".3")))
    percent = t("customer").select(named(key).alias("name_cell"), pct(7).alias("value")).unionByName(t("customer").where(key % 50 == 0).select(named(key).alias("name_cell"), pct(8).alias("value")))
    whole = spark.range(1).select(F.lit("Total").alias("name_cell"), F.lit("27.3").alias("value"))
    return with_total(devolution), with_total(liabilities), percent.unionByName(whole)


def grants(spark, sf_dir):
    """pos, state, amount of urgent orders, names in capitals; some amounts null."""
    key = F.col("o_custkey")
    amount = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice"))
    return table(spark, sf_dir, "orders").where("o_orderpriority like '1%'").select(F.col("o_orderkey").alias("pos"), F.concat(F.lit("CUSTOMER "), key.cast("string")).alias("state"), amount.alias("amount"))


STATEMENTS = """d AS (SELECT 'Customer ' || o_custkey AS state, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS devolution FROM orders GROUP BY 1
  UNION ALL SELECT 'Total', CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) FROM orders),
l AS (SELECT 'Customer ' || c_custkey AS state, CASE WHEN c_custkey % 13 <> 0 THEN CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) ELSE 0 END AS liabilities FROM customer WHERE c_custkey % 17 <> 0
  UNION ALL SELECT 'Total', CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) FROM customer WHERE c_custkey % 17 <> 0 AND c_custkey % 13 <> 0),
p AS (SELECT 'Customer ' || c_custkey AS state, CASE WHEN c_custkey % 23 = 0 THEN 0 ELSE CAST((c_custkey % 40 + k) || '.3' AS DOUBLE) END AS pct FROM customer, (VALUES (7), (8)) t(k) WHERE c_custkey % 19 <> 0 AND (k = 7 OR c_custkey % 50 = 0)
  UNION ALL SELECT 'Total', 27.3),
g AS (SELECT 'Customer ' || o_custkey AS state, arg_min_null(CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END, o_orderkey) AS grants FROM orders WHERE o_orderpriority LIKE '1%' GROUP BY 1),
both_ AS (SELECT state, liabilities / (pct / 100) AS gsdp FROM l JOIN p USING (state) WHERE liabilities > 0 AND pct > 0),
audit AS (SELECT state, gsdp, devolution, devolution * 0.217 / 0.783 AS gap, grants FROM both_ JOIN d USING (state) LEFT JOIN g USING (state) WHERE state <> 'Total')"""


def rounded(number, digits):
    """A double as the SQL rounds it: halves of the scaled number go away from zero. Spark's own looks at its decimal digits."""
    return F.round(number * 10.0**digits) / 10.0**digits


def audit(spark, sf_dir):
    devolution, liabilities, percent = statements(spark, sf_dir)
    return squeeze.squeeze_audit(devolution, liabilities, percent, grants(spark, sf_dir))


@query("job_16_leaderboard", f"WITH {STATEMENTS} SELECT state, round(gsdp, 2) AS gsdp, round(gsdp * 0.12 * 0.41 * 0.217, 2) AS gap, row_number() OVER (ORDER BY gsdp DESC, state) AS rank FROM both_")
def job_16_leaderboard(spark, sf_dir):
    """Gaps by the product, ranked."""
    _, liabilities, percent = statements(spark, sf_dir)
    return squeeze.squeeze_leaderboard(liabilities, percent).select("state", rounded(F.col("gsdp"), 2).alias("gsdp"), rounded(F.col("gap"), 2).alias("gap"), "rank")


@query("job_16_audit", f"WITH {STATEMENTS} SELECT state, round(gsdp, 2) AS gsdp, devolution, round(gap, 2) AS gap, round(100 * gap / gsdp, 4) AS intensity, grants, round(100 * grants / gsdp, 4) AS local_intensity, row_number() OVER (ORDER BY gap DESC, state, gsdp) AS rank FROM audit")
def job_16_audit(spark, sf_dir):
    """Gaps by what was given, grants to local bodies beside them, ranked."""
    places = {"gsdp": 2, "gap": 2, "intensity": 4, "local_intensity": 4}
    return audit(spark, sf_dir).withColumns({c: F.round(c, n) for c, n in places.items()})


@query("job_16_totals", f"WITH {STATEMENTS} SELECT round(sum(gsdp), 0) AS gsdp, round(sum(gap), 0) AS gap, round(sum(grants), 0) AS grants, round(100 * sum(gap) / sum(gsdp), 4) AS intensity FROM audit")
def job_16_totals(spark, sf_dir):
    """The audit's sums over all states."""
    places = {"gsdp": 0, "gap": 0, "grants": 0, "intensity": 4}
    return squeeze.audit_totals(audit(spark, sf_dir)).select(*[F.round(c, n).alias(c) for c, n in places.items()])
