"""Fiscal inputs made of the given tables, and the same as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fiscal


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def budget_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """state, fy, col_type, major, sub, minor, amount (lakh), order and line keys of every line item."""
    t = lambda n: table(spark, sf_dir, n)
    part = F.col("l_partkey")
    number = F.when(part % 3 == 0, part * 97 % 9000).otherwise(2000 + part * 97 % 1700)
    rows = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select(
        F.col("n_name").alias("state"),
        fiscal.fy_of_date(F.col("o_orderdate")).alias("fy"),
        F.when(F.col("o_orderstatus") == "P", "be").when(F.col("o_orderstatus") == "O", "re").otherwise("actual").alias("col_type"),
        F.lpad(number.cast("string"), 4, "0").alias("major"),
        F.lpad((F.col("l_suppkey") % 100).cast("string"), 2, "0").alias("sub"),
        F.lpad(F.col("l_linenumber").cast("string"), 3, "0").alias("minor"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
        "l_orderkey", "l_linenumber", "l_partkey",
    )


LINES = """lines AS (
  SELECT n_name AS state, y || '-' || lpad(CAST((y + 1) % 100 AS VARCHAR), 2, '0') AS fy,
    CASE o_orderstatus WHEN 'P' THEN 'be' WHEN 'O' THEN 're' ELSE 'actual' END AS col_type,
    lpad(CAST(m AS VARCHAR), 4, '0') AS major, lpad(CAST(l_suppkey % 100 AS VARCHAR), 2, '0') AS sub, lpad(CAST(l_linenumber AS VARCHAR), 3, '0') AS minor,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, l_orderkey, l_linenumber, l_partkey
  FROM (SELECT *, CASE WHEN l_partkey % 3 = 0 THEN l_partkey * 97 % 9000 ELSE 2000 + l_partkey * 97 % 1700 END AS m,
          year(o_orderdate) - CASE WHEN month(o_orderdate) < 4 THEN 1 ELSE 0 END AS y
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey))"""


def rules_sql(column: str) -> tuple[str, str]:
    """The classification as two CASE expressions over a four-digit head."""
    number, digit = f"CAST({column} AS INT)", f"substr({column}, 1, 1)"
    twin = f"(CASE WHEN {digit} IN ('4', '5') THEN {number} - 2000 ELSE {number} END)"
    financing = [f"WHEN {digit} IN ('6', '7') AND {number} BETWEEN {a} AND {z} THEN" for a, z, _ in fiscal.FINANCING]
    other = [f"WHEN {twin} BETWEEN {a} AND {z} THEN" for a, z, *_ in fiscal.RULES]
    sector = " ".join([*(f"{w} 'debt'" for w in financing), *(f"{w} '{r[2]}'" for w, r in zip(other, fiscal.RULES, strict=True))])
    label = " ".join([*(f"{w} '{r[2]}'" for w, r in zip(financing, fiscal.FINANCING, strict=True)), *(f"{w} '{r[3]}'" for w, r in zip(other, fiscal.RULES, strict=True))])
    return f"CASE {sector} ELSE '{fiscal.OTHERWISE[0]}' END", f"CASE {label} ELSE '{fiscal.OTHERWISE[1]}' END"


def heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """code, parent_code, kind, label: the chart of accounts that the lines use. A label is the first part's name."""
    own = budget_lines(spark, sf_dir).groupBy("major", "sub", "minor").agg(F.min("l_partkey").alias("first_part"))
    major, sub = F.col("major"), F.col("sub")
    levels = F.array(
        F.struct(major.alias("code"), F.lit(None).cast("string").alias("parent_code"), F.lit("major").alias("kind")),
        F.struct(F.when(sub != "00", F.concat_ws("-", major, sub)).alias("code"), major.alias("parent_code"), F.lit("submajor").alias("kind")),
        F.struct(fiscal.head_code(major, sub, F.col("minor")).alias("code"), fiscal.parent_code(major, sub).alias("parent_code"), F.lit("minor").alias("kind")),
    )
    rows = own.select(F.explode(levels).alias("h"), "first_part").where("h.code is not null")
    codes = rows.groupBy("h.code", "h.parent_code", "h.kind").agg(F.min("first_part").alias("first_part"))
    names = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("first_part"), F.col("p_name").alias("label"))
    return codes.join(names, "first_part").select("code", "parent_code", "kind", "label")


HEADS = LINES + """, heads AS (
  SELECT code, parent_code, kind, arg_min(p_name, l_partkey) AS label FROM (
    SELECT major AS code, NULL AS parent_code, 'major' AS kind, l_partkey FROM lines
    UNION ALL SELECT major || '-' || sub, major, 'submajor', l_partkey FROM lines WHERE sub <> '00'
    UNION ALL SELECT major || '-' || sub || '-' || minor, CASE WHEN sub = '00' THEN major ELSE major || '-' || sub END, 'minor', l_partkey FROM lines
  ) JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3)"""


def versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two snapshots of a code list (code, parent_code, label)."""
    part, key = table(spark, sf_dir, "part"), F.col("p_partkey")
    code = F.lpad(key.cast("string"), 9, "0").alias("code")
    old = part.where(key % 10 != 0).select(code, F.col("p_brand").alias("parent_code"), F.col("p_name").alias("label"))
    new = part.where(key % 11 != 0).select(code, F.when(key % 13 == 0, F.concat("p_brand", F.lit("x"))).otherwise(F.col("p_brand")).alias("parent_code"), F.when(key % 7 == 0, F.concat("p_name", F.lit(" II"))).otherwise(F.col("p_name")).alias("label"))
    return old, new


VERSIONS = """v1 AS (SELECT lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS code, p_brand AS parent_code, p_name AS label FROM part WHERE p_partkey % 10 <> 0),
v2 AS (SELECT lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS code, CASE WHEN p_partkey % 13 = 0 THEN p_brand || 'x' ELSE p_brand END AS parent_code,
  CASE WHEN p_partkey % 7 = 0 THEN p_name || ' II' ELSE p_name END AS label FROM part WHERE p_partkey % 11 <> 0)"""


def slip_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """code, action, label, ts, event_id: changes to the code list."""
    kind = F.col("event_type")
    action = F.when(kind == "signup", "INSERT").when(kind == "error", "DELETE").when(kind == "click", "RENAME").when(kind == "purchase", "UPDATE")
    rows = table(spark, sf_dir, "events").withColumn("action", action).where("action is not null")
    return rows.select(F.lpad((F.col("user_id") % 9000).cast("string"), 4, "0").alias("code"), "action", F.concat(F.lit("L"), F.col("event_id").cast("string")).alias("label"), "ts", "event_id")


EVENTS = """slips AS (SELECT * FROM (SELECT lpad(CAST(user_id % 9000 AS VARCHAR), 4, '0') AS code,
  CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' WHEN 'click' THEN 'RENAME' WHEN 'purchase' THEN 'UPDATE' END AS action,
  'L' || event_id AS label, ts, event_id FROM events) WHERE action IS NOT NULL)"""


def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """name_cell, state, liabilities, pct, devolution, grants: one row per state."""
    t = lambda n: table(spark, sf_dir, n)
    owed = t("customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.sum(F.col("c_acctbal").cast("decimal(18,2)")).alias("liabilities"))
    given = t("supplier").groupBy(F.col("s_nationkey").alias("k2")).agg(F.sum(F.col("s_acctbal").cast("decimal(18,2)")).alias("devolution"))
    key = F.col("n_nationkey")
    rows = t("nation").join(owed, key == F.col("k"), "left").join(given, key == F.col("k2"), "left")
    amount = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("double")
    return rows.select(
        F.concat((key + 1).cast("string"), F.lit(". "), F.col("n_name")).alias("name_cell"), F.col("n_name").alias("state"), amount("liabilities").alias("liabilities"),
        (10.0 + key).alias("pct"), amount("devolution").alias("devolution"), F.when(key % 4 != 0, amount("devolution") / 2).alias("grants"),
    )


STATEMENTS = """statements AS (
  SELECT CAST(n_nationkey + 1 AS VARCHAR) || '. ' || n_name AS name_cell, n_name AS state, CAST(coalesce(liabilities, 0) AS DOUBLE) AS liabilities,
    CAST(10 + n_nationkey AS DOUBLE) AS pct, CAST(coalesce(devolution, 0) AS DOUBLE) AS devolution,
    CASE WHEN n_nationkey % 4 <> 0 THEN CAST(coalesce(devolution, 0) AS DOUBLE) / 2 END AS grants
  FROM nation LEFT JOIN (SELECT c_nationkey AS k, sum(CAST(c_acctbal AS DECIMAL(18,2))) AS liabilities FROM customer GROUP BY 1) ON n_nationkey = k
  LEFT JOIN (SELECT s_nationkey AS k2, sum(CAST(s_acctbal AS DECIMAL(18,2))) AS devolution FROM supplier GROUP BY 1) ON n_nationkey = k2)"""


def probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, state, ext, chars (null where no probe exists), tables, text of every document."""
    key = F.col("doc_id")
    ext = F.element_at(F.array(*map(F.lit, ["pdf", "xls", "xlsx", "csv", "html"])), (key % 5 + 1).cast("int"))
    return table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("state"), ext.alias("ext"), F.when(key % 3 != 0, F.col("n_chars")).alias("chars"), (key % 4).alias("tables"), "text", "lang")


PROBES = """probes AS (SELECT doc_id, source AS state, CASE doc_id % 5 WHEN 0 THEN 'pdf' WHEN 1 THEN 'xls' WHEN 2 THEN 'xlsx' WHEN 3 THEN 'csv' ELSE 'html' END AS ext,
  CASE WHEN doc_id % 3 <> 0 THEN n_chars END AS chars, doc_id % 4 AS tables, text, lang FROM documents)"""


def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, line_no (from 0), line of every document."""
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


TEXT_LINES = """text_lines AS (SELECT doc_id, CAST(unnest(range(0, len(parts))) AS INT) AS line_no, unnest(parts) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))"""


def amount_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, line_no, line: a label and two amounts, one for each line item."""
    own = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    two = lambda c: F.col(c).cast("decimal(18,2)").cast("string")
    return own.select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("line_no"), F.concat_ws("  ", "p_name", two("l_extendedprice"), two("l_quantity")).alias("line"))


AMOUNT_LINES = """amount_lines AS (SELECT l_orderkey AS doc_id, l_linenumber AS line_no,
  p_name || '  ' || CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) || '  ' || CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR) AS line FROM lineitem JOIN part ON l_partkey = p_partkey)"""
