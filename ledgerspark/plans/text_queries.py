"""Queries of pages with tables and lines, of indicators in whole texts, and of wages without a notification."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fiscal
from ..operators import jobs, wages
from ..operators.staging import staged
from .bindings import table
from .job_queries import CENTRAL, RECEIPTS, canonical, estimates_sql, grid, label_sql, receipt_lines, sheets
from .registry import query

PAGES = """l AS (SELECT l_orderkey AS doc_id, l_linenumber % 3 AS page_no, l_linenumber AS line_no, p_name, CAST(CAST(l_quantity AS INT) AS DOUBLE) AS total FROM lineitem JOIN part ON l_partkey = p_partkey),
k AS (SELECT p_name, min(p_brand) AS scheme FROM part WHERE NOT contains(p_name, 'old') GROUP BY 1),
rows_ AS (SELECT doc_id, page_no, line_no, p_name, total + CASE WHEN page_no = 1 THEN 1000.5 ELSE 0 END AS total FROM l WHERE contains(p_name, 'ring') OR contains(p_name, 'rod')),
y AS (SELECT o_orderkey AS doc_id, CASE WHEN month(o_orderdate) < 4 THEN year(o_orderdate) - 1 ELSE year(o_orderdate) END AS y FROM orders)"""


PAGED = """found AS (SELECT doc_id, scheme, y || '-' || lpad(CAST((y + 1) % 100 AS VARCHAR), 2, '0') AS fy, arg_min(total, (page_no, line_no, p_name, total)) AS total FROM rows_ JOIN k USING (p_name) JOIN y USING (doc_id)
  WHERE (doc_id, page_no) IN (SELECT (doc_id, page_no) FROM l WHERE contains(p_name, 'red')) GROUP BY ALL)"""
HEADERS, KEYWORDS = ["Red"], ["RING", "rod"]


def pages(spark, sf_dir):
    """lines, table rows and known names of orders as documents: the second page of each holds a table."""
    part = table(spark, sf_dir, "part")
    rows = table(spark, sf_dir, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    amount, named = F.col("l_quantity").cast("int"), F.concat(F.lit("S "), "p_name")
    own = rows.select(F.col("l_orderkey").alias("doc_id"), (F.col("l_linenumber") % 3).alias("page_no"), F.col("l_linenumber").alias("line_no"), F.concat_ws("  ", named, amount.cast("string")).alias("line"), named.alias("name"), amount.alias("amount"))
    text = F.format_string("%,d.50", F.col("amount") + 1000)
    cells = F.array(F.concat(F.lit(" "), "name"), F.lit("9"), F.lit(None).cast("string"), text, F.lit("nan"), F.lit(" "))
    tables = own.where("page_no = 1").select("doc_id", "page_no", F.lit(0).alias("table_no"), F.col("line_no").alias("row_no"), cells.alias("cells"))
    names = part.where("not contains(p_name, 'old')").groupBy(named.alias("source_name")).agg(F.min("p_brand").alias("canonical"))
    return own.select("doc_id", "page_no", "line_no", "line"), tables, names


def order_years(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), fiscal.fy_of_date(F.col("o_orderdate")).alias("fy"))


@query("job_02_pages", f"WITH {PAGES}, {PAGED} SELECT substr(sha256(concat_ws('|', doc_id, scheme, fy, 'be')), 1, 16) AS id, doc_id, scheme, 'be' AS col_type, fy AS fiscal_year, total FROM found")
def job_02_pages(spark, sf_dir):
    """Schemes on pages that name a colour: of every order's second page the table, of others the lines."""
    lines, tables, names = pages(spark, sf_dir)
    return jobs.allocations_of_pages(lines, tables, order_years(spark, sf_dir), names, HEADERS, KEYWORDS)


# sheets d0 to d39, every third of them no sheet by its extension; orders by their route; a fourth of the sheets is known already
@query("job_01_snapshot", f"""WITH {estimates_sql('2, 3')}, {PAGES}, {PAGED}, s AS (SELECT substr(sha256(concat_ws('|', doc_id, 'icds', {label_sql('y')}, col_type)), 1, 16) AS id, doc_id, 'icds' AS scheme, col_type, {label_sql('y')} AS fiscal_year, revenue, capital, total, CAST(substr(doc_id, 2) AS INT) AS n FROM est)
SELECT id, doc_id, scheme, col_type, fiscal_year, CASE WHEN n % 4 <> 0 THEN revenue END AS revenue, CASE WHEN n % 4 <> 0 THEN capital END AS capital, CASE WHEN n % 4 = 0 THEN -1 ELSE total END AS total FROM s WHERE n % 3 <> 0 OR n % 4 = 0
UNION ALL SELECT substr(sha256(concat_ws('|', doc_id, scheme, fy_, 'be')), 1, 16), CAST(doc_id AS VARCHAR), scheme, 'be', fy_, NULL, NULL, total FROM (SELECT *, CASE WHEN doc_id % 7 = 0 THEN 'unknown' ELSE fy END AS fy_ FROM found WHERE doc_id % 5 < 3)""")
def job_01_snapshot(spark, sf_dir):
    """A snapshot of allocations with what sheets and pages add to it."""
    text = lambda df: df.withColumn("doc_id", F.col("doc_id").cast("string"))
    lines, tables, names = pages(spark, sf_dir)
    key = F.col("doc_id")
    kind = F.substring(key, 2, 9).cast("int")
    sheet = sheets(spark, sf_dir).select("doc_id", F.when(kind % 3 == 0, "csv").when(kind % 3 == 1, "xls").otherwise("xlsx").alias("ext"), F.lit("xls").alias("route"), "fy")
    route = F.element_at(F.array(*map(F.lit, ["text_pdf", "table_pdf", "scanned_pdf", "unknown", "devanagari_pdf"])), (key % 5 + 1).cast("int"))
    paged = order_years(spark, sf_dir).select("doc_id", F.lit("pdf").alias("ext"), route.alias("route"), F.when(key % 7 != 0, F.col("fy")).alias("fy"))
    own = grid(spark, sf_dir)
    none = F.lit(None).cast("double")
    # written before it is filtered: with the filter in the written plan, that took 60 s at sf0.001
    known = staged(jobs.scheme_allocations(own, sheets(spark, sf_dir), canonical(spark)), "known").where(kind % 4 == 0).withColumns({"revenue": none, "capital": none, "total": F.lit(-1.0)})
    return jobs.extracted_allocations(known, sheet.unionByName(text(paged)), own, text(lines), text(tables), names.unionByName(canonical(spark)), HEADERS, KEYWORDS)


@query("job_20_documents", """WITH d AS (SELECT doc_id, len(string_split(coalesce(text, ''), chr(10))) AS last_line FROM documents)
SELECT doc_id, CAST(last_line AS INT) AS line_no, 'Total receipts' AS indicator, CAST(doc_id || '.25' AS DOUBLE) / CASE WHEN doc_id % 4 <> 0 THEN 100 ELSE 1 END AS crore FROM d
UNION ALL SELECT doc_id, NULL, 'GSDP', CAST((doc_id % 90) || '.' || (doc_id % 10) AS DOUBLE) * 100000 FROM d WHERE doc_id % 4 <> 0""")
def job_20_documents(spark, sf_dir):
    """Indicators of every document, each with a table's line at its end, most with a sentence in the legacy font that
    wraps. The unit that the sentence names is the document's."""
    key = F.col("doc_id")
    said = F.when(key % 4 != 0, F.concat(F.lit("\nth0,l0Mh0ih0  "), (key % 90).cast("string"), F.lit("-"), (key % 10).cast("string"), F.lit("\nyk[k djksM")))
    text = F.concat(F.coalesce("text", F.lit("")), F.lit("\nTotal receipts   1,000.50   "), key.cast("string"), F.lit(".25"), F.coalesce(said, F.lit("")))
    return jobs.document_indicators(table(spark, sf_dir, "documents").select("doc_id", text.alias("text")))


@query("agg_06_income", RECEIPTS + f""" SELECT state AS doc_id, round(coalesce(sum(amount) FILTER (account = 'rev' AND sector = 'A' AND head NOT IN ({CENTRAL})), 0), 1) AS own_tax, round(coalesce(sum(amount) FILTER (account = 'rev' AND sector = 'B'), 0), 1) AS own_nontax,
  round(coalesce(sum(amount) FILTER (account = 'rev' AND sector = 'A' AND head IN ({CENTRAL})), 0), 1) AS devolution, round(coalesce(arg_min(amount, first_at) FILTER (head = '1601'), 0), 1) AS grants FROM h GROUP BY 1""")
def agg_06_income(spark, sf_dir):
    """Income of every state, tax heads split by who collects them."""
    return jobs.receipt_income(jobs.receipt_heads(receipt_lines(spark, sf_dir)))


# customers as states: some names stand for states with a source of their own, orders hold the table of rates
def states(spark, sf_dir):
    key = F.col("c_custkey")
    name = F.when(key % 500 == 3, " Tamil_Nadu").when(key % 500 == 4, "RAJASTHAN").when(key % 500 == 5, "Kerala").otherwise(F.concat(F.lit("State_"), key.cast("string")))
    return table(spark, sf_dir, "customer").select(name.alias("state"))


def rates(spark, sf_dir):
    low = F.when(F.col("o_orderkey") % 5 != 0, F.concat((F.col("o_orderkey") % 700 + 100).cast("string"), F.lit(".5")))
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("pos"), F.concat(F.lit("STATE "), F.col("o_custkey").cast("string")).alias("state"), low.alias("low"), F.col("o_orderpriority").alias("note"))


STATES = "states AS (SELECT DISTINCT CASE c_custkey % 500 WHEN 3 THEN ' Tamil_Nadu' WHEN 4 THEN 'RAJASTHAN' WHEN 5 THEN 'Kerala' ELSE 'State_' || c_custkey END AS state FROM customer)"


def values_sql(rows: list[tuple]) -> str:
    cell = lambda x: "NULL" if x is None else f"'{x}'" if isinstance(x, str) else str(x)
    return ", ".join(f"({', '.join(map(cell, r))})" for r in rows)


KEY = "replace(replace(lower(trim(state)), ' ', '-'), '_', '-')"


@query("job_21_states", f"""WITH {STATES}, own AS (SELECT s.state, w.employment, w.skill, w.daily, w.monthly FROM states s JOIN (VALUES {values_sql(wages.RATES)}) w(key, employment, skill, daily, monthly) ON {KEY.replace('state', 's.state')} = w.key),
r AS (SELECT 'State_' || o_custkey AS state, arg_min(o_orderkey % 700 + 100 + 0.5, o_orderkey) AS low FROM orders WHERE o_orderkey % 5 <> 0 GROUP BY 1)
SELECT state, employment, skill, CAST(daily AS DOUBLE) AS daily, CAST(monthly AS DOUBLE) AS monthly, 'own' AS source FROM own UNION ALL SELECT state, '{wages.BENCHMARK}', 'unskilled', CAST(low AS DOUBLE), CAST(low AS DOUBLE) * 26, 'static' FROM states JOIN r USING (state)""")
def job_21_states(spark, sf_dir):
    """Wages of every state: its fixed rates, else its lowest rate by the table."""
    return wages.state_wages(states(spark, sf_dir), rates(spark, sf_dir))


@query("job_21_status", f"""WITH {STATES}, k AS (SELECT * FROM (VALUES {values_sql(wages.STATUS)}) w(key, employment, status, year))
SELECT state, employment, status, CAST(year AS INT) AS year FROM states JOIN k ON {KEY} = key UNION ALL SELECT state, unnest(['anganwadi_worker', 'anganwadi_helper']), 'never_scheduled', NULL FROM states WHERE {KEY} NOT IN (SELECT key FROM k)""")
def job_21_status(spark, sf_dir):
    """Is an employment scheduled, by state."""
    return wages.scheduling_status(states(spark, sf_dir))
