"""Composite jobs, cascades and slips over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fiscal, slips, values
from ..operators import jobs
from ..operators.staging import staged
from ..operators.cascade import projected_and_allocated
from .bindings import EVENTS, HEADS, LINES, STATEMENTS, VERSIONS, budget_lines, heads, rules_sql, slip_events, statements, table, versions
from .registry import query

SECTOR, _ = rules_sql("major")


def label_sql(year: str) -> str:
    return f"(({year}) || '-' || lpad(CAST((({year}) + 1) % 100 AS VARCHAR), 2, '0'))"


# sheets: every part is a row of one of 40 documents; each measure is the part's size plus its place among the twelve
def grid(spark, sf_dir):
    key, doc = F.col("p_partkey"), F.col("p_partkey") % 40
    name = F.when(key % 5 == 0, "Total").when(key % 5 == 2, "Anganwadi Services").when(key % 5 == 3, "Umbrella ICDS").when(key % 5 == 4, F.col("p_name"))

    def cells(layout, width):
        at = {c: n for n, c in enumerate(c for kind in jobs.ESTIMATES for c in layout[kind])}
        own = [name if k == layout["name"] else (F.col("p_size") + at[k]).cast("string") if k in at else F.lit(None).cast("string") for k in range(width)]
        return F.array(*own)

    rows = table(spark, sf_dir, "part")
    return rows.select(F.concat(F.lit("d"), doc.cast("string")).alias("doc_id"), key.alias("row_no"), F.when(doc % 2 == 1, cells(jobs.WIDE, 42)).otherwise(cells(jobs.NARROW, 36)).alias("cells"))


def sheets(spark, sf_dir):
    doc = F.col("p_partkey") % 40
    return table(spark, sf_dir, "part").select(F.concat(F.lit("d"), doc.cast("string")).alias("doc_id"), fiscal.year_label((2015 + doc % 8).cast("int")).alias("fy")).distinct()


def canonical(spark):
    return spark.createDataFrame([("Anganwadi Services", "icds"), ("Umbrella ICDS", "icds")], "source_name string, canonical string")


def estimates_sql(names: str) -> str:
    """First row of each sheet whose name is one of ``names``, as four estimates."""
    return f"""firsts AS (SELECT p_partkey % 40 AS doc, arg_min(p_size, p_partkey) AS size FROM part WHERE p_partkey % 5 IN ({names}) GROUP BY 1),
est AS (SELECT 'd' || doc AS doc_id, col_type, 2015 + doc % 8 - back AS y, 2015 + doc % 8 AS budget, CAST(size + 3 * n AS DOUBLE) AS revenue, CAST(size + 3 * n + 1 AS DOUBLE) AS capital, CAST(size + 3 * n + 2 AS DOUBLE) AS total
  FROM firsts, (VALUES (0, 'actual', 2), (1, 'be', 1), (2, 're', 1), (3, 'be', 0)) k(n, col_type, back))"""


@query("job_01", f"WITH {estimates_sql('2, 3')} SELECT substr(sha256(concat_ws('|', doc_id, 'icds', {label_sql('y')}, col_type)), 1, 16) AS id, doc_id, 'icds' AS scheme, col_type, {label_sql('y')} AS fiscal_year, revenue, capital, total FROM est")
def job_01(spark, sf_dir):
    return jobs.scheme_allocations(grid(spark, sf_dir), sheets(spark, sf_dir), canonical(spark))


@query("job_02", """WITH l AS (SELECT l_orderkey AS doc_id, l_linenumber % 3 AS page_no, l_linenumber AS line_no, p_name, CAST(CAST(l_quantity AS INT) AS DOUBLE) AS total FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT doc_id, CAST(page_no AS INT) AS page_no, line_no, scheme, 'be' AS col_type, total FROM l JOIN (SELECT DISTINCT doc_id, page_no FROM l WHERE contains(p_name, 'ring')) USING (doc_id, page_no)
JOIN (SELECT p_name, min(p_brand) AS scheme FROM part GROUP BY 1) USING (p_name)""")
def job_02(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    rows = table(spark, sf_dir, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    line = F.concat_ws("  ", "p_name", F.col("l_quantity").cast("int").cast("string"))
    lines = rows.select(F.col("l_orderkey").alias("doc_id"), (F.col("l_linenumber") % 3).alias("page_no"), F.col("l_linenumber").alias("line_no"), line.alias("line"))
    names = part.groupBy(F.col("p_name").alias("source_name")).agg(F.min("p_brand").alias("canonical"))
    return jobs.allocations_from_text(lines, names, ["RING"])


@query("job_03", f"""WITH {estimates_sql('3')}, latest AS (SELECT y, col_type, arg_max(total, (budget, doc_id)) AS total FROM est GROUP BY 1, 2),
wide AS (SELECT {label_sql('y')} AS fiscal_year, max(total) FILTER (col_type = 'actual') AS actual, max(total) FILTER (col_type = 'be') AS be, max(total) FILTER (col_type = 're') AS re FROM latest GROUP BY y)
SELECT *, round((re - be) * 100 / be, 4) AS re_vs_be, round((actual - be) * 100 / be, 4) AS actual_vs_be FROM wide""")
def job_03(spark, sf_dir):
    return jobs.scheme_timeseries(grid(spark, sf_dir), sheets(spark, sf_dir), jobs.SERIES_KEYWORDS)


# reports: every order is one; its header says which rule applies, odd lines name the scheme
def report_lines(spark, sf_dir):
    two = lambda c: c.cast("decimal(18,2)").cast("string")
    head = F.when(F.col("o_orderkey") % 4 == 0, "Projections to  MoF").when(F.col("o_orderkey") % 4 == 1, "Projected Demand and Actual Allocation").otherwise("Report")
    first = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), F.lit(0).alias("page_no"), F.lit(0).alias("line_no"), head.alias("line"))
    name = F.when(F.col("l_linenumber") % 2 == 1, "Anganwadi Services").otherwise("Other rows")
    line = F.concat_ws("  ", name, two(F.col("l_extendedprice")), two(F.col("l_quantity") * 20), F.lit("12.50%"))
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.lit(0).alias("page_no"), F.col("l_linenumber").alias("line_no"), line.alias("line"))
    return first.unionByName(rows.groupBy("doc_id", "page_no", "line_no").agg(F.min("line").alias("line")))


CASCADE = """raw AS (SELECT l_orderkey AS doc_id, l_linenumber AS n, arg_min([CAST(l_extendedprice AS DECIMAL(18,2)), CAST(l_quantity * 20 AS DECIMAL(18,2))], CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) || '  ' || CAST(CAST(l_quantity * 20 AS DECIMAL(18,2)) AS VARCHAR)) AS a FROM lineitem GROUP BY 1, 2),
ahead AS (SELECT doc_id, n, list_transform(a, x -> CAST(x AS DOUBLE)) AS a, list_transform(coalesce(lead(a, 1) OVER w, []), x -> CAST(x AS DOUBLE)) AS b, list_transform(coalesce(lead(a, 2) OVER w, []), x -> CAST(x AS DOUBLE)) AS c FROM raw WINDOW w AS (PARTITION BY doc_id ORDER BY n)),
big AS (SELECT doc_id, n, list_filter(a, x -> x >= 100) AS one, list_filter(a || b, x -> x >= 100) AS two, list_reverse_sort(list_filter(a, x -> x >= 500)) AS l1, list_reverse_sort(list_filter(a || b || c, x -> x >= 500)) AS l3 FROM ahead WHERE n % 2 = 1),
found AS (
  SELECT doc_id, 1 AS rule, n, two[-2] AS projected, two[-1] AS allocated, 'high' AS confidence FROM big WHERE doc_id % 4 = 0 AND (len(two) >= 4 AND two[-2] > two[-1] OR len(two) = 2 AND two[1] > two[2])
  UNION ALL SELECT doc_id, 2, n, CASE WHEN len(one) >= 2 THEN one[1] ELSE two[1] END, CASE WHEN len(one) >= 2 THEN one[2] ELSE two[2] END, 'medium' FROM big WHERE doc_id % 4 = 1 AND len(two) >= 2
  UNION ALL SELECT doc_id, 3, n, CASE WHEN len(l1) >= 2 THEN l1[1] ELSE l3[1] END, CASE WHEN len(l1) >= 2 THEN l1[2] ELSE l3[2] END, 'low' FROM big WHERE len(l3) >= 2),
cascade AS (SELECT o_orderkey AS doc_id, projected, allocated, coalesce(confidence, 'none') AS confidence, CASE WHEN confidence IS NULL THEN 'no matching table found' END AS note
  FROM orders LEFT JOIN (SELECT doc_id, projected, allocated, confidence, row_number() OVER (PARTITION BY doc_id ORDER BY rule, n) AS r FROM found) ON o_orderkey = doc_id AND r = 1)"""
CASCADE = CASCADE.replace("x ->", "lambda x:")


@query("win_09", f"WITH {CASCADE} SELECT * FROM cascade")
def win_09(spark, sf_dir):
    return projected_and_allocated(report_lines(spark, sf_dir))


@query("job_04", f"""WITH {CASCADE}, m AS (SELECT o_orderkey AS report_no, year(o_orderdate) AS y, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey END AS doc_id FROM orders WHERE o_orderkey % 3 = 0),
j AS (SELECT report_no, {label_sql('y')} AS fy, m.doc_id, CASE WHEN report_no = 6 THEN 900.0 ELSE projected END AS projected, CASE WHEN report_no = 6 THEN 450.0 ELSE allocated END AS allocated, CASE WHEN report_no = 6 THEN 'manual' ELSE coalesce(confidence, 'none') END AS confidence, CASE WHEN m.doc_id IS NULL THEN 'no pdf_path in manifest' WHEN report_no = 6 THEN 'read by hand' ELSE coalesce(note, '') END AS note FROM m LEFT JOIN cascade c ON m.doc_id = c.doc_id)
SELECT report_no, fy, CAST(projected AS DOUBLE) AS projected, CAST(allocated AS DOUBLE) AS allocated, confidence, note, CASE WHEN projected > 0 THEN round_even(CAST((allocated - projected) * 100 AS DOUBLE) / projected, 2) END AS cut_pct FROM j""")
def job_04(spark, sf_dir):
    key = F.col("o_orderkey")
    year = F.year("o_orderdate")
    title = F.concat(F.lit("Women: Demands for Grants "), year.cast("string"), F.lit("-"), F.lpad(F.pmod(year + 1, F.lit(100)).cast("string"), 2, "0"))
    kind = F.when(key % 3 != 0, "action_taken").when(key % 2 == 0, "demands_for_grants").otherwise("other")
    manifest = table(spark, sf_dir, "orders").select(key.alias("report_no"), title.alias("title"), kind.alias("report_type"), F.when(key % 7 != 0, key).alias("doc_id"))
    own = spark.createDataFrame([(6, 900.0, 450.0, "manual", "read by hand")], "report_no long, projected double, allocated double, confidence string, note string")
    return jobs.demand_vs_allocation(manifest, report_lines(spark, sf_dir), own)


@query("job_05", f"""WITH {LINES}, sums AS (SELECT fy, state, col_type, CAST(sum(amount) AS DOUBLE) AS total FROM lines GROUP BY 1, 2, 3), ys AS (SELECT DISTINCT fy FROM lines),
d AS (SELECT fy, sum(total) FILTER (state = 'NATION_3' AND col_type = 're') AS demanded, CASE WHEN CAST(substr(fy, 1, 4) AS INT) % 2 = 0 THEN sum(total) FILTER (state = 'NATION_3' AND col_type = 'be') END AS allocated FROM sums GROUP BY 1),
s AS (SELECT fy, arg_max(total, state) FILTER (col_type = 'actual' AND total > 0) AS actual, arg_min(total, state) FILTER (col_type = 'be') AS be FROM sums GROUP BY 1),
j AS (SELECT ys.fy AS fiscal_year, demanded, CASE WHEN coalesce(allocated, 0) = 0 AND actual IS NULL AND coalesce(be, 0) <> 0 THEN be ELSE allocated END AS allocated, 1000.0 * (CAST(substr(ys.fy, 1, 4) AS INT) - 1990) AS full_scheme, actual, 100 + 5 * (CAST(substr(ys.fy, 1, 4) AS INT) - 1994) AS deflator FROM ys LEFT JOIN d ON ys.fy = d.fy LEFT JOIN s ON ys.fy = s.fy)
SELECT fiscal_year, demanded, allocated, CAST(full_scheme AS DOUBLE) AS full_scheme, actual, CASE WHEN actual <> 0 AND allocated > 0 THEN round_even(actual * 100 / allocated, 1) END AS pct_spent, CASE WHEN demanded > 0 AND allocated <> 0 THEN round_even((allocated - demanded) * 100 / demanded, 1) END AS cut_pct,
  round_even(demanded * 100 / deflator, 0) AS demanded_real, round_even(allocated * 100 / deflator, 0) AS allocated_real, round_even(CAST(full_scheme AS DOUBLE) * 100 / deflator, 0) AS full_scheme_real, round_even(actual * 100 / deflator, 0) AS actual_real FROM j""")
def job_05(spark, sf_dir):
    fy, total = F.col("fy"), F.sum("amount").cast("double")
    rows = budget_lines(spark, sf_dir).groupBy("fy", "state", "col_type").agg(total.alias("total"))
    years = rows.select(fy.alias("fiscal_year")).distinct()
    start = fiscal.fy_start(F.col("fiscal_year"))
    one = lambda kind: F.sum(F.when((F.col("state") == "NATION_3") & (F.col("col_type") == kind), F.col("total")))
    demand = rows.groupBy(fy.alias("fiscal_year")).agg(one("re").alias("demanded"), one("be").alias("allocated")).withColumn("allocated", F.when(start % 2 == 0, F.col("allocated")))
    spend = jobs.spend_series(rows.withColumnRenamed("fy", "fiscal_year"), "state")
    external = years.select("fiscal_year", ((start - 1990) * 1000.0).alias("full_scheme"))
    return jobs.real_terms_table(years, demand, spend, external, years.select("fiscal_year", (100 + 5 * (start - 1994)).alias("deflator")))


ACCOUNTS = ["own_tax", "own_nontax", "devolution", "grants", "recovery", "rev_exp", "rev_dev_social", "rev_dev_econ", "cap_outlay", "cap_social", "cap_econ"]
ACCOUNTS_SQL = f"acc AS (SELECT state, fy, {', '.join(f'coalesce(sum(amount) FILTER (l_partkey % 11 = {k}), 0) AS {a}' for k, a in enumerate(ACCOUNTS))} FROM lines GROUP BY 1, 2), uses AS (SELECT *, rev_dev_social + cap_social AS social, rev_dev_econ + cap_econ AS economic, rev_exp - rev_dev_social - rev_dev_econ + cap_outlay - cap_social - cap_econ AS general FROM acc), bal AS (SELECT *, social + economic + general - own_tax - own_nontax - devolution - grants - recovery AS net_borrowing FROM uses)"


def accounts(spark, sf_dir):
    part = lambda k, a: F.coalesce(F.sum(F.when(F.col("l_partkey") % 11 == k, F.col("amount"))), F.lit(0)).alias(a)
    return budget_lines(spark, sf_dir).groupBy("state", "fy").agg(*[part(k, a) for k, a in enumerate(ACCOUNTS)])


EDGES = [*((f"'{label}'", "'pool'", k) for k, (label, _) in jobs.SOURCES.items()), *(("'pool'", f"'{label}'", k) for k, label in jobs.USES.items())]


@query("job_08", f"WITH {LINES}, {ACCOUNTS_SQL} " + " UNION ALL ".join(f"SELECT state, fy, {a} AS source, {z} AS target, CAST({k} AS DOUBLE) AS amount, true AS accepted FROM bal" for a, z, k in EDGES))
def job_08(spark, sf_dir):
    return jobs.balance_flow(jobs.from_aggregates(accounts(spark, sf_dir), ["state", "fy"]), ["state", "fy"])


@query("agg_10", f"WITH {LINES}, {ACCOUNTS_SQL} SELECT DISTINCT state, fy, social + economic <= own_tax + own_nontax + devolution + 2 AND social + economic >= own_tax + own_nontax + devolution - 2 AS accepted FROM bal")
def agg_10(spark, sf_dir):
    rows = jobs.from_aggregates(accounts(spark, sf_dir), ["state", "fy"]).drop("grants", "recovery", "net_borrowing").withColumn("general", F.lit(0))
    return jobs.balance_flow(rows, ["state", "fy"]).select("state", "fy", "accepted").distinct()


@query("fn_43", f"WITH {LINES}, {ACCOUNTS_SQL}, p AS (SELECT state, fy, round_even(CAST((devolution + grants) * 100 AS DOUBLE) / nullif(CAST(social + economic + general AS DOUBLE), 0), 0) AS t, round_even(CAST((own_tax + own_nontax) * 100 AS DOUBLE) / nullif(CAST(social + economic + general AS DOUBLE), 0), 0) AS o FROM bal) SELECT state, fy, t AS transfers_pct, o AS own_pct FROM p")
def fn_43(spark, sf_dir):
    names = ["own_tax", "own_nontax", "devolution", "grants", "social", "economic", "general", "net_borrowing"]
    rows = jobs.from_aggregates(accounts(spark, sf_dir), ["state", "fy"])
    return jobs.shares_of_uses(rows.select("state", "fy", *[F.col(n).cast("double").alias(n) for n in names]), ["state", "fy"]).select("state", "fy", "transfers_pct", "own_pct")


def receipt_lines(spark, sf_dir):
    order, n = F.col("l_orderkey"), F.col("l_linenumber")
    head = F.when(F.col("l_partkey") % 50 == 49, "1601").otherwise(F.lpad((F.col("l_partkey") % 50).cast("string"), 4, "0"))
    line = (
        F.when((n == 1) & (order % 3 != 0), "A. Revenue Account").when(n == 1, "B. Capital Account").when((n == 2) & (order % 2 == 0), "SECTOR--A-TAX").when(n == 2, "SECTOR-B-OTHER")
        .otherwise(F.concat(F.lit("Net Total : "), head, F.lit("  1,000.00  "), F.col("amount").cast("string")))
    )
    return budget_lines(spark, sf_dir).select(F.col("state").alias("doc_id"), (order * 10 + n).alias("pos"), line.alias("line"))


RECEIPTS = f"""WITH {LINES}, r AS (SELECT state, l_orderkey * 10 + l_linenumber AS pos, CASE WHEN l_linenumber = 1 THEN CASE WHEN l_orderkey % 3 <> 0 THEN 'rev' ELSE 'cap' END END AS a, CASE WHEN l_linenumber = 2 THEN CASE WHEN l_orderkey % 2 = 0 THEN 'A' ELSE 'B' END END AS s,
    CASE WHEN l_linenumber > 2 THEN CASE WHEN l_partkey % 50 = 49 THEN '1601' ELSE lpad(CAST(l_partkey % 50 AS VARCHAR), 4, '0') END END AS head, amount FROM lines),
f AS (SELECT *, last_value(a IGNORE NULLS) OVER w AS account, last_value(s IGNORE NULLS) OVER w AS sector FROM r WINDOW w AS (PARTITION BY state ORDER BY pos)),
h AS (SELECT state, account, sector, head, max(amount) AS amount, min(pos) AS first_at FROM f WHERE head IS NOT NULL GROUP BY 1, 2, 3, 4)"""
CENTRAL = ", ".join(f"'{h}'" for h in jobs.CENTRAL_TAXES)


@query("agg_06", RECEIPTS + " SELECT state AS doc_id, account, sector, head, amount, first_at FROM h")
def agg_06(spark, sf_dir):
    return jobs.receipt_heads(receipt_lines(spark, sf_dir))


@query("job_09", RECEIPTS + f""", i AS (SELECT state, round(coalesce(sum(amount) FILTER (account = 'rev' AND sector = 'A' AND head NOT IN ({CENTRAL})), 0), 1) AS own_tax, round(coalesce(sum(amount) FILTER (account = 'rev' AND sector = 'B'), 0), 1) AS own_nontax,
  round(coalesce(sum(amount) FILTER (account = 'rev' AND sector = 'A' AND head IN ({CENTRAL})), 0), 1) AS devolution, round(coalesce(arg_min(amount, first_at) FILTER (head = '1601'), 0), 1) AS grants FROM h GROUP BY 1),
u AS (SELECT state, round(coalesce(sum(amount) FILTER (m = 'social'), 0), 1) AS social, round(coalesce(sum(amount) FILTER (m = 'economic'), 0), 1) AS economic, round(coalesce(sum(amount) FILTER (m IN ('general', 'grants')), 0), 1) AS general FROM (SELECT state, {SECTOR} AS m, amount FROM lines WHERE col_type = 'be') GROUP BY 1)
SELECT state AS doc_id, own_tax, own_nontax, devolution, grants, social, economic, general, social + economic + general - own_tax - own_nontax - devolution - grants AS net_borrowing FROM i JOIN u USING (state)""")
def job_09(spark, sf_dir):
    demands = budget_lines(spark, sf_dir).where("col_type = 'be'").select(F.col("state").alias("doc_id"), "major", "amount")
    return jobs.receipts_balance(receipt_lines(spark, sf_dir), demands)


# chart of accounts: every part is a row of one of 20 tables, a major, a sub-major (two ways) or a minor
def head_rows(spark, sf_dir):
    key, kind = F.col("p_partkey"), F.floor(F.col("p_partkey") / 20) % 7
    pad = lambda n, w: F.lpad(n.cast("string"), w, "0")
    label, sub, blank = F.concat(F.col("p_name"), F.lit(" (0"), (key % 30).cast("string"), F.lit(")")), pad(key % 90 + 1, 2), F.lit("")
    cells = F.when(kind == 0, F.array(pad(2000 + key % 1700, 4), label)).when(kind == 1, F.array(blank, F.concat(sub, F.lit("-"), label))).when(kind == 4, F.array(sub, blank, label)).otherwise(F.array(blank, pad(key % 899 + 100, 3), label))
    return table(spark, sf_dir, "part").select((key % 20).alias("table_id"), key.alias("row_no"), cells.alias("cells"))


HEAD_ROWS = """hr AS (SELECT p_partkey % 20 AS t, p_partkey AS n, (p_partkey // 20) % 7 AS k, p_name || ' (0' || (p_partkey % 30) || ')' AS label, CAST(p_partkey % 30 AS VARCHAR) AS marker, lpad(CAST(p_partkey % 90 + 1 AS VARCHAR), 2, '0') AS s2, CAST(2000 + p_partkey % 1700 AS VARCHAR) AS m4, CAST(p_partkey % 899 + 100 AS VARCHAR) AS n3 FROM part),
hf AS (SELECT *, last_value(CASE WHEN k = 0 THEN m4 END IGNORE NULLS) OVER w AS major, count(CASE WHEN k = 0 THEN 1 END) OVER w AS run FROM hr WINDOW w AS (PARTITION BY t ORDER BY n)),
hg AS (SELECT *, last_value(CASE WHEN k IN (1, 4) THEN s2 END IGNORE NULLS) OVER (PARTITION BY t, run ORDER BY n) AS sub FROM hf),
hc AS (SELECT t, n, label, marker, CASE WHEN k = 0 THEN major WHEN k IN (1, 4) THEN major || '-' || sub ELSE major || '-' || coalesce(sub, '00') || '-' || n3 END AS code, CASE WHEN k = 0 THEN NULL WHEN k IN (1, 4) OR coalesce(sub, '00') = '00' THEN major ELSE major || '-' || sub END AS parent_code, CASE WHEN k = 0 THEN 'major' WHEN k IN (1, 4) THEN 'submajor' ELSE 'minor' END AS kind FROM hg WHERE major IS NOT NULL)"""


@query("job_10", f"WITH {HEAD_ROWS} SELECT code, parent_code, kind, label FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY t, n) AS r FROM hc) WHERE r = 1")
def job_10(spark, sf_dir):
    return jobs.head_tree(head_rows(spark, sf_dir))


def paragraphs(spark, sf_dir):
    key = F.col("p_partkey")
    line = F.when(F.floor(key / 20) % 4 == 0, F.concat(F.lit("( 0"), F.col("p_size").cast("string"), F.lit(") "), F.col("p_name"))).otherwise(F.col("p_name"))
    return table(spark, sf_dir, "part").select((key % 20).alias("table_id"), key.alias("pos"), line.alias("text"))


NOTES = """nr AS (SELECT p_partkey % 20 AS t, p_partkey AS n, (p_partkey // 20) % 4 = 0 AS starts, CAST(p_size AS VARCHAR) AS number, p_name FROM part),
nn AS (SELECT *, sum(CASE WHEN starts THEN 1 ELSE 0 END) OVER (PARTITION BY t ORDER BY n) AS run FROM nr),
nt AS (SELECT t, run, max(number) FILTER (starts) AS number, string_agg(p_name, ' ' ORDER BY n) AS note FROM nn WHERE run > 0 GROUP BY 1, 2),
notes AS (SELECT t, number, arg_max(note, run) AS note FROM nt GROUP BY 1, 2)"""


@query("job_11", f"WITH {HEAD_ROWS}, {NOTES} SELECT DISTINCT code, marker AS note_number, note FROM hc JOIN notes ON hc.t = notes.t AND marker = number")
def job_11(spark, sf_dir):
    return jobs.scope_notes(head_rows(spark, sf_dir), paragraphs(spark, sf_dir))


@query("job_12", f"WITH {VERSIONS} SELECT CAST(2 AS INT) AS version, 'Correction Slip Nos. 655-662' AS label, '655,656,657,658,659,660,661,662' AS slips, coalesce(a.code, b.code) AS code, CASE WHEN a.code IS NULL THEN 'INSERT' WHEN b.code IS NULL THEN 'DELETE' WHEN a.label <> b.label THEN 'RENAME' ELSE 'UPDATE' END AS action, coalesce(b.label, a.label) AS new_label, CASE WHEN a.label <> b.label THEN a.label END AS old_label FROM v1 a FULL JOIN v2 b ON a.code = b.code WHERE a.code IS NULL OR b.code IS NULL OR a.label <> b.label OR a.parent_code <> b.parent_code")
def job_12(spark, sf_dir):
    old, new = versions(spark, sf_dir)
    of = lambda df, n, message: df.select(F.lit(n).alias("version"), F.lit(message).alias("message"), "code", "parent_code", "label")
    return jobs.change_timeline(of(old, 1, "base").unionByName(of(new, 2, "Correction Slip: Correction slips No 655 to 662")))


def notes_of_parts(spark, sf_dir):
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select((2000 + key % 1700).cast("string").alias("code"), F.when(key % 3 == 0, " ").otherwise(F.col("p_name")).alias("note"))


PART_NOTES = "pn AS (SELECT CAST(2000 + p_partkey % 1700 AS VARCHAR) AS code, CASE WHEN p_partkey % 3 = 0 THEN ' ' ELSE p_name END AS note FROM part)"


@query("job_13", f"""WITH {HEADS}, {EVENTS}, {PART_NOTES}, rows_ AS (SELECT code, action, label, ts, event_id FROM slips UNION ALL SELECT code, 'HEAD', label, NULL, NULL FROM heads),
numbered AS (SELECT *, row_number() OVER (PARTITION BY code ORDER BY ts NULLS FIRST, event_id NULLS FIRST) AS k, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM rows_),
named AS (SELECT *, last_value(CASE WHEN k = 1 OR action = 'RENAME' THEN label END IGNORE NULLS) OVER (PARTITION BY code ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS old FROM numbered)
SELECT code AS s, 'prefLabel' AS p, arg_max(label, k) AS o FROM named WHERE k = 1 OR action = 'RENAME' GROUP BY code UNION SELECT code, 'altLabel', old FROM named WHERE action = 'RENAME' AND old IS NOT NULL
UNION SELECT code, 'created', day FROM named WHERE action = 'INSERT' UNION SELECT code, 'modified', day FROM named WHERE action IN ('RENAME', 'UPDATE', 'DELETE') UNION SELECT code, 'deprecated', 'true' FROM named WHERE action = 'DELETE'
UNION SELECT code, 'historyNote', 'Renamed from \'\'' || coalesce(old, 'None') || '\'\' to \'\'' || label || '\'\' on ' || day FROM named WHERE action = 'RENAME' UNION SELECT code, 'historyNote', 'Updated on ' || day FROM named WHERE action = 'UPDATE'
UNION SELECT DISTINCT code, 'identifier', code FROM named UNION SELECT code, 'type', kind FROM heads UNION SELECT code, 'topConceptOf', 'scheme' FROM heads WHERE parent_code IS NULL UNION SELECT code, 'topConceptOf', 'scheme' FROM slips WHERE code NOT IN (SELECT code FROM heads)
UNION SELECT code, 'broader', parent_code FROM heads WHERE parent_code IS NOT NULL UNION SELECT parent_code, 'narrower', code FROM heads WHERE parent_code IS NOT NULL UNION SELECT code, 'scopeNote', note FROM pn WHERE trim(note) <> '' AND code IN (SELECT code FROM named)""")
def job_13(spark, sf_dir):
    return jobs.vocabulary_triples(staged(heads(spark, sf_dir), "heads"), slip_events(spark, sf_dir), notes_of_parts(spark, sf_dir), ["ts", "event_id"])


CLASS_SQL = "CASE WHEN {0} < '2' THEN 0 WHEN {0} < '4' THEN 2 WHEN {0} < '6' THEN 4 WHEN {0} < '8' THEN 6 ELSE 8 END"


@query("job_14", f"WITH {HEADS}, {EVENTS}, {PART_NOTES} SELECT code, label, kind, {CLASS_SQL.format('code')} AS cls, (SELECT count(*) FROM heads c WHERE c.parent_code = h.code) AS n_children, (SELECT count(*) FROM pn WHERE pn.code = h.code) AS n_notes, (SELECT count(*) FROM slips s WHERE s.code = h.code) AS n_events FROM heads h")
def job_14(spark, sf_dir):
    return jobs.browser_nodes(staged(heads(spark, sf_dir), "heads"), notes_of_parts(spark, sf_dir), slip_events(spark, sf_dir))


@query("job_15", f"WITH {HEADS}, g AS (SELECT {CLASS_SQL.format('code')} AS cls, count(*) AS n_hits FROM heads WHERE contains(label, 'ring') AND contains(code || ' ' || label, '2') GROUP BY 1) SELECT cls, n_hits, (SELECT count(*) FROM g) AS n_classes FROM g")
def job_15(spark, sf_dir):
    return jobs.lookup_by_class(heads(spark, sf_dir), "Ring, 2")


@query("job_17", f"WITH {STATEMENTS} SELECT state, pct AS ratio, CAST(row_number() OVER (ORDER BY pct DESC, state) AS INT) AS rank, pct > 15 AS high_stress FROM statements")
def job_17(spark, sf_dir):
    return jobs.stress_leaderboard(statements(spark, sf_dir), "pct")


@query("job_18", """WITH g AS (SELECT o_custkey AS doc_id, min(o_orderkey) AS k FROM orders WHERE contains(lower(o_orderpriority), 'urgent') GROUP BY 1), v AS (SELECT doc_id, p.period, CAST(k * 10 + i AS DOUBLE) AS interest, CAST(k % 3 * (100 + i) AS DOUBLE) AS revenue FROM g, (VALUES (0, 'a'), (1, 'b'), (2, 'c')) p(i, period))
SELECT *, CASE WHEN revenue > 0 THEN round_even(interest * 100 / revenue, 2) ELSE 0 END AS ratio FROM v""")
def job_18(spark, sf_dir):
    key = F.col("o_orderkey")

    def grid_of(value):
        cells = F.array(key.cast("string"), F.col("o_orderpriority"), *[value(i).cast("string") for i in range(3)])
        return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc_id"), key.alias("row_no"), cells.alias("cells"))

    return jobs.interest_burden(grid_of(lambda i: key * 10 + i), grid_of(lambda i: key % 3 * (100 + i)), "Urgent", ["a", "b", "c"])


@query("job_20", """WITH l AS (SELECT l_orderkey AS doc_id, l_linenumber AS line_no, p_name, l_orderkey % 3 AS u, CAST(CAST(l_quantity AS DECIMAL(18,2)) AS DOUBLE) AS q FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT doc_id, line_no, p_name AS indicator, CASE WHEN doc_id IN (SELECT doc_id FROM l WHERE line_no = 2 AND u = 0) THEN q / 100 WHEN doc_id IN (SELECT doc_id FROM l WHERE line_no = 2 AND u = 1) THEN q / 10000 ELSE q END AS crore FROM l WHERE NOT (line_no = 2 AND u < 2)""")
def job_20(spark, sf_dir):
    own = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    two = lambda c: F.col(c).cast("decimal(18,2)").cast("string")
    unit = F.when(F.col("l_orderkey") % 3 == 0, "(Figures in lakh)").when(F.col("l_orderkey") % 3 == 1, "(Figures in thousand)")
    line = F.coalesce(F.when(F.col("l_linenumber") == 2, unit), F.concat_ws("  ", "p_name", two("l_extendedprice"), two("l_quantity")))
    return jobs.fiscal_indicators(own.select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("line_no"), line.alias("line")))


@query("job_21", """WITH n AS (SELECT o_orderkey AS doc_id, CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'Hotels' ELSE 'Shops' END AS category FROM orders), l AS (SELECT l_orderkey AS doc_id, l_linenumber AS line_no, 80 + l_partkey % 300 AS d, (80 + l_partkey % 300) * (10 + l_suppkey % 40) AS m FROM lineitem),
r AS (SELECT doc_id, line_no, CAST(d AS DOUBLE) AS daily, CAST(CASE WHEN m BETWEEN 3000 AND 60000 THEN m END AS DOUBLE) AS monthly FROM l)
SELECT doc_id, line_no, category, skill, daily, monthly FROM (SELECT doc_id, line_no, 'unskilled' AS skill, daily, monthly FROM r WHERE line_no % 3 = 0 UNION ALL SELECT doc_id, min(line_no), 'unspecified', daily, monthly FROM r WHERE line_no % 3 <> 0 AND monthly BETWEEN 15 * daily AND 35 * daily GROUP BY 1, 4, 5) JOIN n USING (doc_id) WHERE category IS NOT NULL""")
def job_21(spark, sf_dir):
    key = F.col("o_orderkey") % 5
    title = F.when(key == 0, "Mills 2019 Excluded").when(key == 1, "Hotels - 2020 Final").otherwise("Shops 2021")
    daily = 80 + F.col("l_partkey") % 300
    rates = F.concat_ws(" ", daily.cast("string"), (daily * (10 + F.col("l_suppkey") % 40)).cast("string"))
    line = F.concat_ws(" ", F.when(F.col("l_linenumber") % 3 == 0, "Un-skilled worker").otherwise("row"), rates)
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("line_no"), line.alias("line"))
    return jobs.wage_rows(lines, table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), title.alias("title")))


@query("job_22", "SELECT CAST(1990 + c_custkey AS VARCHAR) AS year, c_custkey / 10.0 AS ghe_pct_gdp, c_custkey + 0.5 AS oope_pct_the, c_custkey * 2.0 AS ghe_pct_the, CAST(c_custkey * 100 AS BIGINT) AS per_capita_ghe_inr, CAST(c_custkey * 50 AS BIGINT) AS per_capita_oope_inr FROM customer")
def job_22(spark, sf_dir):
    k = F.col("c_custkey")
    parts = {"Per_Capita_OOPE_INR": k * 50, "Per_Capita_GHE_INR": k * 100, "GHE_Pct_THE": k * 2, "OOPE_Pct_THE": k + F.lit(0.5).cast("double"), "GHE_Pct_GDP": k / 10, "Year": 1990 + k, "extra": k}
    return jobs.health_accounts(table(spark, sf_dir, "customer").select(*[c.cast("string").alias(n) for n, c in parts.items()]))


@query("job_24", """WITH r AS (SELECT p_name AS scheme, CASE WHEN p_name = 'small ring' THEN 'rings' ELSE 'icds_anganwadi_services' END AS canonical, CAST(2000 + p_partkey % 9 AS VARCHAR) AS fiscal_year, CASE WHEN p_partkey % 2 = 0 THEN 'be' ELSE 'actual' END AS col_type, CAST(p_size AS DOUBLE) AS s, p_partkey FROM part)
SELECT substr(sha256(concat_ws('|', scheme, canonical, fiscal_year, col_type)), 1, 16) AS id, scheme, canonical, fiscal_year, col_type, arg_min(s, p_partkey) AS revenue, arg_min(s, p_partkey) + 1 AS capital, arg_min(s, p_partkey) + 2 AS total FROM r GROUP BY ALL""")
def job_24(spark, sf_dir):
    key, size = F.col("p_partkey"), F.col("p_size")
    rows = table(spark, sf_dir, "part").select(key.alias("pos"), F.col("p_name").alias("scheme"), (2000 + key % 9).cast("string").alias("fiscal_year"), F.when(key % 2 == 0, "be").otherwise("actual").alias("col_type"), *[(size + k).cast("string").alias(m) for k, m in enumerate(jobs.MEASURES)])
    return jobs.import_history(rows, spark.createDataFrame([("small ring", "rings")], "source_name string, canonical string"))


# messages about correction slips, six kinds
def messages(spark, sf_dir):
    key = F.col("event_id")
    a, b = 600 + key % 90, 600 + key % 90 + key % 60
    kinds = ["Correction Slip: Correction Slip No %d to %d", "CS %d %d 389", "Corrigendum to Correction Slip No. %d", "Corrigendum No. %d", "Correction slips numbers %d and %d", "Correction Slip: Transactory and Parking Heads %d"]
    made = [F.format_string(t, *[key % 1000 if k == 3 else x for x in (a, b)[: t.count("%d")]]) for k, t in enumerate(kinds)]
    return table(spark, sf_dir, "events").select(key, F.element_at(F.array(*made), (key % 6 + 1).cast("int")).alias("message"))


MESSAGES = "m AS (SELECT event_id, event_id % 6 AS k, 600 + event_id % 90 AS a, 600 + event_id % 90 + event_id % 60 AS b, event_id % 60 AS w FROM events)"


@query("fn_29", f"WITH {MESSAGES} SELECT event_id, CASE WHEN k = 0 AND w BETWEEN 1 AND 50 THEN array_to_string(range(a, b + 1), ',') WHEN k IN (0, 1, 4) THEN a || ',' || b WHEN k = 2 THEN CAST(a AS VARCHAR) ELSE '' END AS numbers FROM m")
def fn_29(spark, sf_dir):
    return messages(spark, sf_dir).select("event_id", F.array_join(slips.slip_numbers(F.col("message")).cast("array<string>"), ",").alias("numbers"))


@query("fn_30", f"WITH {MESSAGES} SELECT event_id, CASE WHEN k IN (0, 1, 4) THEN 'Correction Slip Nos. ' || CASE WHEN w = 1 OR k = 0 AND w BETWEEN 1 AND 50 THEN a || '-' || b ELSE a || ', ' || b END WHEN k = 2 THEN 'Corrigendum to Correction Slip No. ' || a WHEN k = 3 THEN 'Corrigendum No. ' || (event_id % 1000) ELSE 'Transactory and Parking Heads' END AS label FROM m")
def fn_30(spark, sf_dir):
    return messages(spark, sf_dir).select("event_id", slips.event_label(F.col("message")).alias("label"))


@query("fn_08", """SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'INSERT' WHEN 1 THEN 'DELETE' WHEN 2 THEN 'RENAME' ELSE 'MOVE' END AS action, CASE WHEN p_partkey % 4 < 3 THEN CASE p_partkey % 3 WHEN 0 THEN lpad(CAST(p_partkey % 9000 AS VARCHAR), 4, '0') || '-' || lpad(CAST(p_size AS VARCHAR), 2, '0') || '-105' WHEN 1 THEN lpad(CAST(p_partkey % 9000 AS VARCHAR), 4, '0') || '-' || (10 + p_partkey % 80) ELSE lpad(CAST(p_partkey % 9000 AS VARCHAR), 4, '0') || '-00-007' END END AS code,
  CASE WHEN p_partkey % 4 < 3 THEN CASE p_partkey % 3 WHEN 0 THEN lpad(CAST(p_partkey % 9000 AS VARCHAR), 4, '0') || '-' || lpad(CAST(p_size AS VARCHAR), 2, '0') ELSE lpad(CAST(p_partkey % 9000 AS VARCHAR), 4, '0') END END AS parent_code, CASE WHEN p_partkey % 4 < 3 THEN CASE p_partkey % 3 WHEN 1 THEN 'Sub-Major Head' ELSE 'Minor Head' END END AS kind, CASE WHEN p_partkey % 4 = 3 THEN 'action' END AS error FROM part""")
def fn_08(spark, sf_dir):
    key = F.col("p_partkey")
    action = F.when(key % 4 == 0, " insert").when(key % 4 == 1, "Delete").when(key % 4 == 2, "RENAME").otherwise("move")
    sub = F.when(key % 3 == 0, F.col("p_size").cast("string")).when(key % 3 == 2, "–")
    minor = F.when(key % 3 == 0, "105.").when(key % 3 == 1, (10 + key % 80).cast("string")).otherwise("7")
    change = slips.normal_change(action, (key % 9000).cast("string"), sub, minor, F.col("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", change.alias("c")).select("p_partkey", "c.action", "c.code", "c.parent_code", "c.kind", "c.error")


@query("fn_24", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'unknown' ELSE CAST(p_partkey AS VARCHAR) END AS demand_no, CAST(2000 + p_partkey % 20 AS VARCHAR) AS day, p_name || ' x' AS title FROM part")
def fn_24(spark, sf_dir):
    key = F.col("p_partkey")
    stem = F.when(key % 3 == 0, "book").otherwise(F.concat(F.lit("sbe"), key.cast("string"), F.lit("_2024-25")))
    day, title = slips.slip_file(F.concat_ws("_", (2000 + key % 20).cast("string"), "p_name", F.lit("x")))
    return table(spark, sf_dir, "part").select("p_partkey", slips.demand_number(stem).alias("demand_no"), day.alias("day"), title.alias("title"))


@query("fn_28", f"WITH {HEAD_ROWS} SELECT n AS row_no, CASE WHEN k = 0 THEN m4 END AS major, CASE WHEN k IN (1, 4) THEN s2 END AS sub, CASE WHEN k NOT IN (0, 1, 4) THEN n3 END AS minor FROM hr")
def fn_28(spark, sf_dir):
    c = F.col("cells")
    return head_rows(spark, sf_dir).select("row_no", slips.find_major(c)["code"].alias("major"), slips.find_sub(c)["code"].alias("sub"), slips.find_minor(c)["code"].alias("minor"))


@query("fn_36", "SELECT o_orderkey, o_orderkey % 5 = 0 AS is_excluded, o_orderkey % 5 = 1 AS is_final, false AS is_preliminary, CASE o_orderkey % 5 WHEN 0 THEN 'Mills' WHEN 1 THEN 'Hotels' ELSE 'Shops' END AS category FROM orders")
def fn_36(spark, sf_dir):
    key = F.col("o_orderkey") % 5
    flags = slips.title_flags(F.when(key == 0, "Mills 2019 Exempted").when(key == 1, "Hotels - 2020 FINAL").otherwise("- Shops 2021"))
    return table(spark, sf_dir, "orders").select("o_orderkey", *[flags[n].alias(n) for n in ("is_excluded", "is_final", "is_preliminary", "category")])


@query("fn_38", "SELECT p_partkey, (p_partkey % 10) || '|' || 410 || '|' || (p_size || '.25') AS numbers FROM part")
def fn_38(spark, sf_dir):
    line = F.concat((F.col("p_partkey") % 10).cast("string"), F.lit(",410 x"), F.col("p_size").cast("string"), F.lit(" "), F.col("p_size").cast("string"), F.lit(".25"))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(values.line_numbers(line), "|").alias("numbers"))


@query("fn_42", f"WITH {STATEMENTS} SELECT state, round(liabilities / (pct / 100) * 0.12 * 0.41 * (1 - 0.783), 2) AS gap_a, round(devolution * 0.217 / (1 - 0.217), 2) AS gap_b, round(grants / nullif(liabilities / (pct / 100), 0) * 100, 4) AS local_pct FROM statements WHERE liabilities > 0")
def fn_42(spark, sf_dir):
    product = values.gsdp(F.col("liabilities"), F.col("pct"))
    rows = statements(spark, sf_dir).where("liabilities > 0")
    return rows.select("state", F.round(values.squeeze_gap(product), 2).alias("gap_a"), F.round(values.devolution_gap(F.col("devolution")), 2).alias("gap_b"), F.round(F.try_divide(F.col("grants"), product) * 100, 4).alias("local_pct"))


@query("fn_46", f"WITH {VERSIONS} SELECT coalesce(a.code, b.code) AS code, CASE WHEN a.code IS NULL THEN 'ADD ' || b.label WHEN b.code IS NULL THEN 'DROP ' || a.label ELSE 'RENAME ' || a.label || ' → ' || b.label END AS said FROM v1 a FULL JOIN v2 b ON a.code = b.code WHERE a.code IS NULL OR b.code IS NULL OR a.label <> b.label")
def fn_46(spark, sf_dir):
    rows = job_12(spark, sf_dir).where("action <> 'UPDATE'")
    return rows.select("code", values.change_text(F.col("action"), F.col("old_label"), F.col("new_label")).alias("said"))
