"""Queries over sector flows, discovered documents, classes of heads and leaderboards."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import flows, jobs
from ..operators import relational as rel
from ..operators.staging import staged
from ..sources import discovery
from .bindings import EVENTS, HEADS, LINES, budget_lines, heads, rules_sql, slip_events, table
from .registry import query

SECTOR, SUB_SECTOR = rules_sql("major")
KEYS = ["state", "fy"]
CLASS = "CASE WHEN code < '2' THEN 0 WHEN code < '4' THEN 2 WHEN code < '6' THEN 4 WHEN code < '8' THEN 6 ELSE 8 END"

#: Nodes by counting, for each, what stands before it: every earlier sector's rows and itself, the own sector and larger ones in it.
NODES = f"""{LINES}, s AS (SELECT state, fy, {SECTOR} AS sector, {SUB_SECTOR} AS sub_sector, sum(amount) AS amount FROM lines WHERE col_type = 'be' AND amount <> 0 GROUP BY ALL),
m AS (SELECT state, fy, sector, list_position(['social', 'economic', 'general', 'grants', 'debt'], sector) AS place, sum(amount) AS amount, count(*) AS n FROM s GROUP BY ALL HAVING sum(amount) <> 0),
tops AS (SELECT a.state, a.fy, a.sector, a.amount, 1 + coalesce((SELECT sum(n + 1) FROM m b WHERE b.state = a.state AND b.fy = a.fy AND b.place < a.place), 0) AS node FROM m a),
nodes AS (SELECT state, fy, 0 AS node, 'pool' AS kind, 'Total Disbursements' AS name, NULL AS sector, sum(amount) AS amount FROM s GROUP BY ALL
  UNION ALL SELECT state, fy, node, 'sector', sector, sector, amount FROM tops
  UNION ALL SELECT a.state, a.fy, t.node + 1 + (SELECT count(*) FROM s b WHERE b.state = a.state AND b.fy = a.fy AND b.sector = a.sector AND (b.amount > a.amount OR b.amount = a.amount AND b.sub_sector < a.sub_sector)), 'sub_sector', a.sub_sector, a.sector, a.amount
    FROM s a JOIN tops t ON t.state = a.state AND t.fy = a.fy AND t.sector = a.sector)"""


def levels(spark, sf_dir):
    return staged(flows.flow_levels(budget_lines(spark, sf_dir).where("col_type = 'be'"), KEYS), "levels")


@query("job_07_nodes", f"WITH {NODES} SELECT state, fy, CAST(node AS BIGINT) AS node, kind, name, sector, amount FROM nodes")
def job_07_nodes(spark, sf_dir):
    """Nodes of every state's and year's flow."""
    return flows.flow_nodes(levels(spark, sf_dir), KEYS)


@query("job_07_links", f"WITH {NODES} SELECT a.state, a.fy, CAST(CASE WHEN a.kind = 'sector' THEN 0 ELSE t.node END AS BIGINT) AS source, CAST(a.node AS BIGINT) AS target, round(a.amount, 1) AS value FROM nodes a JOIN tops t ON t.state = a.state AND t.fy = a.fy AND t.sector = a.sector WHERE a.kind <> 'pool'")
def job_07_links(spark, sf_dir):
    """Links by node number."""
    return flows.flow_links(staged(flows.flow_nodes(levels(spark, sf_dir), KEYS), "nodes"), KEYS)


FIGURES = ", ".join(f"round(coalesce(sum(CASE WHEN sector = '{a}' AND sub_sector = '{b}' THEN amount END), 0), 1) AS {name}" for name, (a, b) in flows.DUAL.items())


@query("job_07_figures", f"WITH {NODES} SELECT state, fy, round(sum(amount), 1) AS total, {FIGURES} FROM s GROUP BY ALL")
def job_07_figures(spark, sf_dir):
    """Total and the figures beside the flow."""
    return flows.flow_figures(levels(spark, sf_dir), KEYS)


@query("win_17", f"WITH {NODES.replace(" WHERE col_type = 'be' AND amount <> 0", ' WHERE amount <> 0')} SELECT state, fy, sector, CASE WHEN kind = 'sub_sector' THEN name END AS sub_sector, CAST(node AS INT) AS node FROM nodes WHERE kind <> 'pool'")
def win_17(spark, sf_dir):
    """Node numbers of sectors and sub-sectors over all estimates."""
    found = staged(flows.flow_levels(budget_lines(spark, sf_dir), KEYS), "levels")
    rows = flows.flow_nodes(found, KEYS).where("kind <> 'pool'")
    return rows.select("state", "fy", "sector", F.when(F.col("kind") == "sub_sector", F.col("name")).alias("sub_sector"), F.col("node").cast("int").alias("node"))


# Pages as listings: links to capitalised names get a heading and point to folders of years, others to files beside the page.
LISTED = {
    '<a href="/([A-Z])([^"]*)">': '<h3> $1$2 &amp; more </h3><a class="x" href="docs/../2025-26/$1$2.PDF">',
    '<a href="/([a-m])([^"]*)">[^<]*': "<a href='/files/2025_2026/$1$2.xls?x=1'> ",
    '<a href="/([n-z][^"]*)">': '<a href="./$1-2024-25.pdf">',
}


def listings(spark, sf_dir):
    """page_id, url, html of listing pages made of the stored ones."""
    html = F.col("html")
    for pattern, made in LISTED.items():
        html = F.regexp_replace(html, pattern, made)
    return table(spark, sf_dir, "pages").select("page_id", "url", html.alias("html"))


def listed_sql() -> str:
    html = "html"
    for pattern, made in LISTED.items():
        html = f"regexp_replace({html}, '{pattern}', '{made.replace("'", "''").replace('$', chr(92))}', 'g')"
    return f"listing AS (SELECT page_id, url AS page, {html} AS html FROM pages)"


SHOWN = "trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace({0}, '(?s)<[^>]*>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&'), '\\s+', ' ', 'g'))"
PARTS = f"""{listed_sql()}, found AS (SELECT page_id, page, regexp_extract_all(html, '{discovery.PART.replace("'", "''")}') AS parts FROM listing),
exploded AS (SELECT page_id, page, CAST(unnest(range(len(parts))) AS INT) AS pos, unnest(parts) AS part FROM found),
parts AS (SELECT page_id, page, pos, CASE WHEN lower(part[:2]) <> '<a' THEN nullif({SHOWN.format("part")}, '') END AS heading, CASE WHEN lower(part[:2]) = '<a' THEN {SHOWN.format("part")} END AS text,
  CASE WHEN lower(part[:2]) = '<a' THEN regexp_extract(part, '(?is)^<a\\s[^>]*?href\\s*=\\s*(?:"([^"]*)"|''([^'']*)'')', 1) || regexp_extract(part, '(?is)^<a\\s[^>]*?href\\s*=\\s*(?:"([^"]*)"|''([^'']*)'')', 2) END AS href FROM exploded),
placed AS (SELECT *, last_value(heading IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY pos) AS section, regexp_extract(page, '^[a-z]+://[^/?#]*') AS host, regexp_replace(regexp_replace(regexp_replace(page, '[?#].*$', ''), '^[a-z]+://[^/]*', ''), '[^/]*$', '') AS folder FROM parts),
linked AS (SELECT * EXCLUDE (text), host || array_to_string(list_reduce([['']] || list_transform(string_split(CASE WHEN href[:1] = '/' THEN regexp_extract(href, '^[^?#]*') ELSE CASE WHEN folder = '' THEN '/' ELSE folder END || regexp_extract(href, '^[^?#]*') END, '/')[2:], lambda x: [x]),
    lambda acc, x: CASE WHEN x[1] = '..' THEN acc[:greatest(len(acc) - 1, 1)] WHEN x[1] = '.' THEN acc ELSE acc || x END), '/') || regexp_extract(href, '[?#].*$') AS url, text
  FROM placed WHERE href IS NOT NULL AND (contains(lower(href), '.pdf') OR contains(lower(href), '.xls'))),
titled AS (SELECT *, CASE WHEN text <> '' THEN text ELSE regexp_replace(regexp_extract(regexp_replace(url, '[?#].*$', ''), '[^/]*$'), '(.)\\.[^.]*$', '\\1') END AS title FROM linked)"""
SAFE = "CASE WHEN {0} = '' THEN 'untitled' ELSE substr({0}, 1, 180) END"
TIDY = "regexp_replace(regexp_replace(regexp_replace(regexp_replace({0}, '\\s+', ' ', 'g'), '[<>:\"/\\\\|?*\\x00-\\x1f]', '_', 'g'), '_+', '_', 'g'), '^[ ._]+|[ ._]+$', '', 'g')"
FOUND = f"""{PARTS}, year AS (SELECT *, coalesce(section, 'Budget Documents') AS sect, coalesce(nullif(lower(regexp_extract(regexp_replace(url, '[?#].*$', ''), '\\.([A-Za-z0-9]+)$', 1)), ''), 'pdf') AS ext FROM titled
  WHERE regexp_matches(href || ' ' || title, '2025-26|2025_26|2025-2026|2025_2026')),
named AS (SELECT *, {TIDY.format("title")} AS t, {TIDY.format("sect")} AS f FROM year),
found_docs AS (SELECT substr(lower(regexp_replace(regexp_replace('North_State_2025-26_' || sect || '_' || title, '[^A-Za-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')), 1, 140) AS doc_id, 'North_State' AS state, '2025-26' AS fiscal_year, sect AS section, title AS document_type, url AS source_url, page AS collection_url,
  'North_State/2025-26/' || {SAFE.format("f")} || '/' || {SAFE.format("t")} || CASE WHEN ends_with(lower({SAFE.format("t")}), '.' || ext) THEN '' ELSE '.' || ext END AS local_path, ext AS file_extension, page_id, pos FROM named)"""


@query("src_08_links", f"WITH {PARTS} SELECT page_id, pos, section, href, title, url FROM titled")
def src_08_links(spark, sf_dir):
    """Every link to a document with its section, name and address."""
    return discovery.document_links(listings(spark, sf_dir)).select("page_id", "pos", "section", "href", "title", "url")


@query("job_23_documents", f"WITH {FOUND} SELECT * FROM found_docs")
def job_23_documents(spark, sf_dir):
    """Registry rows of the documents of 2025-26 that all pages link to."""
    return discovery.discovered(listings(spark, sf_dir), "North_State", "2025-26")


@query("job_23_registry", f"""WITH {FOUND}, kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY page_id DESC, pos DESC) AS r FROM found_docs) WHERE r = 1)
SELECT doc_id, state, section, source_url, local_path, file_extension, page_id, pos FROM kept
UNION ALL SELECT doc_id || '_before', state, section, source_url || '?old', local_path, file_extension, page_id, pos FROM found_docs WHERE pos = 1""")
def job_23_registry(spark, sf_dir):
    """The registry after an upsert: of the documents that it held, some are found again, others aren't."""
    found = staged(discovery.discovered(listings(spark, sf_dir), "North_State", "2025-26"), "found")
    before = found.where("pos < 3").withColumn("source_url", F.concat("source_url", F.lit("?old")))
    gone = before.where("pos = 1").withColumn("doc_id", F.concat("doc_id", F.lit("_before")))
    return discovery.registered(before.unionByName(gone), found).select("doc_id", "state", "section", "source_url", "local_path", "file_extension", "page_id", "pos")


@query("joi_10_classes", f"WITH {HEADS}, k AS (SELECT lower(label) AS label_key, code, {CLASS} AS cls FROM heads WHERE kind = 'major'), p AS (SELECT a.label_key, count(*) AS n_links FROM k a JOIN k b ON a.label_key = b.label_key AND a.cls <> b.cls GROUP BY 1) SELECT label_key, count(*) AS n_members, any_value(n_links) AS n_links FROM k JOIN p USING (label_key) GROUP BY 1")
def joi_10_classes(spark, sf_dir):
    """Labels that heads of several account classes bear, with the number of their pairs."""
    return rel.label_classes(heads(spark, sf_dir).where("kind = 'major'"))[0]


FLAT = f"""{EVENTS}, flat AS (SELECT CASE WHEN event_id % 3 = 0 THEN code ELSE code || '-' || lpad(CAST(event_id % 7 + 1 AS VARCHAR), 3, '0') END AS code, action, event_id FROM slips)"""


def flat_events(spark, sf_dir):
    """Changes that name a major, or a minor by its flattened key."""
    minor = F.concat_ws("-", "code", F.lpad((F.col("event_id") % 7 + 1).cast("string"), 3, "0"))
    return slip_events(spark, sf_dir).select(F.when(F.col("event_id") % 3 == 0, F.col("code")).otherwise(minor).alias("code"), "action", "event_id")


@query("joi_13", f"WITH {HEADS}, {FLAT} SELECT h.code, s.code AS event_code, s.event_id, s.action, h.kind = 'minor' AND split_part(h.code, '-', 1) || '-' || split_part(h.code, '-', 3) = s.code AS exact FROM heads h JOIN flat s ON substr(h.code, 1, 4) = substr(s.code, 1, 4)")
def joi_13(spark, sf_dir):
    return jobs.head_history(heads(spark, sf_dir), flat_events(spark, sf_dir))


@query("joi_13_counts", f"WITH {HEADS}, {FLAT} SELECT h.code, count(s.code) AS n_changes, count(CASE WHEN h.kind = 'minor' AND split_part(h.code, '-', 1) || '-' || split_part(h.code, '-', 3) = s.code THEN 1 END) AS n_exact FROM heads h LEFT JOIN flat s ON substr(h.code, 1, 4) = substr(s.code, 1, 4) GROUP BY 1")
def joi_13_counts(spark, sf_dir):
    """How many changes touch each head's major, and the head itself."""
    return jobs.history_counts(heads(spark, sf_dir), flat_events(spark, sf_dir))


@query("job_17_customers", "SELECT c_name AS state, CAST(CAST(round(c_acctbal / 400) AS BIGINT) AS DOUBLE) AS ratio, CAST(row_number() OVER (ORDER BY CAST(round(c_acctbal / 400) AS BIGINT) DESC, c_name) AS INT) AS rank, round(c_acctbal / 400) > 15 AS high_stress FROM customer")
def job_17_customers(spark, sf_dir):
    """A leaderboard of any length, with many ties."""
    rows = table(spark, sf_dir, "customer")
    cell = F.concat_ws(". ", F.col("c_custkey").cast("string"), "c_name")
    return jobs.stress_leaderboard(rows.select(cell.alias("name_cell"), F.round(F.col("c_acctbal") / 400).alias("pct")), "pct")
