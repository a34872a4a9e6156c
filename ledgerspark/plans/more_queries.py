"""Further filters, joins, aggregates, windows and sorts of the survey over the given tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import fiscal, values
from ..operators import jobs
from ..operators import relational as rel
from ..operators import windows as win
from ..sources import readers
from .bindings import AMOUNT_LINES, EVENTS, HEADS, LINES, PROBES, STATEMENTS, amount_lines, budget_lines, heads, probes, rules_sql, slip_events, statements, table
from .job_queries import CLASS_SQL, HEAD_ROWS, NOTES, PART_NOTES, canonical, grid, head_rows, notes_of_parts, paragraphs
from .registry import query
from .table_queries import count_n

SECTOR, SUB_SECTOR = rules_sql("major")


@query("src_05", "SELECT 'd' || (p_partkey % 40) AS doc_id, p_partkey AS row_no, CAST(CASE WHEN p_partkey % 2 = 1 THEN 42 ELSE 36 END AS INT) AS width, CAST(CASE WHEN p_partkey % 2 = 1 THEN p_size + 2 ELSE p_size + 3 END AS VARCHAR) AS cell FROM part WHERE p_partkey >= 6")
def src_05(spark, sf_dir):
    # cell 18 is the first of last year's estimates in narrow sheets; wide ones have the total of actuals at 19
    cell = F.when(F.size("cells") >= jobs.WIDE_FROM, F.get("cells", F.lit(19))).otherwise(F.get("cells", F.lit(18)))
    return grid(spark, sf_dir).where("row_no >= 6").select("doc_id", "row_no", F.size("cells").alias("width"), cell.alias("cell"))


@query("flt_02", f"WITH {PROBES} SELECT doc_id FROM probes WHERE contains(lower(text), 'the ') OR contains(lower(text), 'über')")
def flt_02(spark, sf_dir):
    return probes(spark, sf_dir).where(values.contains_any(F.lower("text"), ["the ", "über"])).select("doc_id")


@query("flt_03", "SELECT p_partkey FROM part WHERE NOT (contains(p_type, 'ECO') OR contains(p_type, 'small'))")
def flt_03(spark, sf_dir):
    return table(spark, sf_dir, "part").where(~values.contains_any(F.col("p_type"), ["ECO", "small"])).select("p_partkey")


@query("flt_05", "SELECT o_orderkey AS report_no FROM orders WHERE o_orderkey % 2 = 0 AND o_orderkey % 3 < 2 AND (o_orderkey % 3 = 0 OR o_orderkey % 5 <= 1)")
def flt_05(spark, sf_dir):
    key = F.col("o_orderkey")
    kind = F.when(key % 3 == 0, "demands_for_grants").when(key % 3 == 1, "other").otherwise("action_taken")
    title = F.concat(F.when(key % 2 == 0, "Women and Child").otherwise("Roads"), F.when(key % 5 == 0, " DFG ").when(key % 5 == 1, " Demands for Grants").otherwise(" Bill"), F.lit(" 2024"))
    return jobs.demand_reports(table(spark, sf_dir, "orders").select(key.alias("report_no"), kind.alias("report_type"), title.alias("title"))).select("report_no")


@query("flt_06", "SELECT o_orderkey FROM orders WHERE o_orderkey % 6 < 4")
def flt_06(spark, sf_dir):
    key = F.col("o_orderkey") % 6
    href = F.element_at(F.array(*map(F.lit, ["a/2025-26/x", "b_2025_26", "c 2025-2026", "d/2025_2026.pdf", "e/2024-25", "f"])), (key + 1).cast("int"))
    variants = fiscal.fy_variants(F.lit("2025-26"))
    return table(spark, sf_dir, "orders").where(F.exists(variants, lambda v: F.contains(href, v))).select("o_orderkey")


@query("flt_09", "SELECT 'd' || (p_partkey % 40) AS doc_id, min(p_partkey) AS row_no FROM part WHERE p_partkey % 5 = 3 GROUP BY 1")
def flt_09(spark, sf_dir):
    hit = F.exists("cells", lambda c: F.contains(F.lower(c), F.lit("icds")))
    return grid(spark, sf_dir).where(hit).groupBy("doc_id").agg(F.min("row_no").alias("row_no"))


@query("flt_10", f"WITH {STATEMENTS} SELECT state FROM statements WHERE state NOT IN ('NATION_1', 'Total') AND grants IS NOT NULL")
def flt_10(spark, sf_dir):
    return statements(spark, sf_dir).where(~F.col("state").isin("NATION_1", "Total")).dropna().select("state")


@query("flt_12", "SELECT p_partkey FROM part WHERE contains(upper(p_name), 'RING')")
def flt_12(spark, sf_dir):
    return table(spark, sf_dir, "part").where(F.upper("p_name").contains("RING")).select("p_partkey")


@query("flt_14", f"WITH {AMOUNT_LINES} SELECT doc_id, line_no, line FROM amount_lines WHERE contains(lower(line), 'ring') ORDER BY doc_id, line_no, line LIMIT 50")
def flt_14(spark, sf_dir):
    return amount_lines(spark, sf_dir).where(F.lower("line").contains("ring")).orderBy("doc_id", "line_no", "line").limit(50)


@query("flt_15", f"WITH {EVENTS} SELECT code, count(*) AS n FROM slips WHERE action = 'RENAME' GROUP BY 1")
def flt_15(spark, sf_dir):
    nested = slip_events(spark, sf_dir).groupBy("code").agg(F.collect_list(F.struct("action", "label")).alias("changes"))
    kept = F.filter("changes", lambda c: c["action"] == "RENAME")
    return nested.select("code", kept.alias("changes")).where(F.size("changes") > 0).select("code", F.size("changes").cast("long").alias("n"))


@query("flt_16", "SELECT CAST(c_custkey AS VARCHAR) AS year, c_custkey * 1.0 AS ghe_pct_gdp FROM customer")
def flt_16(spark, sf_dir):
    columns = [F.col("c_custkey").cast("string").alias(c) for c in jobs.HEALTH]
    return jobs.health_accounts(table(spark, sf_dir, "customer").select(*columns)).select("year", "ghe_pct_gdp")


@query("flt_17", "SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/]*)', 1)) AS slug, CAST(CASE WHEN page_id % 3 = 0 THEN 2 ELSE 1 END AS INT) AS n FROM pages")
def flt_17(spark, sf_dir):
    key = F.col("page_id")
    one = lambda kind, url: F.struct(kind.alias("format"), url.alias("url"))
    resources = F.array(one(F.lit("html"), F.lit("a/b.PDF")), one(F.when(key % 3 == 0, "pdf").otherwise("csv"), F.lit("c")))
    kept = F.filter(resources, lambda r: (F.upper(r["format"]) == "PDF") | F.lower(r["url"]).endswith(".pdf"))
    host = F.regexp_extract("url", "^[a-z]+://([^/]*)", 1)
    return table(spark, sf_dir, "pages").select("page_id", F.lower(F.coalesce(F.nullif(host, F.lit("")), F.lit("none"))).alias("slug"), F.size(kept).alias("n"))


@query("flt_18", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE 80 + l_partkey % 300 BETWEEN 80 AND 2000 AND (80 + l_partkey % 300) * (10 + l_suppkey % 40) BETWEEN 3000 AND 60000 AND l_suppkey % 40 BETWEEN 5 AND 25")
def flt_18(spark, sf_dir):
    daily = 80 + F.col("l_partkey") % 300
    numbers = F.array(daily, daily * (10 + F.col("l_suppkey") % 40))
    d, m = (F.get(F.filter(numbers, lambda n: n.between(a, z)), 0) for a, z in ((80, 2000), (3000, 60000)))  # noqa: B023
    return table(spark, sf_dir, "lineitem").where(m.between(d * 15, d * 35)).select("l_orderkey", "l_linenumber")


@query("joi_02", "SELECT p_partkey, 'icds' AS canonical FROM part WHERE p_partkey % 5 IN (2, 3)")
def joi_02(spark, sf_dir):
    return jobs.measured(grid(spark, sf_dir)).join(canonical(spark), F.col("name") == F.col("source_name")).select(F.col("row_no").alias("p_partkey"), "canonical")


@query("joi_03", "SELECT p_partkey, CASE WHEN p_partkey % 5 IN (2, 3) THEN 'icds' ELSE 'unknown' END AS canonical FROM part")
def joi_03(spark, sf_dir):
    rows = jobs.measured(grid(spark, sf_dir)).join(canonical(spark), F.col("name") == F.col("source_name"), "left")
    return rows.select(F.col("row_no").alias("p_partkey"), F.coalesce("canonical", F.lit("unknown")).alias("canonical"))


@query("joi_05", f"WITH {STATEMENTS} SELECT n.n_name AS state, g.grants FROM nation n LEFT JOIN (SELECT lower(state) AS k, grants FROM statements WHERE grants IS NOT NULL) g ON lower(n.n_name) = g.k")
def joi_05(spark, sf_dir):
    found = rel.first_per(statements(spark, sf_dir).where("grants is not null").select(F.lower("state").alias("k"), "grants"), ["k"], ["grants"])
    rows = table(spark, sf_dir, "nation").select(F.col("n_name").alias("state"))
    return rows.join(found, F.lower("state") == F.col("k"), "left").select("state", "grants")


@query("joi_08", f"WITH {HEADS}, {PART_NOTES} SELECT code, note FROM pn WHERE trim(note) <> '' AND code IN (SELECT code FROM heads)")
def joi_08(spark, sf_dir):
    return notes_of_parts(spark, sf_dir).where("trim(note) <> ''").join(heads(spark, sf_dir).select("code"), "code", "left_semi")


@query("joi_09", f"WITH {HEAD_ROWS}, {NOTES} SELECT DISTINCT hc.code, hc.marker AS number, hc.t AS table_id FROM hc JOIN notes ON hc.t = notes.t AND hc.marker = notes.number")
def joi_09(spark, sf_dir):
    rows = jobs.labelled_heads(head_rows(spark, sf_dir))
    marked = rows.select("table_id", "code", F.explode(values.markers(F.col("label"))).alias("number")).distinct()
    return marked.join(jobs.numbered_notes(paragraphs(spark, sf_dir)), ["table_id", "number"]).select("code", "number", "table_id")


@query("joi_16", "SELECT event_id FROM events WHERE event_id NOT IN (SELECT p_partkey FROM part)")
def joi_16(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id").join(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("event_id")), "event_id", "left_anti")


@query("joi_17", "SELECT 'd' || (p_partkey % 40) AS doc_id, p_partkey AS row_no, CAST(p_size AS DOUBLE) AS actual_revenue, CAST(p_size + 11 AS DOUBLE) AS be_total FROM part")
def joi_17(spark, sf_dir):
    return jobs.measured(grid(spark, sf_dir)).select("doc_id", "row_no", "actual_revenue", "be_total")


@query("joi_18", f"WITH {HEADS}, o AS (SELECT major AS code, CAST(sum(amount) AS DOUBLE) AS spent FROM lines WHERE col_type = 'actual' GROUP BY 1) SELECT h.code, h.label, o.spent FROM heads h LEFT JOIN o ON h.code = o.code WHERE h.kind = 'major'")
def joi_18(spark, sf_dir):
    spent = budget_lines(spark, sf_dir).where("col_type = 'actual'").groupBy(F.col("major").alias("code")).agg(F.sum("amount").cast("double").alias("spent"))
    return heads(spark, sf_dir).where("kind = 'major'").select("code", "label").join(spent, "code", "left")


@query("agg_07", f"WITH {LINES} SELECT state, major, CAST(sum(amount) AS DOUBLE) AS amount FROM lines GROUP BY 1, 2")
def agg_07(spark, sf_dir):
    rows = budget_lines(spark, sf_dir).where(F.col("major").rlike("^[0-9]+$"))
    return rows.groupBy("state", "major").agg(F.sum(F.coalesce("amount", F.lit(0))).cast("double").alias("amount"))


@query("agg_08", f"WITH {LINES}, n AS (SELECT state, {SECTOR} AS s, amount FROM lines) SELECT state, CASE WHEN s = 'grants' THEN 'general' ELSE s END AS macro, CAST(round(sum(amount), 1) AS DOUBLE) AS amount FROM n WHERE s <> 'debt' GROUP BY 1, 2")
def agg_08(spark, sf_dir):
    by_head = budget_lines(spark, sf_dir).groupBy("state", "major").agg(F.sum("amount").alias("amount"))
    macro = fiscal.classify(F.col("major"))[0]
    named = by_head.select("state", F.when(macro == "grants", "general").otherwise(macro).alias("macro"), "amount").where("macro <> 'debt'")
    return named.groupBy("state", "macro").agg(F.round(F.sum("amount"), 1).cast("double").alias("amount"))


@query("agg_15", f"WITH {EVENTS} SELECT action AS status, count(*) AS n FROM slips GROUP BY 1")
def agg_15(spark, sf_dir):
    return slip_events(spark, sf_dir).groupBy(F.col("action").alias("status")).agg(count_n())


@query("agg_16", f"WITH {PART_NOTES}, p AS (SELECT CAST(2000 + p_partkey % 1700 AS VARCHAR) AS code, p_partkey, p_name FROM part) SELECT code, string_agg(p_name, ' / ' ORDER BY p_partkey) AS notes FROM p GROUP BY 1")
def agg_16(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select((2000 + F.col("p_partkey") % 1700).cast("string").alias("code"), F.struct(F.col("p_partkey").alias("pos"), "p_name").alias("r"))
    return rows.groupBy("code").agg(F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["p_name"]), " / ").alias("notes"))


@query("agg_22", f"WITH {HEADS} SELECT {CLASS_SQL.format('code')} AS cls, string_agg(code, ',' ORDER BY code) AS codes FROM heads WHERE kind = 'major' AND contains(label, 'ring') GROUP BY 1")
def agg_22(spark, sf_dir):
    hits = rel.subject_hits(heads(spark, sf_dir).where("kind = 'major'"), "ring")
    return hits.groupBy(fiscal.account_class(F.col("code")).alias("cls")).agg(F.array_join(F.array_sort(F.collect_list("code")), ",").alias("codes"))


@query("agg_23", f"WITH {LINES} SELECT state AS book, fy, col_type AS basis, count(*) AS n FROM lines GROUP BY 1, 2, 3")
def agg_23(spark, sf_dir):
    return budget_lines(spark, sf_dir).groupBy(F.col("state").alias("book"), "fy", F.col("col_type").alias("basis")).agg(count_n())


@query("agg_24", "SELECT c_nationkey AS state, min(c_custkey) AS first_row FROM customer GROUP BY 1")
def agg_24(spark, sf_dir):
    return rel.first_per(table(spark, sf_dir, "customer"), ["c_nationkey"], ["c_custkey"]).select(F.col("c_nationkey").alias("state"), F.col("c_custkey").alias("first_row"))


@query("win_07", "WITH r AS (SELECT *, sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM events) SELECT user_id, CAST(run AS BIGINT) AS run, string_agg(CAST(event_id AS VARCHAR), ' ' ORDER BY event_id) AS label FROM r WHERE run > 0 GROUP BY 1, 2")
def win_07(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", F.when(F.col("event_type") == "click", "4202").otherwise("").alias("code"), F.col("event_id").cast("string").alias("label"))
    return win.continued(rows, ["user_id"], "event_id", F.col("code") != "", "label")


BINS = "CASE WHEN value < 120 THEN 'code' WHEN value < 250 THEN 'sub' WHEN value < 310 THEN 'minor' ELSE 'label' END"


@query("win_11", f"SELECT user_id, {BINS} AS bin, string_agg(CAST(event_id AS VARCHAR), ' ' ORDER BY value, event_id) AS words FROM (SELECT user_id, event_id, value * 8 AS value FROM events) GROUP BY 1, 2")
def win_11(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", (F.col("value") * 8).alias("value"))
    return win.binned_words(rows, ["user_id"], "value", "event_id", [(120, "code"), (250, "sub"), (310, "minor")], "label")


@query("win_16", f"WITH {LINES} SELECT state, col_type, major, coalesce(max(CASE WHEN fy = '1999-00' THEN fy END), max(fy)) AS fy FROM lines GROUP BY 1, 2, 3")
def win_16(spark, sf_dir):
    return rel.latest_period(budget_lines(spark, sf_dir), ["state", "col_type", "major"], "fy", "1999-00")


@query("srt_01", "SELECT p_brand AS code, p_size AS n, p_type AS source, p_partkey FROM part ORDER BY 1, 2, 3, 4")
def srt_01(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(F.col("p_brand").alias("code"), F.col("p_size").cast("string").alias("n"), F.col("p_type").alias("source"), "p_partkey")
    return rows.orderBy("code", F.col("n").cast("int"), "source", "p_partkey").withColumn("n", F.col("n").cast("int"))


@query("srt_02", f"WITH {LINES}, s AS (SELECT {SECTOR} AS sector, {SUB_SECTOR} AS sub_sector, sum(amount) AS amount FROM lines GROUP BY 1, 2) SELECT sector, sub_sector, CAST(row_number() OVER (PARTITION BY sector ORDER BY amount DESC, sub_sector) AS INT) AS place FROM s")
def srt_02(spark, sf_dir):
    rows = rel.sector_rollup(budget_lines(spark, sf_dir).withColumn("k", F.lit(1)), ["k"]).where("level = 0")
    place = F.row_number().over(Window.partitionBy("sector").orderBy(F.desc("amount"), "sub_sector"))
    return rows.select("sector", "sub_sector", place.alias("place"))


@query("srt_04", "SELECT doc_id, source AS state FROM documents ORDER BY doc_id LIMIT 25")
def srt_04(spark, sf_dir):
    return readers.registry(probes(spark, sf_dir), limit=25).select("doc_id", "state")


@query("srt_05", f"WITH {EVENTS} SELECT code, event_id, CAST(row_number() OVER (PARTITION BY code ORDER BY ts DESC, event_id DESC) AS INT) AS place FROM slips")
def srt_05(spark, sf_dir):
    place = F.row_number().over(Window.partitionBy("code").orderBy(F.desc("ts"), F.desc("event_id")))
    return slip_events(spark, sf_dir).select("code", "event_id", place.alias("place"))


@query("set_02", f"WITH {LINES} SELECT col_type AS source, 'pool' AS target, CAST(sum(amount) AS DOUBLE) AS amount FROM lines GROUP BY 1 UNION ALL SELECT 'pool', {SECTOR}, CAST(sum(amount) AS DOUBLE) FROM lines GROUP BY {SECTOR}")
def set_02(spark, sf_dir):
    rows, pool = budget_lines(spark, sf_dir), F.lit("pool")
    into = rows.groupBy(F.col("col_type").alias("source")).agg(F.sum("amount").cast("double").alias("amount")).select("source", pool.alias("target"), "amount")
    out = rows.groupBy("major").agg(F.sum("amount").alias("amount")).groupBy(fiscal.classify(F.col("major"))[0].alias("target")).agg(F.sum("amount").cast("double").alias("amount"))
    return into.unionByName(out.select(pool.alias("source"), "target", "amount"))


@query("set_04", f"WITH {HEAD_ROWS} SELECT DISTINCT parent_code AS code FROM hc WHERE parent_code IS NOT NULL AND kind = 'minor' EXCEPT SELECT code FROM hc WHERE kind = 'submajor' AND code NOT LIKE '%2'")
def set_04(spark, sf_dir):
    rows = jobs.labelled_heads(head_rows(spark, sf_dir))
    kept = "kind = 'minor' OR kind = 'submajor' AND code NOT LIKE '%2'"
    return rel.missing_parents(rows.where(kept).withColumn("parent_code", F.when(F.col("kind") == "minor", F.col("parent_code"))))


@query("snk_07", f"WITH {LINES}, s AS (SELECT state, fy, {SECTOR} AS sector, sum(amount) AS amount FROM lines GROUP BY ALL) SELECT state, fy, '{{\"sectors\":[' || string_agg('{{\"sector\":\"' || sector || '\",\"amount\":' || amount || '}}', ',' ORDER BY sector) || ']}}' AS payload FROM s GROUP BY 1, 2")
def snk_07(spark, sf_dir):
    by_head = budget_lines(spark, sf_dir).groupBy("state", "fy", "major").agg(F.sum("amount").alias("amount"))
    rows = by_head.groupBy("state", "fy", fiscal.classify(F.col("major"))[0].alias("sector")).agg(F.sum("amount").alias("amount"))
    return readers.json_payload(rows, ["state", "fy"], "sectors")


@query("snk_09", f"WITH {HEADS} SELECT code || ' broader ' || parent_code || ' .' AS value FROM heads WHERE parent_code IS NOT NULL")
def snk_09(spark, sf_dir):
    rows = heads(spark, sf_dir).where("parent_code is not null")
    return readers.triple_lines(rows.select(F.col("code").alias("s"), F.lit("broader").alias("p"), F.col("parent_code").alias("o")))


@query("ext_01", f"WITH {PROBES} SELECT doc_id, len(regexp_extract_all(lower(text), 'cut')) + len(regexp_extract_all(lower(text), 'freeze')) AS austerity_score FROM probes")
def ext_01(spark, sf_dir):
    """A provider that a user passes in place of the default markers."""
    from .extensions import text_signals

    short = lambda text: {"austerity_score": values.signal(text, ["cut", "freeze"]).cast("long")}
    return text_signals(probes(spark, sf_dir), "text", short).select("doc_id", "austerity_score")
