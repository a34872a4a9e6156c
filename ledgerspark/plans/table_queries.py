"""Filters, joins, aggregates, windows, sinks and jobs over the given tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import fiscal, values
from ..operators import relational as rel
from ..operators import windows as win
from ..operators.staging import staged
from ..sources import readers
from .bindings import (
    AMOUNT_LINES, EVENTS, HEADS, LINES, PROBES, STATEMENTS, TEXT_LINES, VERSIONS, amount_lines, budget_lines, heads, probes, rules_sql, slip_events, statements, table, text_lines, versions,
)
from .registry import query

SECTOR, SUB_SECTOR = rules_sql("major")


def count_n():
    return F.count(F.lit(1)).cast("long").alias("n")


@query("src_06", f"WITH {TEXT_LINES} SELECT doc_id, line_no, line FROM text_lines")
def src_06(spark, sf_dir):
    return text_lines(spark, sf_dir)


@query("src_07", f"WITH {PROBES} SELECT doc_id, state, ext FROM probes WHERE state IN ('src 7', 'src_7', 'src7')")
def src_07(spark, sf_dir):
    return readers.registry(probes(spark, sf_dir), "src7").select("doc_id", "state", "ext")


@query("src_08", "SELECT page_id, count(*) AS n FROM (SELECT page_id, unnest(regexp_extract_all(html, '(?s)<a[^>]*href=\"([^\"]*)\"[^>]*>(.*?)</a>', 1)) AS href FROM pages) GROUP BY 1")
def src_08(spark, sf_dir):
    return readers.links(table(spark, sf_dir, "pages")).groupBy("page_id").agg(count_n())


@query("flt_01", "SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'ring') OR contains(p_name, 'blue')")
def flt_01(spark, sf_dir):
    return table(spark, sf_dir, "part").where(values.contains_any(F.col("p_name"), ["ring", "blue"])).select("p_partkey", "p_name")


@query("flt_04", "SELECT o_orderkey FROM orders WHERE o_orderpriority IS NOT NULL AND NOT contains(o_orderpriority, 'Net') AND TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) IS NOT NULL")
def flt_04(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("name"), F.substring("o_orderpriority", 1, 1).alias("c1"), F.lit("x").alias("c2"))
    return rel.keep_data_rows(rows, "name", ["c1", "c2"]).select("o_orderkey")


@query("flt_07", f"WITH {LINES} SELECT fy, count(*) AS n FROM lines WHERE CAST(substr(fy, 1, 4) AS INT) BETWEEN 1996 AND 1998 GROUP BY 1")
def flt_07(spark, sf_dir):
    return budget_lines(spark, sf_dir).where(fiscal.fy_start(F.col("fy")).between(1996, 1998)).groupBy("fy").agg(count_n())


@query("flt_08", f"WITH {STATEMENTS} SELECT regexp_extract(name_cell, '^[^.]*\\.(.*)$', 1) AS name FROM statements WHERE regexp_matches(name_cell, '[0-9]') AND contains(name_cell, '.')")
def flt_08(spark, sf_dir):
    c = F.col("name_cell")
    return statements(spark, sf_dir).where(c.rlike("[0-9]") & c.contains(".")).select(F.regexp_extract(c, "^[^.]*\\.(.*)$", 1).alias("name"))


@query("flt_11", f"WITH {STATEMENTS} SELECT state FROM statements WHERE liabilities > 0 AND pct > 0 AND grants IS NOT NULL AND state NOT IN ('Total')")
def flt_11(spark, sf_dir):
    return statements(spark, sf_dir).where("liabilities > 0 AND pct > 0").where(~F.col("state").isin("Total")).dropna().select("state")


@query("flt_13", f"WITH {HEADS} SELECT code, label FROM heads WHERE contains(trim(regexp_replace(lower(code || ' ' || label), '[^a-z0-9]+', ' ', 'g')), '22') AND contains(trim(regexp_replace(lower(code || ' ' || label), '[^a-z0-9]+', ' ', 'g')), '1')")
def flt_13(spark, sf_dir):
    return rel.subject_hits(heads(spark, sf_dir), "22, 1").select("code", "label")


@query("joi_01", f"WITH {PROBES} SELECT d.doc_id, p.chars FROM documents d LEFT JOIN (SELECT doc_id, chars FROM probes WHERE chars IS NOT NULL) p ON d.doc_id = p.doc_id")
def joi_01(spark, sf_dir):
    found = probes(spark, sf_dir).where("chars is not null").select("doc_id", "chars")
    return table(spark, sf_dir, "documents").select("doc_id").join(found, "doc_id", "left")


@query("joi_04", f"WITH {STATEMENTS} SELECT a.state, a.liabilities, b.devolution FROM statements a JOIN statements b ON a.state = b.state WHERE b.grants IS NOT NULL")
def joi_04(spark, sf_dir):
    rows = statements(spark, sf_dir)
    return rows.select("state", "liabilities").join(rows.where("grants is not null").select("state", "devolution"), "state")


@query("joi_07", "WITH " + HEADS + " SELECT DISTINCT parent_code AS code FROM (SELECT * FROM heads WHERE kind <> 'major' OR code < '3') WHERE parent_code IS NOT NULL AND parent_code NOT IN (SELECT code FROM heads WHERE kind <> 'major' OR code < '3')")
def joi_07(spark, sf_dir):
    return rel.missing_parents(heads(spark, sf_dir).where("kind <> 'major' OR code < '3'"))


@query("joi_10", f"WITH {HEADS}, k AS (SELECT code, lower(label) AS key, CASE WHEN code < '2' THEN 0 WHEN code < '4' THEN 2 WHEN code < '6' THEN 4 WHEN code < '8' THEN 6 ELSE 8 END AS cls FROM heads WHERE kind = 'major') SELECT a.code, b.code AS sibling FROM k a JOIN k b ON a.key = b.key AND a.cls <> b.cls")
def joi_10(spark, sf_dir):
    return rel.siblings(heads(spark, sf_dir).where("kind = 'major'"))


@query("joi_11", f"WITH {HEADS} SELECT h.code, h.label, count(c.code) AS n_children FROM heads h LEFT JOIN heads c ON c.parent_code = h.code GROUP BY 1, 2")
def joi_11(spark, sf_dir):
    return rel.children(heads(spark, sf_dir))


@query("joi_12", f"WITH {HEADS} SELECT h.code, concat_ws(' > ', g.code, h.parent_code, h.code) AS path FROM heads h LEFT JOIN heads p ON p.code = h.parent_code LEFT JOIN heads g ON g.code = p.parent_code")
def joi_12(spark, sf_dir):
    return rel.ancestors(staged(heads(spark, sf_dir), "heads"))


@query("joi_15", f"WITH {LINES} SELECT DISTINCT major, {SECTOR} AS sector, {SUB_SECTOR} AS sub_sector FROM lines")
def joi_15(spark, sf_dir):
    sector, label = fiscal.classify(F.col("major"))
    return budget_lines(spark, sf_dir).select("major").distinct().select("major", sector.alias("sector"), label.alias("sub_sector"))


@query("joi_19", f"WITH {VERSIONS} SELECT coalesce(a.code, b.code) AS code, CASE WHEN a.code IS NULL THEN 'added' WHEN b.code IS NULL THEN 'removed' ELSE 'modified' END AS diff, a.label AS from_label, b.label AS to_label FROM v1 a FULL JOIN v2 b ON a.code = b.code WHERE a.code IS NULL OR b.code IS NULL OR a.label <> b.label OR a.parent_code <> b.parent_code")
def joi_19(spark, sf_dir):
    return rel.version_diff(*versions(spark, sf_dir), "code", ["parent_code", "label"]).select("code", "diff", "from_label", "to_label")


@query("fn_31", f"WITH {VERSIONS} SELECT coalesce(a.code, b.code) AS code, CASE WHEN a.code IS NULL THEN 'INSERT' WHEN b.code IS NULL THEN 'DELETE' WHEN a.label <> b.label THEN 'RENAME' ELSE 'UPDATE' END AS action, coalesce(b.label, a.label) AS label, CASE WHEN a.label <> b.label THEN a.label END AS old_label FROM v1 a FULL JOIN v2 b ON a.code = b.code WHERE a.code IS NULL OR b.code IS NULL OR a.label <> b.label OR a.parent_code <> b.parent_code")
def fn_31(spark, sf_dir):
    return rel.change_of(rel.version_diff(*versions(spark, sf_dir), "code", ["parent_code", "label"]))


@query("agg_01", f"WITH {LINES} SELECT major || '-' || sub || '-' || minor AS code, fy, CAST(sum(amount) AS DOUBLE) AS be FROM lines WHERE col_type = 'be' GROUP BY 1, 2")
def agg_01(spark, sf_dir):
    code = fiscal.head_code(F.col("major"), F.col("sub"), F.col("minor"))
    return budget_lines(spark, sf_dir).where("col_type = 'be' AND amount <> 0").groupBy(code.alias("code"), "fy").agg(F.sum("amount").cast("double").alias("be"))


@query("agg_02", f"WITH {LINES} SELECT fy, CAST(sum(amount) AS DOUBLE) AS total, count(*) AS n FROM lines GROUP BY 1")
def agg_02(spark, sf_dir):
    return budget_lines(spark, sf_dir).groupBy("fy").agg(F.sum("amount").cast("double").alias("total"), count_n())


ROLLUP = f"WITH {LINES}, named AS (SELECT state, fy, {SECTOR} AS sector, {SUB_SECTOR} AS sub_sector, amount FROM lines WHERE col_type = 'be' AND amount <> 0) SELECT state, fy, sector, sub_sector, CAST(grouping(sector) * 2 + grouping(sub_sector) AS INT) AS level, CAST(sum(amount) AS DOUBLE) AS amount FROM named GROUP BY GROUPING SETS ((state, fy, sector, sub_sector), (state, fy, sector), (state, fy))"


@query("agg_03", ROLLUP)
def agg_03(spark, sf_dir):
    return rel.sector_rollup(budget_lines(spark, sf_dir).where("col_type = 'be'"), ["state", "fy"]).withColumn("amount", F.col("amount").cast("double"))


@query("agg_04", f"WITH {LINES}, named AS (SELECT state, fy, {SUB_SECTOR} AS s, amount FROM lines) SELECT state, fy, CAST(coalesce(sum(CASE WHEN s = 'Interest payments' THEN amount END), 0) AS DOUBLE) AS interest, CAST(coalesce(sum(CASE WHEN s = 'Health & family welfare' THEN amount END), 0) AS DOUBLE) AS health FROM named GROUP BY 1, 2")
def agg_04(spark, sf_dir):
    _, label = fiscal.classify(F.col("major"))
    pick = lambda name: F.coalesce(F.sum(F.when(F.col("s") == name, F.col("amount"))), F.lit(0)).cast("double")
    return budget_lines(spark, sf_dir).select("state", "fy", label.alias("s"), "amount").groupBy("state", "fy").agg(pick("Interest payments").alias("interest"), pick("Health & family welfare").alias("health"))


@query("agg_05", f"WITH {LINES} SELECT state, fy, major, CAST(greatest(max(amount), 0) AS DOUBLE) AS amount FROM lines GROUP BY 1, 2, 3")
def agg_05(spark, sf_dir):
    return budget_lines(spark, sf_dir).groupBy("state", "fy", "major").agg(F.greatest(F.max("amount"), F.lit(0)).cast("double").alias("amount"))


@query("agg_11", f"WITH {STATEMENTS}, t AS (SELECT sum(liabilities / (pct / 100)) AS gsdp, sum(devolution * 0.217 / (1 - 0.217)) AS gap, sum(grants) AS grants FROM statements) SELECT round(gsdp, 0) AS gsdp, round(gap, 0) AS gap, round(grants, 0) AS grants, round(CASE WHEN gsdp > 0 THEN 100 * gap / gsdp ELSE 0 END, 6) AS intensity FROM t")
def agg_11(spark, sf_dir):
    own = statements(spark, sf_dir).select(fiscal_gsdp().alias("gsdp"), values.devolution_gap(F.col("devolution")).alias("gap"), "grants")
    return rel.national_totals(own).select(*[F.round(c, 0).alias(c) for c in ("gsdp", "gap", "grants")], F.round("intensity", 6).alias("intensity"))


def fiscal_gsdp():
    return values.gsdp(F.col("liabilities"), F.col("pct"))


@query("agg_12", f"WITH {HEADS} SELECT kind, count(*) AS n FROM heads GROUP BY 1")
def agg_12(spark, sf_dir):
    return heads(spark, sf_dir).groupBy("kind").agg(count_n())


@query("agg_13", f"WITH {EVENTS} SELECT action, CAST(day(ts) AS INT) AS day, count(*) AS n FROM slips GROUP BY 1, 2")
def agg_13(spark, sf_dir):
    return slip_events(spark, sf_dir).groupBy("action", F.dayofmonth("ts").alias("day")).agg(count_n())


@query("agg_14", f"WITH {PROBES} SELECT state, count(*) AS total, count(CASE WHEN lang = 'en' THEN 1 END) AS en, count(CASE WHEN lang = 'fr' THEN 1 END) AS fr FROM probes GROUP BY 1")
def agg_14(spark, sf_dir):
    of = lambda lang: F.count(F.when(F.col("lang") == lang, 1)).alias(lang)
    return probes(spark, sf_dir).groupBy("state").agg(F.count(F.lit(1)).alias("total"), of("en"), of("fr"))


@query("agg_17", f"WITH {EVENTS} SELECT CAST(day(ts) AS INT) AS day, string_agg(DISTINCT code, ',' ORDER BY code) AS codes FROM slips GROUP BY 1")
def agg_17(spark, sf_dir):
    return slip_events(spark, sf_dir).groupBy(F.dayofmonth("ts").alias("day")).agg(F.array_join(F.sort_array(F.collect_set("code")), ",").alias("codes"))


@query("agg_18", "SELECT p_brand AS code, count(DISTINCT p_type) AS n FROM part GROUP BY 1 HAVING count(DISTINCT p_type) > 1")
def agg_18(spark, sf_dir):
    return rel.conflicting(table(spark, sf_dir, "part").select(F.col("p_brand").alias("code"), "p_type"), ["p_type"])


@query("agg_19", f"WITH {EVENTS} SELECT min(ts) AS first_at, max(ts) AS last_at FROM slips")
def agg_19(spark, sf_dir):
    return slip_events(spark, sf_dir).agg(F.min("ts").alias("first_at"), F.max("ts").alias("last_at"))


@query("agg_20", f"WITH {LINES} SELECT fy, CAST(sum(CASE WHEN col_type = 'actual' THEN amount END) AS DOUBLE) AS actual, CAST(sum(CASE WHEN col_type = 'be' THEN amount END) AS DOUBLE) AS be, CAST(sum(CASE WHEN col_type = 're' THEN amount END) AS DOUBLE) AS re FROM lines GROUP BY 1")
def agg_20(spark, sf_dir):
    return budget_lines(spark, sf_dir).groupBy("fy").pivot("col_type", ["actual", "be", "re"]).agg(F.sum("amount").cast("double"))


@query("agg_21", "SELECT p_partkey, t.col_type, t.fy, t.total FROM part, (VALUES ('actual', '2023-24'), ('be', '2024-25'), ('re', '2024-25'), ('be', '2025-26')) v(col_type, fy), LATERAL (SELECT v.col_type, v.fy, CAST(CASE WHEN v.fy = '2023-24' THEN p_size WHEN v.col_type = 're' THEN p_size + 2 WHEN v.fy = '2024-25' THEN p_size + 1 ELSE p_size + 3 END AS BIGINT) AS total) t")
def agg_21(spark, sf_dir):
    wide = table(spark, sf_dir, "part").select("p_partkey", F.lit("2025-26").alias("fy"), *[(F.col("p_size") + k).cast("long").alias(f"m{k}") for k in range(4)])
    return rel.estimate_rows(wide, ["p_partkey"], "fy", {"actual": "m0", "be_prev": "m1", "re": "m2", "be": "m3"})


@query("win_01", "SELECT user_id, event_type, arg_max(event_id, ts) AS event_id FROM events GROUP BY 1, 2")
def win_01(spark, sf_dir):
    return rel.latest_reading(table(spark, sf_dir, "events"), ["user_id", "event_type"], "ts", ["event_id"])


@query("win_02", "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events) WHERE r = 1")
def win_02(spark, sf_dir):
    return rel.first_per(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


FILL = "SELECT user_id, event_id, CASE WHEN event_type = 'signup' THEN event_type || event_id END AS major, CASE WHEN event_type = 'click' THEN event_type || event_id END AS sub FROM events"


@query("win_03", f"WITH r AS ({FILL}), a AS (SELECT *, count(major) OVER w AS run, last_value(major IGNORE NULLS) OVER w AS cur_major FROM r WINDOW w AS (PARTITION BY user_id ORDER BY event_id)) SELECT user_id, event_id, cur_major, cur_sub FROM (SELECT *, last_value(sub IGNORE NULLS) OVER (PARTITION BY user_id, run ORDER BY event_id) AS cur_sub FROM a) WHERE cur_major IS NOT NULL")
def win_03(spark, sf_dir):
    kind, key = F.col("event_type"), F.concat("event_type", F.col("event_id").cast("string"))
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", F.when(kind == "signup", key).alias("major"), F.when(kind == "click", key).alias("sub"))
    return win.fill_heads(rows, ["user_id"], "event_id").select("user_id", "event_id", "cur_major", "cur_sub")


@query("win_04", f"SELECT user_id, event_id, last_value(major IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id) AS section FROM ({FILL})")
def win_04(spark, sf_dir):
    kind = F.when(F.col("event_type") == "signup", F.concat("event_type", F.col("event_id").cast("string")))
    return win.fill_forward(table(spark, sf_dir, "events").withColumn("m", kind), ["user_id"], "event_id", "m", "section").select("user_id", "event_id", "section")


@query("win_05", f"WITH {LINES}, c AS (SELECT state, fy, col_type, count(*) AS n FROM lines GROUP BY 1, 2, 3) SELECT fy, col_type, state, n FROM (SELECT *, row_number() OVER (PARTITION BY fy, col_type ORDER BY n DESC, state) AS r FROM c) WHERE r = 1")
def win_05(spark, sf_dir):
    counts = budget_lines(spark, sf_dir).groupBy("state", "fy", "col_type").agg(count_n())
    return rel.first_per(counts, ["fy", "col_type"], [F.desc("n"), "state"]).select("fy", "col_type", "state", "n")


@query("win_06", "WITH r AS (SELECT *, sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM events) SELECT user_id, CAST(run AS BIGINT) AS run, string_agg(event_type, ' ' ORDER BY event_id) AS event_type FROM r WHERE run > 0 GROUP BY 1, 2")
def win_06(spark, sf_dir):
    return win.continued(table(spark, sf_dir, "events"), ["user_id"], "event_id", F.col("event_type") == "signup", "event_type")


@query("win_08", f"WITH {AMOUNT_LINES} SELECT doc_id, line_no, concat_ws(' ', line, lead(line, 1) OVER w, lead(line, 2) OVER w) AS three FROM amount_lines WINDOW w AS (PARTITION BY doc_id ORDER BY line_no, line)")
def win_08(spark, sf_dir):
    w = Window.partitionBy("doc_id").orderBy("line_no", "line")
    return amount_lines(spark, sf_dir).select("doc_id", "line_no", F.concat_ws(" ", "line", F.lead("line", 1).over(w), F.lead("line", 2).over(w)).alias("three"))


ANCHORS = """WITH RECURSIVE r AS MATERIALIZED (SELECT user_id, v, n, row_number() OVER (PARTITION BY user_id ORDER BY v) AS k FROM (SELECT user_id, CAST(value AS DOUBLE) AS v, count(*) AS n FROM events WHERE value IS NOT NULL GROUP BY 1, 2)),
g AS (SELECT user_id, k, n, v AS anchor, 0 AS group_no FROM r WHERE k = 1
  UNION ALL SELECT r.user_id, r.k, r.n, CASE WHEN abs(r.v - g.anchor) >= 3 THEN r.v ELSE g.anchor END, g.group_no + CASE WHEN abs(r.v - g.anchor) >= 3 THEN 1 ELSE 0 END FROM g JOIN r ON r.user_id = g.user_id AND r.k = g.k + 1)
SELECT user_id, CAST(group_no AS INT) AS group_no, anchor, CAST(sum(n) AS BIGINT) AS n FROM g GROUP BY 1, 2, 3"""


@query("win_10", ANCHORS)
def win_10(spark, sf_dir):
    return win.anchored_groups(table(spark, sf_dir, "events"), ["user_id"], "value", 3.0)


REPLAY = f"""WITH {EVENTS}, d AS (SELECT code, max((ts, event_id)) AS at FROM slips WHERE action = 'DELETE' GROUP BY 1), l AS (SELECT s.* FROM slips s LEFT JOIN d ON s.code = d.code WHERE s.action IN ('INSERT', 'RENAME') AND (d.at IS NULL OR (s.ts, s.event_id) > d.at)),
i AS (SELECT code, min((ts, event_id)) AS at, arg_min(label, (ts, event_id)) AS label FROM l WHERE action = 'INSERT' GROUP BY 1), n AS (SELECT l.code, arg_max(l.label, (l.ts, l.event_id)) AS label FROM l JOIN i ON l.code = i.code WHERE l.action = 'RENAME' AND (l.ts, l.event_id) > i.at GROUP BY 1)
SELECT i.code, coalesce(n.label, i.label) AS label FROM i LEFT JOIN n ON i.code = n.code"""


@query("win_12_rejects", f"WITH {EVENTS} SELECT code, event_id FROM (SELECT *, lag(action) OVER (PARTITION BY code ORDER BY ts, event_id) AS before FROM slips WHERE action IN ('INSERT', 'DELETE')) WHERE action = 'INSERT' AND before = 'INSERT'")
def win_12_rejects(spark, sf_dir):
    return win.rejected_inserts(slip_events(spark, sf_dir), ["code"], ["ts", "event_id"]).select("code", "event_id")


@query("win_12", REPLAY)
def win_12(spark, sf_dir):
    return win.replay(slip_events(spark, sf_dir), ["ts", "event_id"])


@query("win_13", f"WITH {EVENTS} SELECT code, coalesce(arg_max(label, (ts, event_id)) FILTER (action = 'RENAME'), arg_min(label, (ts, event_id))) AS pref_label, CAST(max(CASE WHEN action = 'DELETE' THEN 1 ELSE 0 END) AS INT) AS deprecated FROM slips GROUP BY 1")
def win_13(spark, sf_dir):
    return win.vocabulary(slip_events(spark, sf_dir), ["ts", "event_id"])


@query("win_14", f"WITH {STATEMENTS} SELECT state, grants FROM statements ORDER BY grants DESC NULLS LAST, state LIMIT 15")
def win_14(spark, sf_dir):
    return rel.top_n(statements(spark, sf_dir), "grants", 15, "state").select("state", "grants")


@query("win_15", f"WITH {LINES}, p AS (SELECT fy, CAST(sum(CASE WHEN col_type = 'be' THEN amount END) AS DOUBLE) AS be, CAST(sum(CASE WHEN col_type = 're' THEN amount END) AS DOUBLE) AS re FROM lines GROUP BY 1) SELECT fy, round((re - be) / be * 100, 4) AS re_vs_be FROM p")
def win_15(spark, sf_dir):
    return agg_20(spark, sf_dir).select("fy", F.round((F.col("re") - F.col("be")) / F.col("be") * 100, 4).alias("re_vs_be"))


@query("win_15_actual", f"WITH {LINES}, p AS (SELECT fy, CAST(sum(CASE WHEN col_type = 'be' THEN amount END) AS DOUBLE) AS be, CAST(sum(CASE WHEN col_type = 'actual' THEN amount END) AS DOUBLE) AS actual FROM lines GROUP BY 1) SELECT fy, round((actual - be) / be * 100, 4) AS actual_vs_be FROM p")
def win_15_actual(spark, sf_dir):
    return agg_20(spark, sf_dir).select("fy", F.round((F.col("actual") - F.col("be")) / F.col("be") * 100, 4).alias("actual_vs_be"))


@query("srt_03", "SELECT user_id, list_sort(list(CAST(value AS DECIMAL(18,4))), 'DESC')[1] AS first, list_sort(list(CAST(value AS DECIMAL(18,4))), 'DESC')[2] AS second FROM events GROUP BY 1")
def srt_03(spark, sf_dir):
    # two partial maxima instead of a whole list
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", F.col("value").cast("decimal(18,4)").alias("value"))
    ranked = rows.withColumn("r", F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("value"), "event_id"))).where("r <= 2")
    return ranked.groupBy("user_id").agg(F.max(F.when(F.col("r") == 1, F.col("value"))).alias("first"), F.max(F.when(F.col("r") == 2, F.col("value"))).alias("second"))


@query("set_01", f"WITH {LINES} SELECT fy, major FROM lines WHERE col_type = 'be' UNION ALL SELECT fy, major FROM lines WHERE col_type = 're'")
def set_01(spark, sf_dir):
    rows = budget_lines(spark, sf_dir)
    return rows.where("col_type = 'be'").select("fy", "major").unionByName(rows.where("col_type = 're'").select("fy", "major"))


@query("set_03", f"WITH {HEADS} SELECT code AS s, 'broader' AS p, parent_code AS o FROM heads WHERE parent_code IS NOT NULL UNION SELECT code, 'prefLabel', label FROM heads")
def set_03(spark, sf_dir):
    h = staged(heads(spark, sf_dir), "heads")
    up = h.where("parent_code is not null").select(F.col("code").alias("s"), F.lit("broader").alias("p"), F.col("parent_code").alias("o"))
    return up.unionByName(h.select(F.col("code").alias("s"), F.lit("prefLabel").alias("p"), F.col("label").alias("o"))).distinct()


@query("snk_01", "SELECT p_partkey AS id, CASE WHEN p_partkey % 3 = 0 THEN 'new' ELSE 'old' END AS v FROM part")
def snk_01(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"))
    return rel.upsert(rows.withColumn("v", F.lit("old")), rows.where("id % 3 = 0").withColumn("v", F.lit("new")), ["id"], ["v"])


@query("snk_02", "SELECT p_partkey AS id, CASE WHEN p_partkey % 2 = 0 THEN 'old' ELSE 'new' END AS v FROM part")
def snk_02(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"))
    return rel.insert_if_absent(rows.where("id % 2 = 0").withColumn("v", F.lit("old")), rows.withColumn("v", F.lit("new")), ["id"], ["v"])


@query("snk_03", "SELECT c_nationkey AS state, c_custkey AS id FROM customer WHERE c_nationkey >= 5 OR c_acctbal > 0")
def snk_03(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("state"), F.col("c_custkey").alias("id"), "c_acctbal")
    return rel.replace_slices(rows.drop("c_acctbal"), rows.where("state < 5 AND c_acctbal > 0").drop("c_acctbal"), "state")


@query("snk_05", "SELECT o_orderkey, 'pending' AS parsing_status FROM orders")
def snk_05(spark, sf_dir):
    return rel.with_defaults(table(spark, sf_dir, "orders"), {"parsing_status": "pending", "o_orderstatus": "x"}).select("o_orderkey", "parsing_status")


@query("job_06", f"WITH {LINES} SELECT major || '-' || sub || '-' || minor AS code, string_agg(fy || ':' || be, ',' ORDER BY fy) AS series FROM (SELECT major, sub, minor, fy, sum(amount) AS be FROM lines WHERE col_type = 'be' GROUP BY 1, 2, 3, 4) GROUP BY 1")
def job_06(spark, sf_dir):
    code = fiscal.head_code(F.col("major"), F.col("sub"), F.col("minor"))
    rows = budget_lines(spark, sf_dir).where("col_type = 'be' AND amount <> 0").groupBy(code.alias("code"), "fy").agg(F.sum("amount").cast("decimal(18,2)").alias("be"))
    return rows.groupBy("code").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("fy", "be"))), lambda r: F.concat_ws(":", r["fy"], r["be"].cast("string"))), ",").alias("series"))


@query("job_07", f"WITH {LINES}, s AS (SELECT state, fy, {SECTOR} AS sector, {SUB_SECTOR} AS sub_sector, sum(amount) AS amount FROM lines WHERE col_type = 'be' GROUP BY ALL) SELECT state, fy, 'pool' AS source, sector AS target, CAST(sum(amount) AS DOUBLE) AS amount FROM s GROUP BY ALL UNION ALL SELECT state, fy, sector, sub_sector, CAST(amount AS DOUBLE) FROM s")
def job_07(spark, sf_dir):
    """Links of the sector flow of every state and year: pool to sector, sector to sub-sector."""
    rows = agg_03(spark, sf_dir).where("level < 2")
    return rows.select("state", "fy", F.when(F.col("level") == 1, "pool").otherwise(F.col("sector")).alias("source"), F.when(F.col("level") == 1, F.col("sector")).otherwise(F.col("sub_sector")).alias("target"), "amount")


@query("job_16", f"WITH {STATEMENTS} SELECT state, round(devolution * 0.217 / (1 - 0.217), 2) AS gap, round(liabilities / (pct / 100), 2) AS gsdp FROM statements WHERE liabilities > 0 AND pct > 0")
def job_16(spark, sf_dir):
    rows = statements(spark, sf_dir).where("liabilities > 0 AND pct > 0")
    return rows.select("state", F.round(values.devolution_gap(F.col("devolution")), 2).alias("gap"), F.round(fiscal_gsdp(), 2).alias("gsdp"))


@query("job_19", f"WITH {PROBES} SELECT doc_id, length(text) AS n_chars, substr(text, 1, 500) AS sample, regexp_matches(text, '[éèêç]') AS has_script, len(regexp_extract_all(lower(text), 'cut')) AS score FROM probes WHERE chars IS NOT NULL")
def job_19(spark, sf_dir):
    text = F.col("text")
    return probes(spark, sf_dir).where("chars is not null").select("doc_id", F.length(text).cast("long").alias("n_chars"), F.substring(text, 1, 500).alias("sample"), values.has_script(text, "[éèêç]").alias("has_script"), values.signal(text, ["cut"]).cast("long").alias("score"))


@query("job_23", "SELECT page_id, pos - 1 AS pos, href FROM (SELECT page_id, unnest(regexp_extract_all(html, '(?s)<a[^>]*href=\"([^\"]*)\"[^>]*>(.*?)</a>', 1)) AS href, unnest(range(1, len(regexp_extract_all(html, '(?s)<a[^>]*href=\"([^\"]*)\"[^>]*>(.*?)</a>', 1)) + 1)) AS pos FROM pages) WHERE contains(href, 'the') OR contains(href, 'des')")
def job_23(spark, sf_dir):
    rows = readers.links(table(spark, sf_dir, "pages"), F.exists(F.array(F.lit("the"), F.lit("des")), lambda v: F.col("href").contains(v)))
    return rows.select("page_id", F.col("pos").cast("long").alias("pos"), "href")
