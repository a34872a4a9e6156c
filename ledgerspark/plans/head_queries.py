"""Queries of single heads in full, of the browser's payload and of charts with errors."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import heads as hd
from ..operators import jobs
from ..operators import relational as rel
from ..operators.staging import staged
from .bindings import EVENTS, HEADS, budget_lines, heads, slip_events, table
from .flow_queries import CLASS, FLAT, flat_events
from .job_queries import HEAD_ROWS, head_rows
from .registry import query


def numbered_notes(spark, sf_dir):
    """code, note_number, note of every part: notes of majors."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select((2000 + key % 1700).cast("string").alias("code"), F.col("p_size").cast("string").alias("note_number"), F.col("p_name").alias("note"))


NOTED = "noted AS (SELECT CAST(2000 + p_partkey % 1700 AS VARCHAR) AS code, CAST(p_size AS VARCHAR) AS note_number, p_name AS note FROM part)"
EMPTY = "CAST(NULL AS DOUBLE) AS amount, CAST(NULL AS BOOLEAN) AS exact"


def sections(asked: str) -> str:
    """SQL of the details of ``asked``, a table of heads' codes."""
    flat = "split_part(a.code, '-', 1) || '-' || split_part(a.code, '-', 3)"
    return f"""mine AS (SELECT h.* FROM heads h WHERE h.code IN (SELECT code FROM {asked}))
SELECT code, 'head' AS section, kind AS item, label AS text, {EMPTY} FROM mine
UNION ALL SELECT code, 'class', CAST({CLASS} AS VARCHAR), NULL, NULL, NULL FROM mine
UNION ALL SELECT a.code, 'path', b.code, b.label, NULL, NULL FROM mine a JOIN heads b ON a.parent_code = b.code
UNION ALL SELECT a.code, 'path', t.code, t.label, NULL, NULL FROM mine a JOIN heads b ON a.parent_code = b.code JOIN heads t ON b.parent_code = t.code
UNION ALL SELECT a.code, 'child', b.code, b.label, NULL, NULL FROM mine a JOIN heads b ON b.parent_code = a.code
UNION ALL SELECT a.code, 'note', n.note_number, n.note, NULL, NULL FROM mine a JOIN noted n ON n.code = a.code
UNION ALL SELECT a.code, 'sibling', b.code, b.label, NULL, NULL FROM mine a JOIN heads b ON lower(a.label) = lower(b.label) AND {CLASS.replace('code', 'a.code')} <> {CLASS.replace('code', 'b.code')}
UNION ALL SELECT a.code, 'change', CAST(s.event_id AS VARCHAR), s.action || ' ' || s.code, NULL, a.kind = 'minor' AND {flat} = s.code FROM mine a JOIN flat s ON substr(a.code, 1, 4) = substr(s.code, 1, 4)
UNION ALL SELECT a.code, 'booked', k.fy, NULL, k.amount, NULL FROM mine a JOIN booked k ON k.code = a.code"""


BOOKED = "booked AS (SELECT major || '-' || sub || '-' || minor AS code, fy, CAST(sum(amount) AS DOUBLE) AS amount FROM lines WHERE col_type = 'be' GROUP BY 1, 2)"


@query("job_15_details", f"WITH {HEADS}, {FLAT}, {NOTED}, {BOOKED}, hits AS (SELECT code FROM heads WHERE contains(label, 'rod') AND (contains(code, '210') AND contains(code, '003') OR kind = 'major' AND contains(code, '21'))), {sections('hits')}")
def job_15_details(spark, sf_dir):
    """All that is known of the heads that a search among all heads and one among majors find."""
    chart = staged(heads(spark, sf_dir), "heads")
    booked = budget_lines(spark, sf_dir).where("col_type = 'be'").groupBy(F.concat_ws("-", "major", "sub", "minor").alias("code"), "fy").agg(F.sum("amount").alias("amount"))
    asked = rel.subject_hits(chart, "rod, 210 003").unionByName(rel.subject_hits(chart.where("kind = 'major'"), "rod, 21"))
    return hd.head_details(chart, numbered_notes(spark, sf_dir), flat_events(spark, sf_dir), booked, asked)


@query("job_14_payload", f"""WITH {HEADS}, {EVENTS}, {NOTED}, ch AS (SELECT 'CS ' || (event_id // 8) AS slip, CAST(ts AS DATE) AS date, event_id, action, code, label, CASE WHEN action = 'RENAME' THEN 'old ' || label END AS old_label FROM slips),
ev AS (SELECT slip, date, list_sort(list(DISTINCT code)) AS majors, count(*) AS n FROM ch GROUP BY 1, 2)
SELECT 'node' AS part, code AS id, CAST(to_json(struct_pack(c := code, p := parent_code, t := kind, d := label, k := {CLASS}, mh := substr(code, 1, 4), sm := nullif(split_part(code, '-', 2), ''), mn := nullif(split_part(code, '-', 3), ''))) AS VARCHAR) AS payload FROM heads
UNION ALL SELECT 'note', code, CAST(to_json(struct_pack(num := note_number, text := note)) AS VARCHAR) FROM noted
UNION ALL SELECT 'change', CAST(event_id AS VARCHAR), CAST(to_json(struct_pack(slip := slip, action := action, code := code, mh := code, type := 'major', label := label, old_label := old_label)) AS VARCHAR) FROM ch
UNION ALL SELECT 'event', slip, CAST(to_json(struct_pack(date := CAST(date AS VARCHAR), slip := slip, majors := majors, n_changes := n)) AS VARCHAR) FROM ev
UNION ALL SELECT 'meta', NULL, CAST(to_json(struct_pack(total := (SELECT count(*) FROM heads), major := (SELECT count(*) FROM heads WHERE kind = 'major'), sub_major := (SELECT count(*) FROM heads WHERE kind = 'submajor'), minor := (SELECT count(*) FROM heads WHERE kind = 'minor'), notes := (SELECT count(*) FROM noted), events := (SELECT count(*) FROM ev))) AS VARCHAR)""")
def job_14_payload(spark, sf_dir):
    """The browser's payload, a row for each of its parts."""
    own = slip_events(spark, sf_dir)
    slip = F.concat(F.lit("CS "), F.floor(F.col("event_id") / 8).cast("string"))
    old = F.when(F.col("action") == "RENAME", F.concat(F.lit("old "), "label"))
    changes = own.select(slip.alias("slip"), F.to_date("ts").alias("date"), "event_id", "action", "code", F.lit("major").alias("kind"), "label", old.alias("old_label"))
    return hd.browser_payload(staged(heads(spark, sf_dir), "heads"), numbered_notes(spark, sf_dir), changes)


# every head of table rows twice: some with another label the second time, some without a label, so that those below lack a parent
CHARTS = f"""{HEAD_ROWS}, all_ AS (SELECT code, parent_code, kind, CASE WHEN n % 101 = 0 THEN ' ' WHEN n % 7 = 0 AND k = 1 THEN 'other' ELSE kind END AS label FROM hc, (VALUES (0), (1)) twice(k)),
full_ AS (SELECT * FROM all_ WHERE label <> ' '), once AS (SELECT code, count(DISTINCT (kind, coalesce(parent_code, ''), label)) AS v, any_value(kind) AS kind, any_value(parent_code) AS parent_code, any_value(label) AS label FROM full_ GROUP BY 1)"""


def chart_rows(spark, sf_dir):
    n = F.col("row_no")
    label = F.when(n % 101 == 0, " ").when((n % 7 == 0) & (F.col("k") == 1), "other").otherwise(F.col("kind"))
    twice = F.explode(F.array(F.lit(0), F.lit(1))).alias("k")
    return jobs.labelled_heads(head_rows(spark, sf_dir)).select("*", twice).select("code", "parent_code", "kind", label.alias("label"))


@query("job_10_rejects", f"WITH {CHARTS} SELECT DISTINCT code, 'incomplete' AS reason FROM all_ WHERE label = ' ' UNION ALL SELECT code, 'conflict' FROM once WHERE v > 1 UNION ALL SELECT code, 'missing parent' FROM once WHERE v = 1 AND parent_code IS NOT NULL AND parent_code NOT IN (SELECT code FROM once)")
def job_10_rejects(spark, sf_dir):
    """Codes of a chart that contradict each other, lack a cell or a parent."""
    return hd.checked_heads(chart_rows(spark, sf_dir))[1]


@query("job_10_checked", f"WITH {CHARTS} SELECT code, kind, parent_code, label FROM once WHERE v = 1 AND (parent_code IS NULL OR parent_code IN (SELECT code FROM once))")
def job_10_checked(spark, sf_dir):
    """The heads of a chart that nothing speaks against."""
    return hd.checked_heads(chart_rows(spark, sf_dir))[0]
