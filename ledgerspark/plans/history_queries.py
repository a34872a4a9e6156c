"""Queries over a code list's past."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import history
from .bindings import EVENTS, slip_events, table
from .registry import query

ORDER = ["ts", "event_id"]
TIMES = ["2024-01-05 00:00:00", "2024-01-15 12:00:00", "2024-02-01 00:00:00"]

BASE = "base AS (SELECT lpad(CAST(c_custkey * 7 % 9000 AS VARCHAR), 4, '0') AS code, min(c_name) AS label FROM customer WHERE c_custkey % 2 = 0 GROUP BY 1)"
#: Every event after the base, with whether it counts: an INSERT if the last INSERT or DELETE before isn't an INSERT, others if it is.
CHECKED = f"""{EVENTS}, {BASE}, every AS (SELECT code, action, label, ts, event_id FROM slips WHERE action <> 'UPDATE' UNION ALL SELECT code, 'INSERT', label, NULL, NULL FROM base),
seen AS (SELECT *, coalesce(last_value(CASE WHEN action <> 'RENAME' THEN action END IGNORE NULLS) OVER (PARTITION BY code ORDER BY ts NULLS FIRST, event_id NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 'DELETE') AS before FROM every),
changes AS (SELECT * FROM seen WHERE (action = 'INSERT') = (before = 'DELETE'))"""
SPANS = """spans AS (SELECT code, action, label, ts AS valid_from, lead(ts) OVER (PARTITION BY code ORDER BY ts NULLS FIRST, event_id NULLS FIRST) AS valid_to FROM changes)"""


def base_codes(spark, sf_dir):
    key = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").where(key % 2 == 0)
    return rows.groupBy(F.lpad((key * 7 % 9000).cast("string"), 4, "0").alias("code")).agg(F.min("c_name").alias("label"))


@query("win_12_intervals", f"WITH {CHECKED}, {SPANS} SELECT code, label, valid_from, valid_to FROM spans WHERE action <> 'DELETE'")
def win_12_intervals(spark, sf_dir):
    """When each code had which label, from a base list on."""
    return history.intervals(slip_events(spark, sf_dir), ORDER, base_codes(spark, sf_dir))


@query("win_12_as_of", f"""WITH {EVENTS}, {BASE}, asked AS (SELECT CAST(unnest([{", ".join(f"'{t}'" for t in TIMES)}]) AS TIMESTAMP) AS as_of),
e AS (SELECT as_of, code, action, label, (ts, event_id) AS moment FROM slips JOIN asked ON ts <= as_of UNION ALL SELECT as_of, code, 'INSERT', label, (TIMESTAMP '1900-01-01', CAST(-1 AS BIGINT)) FROM base, asked),
d AS (SELECT as_of, code, max(moment) AS gone FROM e WHERE action = 'DELETE' GROUP BY ALL), l AS (SELECT e.* FROM e LEFT JOIN d USING (as_of, code) WHERE gone IS NULL OR moment > gone),
i AS (SELECT as_of, code, min(moment) AS moment, arg_min(label, moment) AS label FROM l WHERE action = 'INSERT' GROUP BY ALL),
n AS (SELECT l.as_of, l.code, arg_max(l.label, l.moment) AS label FROM l JOIN i USING (as_of, code) WHERE l.action = 'RENAME' AND l.moment > i.moment GROUP BY ALL)
SELECT i.as_of, i.code, coalesce(n.label, i.label) AS label FROM i LEFT JOIN n USING (as_of, code)""")
def win_12_as_of(spark, sf_dir):
    """The code list as of three times; the SQL replays the events for each time anew."""
    found = history.intervals(slip_events(spark, sf_dir), ORDER, base_codes(spark, sf_dir))
    return history.live_at(found, [F.to_timestamp(F.lit(t)) for t in TIMES])


ASKED = "asked AS (SELECT event_id, lpad(CAST(user_id * 7 % 9000 AS VARCHAR), 4, '0') AS code, ts AS time FROM events WHERE event_type IN ('view', 'purchase'))"


@query("win_12_labels_at", f"WITH {CHECKED}, {SPANS}, {ASKED} SELECT a.event_id, a.code, a.time, label FROM asked a LEFT JOIN spans s ON s.code = a.code AND action <> 'DELETE' AND (valid_from IS NULL OR valid_from <= time) AND (valid_to IS NULL OR valid_to > time)")
def win_12_labels_at(spark, sf_dir):
    """The label of each viewed or bought code at that time."""
    rows = table(spark, sf_dir, "events").where(F.col("event_type").isin("view", "purchase"))
    asked = rows.select(F.lpad((F.col("user_id") * 7 % 9000).cast("string"), 4, "0").alias("code"), F.col("ts").alias("time"), "event_id")
    return history.labels_at(slip_events(spark, sf_dir), ORDER, asked, "time", base_codes(spark, sf_dir)).select("event_id", "code", "time", "label")


@query("win_12_base_rejects", f"WITH {CHECKED} SELECT code, event_id FROM seen WHERE action = 'INSERT' AND before = 'INSERT'")
def win_12_base_rejects(spark, sf_dir):
    """Inserts of codes that the base or an earlier event had made live."""
    return history.rejects(slip_events(spark, sf_dir), ORDER, base_codes(spark, sf_dir)).select("code", "event_id")


NAMED = f"""{EVENTS}, {BASE}, rows_ AS (SELECT code, action, label, ts, event_id FROM slips UNION ALL SELECT code, 'HEAD', label, NULL, NULL FROM base),
numbered AS (SELECT *, row_number() OVER (PARTITION BY code ORDER BY ts NULLS FIRST, event_id NULLS FIRST) AS k FROM rows_),
named AS (SELECT *, last_value(CASE WHEN k = 1 OR action = 'RENAME' THEN label END IGNORE NULLS) OVER (PARTITION BY code ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS old, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM numbered)"""


@query("win_13_history", f"""WITH {NAMED} SELECT code, 'prefLabel' AS p, arg_max(label, k) AS o FROM named WHERE k = 1 OR action = 'RENAME' GROUP BY code
UNION ALL (SELECT code, 'altLabel', old FROM named WHERE action = 'RENAME' AND old IS NOT NULL UNION SELECT code, 'created', day FROM named WHERE action = 'INSERT'
UNION SELECT code, 'modified', day FROM named WHERE action IN ('RENAME', 'UPDATE', 'DELETE') UNION SELECT code, 'deprecated', 'true' FROM named WHERE action = 'DELETE'
UNION SELECT code, 'historyNote', 'Renamed from ''' || coalesce(old, 'None') || ''' to ''' || label || ''' on ' || day FROM named WHERE action = 'RENAME' UNION SELECT code, 'historyNote', 'Updated on ' || day FROM named WHERE action = 'UPDATE')""")
def win_13_history(spark, sf_dir):
    """All names, dates and notes of every code."""
    return history.vocabulary_history(slip_events(spark, sf_dir), ORDER, base_codes(spark, sf_dir))
