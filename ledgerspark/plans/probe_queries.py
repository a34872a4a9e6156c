"""Queries over probed documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import probing
from ..operators.staging import staged
from .bindings import PROBES, probes
from .registry import query

PAGE = 600
SIGNALS = {"cuts": ["the ", "tion"], "gifts": ["und", "les"]}
SCRIPT = "[éèêç]"


def paged(spark, sf_dir):
    """doc_id, page_no, text, tables: every text in pages of 600 characters; every eleventh document has none."""
    text = F.col("text")
    numbers = F.sequence(F.lit(1), F.greatest(F.ceil(F.length(text) / PAGE), F.lit(1)).cast("int"))
    rows = probes(spark, sf_dir).where(F.col("doc_id") % 11 != 0).select("doc_id", "tables", "text", F.explode(numbers).alias("page_no"))
    return rows.select("doc_id", "page_no", F.substring("text", (F.col("page_no") - 1) * PAGE + 1, F.lit(PAGE)).alias("text"), "tables")


COUNT = lambda found: " + ".join(f"len(regexp_extract_all(lower(head), '{m}'))" for m in found)
PROBED = f"""{PROBES}, looked AS (SELECT *, ext IN ('xls', 'xlsx', 'csv') AS sheet, doc_id % 11 <> 0 AS there, substr(text, 1, {PAGE * probing.PAGES}) AS head FROM probes),
told AS (SELECT doc_id, CASE WHEN there AND NOT sheet THEN CAST(greatest(ceil(length(text) / {PAGE}), 1) AS BIGINT) END AS n_pages, CASE WHEN there AND NOT sheet THEN length(head) END AS n_chars, CASE WHEN there AND NOT sheet THEN substr(head, 1, 500) END AS sample,
  CASE WHEN there AND NOT sheet THEN tables END AS tables, there AND NOT sheet AND regexp_matches(head, '{SCRIPT}') AS has_script,
  CASE WHEN sheet THEN 'xls' WHEN NOT there THEN 'unknown' WHEN regexp_matches(head, '{SCRIPT}') THEN 'devanagari_pdf' WHEN length(head) < 100 THEN 'scanned_pdf' WHEN tables >= 2 THEN 'table_pdf' ELSE 'text_pdf' END AS route,
  {", ".join(f"CASE WHEN there AND NOT sheet THEN {COUNT(found)} ELSE 0 END AS {name}" for name, found in SIGNALS.items())}, CASE WHEN NOT there AND NOT sheet THEN 'File not found: /budget/' || doc_id || '.' || ext END AS error FROM looked)"""


def results(spark, sf_dir):
    docs = probes(spark, sf_dir).select("doc_id", F.concat(F.lit("/budget/"), F.col("doc_id").cast("string"), F.lit("."), "ext").alias("path"), "ext")
    return probing.probe_documents(docs, paged(spark, sf_dir), SIGNALS, SCRIPT)


@query("job_19_probes", f"WITH {PROBED} SELECT * FROM told")
def job_19_probes(spark, sf_dir):
    """Every document's probe: sheets, documents that aren't there and texts."""
    return results(spark, sf_dir)


@query("job_19_upsert", f"WITH {PROBED} SELECT doc_id, n_chars, route, error FROM told WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id, -1, 'unknown', 'timeout' FROM told WHERE doc_id % 2 = 1 AND doc_id % 3 = 0")
def job_19_upsert(spark, sf_dir):
    """Probes of even documents over results of every third one that were there before."""
    found = staged(results(spark, sf_dir), "probes")
    before = found.where("doc_id % 3 = 0").withColumns({"n_chars": F.lit(-1).cast("long"), "route": F.lit("unknown"), "error": F.lit("timeout")})
    return probing.probed(before, found.where("doc_id % 2 = 0")).select("doc_id", "n_chars", "route", "error")
