"""Cascading extraction: rules in an order of trust, the first that yields wins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import values

# Lines about the scheme, and page phrases of the first two rules.
SCHEME = r"(?i)anganwadi|\bicds\b"
PROJECTIONS = r"(?i)projections?\s+to\s+(mof|ministry\s+of\s+finance)"
DEMANDED = r"(?i)projected\s+(demand|be\b)"
ALLOCATED = r"(?i)actual\s+allocation|allocated\s+be\b"
#: Lines that a phrase may wrap over.
WRAP = 5


def big_numbers(line):
    """Numbers of three digits or more, with or without decimals, percentages aside, that reach 100."""
    plain = F.regexp_replace(line, "[0-9,]+\\.?[0-9]*\\s*%", "")
    found = F.transform(F.regexp_extract_all(plain, F.lit("\\b[0-9]{3,}(?:\\.[0-9]{1,2})?\\b"), F.lit(0)), values.parse_float)
    return F.filter(found, lambda x: x >= 100)


def projected_and_allocated(lines: DataFrame) -> DataFrame:
    """doc_id, projected, allocated, confidence (high, medium, low, none), note of each document of ``lines`` (doc_id,
    page_no, line_no, line).

    Rule 1 reads a scheme line and the next on pages that name projections; rule 2 a scheme line on pages that name
    demand and allocation, its integers, or it and the next; rule 3 any scheme line and the two after, pages aside. The
    smallest (rule, page, line) that yields wins. One shuffle by document; each window reads ahead a few lines, and the
    last step is a minimum with a partial step.
    """
    page = Window.partitionBy("doc_id", "page_no")
    within = page.orderBy("line_no")
    across = Window.partitionBy("doc_id").orderBy("page_no", "line_no")
    line = F.coalesce("line", F.lit(""))
    rows = lines.select("doc_id", "page_no", "line_no", line.alias("line"))
    near = F.concat_ws("\n", "line", *[F.lead("line", k).over(within) for k in range(1, WRAP)])
    rows = rows.withColumns({
        "near": near, "two": F.concat_ws(" ", "line", F.lead("line", 1).over(within)), "three": F.concat_ws(" ", "line", F.lead("line", 1).over(across), F.lead("line", 2).over(across)),
    })
    names = lambda pattern: F.max(F.col("near").rlike(pattern)).over(page)
    rows = rows.withColumns({"projects": names(PROJECTIONS), "demands": names(DEMANDED) & names(ALLOCATED)}).drop("near")

    def candidate(rule: int, projected, allocated, confidence: str):
        return F.struct(F.lit(rule).alias("rule"), "page_no", "line_no", projected.alias("projected"), allocated.alias("allocated"), F.lit(confidence).alias("confidence"))

    def two_of(rule: int, confidence: str, *lists):
        """The first two of the first list that has two."""
        out = None
        for a in lists:
            found = candidate(rule, F.get(a, 0), F.get(a, 1), confidence)
            out = F.when(F.size(a) >= 2, found) if out is None else out.when(F.size(a) >= 2, found)
        return out

    wide = values.amounts(F.col("two"), 100)
    last, before = F.try_element_at(wide, F.lit(-1)), F.try_element_at(wide, F.lit(-2))
    first_rule = F.when(F.col("projects") & (F.size(wide) >= 4) & (before > last), candidate(1, before, last, "high")).when(
        F.col("projects") & (F.size(wide) == 2) & (F.get(wide, 0) > F.get(wide, 1)), candidate(1, F.get(wide, 0), F.get(wide, 1), "high")
    )
    second_rule = F.when(F.col("demands"), two_of(2, "medium", values.amounts(F.col("line"), 100), big_numbers(F.col("line")), wide))
    falling = lambda c: F.sort_array(values.amounts(F.col(c), 500), asc=False)
    third_rule = two_of(3, "low", falling("line"), falling("three"))
    best = F.array_min(F.filter(F.array(first_rule, second_rule, third_rule), lambda c: c.isNotNull()))
    found = rows.select("doc_id", F.trim("line").alias("line"), F.when(F.col("line").rlike(SCHEME), best).alias("best"))
    each = found.groupBy("doc_id").agg(F.min("best").alias("best"), F.max(F.col("line") != "").alias("has_text"))
    note = F.when(F.col("best").isNotNull(), F.lit(None)).when(F.col("has_text"), "no matching table found").otherwise("no text extracted (possibly scanned)")
    return each.select("doc_id", "best.projected", "best.allocated", F.coalesce("best.confidence", F.lit("none")).alias("confidence"), note.alias("note"))
