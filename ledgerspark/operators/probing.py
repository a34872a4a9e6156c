"""What a first look at documents tells: size of the text, script, tables, marker scores, and how to parse them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import values
from . import relational as rel

#: Pages of a document that are looked at, characters of its sample and of an error that are kept.
PAGES, SAMPLE, ERROR = 5, 500, 300
SHEETS = ["xls", "xlsx", "csv"]


def first_pages(pages: DataFrame, n: int = PAGES) -> DataFrame:
    """doc_id, text of the first ``n`` pages of ``pages`` (doc_id, page_no from 1, text, tables) in their order, n_pages of all,
    tables of the first page. At most ``n`` texts of a document come together."""
    own = F.when(F.col("page_no") <= n, F.struct("page_no", F.coalesce("text", F.lit("")).alias("text")))
    found = pages.groupBy("doc_id").agg(F.array_sort(F.collect_list(own)).alias("p"), F.max("page_no").cast("long").alias("n_pages"), F.max(F.when(F.col("page_no") == 1, F.col("tables"))).alias("tables"))
    return found.select("doc_id", F.array_join(F.transform("p", lambda x: x["text"]), "").alias("text"), "n_pages", "tables")


def probe_documents(docs: DataFrame, pages: DataFrame, signals: dict[str, list[str]], script: str = "[ऀ-ॿ]") -> DataFrame:
    """doc_id, n_pages, n_chars, sample, tables, has_script, route, a score for each of ``signals`` (name to markers), error of
    every row of ``docs`` (doc_id, path, ext).

    A sheet isn't read: it has route xls and scores of 0. A document without pages isn't there: its error says so, its
    route is unknown. Repeated ids are repeated rows; see ``probed``.
    """
    sheet = F.coalesce(F.col("ext").isin(*SHEETS), F.lit(False))
    rows = docs.select("doc_id", "path", "ext").join(first_pages(pages), "doc_id", "left")
    read = ~sheet & F.col("n_pages").isNotNull()
    only = lambda c: F.when(read, c)
    text, n_chars = F.col("text"), F.length("text").cast("long")
    has_script = F.coalesce(only(values.has_script(text, script)), F.lit(False))
    return rows.select(
        "doc_id", only(F.col("n_pages")).alias("n_pages"), only(n_chars).alias("n_chars"), only(F.substring(text, 1, SAMPLE)).alias("sample"), only(F.col("tables")).alias("tables"), has_script.alias("has_script"),
        values.route(F.col("ext"), only(n_chars), F.coalesce("tables", F.lit(0)), has_script).alias("route"),
        *[F.coalesce(only(values.signal(text, found)), F.lit(0)).cast("long").alias(name) for name, found in signals.items()],
        F.when(~sheet & F.col("n_pages").isNull(), F.substring(F.concat(F.lit("File not found: "), F.coalesce("path", F.lit(""))), 1, ERROR)).alias("error"),
    )


def probed(existing: DataFrame, found: DataFrame) -> DataFrame:
    """Results after an upsert: a new one replaces what was known of its document; of several new ones the one that read
    most counts."""
    return rel.upsert(existing, found, ["doc_id"], [F.desc_nulls_last("n_chars"), F.asc_nulls_last("sample"), F.asc_nulls_last("error")])
