"""Documents that stored web pages link to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fiscal, values
from ..operators import relational as rel
from ..operators import windows as win

#: A heading or a link with its target, in the order of the page.
PART = r"""(?is)<h[1-6][^>]*>.*?</h[1-6]>|<a\s[^>]*?href\s*=\s*(?:"[^"]*"|'[^']*')[^>]*>.*?</a>"""
HREF = r"""(?is)^<a\s[^>]*?href\s*=\s*(?:"([^"]*)"|'([^']*)')"""
#: Kinds of files that are budget documents.
SUFFIXES = [".pdf", ".xls"]


def shown(html: Column) -> Column:
    """The text of a piece of HTML: no tags, common entities replaced, white space as single blanks."""
    text = F.regexp_replace(html, "(?s)<[^>]*>", " ")
    for name, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(name), F.lit(sign))
    return F.trim(F.regexp_replace(text, "\\s+", " "))


def without_dots(path: Column) -> Column:
    """An absolute path without its ``.`` and ``..`` segments."""
    segments = F.split(path, "/")
    step = lambda acc, s: F.when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(1)))).when(s == ".", acc).otherwise(F.concat(acc, F.array(s)))
    kept = F.aggregate(F.slice(segments, 2, F.size(segments)), F.array(F.lit("")), step)
    last = F.element_at(segments, -1)
    return F.concat(F.array_join(kept, "/"), F.when(last.isin(".", ".."), "/").otherwise(""))


def resolved(page: Column, href: Column) -> Column:
    """``href`` as an absolute address, seen from ``page``."""
    href, bare = F.trim(href), F.regexp_replace(page, "#.*$", "")
    whole = F.regexp_replace(bare, "\\?.*$", "")
    scheme, host = F.regexp_extract(page, "^([A-Za-z][A-Za-z0-9+.-]*:)", 1), F.regexp_extract(whole, "^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", 0)
    path = F.substring(whole, F.length(host) + 1, F.length(whole))
    folder = F.when(path == "", "/").otherwise(F.regexp_replace(path, "[^/]*$", ""))
    own, rest = F.regexp_extract(href, "^[^?#]*", 0), F.regexp_extract(href, "[?#].*$", 0)
    joined = F.concat(host, without_dots(F.when(own.startswith("/"), own).otherwise(F.concat(folder, own))), rest)
    return (
        F.when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), href).when(href.startswith("//"), F.concat(scheme, href))
        .when(href == "", bare).when(href.startswith("#"), F.concat(bare, href)).when(href.startswith("?"), F.concat(whole, href)).otherwise(joined)
    )


def page_parts(pages: DataFrame) -> DataFrame:
    """page_id, page, pos, heading, href, title: headings (no href) and links (no heading) of ``pages`` (page_id, url, html) in
    their order. One pass finds both, so a link's place among headings is known."""
    rows = pages.select("page_id", F.col("url").alias("page"), F.posexplode(F.regexp_extract_all("html", F.lit(PART), F.lit(0))).alias("pos", "part"))
    is_link = F.lower(F.substring("part", 1, 2)) == "<a"
    href = F.concat(F.regexp_extract("part", HREF, 1), F.regexp_extract("part", HREF, 2))
    # a heading without text doesn't start a section
    heading = F.when(~is_link, F.nullif(shown(F.col("part")), F.lit("")))
    return rows.select("page_id", "page", "pos", heading.alias("heading"), F.when(is_link, href).alias("href"), F.when(is_link, shown(F.col("part"))).alias("title"))


def document_links(pages: DataFrame, suffixes: list[str] = SUFFIXES) -> DataFrame:
    """page_id, page, pos, section, href, title, url of links whose href has one of ``suffixes``, in either case. The
    section is the last heading before the link, null before the first. A link without text is named by its file."""
    parts = win.fill_forward(page_parts(pages), ["page_id"], "pos", "heading", "section")
    rows = parts.where("href is not null").where(F.exists(F.array(*map(F.lit, suffixes)), lambda s: F.contains(F.lower("href"), s)))
    rows = rows.withColumn("url", resolved(F.col("page"), F.col("href")))
    stem = F.regexp_replace(F.regexp_extract(F.regexp_replace("url", "[?#].*$", ""), "[^/]*$", 0), "(?<=.)\\.[^.]*$", "")
    return rows.select("page_id", "page", "pos", "section", "href", F.when(F.col("title") != "", F.col("title")).otherwise(stem).alias("title"), "url")


def of_year(links: DataFrame, fy: str, in_path: bool = False) -> DataFrame:
    """Links that name the fiscal year in one of its forms, in href or title; with ``in_path`` as a folder of the href."""
    forms = fiscal.fy_variants(F.lit(fy))
    text = F.col("href") if in_path else F.concat_ws(" ", "href", "title")
    return links.where(F.exists(forms, lambda v: F.contains(text, F.concat(F.lit("/"), v, F.lit("/")) if in_path else v)))


def discovered(pages: DataFrame, state: str, fy: str, in_path: bool = False, suffixes: list[str] = SUFFIXES) -> DataFrame:
    """Registry rows of the documents of a fiscal year: doc_id, state, fiscal_year, section, document_type, source_url,
    collection_url, local_path, file_extension, page_id, pos.

    Pages without html give none. A document found twice stays twice; see ``registered``.
    """
    links = of_year(document_links(pages, suffixes), fy, in_path)
    section, title = F.coalesce("section", F.lit("Budget Documents")), F.col("title")
    ext, name = values.extension(F.col("url")), values.safe_name(title)
    file = F.when(F.lower(name).endswith(F.concat(F.lit("."), ext)), name).otherwise(F.concat(name, F.lit("."), ext))
    folder = F.concat_ws("/", values.safe_name(F.lit(state)), F.lit(fy), values.safe_name(section))
    return links.select(
        values.doc_slug(F.lit(state), F.lit(fy), section, title).alias("doc_id"), F.lit(state).alias("state"), F.lit(fy).alias("fiscal_year"), section.alias("section"), title.alias("document_type"),
        F.col("url").alias("source_url"), F.col("page").alias("collection_url"), F.concat_ws("/", folder, file).alias("local_path"), ext.alias("file_extension"), "page_id", "pos",
    )


def registered(existing: DataFrame, found: DataFrame) -> DataFrame:
    """The registry after an upsert: what was found last, by page and place, replaces a document of the same id."""
    return rel.upsert(existing, found, ["doc_id"], [F.desc("page_id"), F.desc("pos")])
