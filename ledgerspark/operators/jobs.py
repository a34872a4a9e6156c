"""Composite jobs: budget tables from grids and lines, series, flows, chart of accounts, leaderboards, wages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fiscal, slips, values
from . import relational as rel
from . import windows as win
from .cascade import projected_and_allocated
from .history import vocabulary_history
from .ranking import numbered
from .staging import staged

# Cells of the name and of (revenue, capital, total) for each estimate, in sheets below 40 cells and others.
NARROW = {"name": 5, "actual": (12, 14, 16), "be_prev": (18, 20, 22), "re": (25, 27, 29), "be": (31, 33, 35)}
WIDE = {"name": 6, "actual": (15, 17, 19), "be_prev": (21, 23, 25), "re": (29, 31, 33), "be": (35, 39, 41)}
WIDE_FROM = 40
SERIES_KEYWORDS = ["Saksham Anganwadi", "POSHAN 2.0", "Umbrella ICDS"]
# Kind and years back of each estimate of a sheet.
ESTIMATES = {"actual": ("actual", 2), "be_prev": ("be", 1), "re": ("re", 1), "be": ("be", 0)}
#: The canonical name of history rows whose scheme isn't known.
DEFAULT_SCHEME = "icds_anganwadi_services"
# Tax heads of which a state gets its share only.
CENTRAL_TAXES = ["0005", "0008", "0020", "0021", "0028", "0037", "0038", "0044", "0045"]
GRANT_HEAD = "1601"
# Columns of the health accounts, in order, by their names in the source.
HEALTH = {
    "Year": "year", "GHE_Pct_GDP": "ghe_pct_gdp", "OOPE_Pct_THE": "oope_pct_the", "GHE_Pct_THE": "ghe_pct_the", "Per_Capita_GHE_INR": "per_capita_ghe_inr", "Per_Capita_OOPE_INR": "per_capita_oope_inr",
}
HIGH_STRESS = 15.0
# Extensions of sheets, and routes of documents whose pages are read.
SHEETS = ["xls", "xlsx"]
PAGE_ROUTES = ["text_pdf", "table_pdf", "scanned_pdf"]
#: The product that prose states.
PRODUCT = "GSDP"
MEASURES = ["revenue", "capital", "total"]


def measured(grid: DataFrame) -> DataFrame:
    """doc_id, row_no, name and (revenue, capital, total) of each estimate from ``grid`` (doc_id, row_no, cells). The
    widest row of a document tells its layout."""
    width = grid.groupBy("doc_id").agg(F.max(F.size("cells")).alias("width"))
    cell = lambda narrow, wide: F.get("cells", F.when(F.col("width") >= WIDE_FROM, wide).otherwise(narrow))
    parts = [cell(n, w).try_cast("double").alias(f"{kind}_{m}") for kind in ESTIMATES for m, n, w in zip(MEASURES, NARROW[kind], WIDE[kind], strict=True)]
    return grid.join(width, "doc_id").select("doc_id", "row_no", F.trim(cell(NARROW["name"], WIDE["name"])).alias("name"), *parts)


def estimates(rows: DataFrame, keys: list[str], fy: str) -> DataFrame:
    """``keys``, col_type, fiscal_year, revenue, capital, total: four rows of each of ``measured``'s."""
    kinds = [F.struct(F.lit(kind).alias("col_type"), fiscal.earlier_fy(F.col(fy), back).alias("fiscal_year"), *[F.col(f"{n}_{m}").alias(m) for m in MEASURES]) for n, (kind, back) in ESTIMATES.items()]
    return rows.select(*keys, F.explode(F.array(*kinds)).alias("r")).select(*keys, "r.*")


def scheme_allocations(grid: DataFrame, docs: DataFrame, canonical: DataFrame) -> DataFrame:
    """id, doc_id, scheme, col_type, fiscal_year, revenue, capital, total of rows whose name is in ``canonical``
    (source_name, canonical); ``docs`` has doc_id and fy. The first row of an id stays."""
    rows = rel.keep_data_rows(measured(grid), "name", [f"{kind}_{m}" for kind in ESTIMATES for m in MEASURES])
    known = rows.join(canonical, F.col("name") == F.col("source_name")).join(docs.select("doc_id", "fy"), "doc_id")
    found = estimates(known, ["doc_id", "row_no", "canonical", "fy"], "fy").withColumnRenamed("canonical", "scheme")
    # be of last year and be of this one differ in their year, so these four name a row
    found = found.withColumn("id", values.row_id(*map(F.col, ["doc_id", "scheme", "fiscal_year", "col_type"])))
    best = found.groupBy("id").agg(F.min_by(F.struct("doc_id", "scheme", "col_type", "fiscal_year", *MEASURES), "row_no").alias("r"))
    return best.select("id", "r.*")


def allocations_from_text(lines: DataFrame, canonical: DataFrame, headers: list[str]) -> DataFrame:
    """doc_id, page_no, line_no, scheme, col_type, total: lines that end in an amount, on pages with a header keyword."""
    has = values.contains_any(F.lower("line"), [h.lower() for h in headers])
    pages = lines.where(has).select("doc_id", "page_no").distinct()
    name, total = values.trailing_amount(F.col("line"))
    rows = lines.join(pages, ["doc_id", "page_no"], "left_semi").select("doc_id", "page_no", "line_no", name.alias("source_name"), total.alias("total"))
    return rows.join(canonical, "source_name").select("doc_id", "page_no", "line_no", F.col("canonical").alias("scheme"), F.lit("be").alias("col_type"), "total")


def allocations_of_pages(lines: DataFrame, cells: DataFrame, docs: DataFrame, canonical: DataFrame, headers: list[str], keywords: list[str]) -> DataFrame:
    """id, doc_id, scheme, col_type, fiscal_year, total of schemes on pages with a header keyword: of table rows where the
    page has tables (``cells``: doc_id, page_no, table_no, row_no, cells), else of lines (doc_id, page_no, line_no, line)
    that end in an amount. A row's amount is its last cell that isn't empty; a name counts if it holds one of
    ``keywords`` and ``canonical`` (source_name, canonical) knows it. ``docs``: doc_id, fy. The first of an id stays, of
    rows in one place the first by name and amount."""
    wanted = [h.lower() for h in headers]
    pages = lines.where(values.contains_any(F.lower("line"), wanted)).select("doc_id", "page_no").distinct()
    known = lambda c: values.contains_any(F.lower(c), [k.lower() for k in keywords])
    place = ["doc_id", "page_no"]
    name = F.trim(F.get("cells", F.lit(0)))
    given = F.filter(F.slice("cells", 2, F.greatest(F.size("cells") - 1, F.lit(0))), lambda x: x.isNotNull() & ~F.trim(x).isin("", "nan"))
    amount = F.replace(F.try_element_at(given, F.lit(-1)), F.lit(","), F.lit("")).try_cast("double")
    tabled = cells.join(pages, place, "left_semi").select(*place, "table_no", "row_no", name.alias("source_name"), amount.alias("total"))
    said, trailing = values.trailing_amount(F.trim("line"))
    plain = lines.join(pages, place, "left_semi").join(cells.select(*place).distinct(), place, "left_anti")
    plain = plain.select(*place, F.lit(None).cast("long").alias("table_no"), F.col("line_no").cast("long").alias("row_no"), said.alias("source_name"), trailing.alias("total"))
    rows = tabled.withColumns({c: F.col(c).cast("long") for c in ("table_no", "row_no")}).unionByName(plain).where(known(F.col("source_name")) & F.col("total").isNotNull())
    found = rows.join(canonical, "source_name").join(docs.select("doc_id", "fy"), "doc_id").withColumnsRenamed({"canonical": "scheme", "fy": "fiscal_year"}).withColumn("col_type", F.lit("be"))
    found = found.withColumn("id", values.row_id(*map(F.col, ["doc_id", "scheme", "fiscal_year", "col_type"])))
    best = found.groupBy("id").agg(F.min_by(F.struct("doc_id", "scheme", "col_type", "fiscal_year", "total"), F.struct("page_no", "table_no", "row_no", "source_name", "total")).alias("r"))
    return best.select("id", "r.*")


def extracted_allocations(existing: DataFrame, docs: DataFrame, grid: DataFrame, lines: DataFrame, cells: DataFrame, canonical: DataFrame, headers: list[str], keywords: list[str]) -> DataFrame:
    """``existing`` (id, doc_id, scheme, col_type, fiscal_year, revenue, capital, total) and what the documents add to it.

    ``docs`` (doc_id, ext, route, fy) says how each is read: sheets by ``scheme_allocations``, others whose route is one of
    ``PAGE_ROUTES`` by ``allocations_of_pages``, without revenue and capital and with the year ``unknown`` where there is
    none; the rest not at all. An id that is there already stays as it is."""
    is_sheet = F.coalesce(F.col("ext").isin(*SHEETS), F.lit(False))
    sheets, paged = docs.where(is_sheet), docs.where(~is_sheet & F.col("route").isin(*PAGE_ROUTES)).withColumn("fy", F.coalesce("fy", F.lit("unknown")))
    of = lambda rows, own: rows.join(own.select("doc_id"), "doc_id", "left_semi")
    none = F.lit(None).cast("double")
    from_pages = allocations_of_pages(of(lines, paged), of(cells, paged), paged, canonical, headers, keywords).withColumns({"revenue": none, "capital": none})
    found = scheme_allocations(of(grid, sheets), sheets, canonical).unionByName(from_pages).select(existing.columns)
    return existing.unionByName(found.join(existing.select("id"), "id", "left_anti").select(existing.columns))


def scheme_timeseries(grid: DataFrame, docs: DataFrame, keywords: list[str]) -> DataFrame:
    """fiscal_year, actual, be, re, re_vs_be, actual_vs_be: the first row of each document that a keyword names, of each
    figure its latest reading."""
    rows = measured(grid).where(values.contains_any(F.col("name"), keywords))
    first = rows.groupBy("doc_id").agg(F.min_by(F.struct(*rows.columns[1:]), "row_no").alias("r")).select("doc_id", "r.*").join(docs.select("doc_id", "fy"), "doc_id")
    found = estimates(first, ["doc_id", "fy"], "fy")
    # of one budget year the first document by id counts
    latest = found.groupBy("fiscal_year", "col_type").agg(F.max_by("total", F.struct("fy", F.col("doc_id"))).alias("total"))
    wide = latest.groupBy("fiscal_year").pivot("col_type", ["actual", "be", "re"]).agg(F.first("total"))
    change = lambda c: F.round(F.try_divide((F.col(c) - F.col("be")) * 100, F.col("be")), 4)
    return wide.withColumns({"re_vs_be": change("re"), "actual_vs_be": change("actual")})


def demand_reports(manifest: DataFrame) -> DataFrame:
    """Reports on demands for grants about women or children."""
    low = F.lower(F.coalesce("title", F.lit("")))
    kind = (F.col("report_type") == "demands_for_grants") | ((F.col("report_type") == "other") & (low.contains("demands for grants") | low.contains(" dfg ")))
    return manifest.where(kind & (low.contains("women") | low.contains("child")))


def with_overrides(rows: DataFrame, overrides: DataFrame, key: str, columns: list[str], only=None) -> DataFrame:
    """``rows`` with ``columns`` of those that ``overrides`` (``key``, unique, and ``columns``) has replaced, nulls
    included. ``only``: which rows may be replaced."""
    own = overrides.select(key, F.struct(*columns).alias("__own"))
    over = F.col("__own").isNotNull() & (F.lit(True) if only is None else only)
    return rows.join(own, key, "left").withColumns({c: F.when(over, F.col("__own")[c]).otherwise(F.col(c)) for c in columns}).drop("__own")


def demand_vs_allocation(manifest: DataFrame, lines: DataFrame, overrides: DataFrame) -> DataFrame:
    """report_no, fy, projected, allocated, cut_pct, confidence, note of each report of ``manifest`` (report_no, title,
    report_type, doc_id). ``overrides`` (report_no, projected, allocated, confidence, note) replace what is found."""
    reports = demand_reports(manifest).select("report_no", fiscal.fy_from_title(F.col("title")).alias("fy"), "doc_id")
    found = projected_and_allocated(lines.join(reports.where("doc_id is not null").select("doc_id").distinct(), "doc_id", "left_semi"))
    missing = F.when(F.col("doc_id").isNull(), "no pdf_path in manifest").when(F.col("confidence").isNull(), "pdf not found")
    rows = reports.join(found, "doc_id", "left").withColumn("missing", missing)
    rows = with_overrides(rows, overrides, "report_no", ["projected", "allocated", "confidence", "note"], F.col("missing").isNull())
    out = rows.select("report_no", "fy", "projected", "allocated", F.coalesce("confidence", F.lit("none")).alias("confidence"), F.coalesce("missing", "note", F.lit("")).alias("note"))
    return out.withColumn("cut_pct", values.share(F.col("allocated") - F.col("projected"), F.col("projected"), 2))


def spend_series(rows: DataFrame, position: str) -> DataFrame:
    """fiscal_year, actual, be of ``rows`` (fiscal_year, col_type, total): the last positive actual; the first be only
    where no such actual is."""
    actual = F.when((F.col("col_type") == "actual") & (F.col("total") > 0), F.col("total"))
    be = F.when(F.col("col_type") == "be", F.coalesce("total", F.lit(0.0)))
    at = lambda c: F.when(c.isNotNull(), F.col(position))
    both = rows.groupBy("fiscal_year").agg(F.max_by(actual, at(actual)).alias("actual"), F.min_by(be, at(be)).alias("be"))
    return both.withColumn("be", F.when(F.col("actual").isNull(), F.col("be"))).where("actual is not null or be is not null")


def spine_join(years: DataFrame, demand: DataFrame, spend: DataFrame, external: DataFrame, deflators: DataFrame) -> DataFrame:
    """``years`` (fiscal_year) with all series that have it; what is allocated is the spending series' estimate where the
    demands have none or zero."""
    rows = years.join(demand, "fiscal_year", "left").join(spend, "fiscal_year", "left").join(external, "fiscal_year", "left").join(deflators, "fiscal_year", "left")
    return rows.withColumn("allocated", F.when(~is_given("allocated") & is_given("be"), F.col("be")).otherwise(F.col("allocated")))


def is_given(c: str):
    return F.coalesce(F.col(c), F.lit(0)) != 0


def real_terms_table(years: DataFrame, demand: DataFrame, spend: DataFrame, external: DataFrame, deflators: DataFrame) -> DataFrame:
    """Nominal and real figures of each of ``years`` (fiscal_year). demand: demanded, allocated; spend: see
    ``spend_series``; external: full_scheme; deflators: deflator; all by fiscal_year."""
    rows = spine_join(years, demand, spend, external, deflators)
    real = lambda c: values.deflated(F.col(c), F.col("deflator")).alias(f"{c}_real")
    spent = F.when(is_given("actual") & is_given("allocated"), values.share(F.col("actual"), F.col("allocated")))
    cut = F.when(is_given("demanded") & is_given("allocated"), values.share(F.col("allocated") - F.col("demanded"), F.col("demanded")))
    figures = ["demanded", "allocated", "full_scheme", "actual"]
    return rows.select("fiscal_year", *figures, spent.alias("pct_spent"), cut.alias("cut_pct"), *map(real, figures))


def from_aggregates(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` with the sources and uses that ten aggregates of a state's accounts come to."""
    c = F.col
    social, economic = c("rev_dev_social") + c("cap_social"), c("rev_dev_econ") + c("cap_econ")
    general = c("rev_exp") - c("rev_dev_social") - c("rev_dev_econ") + c("cap_outlay") - c("cap_social") - c("cap_econ")
    income = ["own_tax", "own_nontax", "devolution", "grants", "recovery"]
    return rows.select(*keys, *income, social.alias("social"), economic.alias("economic"), general.alias("general")).withColumn("net_borrowing", c("social") + c("economic") + c("general") - sum(map(c, income[1:]), c(income[0])))


#: Labels and kinds of balance flows by column: sources, then uses.
SOURCES = {"own_tax": ("Own tax", "own"), "own_nontax": ("Own non-tax", "own"), "devolution": ("Tax devolution", "transfer"), "grants": ("Grants from Centre", "transfer"), "net_borrowing": ("Net borrowing", "borrow"), "recovery": ("Loan recovery", "misc")}
USES = {"social": "Social Services", "economic": "Economic Services", "general": "General Services"}
TOLERANCE = 2


def balance_flow(rows: DataFrame, keys: list[str], strict: bool = False) -> DataFrame:
    """Edges source, target, amount of the money flow, with accepted: do both sides agree within ``TOLERANCE``?
    ``strict`` fails instead. ``rows`` holds one row of each of ``keys`` with the columns of ``SOURCES`` and ``USES``;
    a source column that isn't there is left out."""
    sources = {k: v for k, v in SOURCES.items() if k in rows.columns}
    gap = F.abs(sum((F.col(k) for k in sources), F.lit(0)) - sum((F.col(k) for k in USES), F.lit(0)))
    accepted = gap <= TOLERANCE
    if strict:
        accepted = F.when(accepted, True).otherwise(F.raise_error(F.lit("sources and uses differ")).cast("boolean"))
    edge = lambda a, z, k: F.struct(F.lit(a).alias("source"), F.lit(z).alias("target"), F.col(k).cast("double").alias("amount"))
    edges = [*(edge(label, "pool", k) for k, (label, _) in sources.items()), *(edge("pool", label, k) for k, label in USES.items())]
    return rows.select(*keys, accepted.alias("accepted"), F.explode(F.array(*edges)).alias("e")).select(*keys, "e.*", "accepted")


def shares_of_uses(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Transfers, own revenue and borrowing as percent of all uses, and the sentence that says so."""
    uses = F.col("social") + F.col("economic") + F.col("general")
    pct = lambda c: F.bround(F.try_divide(c * 100, uses).cast("double"), 0)
    out = rows.select(*keys, pct(F.col("devolution") + F.col("grants")).alias("transfers_pct"), pct(F.col("own_tax") + F.col("own_nontax")).alias("own_pct"), pct(F.col("net_borrowing")).alias("borrowing_pct"))
    said = F.format_string("%.0f%% comes from the Centre; own revenue %.0f%%; net borrowing %.0f%%", "transfers_pct", "own_pct", "borrowing_pct")
    return out.withColumn("headline", said)


def receipt_heads(lines: DataFrame) -> DataFrame:
    """doc_id, account, sector, head, amount, first_at from ``lines`` (doc_id, pos, line) of receipt statements: the
    largest net total of each head under its account and sector."""
    c = F.col("line")
    account = F.when(c.contains("Revenue Account"), "rev").when(c.contains("Capital Account"), "cap")
    marked = lines.withColumns({"account": account, "sector": slips.first_group(c, "SECTOR-+([A-Z])-")})
    for name in ("account", "sector"):
        marked = win.fill_forward(marked, ["doc_id"], "pos", name, name)
    number = F.try_element_at(F.regexp_extract_all(c, F.lit("[0-9][0-9,]*\\.[0-9]+"), F.lit(0)), F.lit(-1))
    rows = marked.select("doc_id", "pos", "account", "sector", slips.first_group(c, "Net Total\\s*:\\s*([0-9]{4})(?![0-9A-Za-z_])").alias("head"), F.replace(number, F.lit(","), F.lit("")).cast("decimal(18,2)").alias("amount"))
    rows = rows.where("head is not null and amount is not null")
    return rows.groupBy("doc_id", "account", "sector", "head").agg(F.greatest(F.max("amount"), F.lit(0).cast("decimal(18,2)")).alias("amount"), F.min("pos").alias("first_at"))


def receipt_income(heads: DataFrame) -> DataFrame:
    """doc_id, own_tax, own_nontax, devolution, grants from ``receipt_heads``: tax heads split by whether the Centre collects
    them; of the grants' head the first by position under any account. What is missing is zero."""
    sector = lambda s: (F.col("account") == "rev") & (F.col("sector") == s)
    central = F.col("head").isin(*CENTRAL_TAXES)
    total = lambda test: F.round(F.coalesce(F.sum(F.when(test, F.col("amount"))), F.lit(0)), 1).cast("decimal(18,1)")
    grant = F.col("head") == GRANT_HEAD
    first_grant = F.min_by(F.when(grant, F.col("amount")), F.when(grant, F.col("first_at")))
    return heads.groupBy("doc_id").agg(
        total(sector("A") & ~central).alias("own_tax"), total(sector("B")).alias("own_nontax"), total(sector("A") & central).alias("devolution"),
        F.round(F.coalesce(first_grant, F.lit(0)), 1).cast("decimal(18,1)").alias("grants"),
    )


def receipts_balance(lines: DataFrame, demands: DataFrame) -> DataFrame:
    """doc_id, own_tax, own_nontax, devolution, grants, social, economic, general, net_borrowing from receipt lines and
    demands (doc_id, major, amount). Debt is no use; grants count as general services."""
    income = receipt_income(receipt_heads(lines))
    by_head = demands.where(F.col("major").rlike("^[0-9]+$")).groupBy("doc_id", "major").agg(F.sum(F.coalesce("amount", F.lit(0))).alias("amount"))
    macro = fiscal.classify(F.col("major"))[0]
    named = by_head.select("doc_id", F.when(macro == "grants", "general").otherwise(macro).alias("macro"), "amount")
    use = lambda name: F.round(F.coalesce(F.sum(F.when(F.col("macro") == name, F.col("amount"))), F.lit(0)), 1).cast("decimal(18,1)").alias(name)
    uses = named.groupBy("doc_id").agg(*map(use, USES))
    c = F.col
    return income.join(uses, "doc_id").withColumn("net_borrowing", c("social") + c("economic") + c("general") - c("own_tax") - c("own_nontax") - c("devolution") - c("grants"))


def labelled_heads(rows: DataFrame) -> DataFrame:
    """table_id, row_no, code, parent_code, kind, label of every head in table rows (table_id, row_no, cells); major and
    sub-major carry down within a table."""
    c = F.col("cells")
    found = rows.where(F.exists(c, lambda x: x != "")).select("table_id", "row_no", slips.find_major(c).alias("m"), slips.find_sub(c).alias("s"), slips.find_minor(c).alias("n"))
    own = win.fill_heads(found.withColumns({"major": F.col("m.code"), "sub": F.col("s.code")}), ["table_id"], "row_no")
    major, base = F.col("cur_major"), F.coalesce("cur_sub", F.lit("00"))
    one = lambda found, code, parent, kind: F.when(F.col(found).isNotNull(), F.struct(code.alias("code"), parent.alias("parent_code"), F.lit(kind).alias("kind"), F.col(f"{found}.label").alias("label")))
    heads = F.array(
        one("m", major, F.lit(None).cast("string"), "major"),
        one("s", F.concat_ws("-", major, "cur_sub"), major, "submajor"),
        one("n", F.concat_ws("-", major, base, F.col("n.code")), fiscal.parent_code(major, base), "minor"),
    )
    return own.select("table_id", "row_no", F.explode(F.filter(heads, lambda h: h.isNotNull())).alias("h")).select("table_id", "row_no", "h.*")


def head_tree(rows: DataFrame) -> DataFrame:
    """code, parent_code, kind, label from table rows; the first row of a code stays."""
    first = F.min_by(F.struct("parent_code", "kind", "label"), F.struct("table_id", "row_no")).alias("r")
    return labelled_heads(rows).groupBy("code").agg(first).select("code", "r.*")


def numbered_notes(paragraphs: DataFrame) -> DataFrame:
    """table_id, number, note from ``paragraphs`` (table_id, pos, text): ``(n) text`` starts one, what follows goes on;
    of a number that stands twice the last counts. Headings "Note" and "Notes" don't count."""
    text = F.trim(F.regexp_replace("text", "\\s+", " "))
    rows = paragraphs.withColumn("text", text).where((F.col("text") != "") & ~F.rtrim(F.lower("text"), F.lit(":")).isin("note", "notes"))
    start = "^\\(\\s*([0-9]+)\\s*\\)\\s*(.*)$"
    runs = win.continued(rows, ["table_id"], "pos", F.col("text").rlike(start), "text")
    own = runs.select("table_id", "run", F.regexp_replace(F.regexp_extract("text", start, 1), "^0+(?=[0-9])", "").alias("number"), F.trim(F.regexp_extract("text", start, 2)).alias("note"))
    return own.groupBy("table_id", "number").agg(F.max_by("note", "run").alias("note"))


def scope_notes(rows: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """code, note_number, note: notes of the markers ``(n)`` in labels of table rows, by table."""
    marked = labelled_heads(rows).select("table_id", "code", F.explode(values.markers(F.col("label"))).alias("number")).distinct()
    return marked.join(numbered_notes(paragraphs).where("note <> ''"), ["table_id", "number"]).select("code", F.col("number").alias("note_number"), "note").distinct()


def change_timeline(versions: DataFrame) -> DataFrame:
    """version, label, slips, action, code, new_label, old_label: what each version of a code list (version, message,
    code, parent_code, label) changes against the one before it (version - 1)."""
    cells = ["parent_code", "label"]
    messages = versions.groupBy("version").agg(F.min("message").alias("message"))
    here = versions.select("version", "code", *cells)
    before = here.withColumn("version", F.col("version") + 1)
    # the version after the last one has no row of its own, so nothing is taken for removed there
    known = messages.select("version").join(messages.select((F.col("version") + 1).alias("version")), "version", "left_semi")
    keyed = lambda df: df.join(known, "version", "left_semi").select(F.struct("version", "code").alias("key"), *cells)
    diff = rel.version_diff(keyed(before), keyed(here), "key", cells).withColumn("code", F.col("key"))
    changes = rel.change_of(diff).select(F.col("code.version").alias("version"), F.col("code.code").alias("code"), "action", F.col("label").alias("new_label"), "old_label")
    told = messages.select("version", slips.event_label(F.col("message")).alias("label"), F.array_join(slips.slip_numbers(F.col("message")).cast("array<string>"), ",").alias("slips"))
    return changes.join(told, "version")


def vocabulary_triples(heads: DataFrame, events: DataFrame, notes: DataFrame, order: list[str]) -> DataFrame:
    """s, p, o of every concept: what ``vocabulary_history`` tells, identifier, kind, its place (broader and narrower heads,
    or a top concept) and its notes. Codes that only changes name are concepts, too. A note counts if its code is known
    and its text isn't empty. Each statement is made once."""
    told = staged(vocabulary_history(events, order, heads), "vocabulary")
    codes = told.where("p = 'prefLabel'").select("code").join(heads.select("code", "kind", "parent_code"), "code", "left")
    triple = lambda p, o: F.struct(F.lit(p).alias("p"), o.alias("o"))
    top, up = F.col("parent_code").isNull(), F.col("parent_code")
    own = F.array(triple("identifier", F.col("code")), triple("type", F.col("kind")), triple("topConceptOf", F.when(top, "scheme")), triple("broader", up))
    placed = codes.select(F.col("code").alias("s"), F.explode(own).alias("t")).where("t.o is not null").select("s", "t.p", "t.o")
    narrower = heads.where(~top).select(up.alias("s"), F.lit("narrower").alias("p"), F.col("code").alias("o"))
    kept = notes.where("trim(note) <> ''").join(codes.select("code"), "code", "left_semi").select(F.col("code").alias("s"), F.lit("scopeNote").alias("p"), F.col("note").alias("o")).distinct()
    return told.select(F.col("code").alias("s"), "p", "o").unionByName(placed).unionByName(narrower).unionByName(kept)


def browser_nodes(heads: DataFrame, notes: DataFrame, events: DataFrame) -> DataFrame:
    """code, label, kind, cls, n_children, n_notes, n_events of every head."""
    count = lambda df, name: df.groupBy("code").agg(F.count(F.lit(1)).alias(name))
    rows = heads.select("code", "label", "kind", fiscal.account_class(F.col("code")).alias("cls")).join(rel.children(heads).drop("label"), "code", "left")
    rows = rows.join(count(notes, "n_notes"), "code", "left").join(count(events, "n_events"), "code", "left")
    return rows.fillna(0, ["n_children", "n_notes", "n_events"])


def flattened(code) -> Column:
    """The key of a minor head in the ledger of changes: major and minor without what is between; null for other heads."""
    return F.when(F.size(F.split(code, "-")) == 3, F.concat_ws("-", F.split_part(code, F.lit("-"), F.lit(1)), F.split_part(code, F.lit("-"), F.lit(3))))


def head_history(heads: DataFrame, events: DataFrame) -> DataFrame:
    """code, event_code, event_id, action, exact: changes under each head's major; exact where the change names this minor
    head by its flattened key. For a few heads; for a whole chart see ``history_counts``."""
    own = heads.select("code", fiscal.bare_major(F.col("code")).alias("major"), flattened(F.col("code")).alias("flat"))
    other = events.select(F.col("code").alias("event_code"), fiscal.bare_major(F.col("code")).alias("major"), "action", "event_id")
    return own.join(other, "major").select("code", "event_code", "event_id", "action", F.coalesce(F.col("flat") == F.col("event_code"), F.lit(False)).alias("exact"))


def history_counts(heads: DataFrame, events: DataFrame) -> DataFrame:
    """code, n_changes, n_exact of every head: changes are counted by major and by key before they meet the heads, so
    each head is one row, however many changes its major has."""
    count = lambda key, name: events.groupBy(key.alias(name)).agg(F.count(F.lit(1)).alias(f"n_{name}"))
    own = heads.select("code", fiscal.bare_major(F.col("code")).alias("major"), flattened(F.col("code")).alias("flat"))
    rows = own.join(count(fiscal.bare_major(F.col("code")), "major"), "major", "left").join(count(F.col("code"), "flat"), "flat", "left")
    return rows.select("code", F.coalesce("n_major", F.lit(0)).alias("n_changes"), F.coalesce("n_flat", F.lit(0)).alias("n_exact"))


def lookup_by_class(heads: DataFrame, query: str) -> DataFrame:
    """cls, n_hits, n_classes of a subject's heads, classes in their order."""
    hits = rel.subject_hits(heads, query).groupBy(fiscal.account_class(F.col("code")).alias("cls")).agg(F.count(F.lit(1)).alias("n_hits"))
    # five classes at most
    return hits.withColumn("n_classes", F.count(F.lit(1)).over(Window.partitionBy())).orderBy("cls")


def stress_leaderboard(rows: DataFrame, ratio: str) -> DataFrame:
    """state, ratio, rank, high_stress of statement rows whose name_cell reads ``12. Name``; dashes and junk are zero."""
    name = F.col("name_cell")
    own = rows.where(name.rlike("[0-9]") & name.contains(".")).select(F.trim(F.regexp_extract(name, "(?s)^[^.]*\\.(.*)$", 1)).alias("state"), values.clean_value(F.col(ratio).cast("string")).alias("ratio"))
    rows = numbered(own, [], [F.desc_nulls_last("ratio"), F.col("state")])
    return rows.select("state", "ratio", F.col("rank").cast("int").alias("rank"), (F.col("ratio") > HIGH_STRESS).alias("high_stress"))


def first_row_with(grid: DataFrame, text: str) -> DataFrame:
    """doc_id, cells of the first row of each document in which a cell contains ``text``, in either case."""
    hit = F.exists("cells", lambda c: F.contains(F.lower(c), F.lit(text.lower())))
    return grid.where(hit).groupBy("doc_id").agg(F.min_by("cells", "row_no").alias("cells"))


def interest_burden(interest: DataFrame, revenue: DataFrame, state: str, periods: list[str]) -> DataFrame:
    """doc_id, period, interest, revenue, ratio: cells 2 and on of a state's row in two statements of the same doc_id."""
    cell = lambda side, k: values.clean_value(F.get(f"{side}.cells", k + 2))
    rows = first_row_with(interest, state).alias("i").join(first_row_with(revenue, state).alias("r"), "doc_id")
    kinds = [F.struct(F.lit(p).alias("period"), cell("i", k).alias("interest"), cell("r", k).alias("revenue")) for k, p in enumerate(periods)]
    out = rows.select("doc_id", F.explode(F.array(*kinds)).alias("x")).select("doc_id", "x.*")
    return out.withColumn("ratio", F.coalesce(values.share(F.col("interest"), F.col("revenue"), 2), F.lit(0.0)))


def fiscal_indicators(lines: DataFrame) -> DataFrame:
    """doc_id, line_no, indicator, crore of lines with a label and two columns, the second scaled by the unit that the
    document declares first of thousand, lakh and crore; without one, crore."""
    text = values.legacy_font(F.col("line"))
    rows = lines.select("doc_id", "line_no", F.trim(text).alias("line"))
    rank = {"Thousand": 1, "Lakh": 2, "Crore": 3}
    said = values.declared_unit(F.col("line"))
    order = F.when(said == "Thousand", rank["Thousand"]).when(said == "Lakh", rank["Lakh"]).when(said == "Crore", rank["Crore"])
    unit = rows.groupBy("doc_id").agg(F.min(order).alias("unit"))
    label, value = values.second_column(F.col("line"))
    found = rows.select("doc_id", "line_no", label.alias("indicator"), value.alias("value")).where("indicator is not null")
    scale = F.when(F.col("unit") == 1, "thousand").when(F.col("unit") == 2, "lakh").otherwise("crore")
    return found.join(unit, "doc_id").select("doc_id", "line_no", "indicator", values.to_crore(F.col("value"), scale).alias("crore"))


def prose_indicators(texts: DataFrame) -> DataFrame:
    """doc_id, indicator, crore: the first product of the state that a text (doc_id, text) names in lakh crore, in its own or
    the legacy font, wherever lines break. A dash within the number is a decimal point. Null texts give no row."""
    font = dict(values.LEGACY_FONT)
    gap = "[\\s\\p{Z}]+"
    pattern = gap.join([font["th0,l0Mh0ih0"], "([0-9.-]+)", font["yk[k"], font["djksM"]])
    number = F.replace(F.regexp_extract(values.legacy_font(F.col("text")), pattern, 1), F.lit("-"), F.lit(".")).try_cast("double")
    return texts.select("doc_id", F.lit(PRODUCT).alias("indicator"), (number * 100000).alias("crore")).where("crore is not null")


def document_indicators(texts: DataFrame) -> DataFrame:
    """doc_id, line_no, indicator, crore of whole texts (doc_id, text): the product named in prose (line_no null), then each
    line with a label and two columns in the unit that the document declares. Lines count from 0. Rows are appended, so a
    text that stands twice counts twice."""
    lines = texts.select("doc_id", F.posexplode(F.split("text", "\r\n|[\n\r\f\x0B]")).alias("line_no", "line"))
    prose = prose_indicators(texts).withColumn("line_no", F.lit(None).cast("int"))
    return fiscal_indicators(lines).unionByName(prose.select("doc_id", "line_no", "indicator", "crore"))


def wage_rows(lines: DataFrame, notifications: DataFrame) -> DataFrame:
    """doc_id, line_no, category, skill, daily, monthly of wage notifications (doc_id, title) from their ``lines``
    (doc_id, line_no, line). Lines that name a skill count as they are; others need a daily and a monthly rate that fit
    each other, and count once for each such pair in a document. Excluded notifications give no rows."""
    flags = slips.title_flags(F.col("title"))
    wanted = notifications.where(~flags["is_excluded"]).select("doc_id", flags["category"].alias("category"))
    numbers = F.transform(values.line_numbers(F.col("line")), lambda n: F.replace(n, F.lit(","), F.lit("")).cast("double"))
    between = lambda low, high: F.get(F.filter(F.col("numbers"), lambda n: n.between(low, high)), 0)
    rows = lines.select("doc_id", "line_no", values.skill(F.col("line")).alias("skill"), numbers.alias("numbers")).select("doc_id", "line_no", "skill", between(80, 2000).alias("daily"), between(3000, 60000).alias("monthly"))
    named = rows.where("skill is not null")
    fits = F.col("monthly").between(F.col("daily") * 15, F.col("daily") * 35)
    paired = rows.where(F.col("skill").isNull() & fits).groupBy("doc_id", "daily", "monthly").agg(F.min("line_no").alias("line_no"))
    out = named.unionByName(paired.select("doc_id", "line_no", F.lit("unspecified").alias("skill"), "daily", "monthly"))
    return out.join(wanted, "doc_id").select("doc_id", "line_no", "category", "skill", "daily", "monthly")


def health_accounts(df: DataFrame) -> DataFrame:
    """The health accounts under their own names, in order, as numbers. Raises if a column is missing or not a number."""
    own = df.withColumnsRenamed(HEALTH)
    missing = [c for c in HEALTH.values() if c not in own.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    kind = lambda c: "bigint" if c.startswith("per_capita") else "double"
    return own.select("year", *[F.col(c).cast(kind(c)).alias(c) for c in list(HEALTH.values())[1:]])


def import_history(rows: DataFrame, canonical: DataFrame, default: str = DEFAULT_SCHEME) -> DataFrame:
    """id, scheme, canonical, fiscal_year, col_type, revenue, capital, total of history rows (all strings); a scheme that
    isn't in ``canonical`` gets the default. The first row of an id stays; ``pos`` orders them."""
    known = rows.join(canonical, F.col("scheme") == F.col("source_name"), "left").withColumn("canonical", F.coalesce("canonical", F.lit(default)))
    own = known.withColumn("id", values.row_id(*map(F.col, ["scheme", "canonical", "fiscal_year", "col_type"])))
    figures = [F.col(m).cast("double").alias(m) for m in MEASURES]
    best = own.groupBy("id").agg(F.min_by(F.struct("scheme", "canonical", "fiscal_year", "col_type", *figures), "pos").alias("r"))
    return best.select("id", "r.*")
