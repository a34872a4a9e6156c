"""Numbers and text as they stand in budget documents, as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Literal replacements of a legacy font, in order.
LEGACY_FONT = [
    ("foRr", "वित्त"), ("ea=h", "मंत्री"), ("ctV", "बजट"), ("vuqekuksa", "अनुमानों"), ('Hkk"k.k', "भाषण"),
    ("th0,l0Mh0ih0", "जीएसडीपी"), ("yk[k", "लाख"), ("djksM", "करोड़"), ("izfr'kr", "प्रतिशत"),
]
# Markers whose occurrences make up the two signal scores.
AUSTERITY = ["rationalization", "freeze", "expenditure control", "merger of schemes", "austerity", "cut", "reduction", "efficiency", "disinvestment", "contractual cadre", "honorarium", "fixed term", "outsource"]
EXTRAVAGANCE = ["concession", "incentive", "investor", "viability gap", "ppp", "exemption", "tax holiday", "subsidy to capital", "asset inflation", "mega project", "mou signed", "global summit"]
# Parts of a name that mark a total or heading row.
SKIPPED = ["CENTRE", "TRANSFERS", "Total", "Grand Total", "Centrally Sponsored", "Autonomous", "Others", "Establishment", "Gross", "Net", "Recoveries", "Receipts", "Social", "Secretariat", "Ministry", "(In", "B. Developmental"]


def to_float(text: Column) -> Column:
    return text.try_cast("double")


def clean_value(text: Column, commas: bool = False, legacy_dash: bool = False) -> Column:
    """Zero for what isn't a number. ``commas``: drop them first. ``legacy_dash``: also drop spaces and read dashes as
    the digit 0, so signs are lost."""
    own = text
    if commas or legacy_dash:
        own = F.replace(own, F.lit(","), F.lit(""))
    if legacy_dash:
        own = F.translate(F.replace(own, F.lit(" "), F.lit("")), "–-", "00")
    return F.coalesce(own.try_cast("double"), F.lit(0.0))


def parse_float(text: Column) -> Column:
    return F.round(F.regexp_replace(text, "[^0-9.]", "").try_cast("double"), 2)


def amounts(line: Column, least: float = 0.0) -> Column:
    """Amounts with two decimals, percentages aside, that reach ``least``."""
    plain = F.regexp_replace(line, "[0-9,]+\\.?[0-9]*\\s*%", "")
    found = F.transform(F.regexp_extract_all(plain, F.lit("[0-9,]+\\.[0-9]{2}"), F.lit(0)), parse_float)
    return F.filter(found, lambda x: x >= least)


def to_crore(value: Column, unit: Column) -> Column:
    number = F.when(F.trim(value).isin("", "..", "-", "NA"), F.lit(0.0)).otherwise(F.coalesce(F.replace(value, F.lit(","), F.lit("")).try_cast("double"), F.lit(0.0)))
    low = F.lower(unit)
    return F.when(low.contains("lakh"), number / 100).when(low.contains("thousand"), number / 10000).otherwise(number)


def declared_unit(text: Column) -> Column:
    low = F.lower(text)
    return F.when(low.rlike("in thousand|हजार"), "Thousand").when(low.rlike("in lakh|लाख"), "Lakh").when(low.rlike("in crore|करोड़"), "Crore")


def trailing_amount(line: Column) -> tuple[Column, Column]:
    pattern = "^(.+?)\\s+([0-9,]+\\.?[0-9]*)\\s*$"
    name = F.regexp_extract(line, pattern, 1)
    return F.when(name != "", name), F.replace(F.regexp_extract(line, pattern, 2), F.lit(","), F.lit("")).try_cast("double")


def second_column(line: Column) -> tuple[Column, Column]:
    pattern = "^(.*?)\\s{2,}([0-9,.-]+)\\s{2,}([0-9,.-]+)"
    label = F.trim(F.regexp_extract(line, pattern, 1))
    return F.when((label != "") & ~label.rlike("^[0-9]+$"), label), F.regexp_extract(line, pattern, 3)


def lakh_crore(text: Column) -> Column:
    return F.replace(F.regexp_extract(text, "([0-9]+[.-]?[0-9]*) lakh crore", 1), F.lit("-"), F.lit(".")).try_cast("double") * 100000


def doc_slug(*parts: Column) -> Column:
    return F.substring(F.lower(F.regexp_replace(F.regexp_replace(F.concat_ws("_", *parts), "[^A-Za-z0-9]+", "_"), "^_+|_+$", "")), 1, 140)


def safe_name(text: Column) -> Column:
    tidy = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, "\\s+", " "), '[<>:"/\\\\|?*\\x00-\\x1f]', "_"), "_+", "_")
    tidy = F.regexp_replace(tidy, "^[ ._]+|[ ._]+$", "")
    return F.substring(F.when(tidy == "", "untitled").otherwise(F.coalesce(tidy, F.lit("untitled"))), 1, 180)


def row_id(*parts: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("None")) for p in parts]), 256), 1, 16)


def extension(url: Column) -> Column:
    found = F.lower(F.regexp_extract(F.regexp_replace(url, "[?#].*$", ""), "\\.([A-Za-z0-9]+)$", 1))
    return F.when(found != "", found).otherwise("pdf")


def normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def tokens(text: Column) -> Column:
    return F.filter(F.split(normal(text), " "), lambda t: t != "")


def clean_text(text: Column, markers: bool = False) -> Column:
    own = F.replace(text, F.lit(" "), F.lit(" "))
    if markers:
        own = F.regexp_replace(own, "\\(\\s*[0-9]+\\s*\\)", "")
    return F.trim(F.regexp_replace(own, "\\s+", " "))


def markers(label: Column) -> Column:
    return F.transform(F.regexp_extract_all(label, F.lit("\\(\\s*([0-9]+)\\s*\\)"), F.lit(1)), lambda n: F.regexp_replace(n, "^0+(?=[0-9])", ""))


def legacy_font(text: Column) -> Column:
    return reduce(lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])), LEGACY_FONT, text)


def has_script(text: Column, chars: str = "[ऀ-ॿ]") -> Column:
    return text.rlike(chars)


def route(ext: Column, chars: Column, tables: Column, script: Column) -> Column:
    return F.when(ext.isin("xls", "xlsx", "csv"), "xls").when(chars.isNull(), "unknown").when(script, "devanagari_pdf").when(chars < 100, "scanned_pdf").when(tables >= 2, "table_pdf").otherwise("text_pdf")


def signal(text: Column, found: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.regexp_count(F.lower(text), F.lit(m)) for m in found])


def contains_any(text: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words])


def skill(line: Column) -> Column:
    """The first that matches, in this order; a highly skilled line therefore reads as skilled."""
    low = F.lower(line)
    return F.when(low.rlike("un-?skilled"), "unskilled").when(low.rlike("semi-? ?skilled"), "semi-skilled").when(low.contains("skilled"), "skilled").when(low.contains("highly"), "highly-skilled")


def line_numbers(line: Column) -> Column:
    return F.regexp_extract_all(line, F.lit("(?:^|[^0-9A-Za-z_])([0-9]{1,5}(?:[.,][0-9]{1,2})?)(?![0-9A-Za-z_])"), F.lit(1))


def share(part: Column, whole: Column, digits: int = 1) -> Column:
    """Percent, null where the whole isn't positive. Halves round to even."""
    return F.when(whole > 0, F.bround(F.try_divide(part * 100, whole), digits))


def deflated(value: Column, deflator: Column) -> Column:
    return F.when(deflator > 0, F.bround(value * 100 / deflator, 0))


def gsdp(liabilities: Column, percent: Column) -> Column:
    return liabilities / (percent / 100)


def squeeze_gap(product: Column) -> Column:
    return product * 0.12 * 0.41 * 0.217  # 1 - 0.783 as doubles is less than 0.217


def devolution_gap(devolution: Column) -> Column:
    return devolution * 0.217 / (1 - 0.217)


def concept_uri(base: str, code: Column) -> Column:
    return F.concat(F.lit(base), F.replace(code, F.lit("-"), F.lit("/")))


def escaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def change_text(action: Column, old: Column, new: Column) -> Column:
    return F.when(action == "INSERT", F.concat(F.lit("ADD "), new)).when(action == "DELETE", F.concat(F.lit("DROP "), new)).when(action == "RENAME", F.concat(F.lit("RENAME "), F.coalesce(old, F.lit("")), F.lit(" → "), new))
