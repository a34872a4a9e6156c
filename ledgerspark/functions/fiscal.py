"""Fiscal years, account codes and their classes, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Account ranges (after capital heads are shifted to their revenue twins), first match wins.
RULES = [
    (2048, 2049, "general", "Interest payments"),
    (2071, 2071, "general", "Pensions & retirement benefits"),
    (2055, 2055, "general", "Police"),
    (2011, 2079, "general", "Administration & organs of state"),
    (2202, 2205, "social", "Education, sports, art & culture"),
    (2210, 2211, "social", "Health & family welfare"),
    (2215, 2215, "social", "Water supply & sanitation"),
    (2216, 2217, "social", "Housing & urban development"),
    (2225, 2225, "social", "Welfare, social security & nutrition"),
    (2230, 2230, "social", "Welfare, social security & nutrition"),
    (2235, 2236, "social", "Welfare, social security & nutrition"),
    (2245, 2245, "social", "Welfare, social security & nutrition"),
    (2250, 2252, "social", "Welfare, social security & nutrition"),
    (2202, 2252, "social", "Other social services"),
    (2401, 2435, "economic", "Agriculture & allied"),
    (2501, 2575, "economic", "Rural & area development"),
    (2700, 2711, "economic", "Irrigation & flood control"),
    (2801, 2810, "economic", "Energy / power"),
    (2851, 2885, "economic", "Industry & minerals"),
    (3051, 3075, "economic", "Transport"),
    (3201, 3475, "economic", "Communications, science & other economic"),
    (3601, 3606, "grants", "Compensation & assignments to local bodies"),
]
OTHERWISE = ("economic", "Other economic services")
#: Heads of the financing side by the shifted number: (low, high, label).
FINANCING = [(7999, 7999, "Appropriation to Contingency Fund"), (6000, 6075, "Public debt repayment"), (6000, 7999, "Loans disbursed by the State")]
SECTORS = ["social", "economic", "general", "grants", "debt"]


def year_label(start: Column) -> Column:
    return F.concat(start.cast("string"), F.lit("-"), F.lpad(F.pmod(start + 1, F.lit(100)).cast("string"), 2, "0"))


def fy_of_date(day: Column) -> Column:
    """April to March."""
    return year_label(F.year(day) - (F.month(day) < 4).cast("int"))


def fy_start(fy: Column) -> Column:
    return F.substring(fy, 1, 4).cast("int")


def earlier_fy(fy: Column, years: int = 1) -> Column:
    return year_label(fy_start(fy) - years)


def full_fy(fy: Column) -> Column:
    """Both years in full. The century is the first year's own, so 1999-00 becomes 1999-1900."""
    return F.concat(F.substring(fy, 1, 4), F.lit("-"), F.substring(fy, 1, 2), F.substring(fy, 6, 2))


def fy_from_title(title: Column) -> Column:
    found = F.regexp_extract(title, "([0-9]{4})[-–]([0-9]{2,4})", 0)
    return F.when(found != "", F.concat(F.substring(found, 1, 4), F.lit("-"), F.right(found, F.lit(2))))


def fy_variants(fy: Column) -> Column:
    short = F.array(fy, F.replace(fy, F.lit("-"), F.lit("_")))
    long = F.concat(F.substring(fy, 1, 4), F.lit("-20"), F.substring(fy, 6, 2))
    return F.when(fy.rlike("^20[0-9]{2}-[0-9]{2}$"), F.concat(short, F.array(long, F.replace(long, F.lit("-"), F.lit("_"))))).otherwise(short)


def zfill(text: Column, width: int) -> Column:
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def head_code(major: Column, sub: Column, minor: Column) -> Column:
    """major-sub-minor; null without a major or a minor."""
    own = F.coalesce(F.when(sub != "", sub), F.lit("00"))
    return F.when((F.coalesce(major, F.lit("")) != "") & (F.coalesce(minor, F.lit("")) != ""), F.concat_ws("-", major, zfill(own, 2), minor))


def parent_code(major: Column, sub: Column) -> Column:
    """A minor under sub-major 00 hangs on the major."""
    return F.when(sub == "00", major).otherwise(F.concat_ws("-", major, sub))


def account_class(code: Column) -> Column:
    digit = F.substring(code, 1, 1)
    return F.when(digit.isin("0", "1"), 0).when(digit.isin("2", "3"), 2).when(digit.isin("4", "5"), 4).when(digit.isin("6", "7"), 6).otherwise(8)


def is_receipt(major: Column) -> Column:
    return (major.cast("int") < 4000).cast("int")


def is_expenditure(major: Column) -> Column:
    return (major.cast("int") >= 2000).cast("int")


def bare_major(code: Column) -> Column:
    return F.trim(F.substring_index(code, "-", 1))


def shifted(major: Column) -> Column:
    number = major.cast("int")
    return F.when(F.substring(major, 1, 1).isin("4", "5"), number - 2000).otherwise(number)


def classify(major: Column) -> tuple[Column, Column]:
    """(sector, sub-sector) of a four-digit major head, as conditional expressions: no join, no shuffle."""
    number, twin = major.cast("int"), shifted(major)
    financing = F.substring(major, 1, 1).isin("6", "7")
    sector, label = F.when(financing, "debt"), None
    for low, high, name in FINANCING:
        test = financing & number.between(low, high)
        label = F.when(test, name) if label is None else label.when(test, name)
    for low, high, macro, name in RULES:
        sector, label = sector.when(twin.between(low, high), macro), label.when(twin.between(low, high), name)
    return sector.otherwise(OTHERWISE[0]), label.otherwise(OTHERWISE[1])


def sector_order(sector: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, SECTORS)), sector).cast("int")
