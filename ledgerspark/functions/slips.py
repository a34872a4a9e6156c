"""Correction slips, chart-of-accounts cells and notification titles, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fiscal

# How messages name slips, in either case.
CORRIGENDUM_TO_SLIP = r"(?i)\bcorrigendum\s+to\s+correction\s+slip\s+no\.?\s+(\d{3,4})\b"
CORRIGENDUM = r"(?i)\bcorrigendum\s+no\.?\s+(\d{1,4})\b"
CS_SEGMENT = r"(?i)\bcs\.?\s+((?:\d{3,4}\s*){1,8})"
SLIP_SEGMENT = r"(?i)\bcorrection\s+slips?\s*(?:nos?|numbers?|number)?(?:\s+from)?\s+((?:\d{3,4}\s*(?:(?:to|and|&|-)\s*)?){1,8})"
#: Slips between two numbers up to which the two stand for a range.
WIDEST_RANGE = 50
ACTIONS = ["INSERT", "DELETE", "RENAME"]


def first_group(text: Column, pattern: str) -> Column:
    """The first group of the first match; null without one."""
    return F.nullif(F.regexp_extract(F.coalesce(text, F.lit("")), pattern, 1), F.lit(""))


def listed_numbers(segment: Column) -> Column:
    """Numbers of a segment without a file id at its end, that is, while the last is smaller than the one before."""
    found = F.transform(F.regexp_extract_all(segment, F.lit(r"\d{3,4}"), F.lit(0)), lambda n: n.cast("int"))
    rising = lambda a: F.filter(F.sequence(F.lit(1), F.size(a)), lambda k: (k == 1) | (F.get(a, k - 1) >= F.get(a, k - 2)))
    return F.get(F.transform(F.array(found), lambda a: F.when(F.size(a) > 0, F.slice(a, 1, F.array_max(rising(a)))).otherwise(a)), 0)


def slip_numbers(message: Column) -> Column:
    """array<int>: the slips that a message is about. Two numbers that aren't joined by "and" are the ends of a range."""
    corrigendum, segment, short = (first_group(message, p) for p in (CORRIGENDUM_TO_SLIP, SLIP_SEGMENT, CS_SEGMENT))
    ends = listed_numbers(segment)
    first, last = F.get(ends, 0), F.get(ends, 1)
    is_range = (F.size(ends) == 2) & ~segment.rlike(r"(?i)\b(?:and|&)\b") & (last > first) & (last - first <= WIDEST_RANGE)
    listed = F.when(is_range, F.sequence(first, F.greatest(first, last))).otherwise(ends)
    none = F.array().cast("array<int>")
    return F.when(corrigendum.isNotNull(), F.array(corrigendum.cast("int"))).when(segment.isNotNull(), listed).when(short.isNotNull(), listed_numbers(short)).otherwise(none)


def compressed(numbers: Column) -> Column:
    """``a-b`` for consecutive numbers, else a list."""
    first, last = F.get(numbers, 0), F.try_element_at(numbers, F.lit(-1))
    run = (F.size(numbers) > 1) & (first < last) & (numbers == F.sequence(first, F.greatest(first, last)))
    return F.when(run, F.concat_ws("-", first.cast("string"), last.cast("string"))).otherwise(F.array_join(F.transform(numbers, lambda n: n.cast("string")), ", "))


def event_label(message: Column) -> Column:
    """What readers see of a message: its slips, else the message without its prefix and file id."""
    text = F.coalesce(message, F.lit(""))
    numbers = slip_numbers(message)
    kind = F.when(first_group(message, CORRIGENDUM_TO_SLIP).isNotNull(), "Corrigendum to Correction Slip No. ").when(F.size(numbers) == 1, "Correction Slip No. ").otherwise("Correction Slip Nos. ")
    plain = F.trim(F.regexp_replace(F.trim(F.regexp_replace(text, r"(?i)^\s*Correction Slip:\s*", "")), r"\s+\d{3,4}\s*$", ""))
    lone = first_group(message, CORRIGENDUM)
    return F.when(F.size(numbers) > 0, F.concat(kind, compressed(numbers))).when(lone.isNotNull(), F.concat(F.lit("Corrigendum No. "), lone)).otherwise(plain)


def normal_change(action: Column, major: Column, sub: Column, minor: Column, label: Column) -> Column:
    """struct<action, code, parent_code, kind, label, is_receipt, is_expenditure, error> of a slip's change.

    Codes keep their digits and are padded to 4, 2 and 3. A two-digit minor without a sub-major is a sub-major. error
    says what is wrong (unknown action, no major, too many digits); it is null for a change that can be applied.
    """
    digits = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), "[^0-9]", "")
    m, s, n = digits(major), digits(sub), digits(minor)
    moved = (F.length(n) == 2) & (s == "")
    s, n = F.when(moved, n).otherwise(s), F.when(moved, "").otherwise(n)
    verb = F.upper(F.trim(F.coalesce(action, F.lit(""))))
    error = F.when(~verb.isin(*ACTIONS), "action").when((F.length(m) > 4) | (F.length(s) > 2) | (F.length(n) > 3), "width").when(m == "", "major")
    m4, s2, n3 = fiscal.zfill(m, 4), F.when(s == "", F.when(n != "", "00").otherwise("")).otherwise(fiscal.zfill(s, 2)), fiscal.zfill(n, 3)
    code = F.when(n != "", F.concat_ws("-", m4, s2, n3)).when(s2 != "", F.concat_ws("-", m4, s2)).otherwise(m4)
    parent = F.when(n != "", fiscal.parent_code(m4, s2)).when(s2 != "", m4)
    kind = F.when(n != "", "Minor Head").when(s2 != "", "Sub-Major Head").otherwise("Major Head")
    fine = lambda c: F.when(error.isNull(), c)
    number = m4.try_cast("int")
    return F.struct(
        verb.alias("action"), fine(code).alias("code"), fine(parent).alias("parent_code"), fine(kind).alias("kind"), F.trim(F.coalesce(label, F.lit(""))).alias("label"),
        fine((number < 4000).cast("int")).alias("is_receipt"), fine((number >= 2000).cast("int")).alias("is_expenditure"), error.alias("error"),
    )


def cell_after(cells: Column, k: Column) -> Column:
    """The next cell that isn't empty after position ``k`` (from 0); empty if there is none."""
    rest = F.filter(F.slice(cells, k + 2, F.greatest(F.size(cells), F.lit(1))), lambda c: c != "")
    return F.coalesce(F.get(rest, 0), F.lit(""))


def first_cell(cells: Column, pick) -> Column:
    """The first struct<code, label> that ``pick(cell, k)`` makes of a cell; null if it makes none."""
    return F.get(F.filter(F.transform(cells, pick), lambda found: found.isNotNull()), 0)


def pair(code: Column, label: Column) -> Column:
    return F.struct(code.alias("code"), label.alias("label"))


def find_major(cells: Column) -> Column:
    return first_cell(cells, lambda c, k: F.when(c.rlike("^[0-9]{4}$"), pair(c, cell_after(cells, k))))


def find_sub(cells: Column) -> Column:
    """``02 Label`` or ``02-Label`` in one cell, or ``02`` with a label in the next that isn't a minor's code."""
    whole = r"^([0-9]{2})(?:\s*[-.]\s*|\s+)(.+)$"
    alone = lambda c, k: c.rlike("^[0-9]{2}$") & (cell_after(cells, k) != "") & ~cell_after(cells, k).rlike("^[0-9]{3}$")
    return first_cell(cells, lambda c, k: F.when(c.rlike(whole), pair(F.regexp_extract(c, whole, 1), F.regexp_extract(c, whole, 2))).when(alone(c, k), pair(c, cell_after(cells, k))))


def find_minor(cells: Column) -> Column:
    return first_cell(cells, lambda c, k: F.when(c.rlike("^[0-9]{3}$") & (cell_after(cells, k) != ""), pair(c, cell_after(cells, k))))


def title_flags(title: Column) -> dict[str, Column]:
    """Flags and category of a wage notification's title."""
    low = F.lower(title)
    return {
        "is_preliminary": low.contains("prelim"),
        "is_final": low.contains("final"),
        "is_excluded": low.contains("excluded") | low.contains("exempt"),
        "is_amendment": low.contains("amendment"),
        "category": F.btrim(F.regexp_replace(title, r"(?s)\s*[0-9]{4}.*$", ""), F.lit(" -")),
    }


def demand_number(stem: Column) -> Column:
    return F.coalesce(first_group(stem, "sbe([0-9]+)"), F.lit("unknown"))


def slip_file(stem: Column) -> tuple[Column, Column]:
    """Date and title of a file name: the part before the first underscore, and the others with blanks."""
    parts = F.split(stem, "_")
    return F.get(parts, 0), F.array_join(F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1))), " ")
