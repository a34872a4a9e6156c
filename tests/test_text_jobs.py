"""Pages with tables and lines, indicators in whole texts, income by who collects it, wages without a notification."""

from decimal import Decimal

import pytest

from ledgerspark.functions import values
from ledgerspark.operators import jobs, wages


def test_allocations_of_pages(spark):
    lines = spark.createDataFrame([
        (1, 1, 1, "Women and CHILD Welfare"), (1, 1, 2, "icds  9,000"), (1, 2, 1, "Child Welfare"), (1, 2, 2, " Icds Scheme   1,234.5 "), (1, 2, 3, "icds scheme 7"), (1, 2, 4, "poshan twelve"),
        (1, 2, 5, "roads 55"), (1, 3, 1, "icds scheme 99"), (2, 1, 1, "child welfare"), (2, 1, 2, "icds 5"), (3, 1, 1, None), (4, 1, 1, "child welfare icds 8"),
    ], "doc_id int, page_no int, line_no int, line string")
    cells = spark.createDataFrame([
        (1, 1, 0, 1, [" poshan ", "5", None, "2,000.25", "nan", " "]), (1, 1, 0, 2, ["poshan", "77"]), (1, 1, 0, 3, ["icds scheme", "x"]), (1, 1, 0, 4, ["icds scheme", None, ""]), (1, 1, 0, 5, []),
        (1, 1, 1, 1, [None, "icds"]), (1, 1, 1, 2, ["icds"]), (9, 1, 0, 1, ["icds", "1"]),
    ], "doc_id int, page_no int, table_no int, row_no int, cells array<string>")
    docs = spark.createDataFrame([(1, "2024-25"), (2, None), (4, "2024-25")], "doc_id int, fy string")
    names = spark.createDataFrame([("icds", "ICDS"), ("Icds Scheme", "ICDS"), ("icds scheme", "ICDS"), ("poshan", "POSHAN"), ("roads", "ROADS")], "source_name string, canonical string")
    found = jobs.allocations_of_pages(lines, cells, docs, names, ["child welfare"], ["ICDS", "Poshan"])
    # page 1 has tables, so its lines don't count, a table's first row of a scheme does; page 3 has no header
    assert sorted((r.doc_id, r.scheme, r.total, r.fiscal_year) for r in found.collect()) == [(1, "ICDS", 1234.5, "2024-25"), (1, "POSHAN", 2000.25, "2024-25"), (2, "ICDS", 5.0, None)]
    assert found.select("id").distinct().count() == 3
    assert jobs.allocations_of_pages(lines.limit(0), cells.limit(0), docs, names, ["x"], ["y"]).count() == 0


FONT = dict(values.LEGACY_FONT)
NAMED = f"{FONT['th0,l0Mh0ih0']} 12-5 {FONT['yk[k']} {FONT['djksM']}"


@pytest.mark.parametrize(("text", "crore"), [
    ("th0,l0Mh0ih0 12.5 yk[k djksM", 1250000.0), (NAMED, 1250000.0), (f"a\n{NAMED.replace(' ', chr(10))} b", 1250000.0), (f"{NAMED} {NAMED.replace('12', '13')}", 1250000.0), (NAMED.replace(" ", " "), 1250000.0),
    (NAMED.replace("12-5", "1-2-3"), None), (NAMED.replace("12-5", ""), None), ("", None), (None, None),
])
def test_prose(spark, text, crore):
    rows = jobs.prose_indicators(spark.createDataFrame([(1, text)], "doc_id int, text string")).collect()
    assert [r.crore for r in rows] == ([] if crore is None else [crore])


def test_document_indicators(spark):
    long = "x " * 200_000
    texts = [(1, f"{long}\n{NAMED}\r\nTaxes   1   250\n12   1   2"), (2, "Taxes   1   2.5"), (2, "Taxes   1   2.5"), (3, None), (4, "")]
    found = jobs.document_indicators(spark.createDataFrame(texts, "doc_id int, text string"))
    # the sentence's "lakh" is the unit that the document names; a number is no label
    assert sorted(((r.doc_id, r.line_no, r.indicator, r.crore) for r in found.collect()), key=str) == sorted([(1, None, "GSDP", 1250000.0), (1, 2, "Taxes", 2.5), (2, 0, "Taxes", 2.5), (2, 0, "Taxes", 2.5)], key=str)


def test_receipt_income(spark):
    rows = [("A", "rev", "A", "0020", "5.00", 1), ("A", "rev", "A", "0040", "7.00", 2), ("A", "cap", "A", "0040", "9.00", 3), ("A", "rev", "B", "0070", "1.25", 4), ("A", "cap", None, "1601", "3.00", 6), ("A", "rev", "C", "1601", "4.00", 5), ("B", None, None, "0020", "1.00", 1)]
    heads = spark.createDataFrame([(*r[:4], Decimal(r[4]), r[5]) for r in rows], "doc_id string, account string, sector string, head string, amount decimal(18,2), first_at int")
    got = {r.doc_id: tuple(map(float, r[1:])) for r in jobs.receipt_income(heads).select("doc_id", "own_tax", "own_nontax", "devolution", "grants").collect()}
    assert got == {"A": (7.0, 1.3, 5.0, 4.0), "B": (0.0, 0.0, 0.0, 0.0)}


def test_wages_of_states(spark):
    states = spark.createDataFrame([("Goa",), ("Goa",), ("west_bengal",), ("Tamil Nadu",), ("Nowhere",), (None,)], "state string")
    rates = spark.createDataFrame([(3, "GOA", "300", "b"), (1, "Goa", "", "x"), (2, "goa", "280.5", None), (4, "West Bengal", "200", "n"), (5, "Tamil Nadu", "1", ""), (6, None, "7", "")], "pos int, state string, low string, note string")
    table = {r.state: (r.daily, r.monthly, r.note) for r in wages.wages_from_table(states, rates).collect()}
    assert table == {"Goa": (280.5, 7293.0, ""), "west_bengal": (200.0, 5200.0, "n"), "Tamil Nadu": (1.0, 26.0, "")}
    every = sorted((r.state, r.employment, r.monthly, r.source) for r in wages.state_wages(states, rates).collect())
    assert every == [("Goa", wages.BENCHMARK, 7293.0, "static"), ("Tamil Nadu", "Anganwadi Helper", 4100.0, "own"), ("Tamil Nadu", "Anganwadi Worker", 7700.0, "own"), ("west_bengal", wages.BENCHMARK, 5200.0, "static")]
    with pytest.raises(Exception, match="abc"):
        wages.wages_from_table(states, spark.createDataFrame([(1, "Goa", "abc", "")], rates.schema)).collect()
    assert wages.state_wages(states.limit(0), rates.limit(0)).count() == 0


def test_scheduling_status(spark):
    states = spark.createDataFrame([(" RAJASTHAN",), ("Goa",), ("Goa",), (None,)], "state string")
    got = sorted((r.state, r.employment, r.status, r.year) for r in wages.scheduling_status(states).collect())
    assert got == [
        (" RAJASTHAN", "anganwadi_helper", "scheduled", None), (" RAJASTHAN", "anganwadi_worker", "scheduled", None), (" RAJASTHAN", "shops_commercial", "scheduled", 2024),
        ("Goa", "anganwadi_helper", "never_scheduled", None), ("Goa", "anganwadi_worker", "never_scheduled", None),
    ]
    more = spark.createDataFrame([("goa", "asha_worker", "excluded", 2020)], "state string, employment string, status string, year int")
    assert [(r.employment, r.year) for r in wages.scheduling_status(states.where("state = 'Goa'"), more).collect()] == [("asha_worker", 2020)]


def test_extracted_allocations(spark):
    """A snapshot's rows stay, sheets and pages are told apart by extension and route, other documents add nothing."""
    sheet = [None] * 36
    sheet[5], sheet[31], sheet[33], sheet[35] = "icds", "1", "2", "3"
    grid = spark.createDataFrame([("s", 1, sheet), ("c", 1, sheet)], "doc_id string, row_no int, cells array<string>")
    lines = spark.createDataFrame([(d, 1, n, text) for d in "pqs" for n, text in enumerate(["child welfare", "icds 5"])], "doc_id string, page_no int, line_no int, line string")
    cells = spark.createDataFrame([], "doc_id string, page_no int, table_no int, row_no int, cells array<string>")
    docs = spark.createDataFrame([("s", "xls", None, "2024-25"), ("c", "csv", "xls", "2024-25"), ("p", "pdf", "text_pdf", None), ("q", "pdf", "devanagari_pdf", "2024-25"), ("r", None, None, None)], "doc_id string, ext string, route string, fy string")
    names = spark.createDataFrame([("icds", "ICDS")], "source_name string, canonical string")
    schema = "id string, doc_id string, scheme string, col_type string, fiscal_year string, revenue double, capital double, total double"
    run = lambda rows: jobs.extracted_allocations(spark.createDataFrame(rows, schema), docs, grid, lines, cells, names, ["child welfare"], ["icds"]).collect()
    fresh = run([])
    assert {(r.doc_id, r.fiscal_year, r.col_type, r.revenue, r.total) for r in fresh if r.total is not None} == {("s", "2024-25", "be", 1.0, 3.0), ("p", "unknown", "be", None, 5.0)}
    assert {r.doc_id for r in fresh} == {"s", "p"}
    first = next(r for r in fresh if r.doc_id == "p")
    again = run([(first.id, "p", "ICDS", "be", "unknown", 9.0, 9.0, 9.0), ("x", "z", "Z", "be", "2020-21", None, None, None)])
    assert len(again) == len(fresh) + 1 and [r.total for r in again if r.id == first.id] == [9.0]
