"""Composite jobs on small fixtures and against folds in Python."""

import random
import re

import pytest
from ledgerspark.functions import slips
from ledgerspark.operators import jobs
from ledgerspark.operators.cascade import projected_and_allocated
from ledgerspark.plans import extensions
from pyspark.sql import functions as F


def numbers_of(spark, messages):
    df = spark.createDataFrame([(k, m) for k, m in enumerate(messages)], "k int, m string")
    rows = df.select("k", slips.slip_numbers(F.col("m")).alias("n"), slips.event_label(F.col("m")).alias("l")).orderBy("k").collect()
    return [(r.n, r.l) for r in rows]


def test_slip_messages(spark):
    got = numbers_of(spark, ["Correction Slip: Correction Slip Nos 1102 to 1105", "correction slips 655 662 389", "CS 730 734 420", "Corrigendum to Correction slip No. 1027", "Correction Slip: Transactory and Parking Heads 812", "Corrigendum No. 12", None, "", "Correction slips 100 to 900"])
    assert got[0] == ([1102, 1103, 1104, 1105], "Correction Slip Nos. 1102-1105")
    assert got[1] == (list(range(655, 663)), "Correction Slip Nos. 655-662")
    assert got[2] == ([730, 734], "Correction Slip Nos. 730, 734")
    assert got[3] == ([1027], "Corrigendum to Correction Slip No. 1027")
    assert got[4:8] == [([], "Transactory and Parking Heads"), ([], "Corrigendum No. 12"), ([], ""), ([], "")]
    assert got[8] == ([100, 900], "Correction Slip Nos. 100, 900")


def test_changes_are_normalised(spark):
    rows = [("insert", "4202", "04", "105", "x"), ("INSERT", "2205", "–", "105", "x"), ("Rename", "2205", None, "12", "x"), ("DELETE", "75", None, None, None), ("MOVE", "1", None, None, ""), ("INSERT", None, "1", None, ""), ("INSERT", "20221", None, None, "")]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, a string, m string, s string, n string, l string")
    got = [r.c for r in df.select("k", slips.normal_change(*map(F.col, "amsnl")).alias("c")).orderBy("k").collect()]
    assert [(c.code, c.parent_code, c.is_receipt, c.is_expenditure) for c in got[:4]] == [("4202-04-105", "4202-04", 0, 1), ("2205-00-105", "2205", 1, 1), ("2205-12", "2205", 1, 1), ("0075", None, 1, 0)]
    assert [c.error for c in got] == [None, None, None, None, "action", "major", "width"]


SCHEME = re.compile("(?i)anganwadi|\\bicds\\b")


def amounts(line, least):
    plain = re.sub(r"[\d,]+\.?\d*\s*%", "", line)
    found = [round(float(re.sub("[^0-9.]", "", m)), 2) for m in re.findall(r"[\d,]+\.\d{2}", plain) if re.search("[0-9]", m)]
    return [x for x in found if x >= least]


def fold(pages):
    """The cascade as a program would run it, page by page and line by line."""
    for page in pages:
        if re.search(r"(?i)projections?\s+to\s+(mof|ministry\s+of\s+finance)", "\n".join(page)):
            for k, line in enumerate(page):
                a = amounts(" ".join(page[k : k + 2]), 100)
                if SCHEME.search(line) and (len(a) >= 4 and a[-2] > a[-1] or len(a) == 2 and a[0] > a[1]):
                    return a[-2], a[-1], "high"
    for page in pages:
        whole = "\n".join(page)
        if re.search(r"(?i)projected\s+(demand|be\b)", whole) and re.search(r"(?i)actual\s+allocation|allocated\s+be\b", whole):
            for k, line in enumerate(page):
                big = [float(x) for x in re.findall(r"\b\d{3,}(?:\.\d{1,2})?\b", re.sub(r"[\d,]+\.?\d*\s*%", "", line))]
                for a in (amounts(line, 100), [x for x in big if x >= 100], amounts(" ".join(page[k : k + 2]), 100)):
                    if SCHEME.search(line) and len(a) >= 2:
                        return a[0], a[1], "medium"
    lines = [line for page in pages for line in page]
    for k, line in enumerate(lines):
        for a in (amounts(line, 500), amounts(" ".join(lines[k : k + 3]), 500)):
            if SCHEME.search(line) and len(a) >= 2:
                return (*sorted(a, reverse=True)[:2], "low")
    return None, None, "none"


def test_cascade_against_a_fold(spark):
    rng = random.Random(3)
    heads = ["Projections to", "MoF", "Ministry of Finance", "Projected Demand", "Actual Allocation", "Projected BE", "Allocated BE", "text", ""]
    number = lambda: rng.choice(["12.5%", "99.99", f"{rng.randrange(100, 9999)}.{rng.randrange(10, 99)}", f"{rng.randrange(100, 999)}", "1,234.50"])
    line = lambda: rng.choice([rng.choice(heads), " ".join([rng.choice(["Anganwadi Services", "Umbrella ICDS", "Others", "icdsx"]), *[number() for _ in range(rng.randrange(5))]])])
    docs = {d: [[line() for _ in range(rng.randrange(1, 7))] for _ in range(rng.randrange(1, 4))] for d in range(300)}
    docs[300] = [["", " "]]
    rows = [(d, p, k, x) for d, pages in docs.items() for p, page in enumerate(pages) for k, x in enumerate(page)]
    got = {r.doc_id: r for r in projected_and_allocated(spark.createDataFrame(rows, "doc_id int, page_no int, line_no int, line string")).collect()}
    assert {d: (r.projected, r.allocated, r.confidence) for d, r in got.items()} == {d: fold(pages) for d, pages in docs.items()}
    assert {r.confidence for r in got.values()} == {"high", "medium", "low", "none"}
    assert got[300].note == "no text extracted (possibly scanned)"


def test_balance(spark):
    row = {"own_tax": 28178, "own_nontax": 5903, "devolution": 35331, "grants": 22123, "recovery": 3282, "rev_exp": 94163, "rev_dev_social": 43509, "rev_dev_econ": 12200, "cap_outlay": 21444, "cap_social": 4611, "cap_econ": 13783}
    made = jobs.from_aggregates(spark.createDataFrame([("as", *row.values())], f"state string, {', '.join(f'{k} int' for k in row)}"), ["state"])
    one = made.first()
    assert (one.social, one.economic, one.general) == (48120, 25983, 41504)
    edges = jobs.balance_flow(made, ["state"], strict=True).collect()
    assert len(edges) == 9 and all(e.accepted for e in edges)
    wrong = made.withColumn("social", F.col("social") + 10)
    assert not any(e.accepted for e in jobs.balance_flow(wrong, ["state"]).collect())
    with pytest.raises(Exception, match="sources and uses differ"):
        jobs.balance_flow(wrong, ["state"], strict=True).collect()


def test_head_tables(spark):
    cells = [["4202", "Capital Outlay"], ["", "02 Technical Education"], ["", "105", "Schools"], ["2205", "", "Art (1)"], ["", "105", "Libraries (2)"], ["02-Social Welfare (3)"], ["02", "101", "Handicapped (2)"], ["", ""]]
    df = spark.createDataFrame([(1, k, c) for k, c in enumerate(cells)], "table_id int, row_no int, cells array<string>")
    tree = {r.code: (r.parent_code, r.label) for r in jobs.head_tree(df).collect()}
    assert tree["4202-02-105"] == ("4202-02", "Schools") and tree["2205-00-105"] == ("2205", "Libraries (2)") and tree["2205-02-101"] == ("2205-02", "Handicapped (2)")
    notes = spark.createDataFrame([(1, 0, "Notes:"), (1, 1, "(1) all"), (1, 2, "(2) some"), (1, 3, "more"), (1, 4, "(4) none")], "table_id int, pos int, text string")
    got = sorted(tuple(r) for r in jobs.scope_notes(df, notes).collect())
    assert got == [("2205", "1", "all"), ("2205-00-105", "2", "some more"), ("2205-02-101", "2", "some more")]


def test_health_accounts_and_wages(spark):
    with pytest.raises(ValueError, match="ghe_pct_thee?"):
        jobs.health_accounts(spark.createDataFrame([("x",)], "Year string"))
    lines = spark.createDataFrame([(1, 0, "Unskilled 400 10400"), (1, 1, "x 400 9000"), (1, 2, "y 400 9000"), (1, 3, "z 400 3000"), (2, 0, "Skilled 500")], "doc_id int, line_no int, line string")
    told = spark.createDataFrame([(1, "Hotels - 2020 Final"), (2, "Mills 2019 excluded")], "doc_id int, title string")
    got = sorted(tuple(r) for r in jobs.wage_rows(lines, told).collect())
    assert got == [(1, 0, "Hotels", "unskilled", 400.0, 10400.0), (1, 1, "Hotels", "unspecified", 400.0, 9000.0)]


def test_extension_registries(spark):
    extensions.add_adapter("New Delhi", "sector", lambda s, state, fy: s.createDataFrame([(state, fy)], "state string, fy string"))
    assert tuple(extensions.flow_of(spark, "new_delhi", "2024-25", "sector").first()) == ("new_delhi", "2024-25")
    with pytest.raises(KeyError):
        extensions.flow_of(spark, "goa", "2024-25", "sector")
    extensions.WAGE_SOURCES[extensions.ANY] = lambda s, state: s.createDataFrame([(state,)], "state string")
    assert extensions.wages_of(spark, "Goa").first().state == "Goa"
    df = extensions.text_signals(spark.createDataFrame([("a freeze and a cut, an incentive",)], "t string"), "t").first()
    assert (df.austerity_score, df.extravagance_score) == (2, 1)
