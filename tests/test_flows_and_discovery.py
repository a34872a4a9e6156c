"""Flows, discovered documents, head history and classes against small cases worked out by hand or in Python."""

from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from ledgerspark.operators import flows, jobs
from ledgerspark.operators import relational as rel
from ledgerspark.operators import windows as win
from ledgerspark.sources import discovery, readers


def test_flow_nodes_links_and_figures(spark):
    lines = [("A", "2049", 10.0), ("A", "2210", 5.0), ("A", "2202", 5.0), ("A", "2202", 2.04), ("A", "2215", 0.0), ("A", "6003", 4.0), ("A", "2801", 3.0), ("A", "2801", -3.0), ("B", "2210", 1.0)]
    levels = flows.flow_levels(spark.createDataFrame(lines, "state string, major string, amount double"), ["state"])
    nodes = flows.flow_nodes(levels, ["state"])
    got = sorted((r.node, r.kind, r.name, round(r.amount, 2)) for r in nodes.where("state = 'A'").collect())
    # the economic sector sums to zero, so it has no node
    assert got == [
        (0, "pool", flows.POOL, 26.04), (1, "sector", "social", 12.04), (2, "sub_sector", "Education, sports, art & culture", 7.04), (3, "sub_sector", "Health & family welfare", 5.0),
        (4, "sector", "general", 10.0), (5, "sub_sector", "Interest payments", 10.0), (6, "sector", "debt", 4.0), (7, "sub_sector", "Public debt repayment", 4.0),
    ]
    links = sorted((r.source, r.target, r.value) for r in flows.flow_links(nodes, ["state"]).where("state = 'A'").collect())
    assert links == [(0, 1, 12.0), (0, 4, 10.0), (0, 6, 4.0), (1, 2, 7.0), (1, 3, 5.0), (4, 5, 10.0), (6, 7, 4.0)]
    figures = {r.state: r.asDict() for r in flows.flow_figures(levels, ["state"]).collect()}
    assert figures["A"] == {"state": "A", "total": 26.0, "interest": 10.0, "repayment": 4.0, "health": 5.0, "water": 0.0}
    assert figures["B"] == {"state": "B", "total": 1.0, "interest": 0.0, "repayment": 0.0, "health": 1.0, "water": 0.0}


PAGE = "http://fin.example/budget/list.aspx?year=1#top"
HREFS = ["a.pdf", "/x/a.pdf", "../a.pdf", "../../../a.pdf", "./b/./c.PDF?q=/../#f", "//cdn.example/a.pdf", "https://other.example/a.pdf", "?d=a.pdf", "#a.pdf", "", "b/..", "b/.", "/"]


@pytest.mark.parametrize("page", [PAGE, "https://h.example", "https://h.example/", "http://h.example/a/b/"])
def test_addresses(spark, page):
    rows = spark.createDataFrame([(k, page, h) for k, h in enumerate(HREFS)], "k int, page string, href string")
    got = {HREFS[r.k]: r.url for r in rows.select("k", discovery.resolved(F.col("page"), F.col("href")).alias("url")).collect()}
    assert got == {h: urljoin(page, h) if h else page.split("#")[0] for h in HREFS}


def test_sections_titles_and_years(spark):
    html = """<a href="early_2025-26.pdf">Early</a><h2 class="x">Demands <b>for</b>&nbsp;Grants</h2><p><a class="c" href='d/One 2025_26.PDF'> Demand&amp;One </a>
      <A HREF="two.xlsx"><img src="x"></A><a href="/2025-2026/three.xls"></a><h3> </h3><a href="page.html">2025-26</a><h1>Older</h1><a href="2024-25/four.pdf">Four: "2024-25"</a><a name="2025-26.pdf">no target</a></h1>"""
    pages = spark.createDataFrame([(1, PAGE, html), (2, PAGE, None), (3, PAGE, "")], "page_id long, url string, html string")
    links = sorted((r.pos, r.section, r.title, r.url) for r in discovery.document_links(pages).collect())
    base = "http://fin.example/budget/"
    assert [x[1:] for x in sorted(links, key=lambda x: x[0])] == [
        (None, "Early", f"{base}early_2025-26.pdf"), ("Demands for Grants", "Demand&One", f"{base}d/One 2025_26.PDF"), ("Demands for Grants", "two", f"{base}two.xlsx"),
        ("Demands for Grants", "three", "http://fin.example/2025-2026/three.xls"), ("Older", 'Four: "2024-25"', f"{base}2024-25/four.pdf"),
    ]
    found = {r.document_type: r for r in discovery.discovered(pages, "Old State", "2025-26").collect()}
    assert set(found) == {"Early", "Demand&One", "three"}
    assert (found["Demand&One"].doc_id, found["Demand&One"].local_path) == ("old_state_2025_26_demands_for_grants_demand_one", "Old State/2025-26/Demands for Grants/Demand&One.pdf")
    assert (found["Early"].section, found["three"].file_extension) == ("Budget Documents", "xls")
    assert {r.document_type for r in discovery.discovered(pages, "Old State", "2025-26", in_path=True).collect()} == {"three"}
    again = discovery.discovered(pages, "Old State", "2025-26").withColumn("page_id", F.lit(9).cast("long"))
    kept = discovery.registered(discovery.discovered(pages, "Old State", "2025-26"), again).collect()
    assert len(kept) == 3 and {r.page_id for r in kept} == {9}


def test_history_of_minor_heads(spark):
    heads = spark.createDataFrame([("2202",), ("2202-01",), ("2202-01-105",), ("2202-02-105",), ("2210-01-105",)], "code string")
    events = spark.createDataFrame([("2202-105", "RENAME", 1), ("2202", "UPDATE", 2), ("2202-106", "INSERT", 3)], "code string, action string, event_id long")
    exact = {(r.code, r.event_id) for r in jobs.head_history(heads, events).where("exact").collect()}
    assert exact == {("2202-01-105", 1), ("2202-02-105", 1)}
    assert jobs.head_history(heads, events).count() == 12
    counts = {r.code: (r.n_changes, r.n_exact) for r in jobs.history_counts(heads, events).collect()}
    assert counts == {"2202": (3, 0), "2202-01": (3, 0), "2202-01-105": (3, 1), "2202-02-105": (3, 1), "2210-01-105": (0, 0)}


def test_classes_hold_the_links_of_siblings(spark):
    codes = [("2202", "Sport"), ("4202", "SPORT"), ("2203", "sport"), ("6202", "Sport"), ("2204", "Alone"), ("2205", "Twin"), ("2206", "Twin")]
    heads = spark.createDataFrame(codes, "code string, label string")
    classes, members = rel.label_classes(heads)
    pairs = {tuple(r) for r in rel.siblings(heads).collect()}
    assert [tuple(r) for r in classes.collect()] == [("sport", 4, len(pairs))]
    assert {r.code for r in members.collect()} == {a for a, _ in pairs}
    asked = spark.createDataFrame([("4202",), ("4202",), ("none",)], "code string")
    assert {tuple(r) for r in rel.siblings_of(heads, asked).collect()} == {p for p in pairs if p[0] == "4202"}


def test_runs_of_a_hot_key(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    rows = [("hot" if k % 2 else f"k{k % 10}", k, f"w{k}", k % 14 in (3, 4)) for k in range(400)]
    got = win.continued(spark.createDataFrame(rows, "key string, pos long, text string, s boolean"), ["key"], "pos", F.col("s"), "text").collect()
    for k, v in before.items():
        spark.conf.set(k, v)
    want = []
    for key in {r[0] for r in rows}:
        runs = []
        for _, _, text, start in (r for r in rows if r[0] == key):
            if start:
                runs.append([text])
            elif runs:
                runs[-1].append(text)
        want += [(key, k + 1, " ".join(run)) for k, run in enumerate(runs)]
    assert sorted((r.key, r.run, r.text) for r in got) == sorted(want)


def test_n_triples_escape_what_literals_must_not_hold(spark):
    rows = [("2202-01", "label", 'A "quoted"\\ line\nand\ttab\r'), ("2202-01", "up", "2202"), ("a b", "label", "é")]
    terms = {"label": "http://x/label", "up": "http://x/up"}
    lines = {r.value for r in readers.n_triples(spark.createDataFrame(rows, "s string, p string, o string"), "http://h/", terms, ["up"]).collect()}
    assert lines == {'<http://h/2202-01> <http://x/label> "A \\"quoted\\"\\\\ line\\nand\\ttab\\r" .', "<http://h/2202-01> <http://x/up> <http://h/2202> .", '<http://h/a_b> <http://x/label> "é" .'}
