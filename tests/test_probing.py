"""Probes of documents: sheets, missing ones, scripts, scans, tables and upserts."""

from ledgerspark.operators import probing


def test_probes(spark):
    docs = spark.createDataFrame([(1, "a.pdf", "pdf"), (2, "b.xlsx", "xlsx"), (3, "/gone/" + "c" * 400, "pdf"), (4, "d.pdf", None), (5, "e.pdf", "pdf"), (6, "f.pdf", "pdf"), (7, None, "pdf")], "doc_id long, path string, ext string")
    long = "Cut the Gift. " * 50
    pages = [(1, 2, "CUT again", 9), (1, 1, long, 2), *[(1, k, "cut", 0) for k in range(3, 9)], (2, 1, "cut", 5), (4, 1, None, 0), (5, 1, "योजना cut", 3), (6, 1, long, None)]
    found = {r.doc_id: r for r in probing.probe_documents(docs, spark.createDataFrame(pages, "doc_id long, page_no int, text string, tables int"), {"cuts": ["cut"], "gifts": ["gift", "bonus"]}).collect()}
    one = found[1]
    assert (one.n_pages, one.n_chars, one.sample, one.tables, one.route, one.cuts, one.gifts, one.error) == (8, 700 + 9 + 9, long[:500], 2, "table_pdf", 54, 50, None)
    assert (found[2].route, found[2].n_chars, found[2].cuts, found[2].error) == ("xls", None, 0, None)
    assert (found[3].route, len(found[3].error), found[3].cuts) == ("unknown", 300, 0) and found[3].error.startswith("File not found: /gone/ccc")
    assert (found[4].route, found[4].n_chars) == ("scanned_pdf", 0)
    assert (found[5].route, found[5].has_script, found[5].cuts) == ("devanagari_pdf", True, 1)
    assert (found[6].route, found[6].has_script) == ("text_pdf", False)
    assert found[7].error == "File not found: "


def test_upsert_keeps_the_reading_that_saw_most(spark):
    schema = "doc_id long, n_chars long, sample string, error string"
    before = spark.createDataFrame([(1, 5, "old", None), (2, 7, "kept", None)], schema)
    new = spark.createDataFrame([(1, None, None, "timeout"), (1, 3, "new", None), (3, 1, "x", None)], schema)
    assert sorted(tuple(r) for r in probing.probed(before, new).collect()) == [(1, 3, "new", None), (2, 7, "kept", None), (3, 1, "x", None)]
