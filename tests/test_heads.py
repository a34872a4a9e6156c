"""Details of a head, the browser's payload and checked charts against cases worked out by hand."""

import json

import pytest
from pyspark.sql import functions as F

from ledgerspark.operators import heads as hd

HEAD = "code string, parent_code string, kind string, label string"
CHART = [
    ("2202", None, "major", "Education"), ("2202-01", "2202", "submajor", "Elementary"), ("2202-01-105", "2202-01", "minor", "Training"), ("2202-01-106", "2202-01", "minor", "Books"),
    ("4202", None, "major", "EDUCATION"), ("4202-00-001", "4202", "minor", "Training"), ("2203-02-001", "2203-02", "minor", "Lost"),
]


def details(spark, asked):
    chart = spark.createDataFrame(CHART, HEAD)
    notes = spark.createDataFrame([("2202-01-105", "1", "n1"), ("2202-01-105", "2", None), ("9999", "1", "x")], "code string, note_number string, note string")
    events = spark.createDataFrame([("2202-105", "RENAME", 1), ("2202", "UPDATE", 2), ("4202-105", "DELETE", 3), (None, "DELETE", 4)], "code string, action string, event_id int")
    booked = spark.createDataFrame([("2202-01-105", "2024-25", 5.0), ("2202-01-106", "2024-25", 6.0)], "code string, fy string, amount double")
    found = hd.head_details(chart, notes, events, booked, spark.createDataFrame([(a,) for a in asked], "code string"))
    return sorted(((r.code, r.section, r.item, r.text, r.amount, r.exact) for r in found.collect()), key=str)


def test_details_of_a_minor_head(spark):
    code = "2202-01-105"
    # asked twice, with a null and an unknown code beside it
    assert details(spark, [code, code, None, "0000"]) == sorted([
        (code, "head", "minor", "Training", None, None), (code, "class", "2", None, None, None), (code, "path", "2202-01", "Elementary", None, None), (code, "path", "2202", "Education", None, None),
        (code, "note", "1", "n1", None, None), (code, "note", "2", None, None, None), (code, "sibling", "4202-00-001", "Training", None, None),
        (code, "change", "1", "RENAME 2202-105", None, True), (code, "change", "2", "UPDATE 2202", None, False), (code, "booked", "2024-25", None, 5.0, None),
    ], key=str)


def test_details_of_other_heads(spark):
    got = details(spark, ["2202", "2203-02-001"])
    assert [x[2] for x in got if x[:2] == ("2202", "child")] == ["2202-01"]
    assert [x[2] for x in got if x[:2] == ("2202", "sibling")] == ["4202"]
    assert [x[5] for x in got if x[:2] == ("2202", "change")] == [False, False]
    # its parent is no head, so the path is empty
    assert {x[1] for x in got if x[0] == "2203-02-001"} == {"head", "class"}
    assert details(spark, []) == []


def test_payload(spark):
    chart = spark.createDataFrame([*CHART[:3], ("2203", None, "major", None)], HEAD)
    notes = spark.createDataFrame([("2202", "1", 'say "x"')], "code string, note_number string, note string")
    schema = "slip string, date date, event_id int, action string, code string, kind string, label string, old_label string"
    rows = [("s1", None, 1, "RENAME", "2202-105", "minor", "B", "A"), ("s1", None, 2, "DELETE", "2101", "major", None, None), ("s1", None, 3, "DELETE", "2202", "major", None, None), ("s2", None, 4, None, None, None, None, None)]
    changes = spark.createDataFrame(rows, schema)
    got = [(r.part, r.id, json.loads(r.payload)) for r in hd.browser_payload(chart, notes, changes).collect()]
    parts = lambda name: {i: p for part, i, p in got if part == name}
    assert parts("node")["2202-01-105"] == {"c": "2202-01-105", "p": "2202-01", "t": "minor", "d": "Training", "k": 2, "mh": "2202", "sm": "01", "mn": "105"}
    assert parts("node")["2203"] == {"c": "2203", "p": None, "t": "major", "d": None, "k": 2, "mh": "2203", "sm": None, "mn": None}
    assert parts("note") == {"2202": {"num": "1", "text": 'say "x"'}}
    assert parts("event") == {"s1": {"date": None, "slip": "s1", "majors": ["2101", "2202"], "n_changes": 3}, "s2": {"date": None, "slip": "s2", "majors": [], "n_changes": 1}}
    assert parts("change")["1"] == {"slip": "s1", "action": "RENAME", "code": "2202-105", "mh": "2202", "type": "minor", "label": "B", "old_label": "A"}
    assert parts("change")["4"]["code"] == "" and parts("change")["4"]["mh"] is None
    assert parts("meta")[None] == {"total": 4, "major": 2, "sub_major": 1, "minor": 1, "notes": 1, "events": 2}
    none = hd.browser_payload(chart.limit(0), notes.limit(0), changes.limit(0)).collect()
    assert [(r.part, json.loads(r.payload)["total"]) for r in none] == [("meta", 0)]


ERRORS = [
    ("1", None, "major", "A"), ("1", None, "major", "A"), ("2", None, "major", "B"), ("2", None, "major", "b"), ("2-1", "2", "submajor", "C"), ("3-1", "3", "submajor", "D"),
    ("4", None, None, "E"), (None, None, "major", "F"), ("5", None, "major", " "), ("5", None, "major", "G"), ("6", "", "major", "H"), ("7", None, "major", "I"), ("7", "1", "major", "I"),
]


def test_checked_heads(spark):
    kept, rejects = hd.checked_heads(spark.createDataFrame(ERRORS, HEAD))
    assert sorted(r.code for r in kept.collect()) == ["1", "2-1", "5", "6"]
    assert sorted(((r.code, r.reason) for r in rejects.collect()), key=str) == sorted([
        ("2", "conflict"), ("7", "conflict"), ("3-1", "missing parent"), ("4", "incomplete"), ("5", "incomplete"), (None, "incomplete"),
    ], key=str)
    strict = spark.createDataFrame(ERRORS, HEAD)
    with pytest.raises(Exception, match="head .*: (conflict|missing parent|incomplete)"):
        hd.checked_heads(strict, strict=True)[0].collect()
    fine = strict.where(F.col("code").isin("1", "6"))
    assert hd.checked_heads(fine, strict=True)[0].count() == 2
    assert hd.checked_heads(fine.limit(0))[0].count() == 0
