"""Every registered fiscal query against its SQL, and operators on small fixtures."""

import datetime
import decimal
import glob
import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerspark.functions import fiscal, values
from ledgerspark.operators import relational as rel
from ledgerspark.operators import windows as win
from ledgerspark.plans.registry import FOUND
from ledgerspark.sources import readers
from ledgerspark.streaming.incremental import run_incremental

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def plain(v):
    if isinstance(v, (int, float, decimal.Decimal)) and not isinstance(v, bool):
        return round(float(v), 6)
    return v if not isinstance(v, datetime.datetime) else v.replace(tzinfo=None)


@pytest.mark.parametrize("name", sorted(FOUND))
def test_query_matches_its_sql(spark, duck, name):
    run, sql = FOUND[name]
    df = run(spark, SF)
    columns = sorted(df.columns)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if sql:
        found = duck.sql(sql)
        assert sorted(found.columns) == columns
        at = [found.columns.index(c) for c in columns]
        assert rows == sorted((tuple(plain(r[k]) for k in at) for r in found.fetchall()), key=repr)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_fiscal_years_and_codes(spark):
    assert one(spark, fiscal.earlier_fy(F.lit("2026-27")), fiscal.earlier_fy(F.lit("2000-01")), fiscal.full_fy(F.lit("1999-00"))) == ("2025-26", "1999-00", "1999-1900")
    assert one(spark, fiscal.fy_from_title(F.lit("Report 2024–2025")), fiscal.fy_from_title(F.lit("none"))) == ("2024-25", None)
    assert one(spark, fiscal.head_code(F.lit("2205"), F.lit(None), F.lit("105")), fiscal.head_code(F.lit(""), F.lit("1"), F.lit("105")), fiscal.parent_code(F.lit("2205"), F.lit("00"))) == ("2205-00-105", None, "2205")


def test_classification(spark):
    got = {h: one(spark, *fiscal.classify(F.lit(h))) for h in ("2202", "4202", "2210", "2401", "2048", "6003", "6076", "7999", "3601", "0005")}
    assert [got[h][0] for h in got] == ["social", "social", "social", "economic", "general", "debt", "debt", "debt", "grants", "economic"]
    assert (got["6003"][1], got["6076"][1], got["7999"][1]) == ("Public debt repayment", "Loans disbursed by the State", "Appropriation to Contingency Fund")


def test_routes_and_values(spark):
    r = lambda *a: one(spark, values.route(*map(F.lit, a)))[0]
    assert [r("pdf", 900, 0, False), r("pdf", 300, 3, False), r("pdf", 400, 1, True), r("pdf", 30, 0, False), r("xlsx", None, 0, False), r("pdf", None, 0, False)] == ["text_pdf", "table_pdf", "devanagari_pdf", "scanned_pdf", "xls", "unknown"]
    assert one(spark, values.clean_value(F.lit("-5.2"), legacy_dash=True), values.clean_value(F.lit("-5.2")), values.deflated(F.lit(2.5), F.lit(100.0))) == (5.2, -5.2, 2.0)
    assert one(spark, values.skill(F.lit("Highly skilled")), F.size(values.line_numbers(F.lit("7,410 and 12.50")))) == ("skilled", 3)


def test_head_rows_fill_forward(spark):
    rows = [(0, None, None, "001"), (1, "4202", None, None), (2, None, "02", "105"), (3, "2205", None, None), (4, None, None, "105"), (5, "2235", "02", "101")]
    df = spark.createDataFrame([("f", *r) for r in rows], "file string, row int, major string, sub string, minor string")
    got = win.fill_heads(df, ["file"], "row").where("minor is not null")
    assert [tuple(r) for r in got.orderBy("row").select("cur_major", "cur_sub", "minor").collect()] == [("4202", "02", "105"), ("2205", None, "105"), ("2235", "02", "101")]


def test_anchored_groups_are_no_sessions(spark):
    df = spark.createDataFrame([(1, float(y)) for y in (0, 2, 4, 5, 6, 9, 9.5)], "page int, y double")
    assert [(r.anchor, r.n) for r in win.anchored_groups(df, ["page"], "y", 3).orderBy("group_no").collect()] == [(0.0, 2), (4.0, 3), (9.0, 2)]


def test_replay_against_a_fold(spark):
    rng = random.Random(1)
    events = [(f"c{rng.randrange(25)}", rng.choice(["INSERT", "DELETE", "RENAME", "UPDATE"]), f"l{k}", k) for k in range(300)]
    df = spark.createDataFrame(events, "code string, action string, label string, at int")
    assert {r.code: r.label for r in win.replay(df, ["at"]).collect()} == fold(events)
    clash = {at for k, (code, action, _, at) in enumerate(events) if action == "INSERT" and code in fold(events[:k])}
    assert {r.at for r in win.rejected_inserts(df, ["code"], ["at"]).collect()} == clash


def fold(events):
    live = {}
    for code, action, label, _ in events:
        if action == "INSERT" and code not in live:
            live[code] = label
        elif action == "DELETE":
            live.pop(code, None)
        elif action == "RENAME" and code in live:
            live[code] = label
    return live


def test_sinks_can_be_run_again(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d"), (3, "e")], "id int, v string")
    up = rel.upsert(old, new, ["id"], ["v"])
    assert sorted(map(tuple, up.collect())) == [(1, "a"), (2, "c"), (3, "d")] == sorted(map(tuple, rel.upsert(up, new, ["id"], ["v"]).collect()))
    once = rel.insert_if_absent(old, new, ["id"], ["v"])
    assert sorted(map(tuple, once.collect())) == [(1, "a"), (2, "b"), (3, "d")] == sorted(map(tuple, rel.insert_if_absent(once, new, ["id"], ["v"]).collect()))
    assert rel.replace_slices(old, new.limit(0), "id").count() == 2


def test_readers(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"x": 1}, {"x": 2}]')
    (tmp_path / "b.json").write_text('{"rows": [{"x": 3}]}')
    assert sorted(r.x for r in readers.read_payload(spark, str(tmp_path / "*.json"), "rows", "struct<x:int>").collect()) == [1, 2, 3]
    (tmp_path / "m.map").write_text('{"k": {"v": 5}}')
    assert [tuple(r) for r in readers.read_map(spark, str(tmp_path / "m.map"), "struct<v:int>").collect()] == [("k", 5)]
    (tmp_path / "t.csv").write_text("a,b\n1,\n")
    assert [tuple(r) for r in readers.read_csv_table(spark, str(tmp_path / "t.csv"), ["a", "b"]).collect()] == [("1", None)]
    assert [r.cells for r in readers.read_grid(spark, str(tmp_path / "t.csv"), 1).collect()] == [["1", None]]
    page = spark.createDataFrame([(1, "http://h/x/p", '<table><tr><th>h</th></tr><tr><td colspan="2">4202</td><td><b>Edu</b></td></tr></table><a href="r.pdf">R</a><a href="/q.xls">Q</a>')], "page_id long, url string, html string")
    assert [r.cells for r in readers.table_rows(page).collect()] == [["4202", "", "Edu"]]
    assert [r.url for r in readers.links(page).orderBy("pos").collect()] == ["http://h/x/r.pdf", "http://h/q.xls"]


def test_incremental_equals_batch(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "out")
    merge = lambda before, batch: rel.first_per(batch, ["id"], ["v"]) if before is None else rel.insert_if_absent(before, batch, ["id"], ["v"])
    spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string").write.parquet(f"{source}", mode="append")
    assert run_incremental(spark, source, "id int, v string", folder, merge).count() == 2
    spark.createDataFrame([(2, "c"), (3, "d")], "id int, v string").write.parquet(f"{source}", mode="append")
    assert sorted(map(tuple, run_incremental(spark, source, "id int, v string", folder, merge).collect())) == [(1, "a"), (2, "b"), (3, "d")]
    assert run_incremental(spark, source, "id int, v string", folder, merge).count() == 3
