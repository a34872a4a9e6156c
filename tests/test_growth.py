"""Snapshots whose buckets split, grids read in splits, amounts of several sources."""

import glob
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from ledgerspark.operators import crosscheck
from ledgerspark.operators import relational as rel
from ledgerspark.sources import readers
from ledgerspark.streaming.incremental import Snapshots


def test_buckets_split_and_a_small_batch_rewrites_an_ever_smaller_share(spark):
    folder = tempfile.mkdtemp(prefix="spark-grow-", dir="/tmp")
    table = Snapshots(spark, folder, capacity=40, keep=2)

    def merge(before, batch):
        return batch if before is None else rel.upsert(before, batch, ["id"], ["v"])

    want, shares = {}, []
    for number, (ids, v) in enumerate([(range(100), 0), ([5, 7], 1), (range(50, 700), 2), ([5, 699], 3), (range(600, 2000), 4), ([5, 1999], 5)]):
        table.apply(number, spark.createDataFrame([(i, v) for i in ids], "id long, v long"), "id", merge)
        want |= dict.fromkeys(ids, v)
        got = table.read(table.buckets(number)).drop("bucket").collect()
        assert {r.id: r.v for r in got} == want and len(got) == len(want)
        directory = table.directory(number)
        assert sum(n for _, n in directory.values()) == len(want)
        assert sum(2.0**-d for d, _ in directory) == 1  # every hash has one bucket
        if len(ids) == 2:
            shares.append(sum(n for batch, n in directory.values() if batch == number) / len(want))
    assert shares == sorted(shares, reverse=True) and shares[-1] < 0.08
    # the last two versions are there, and no data but theirs
    assert sorted(os.path.basename(p) for p in glob.glob(f"{folder}/version-*")) == ["version-000000004", "version-000000005"]
    used = {table.data(b, batch) for number in (4, 5) for b, batch in table.buckets(number).items()}
    assert set(glob.glob(f"{folder}/data-*/bucket=*")) <= used
    assert table.read(table.buckets(4)).count() == len(want)


def test_a_batch_that_is_run_again_replaces_its_own_files(spark):
    folder = tempfile.mkdtemp(prefix="spark-grow-", dir="/tmp")
    table = Snapshots(spark, folder, capacity=10)
    rows = lambda ids: spark.createDataFrame([(i,) for i in ids], "id long")
    keep = lambda before, batch: batch if before is None else before.drop("bucket").unionByName(batch).distinct()
    table.apply(0, rows(range(30)), "id", keep)
    for _ in range(2):
        table.apply(1, rows(range(25, 60)), "id", keep)
        assert sorted(r.id for r in table.read(table.buckets(1)).collect()) == list(range(60))
    table.apply(2, rows([]), "id", keep)
    assert table.read(table.buckets(2)).count() == 60


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0b")
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_grids_are_numbered_over_splits(spark, small_splits, tmp_path):
    want = {}
    for name, n in (("a", 900), ("b", 3), ("c", 400)):
        rows = [[f"{name}{k}", f"x, {k}", 'say "hi"', "", "é"] for k in range(n)]
        (tmp_path / f"{name}.csv").write_text("".join(f'{r[0]},"{r[1]}", "say ""hi""" ,,{r[4]}\r\n' for r in rows))
        want |= {(name, k): [c or None for c in r] for k, r in enumerate(rows)}
    grid = readers.read_grid(spark, str(tmp_path))
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 5
    assert {(r.doc_id.rsplit("/", 1)[-1][:1], r.row_no): r.cells for r in grid.collect()} == want
    assert readers.read_grid(spark, str(tmp_path), 899).count() == 1


def test_cells_of_odd_lines(spark):
    lines = {"": [None], ",": [None, None], '"a,b",c': ["a,b", "c"], '""': [None], ' "x" , y ': ["x", "y"], 'a"b,c': ['a"b', "c"], '"open,c': ['"open', "c"]}
    rows = spark.createDataFrame([(x,) for x in lines], "line string")
    assert {r.line: r.cells for r in rows.select("line", readers.cells_of(F.col("line")).alias("cells")).collect()} == lines


def test_sources_that_agree_and_differ(spark):
    draw = random.Random(4)
    of = lambda n: [("S" if draw.random() < 0.8 else "T", f"h{k}", draw.randrange(-300, 900) / 4) for k in range(n)]
    a, b = of(120), of(150)
    frame = lambda rows: spark.createDataFrame(rows, "state string, head string, amount double")
    got = {(r.state, r.head, r.other_head, r.gap) for r in crosscheck.agreeing(frame(a), frame(b), ["state"], 2.5).collect()}
    want = {(s, h, o, abs(x - y)) for s, h, x in a for t, o, y in b if s == t and abs(x - y) <= 2.5}
    assert got == want and any(g == 2.5 for *_, g in want)
    alone = {r.head for r in crosscheck.unmatched(frame(a), frame(b), ["state"], 2.5).collect()}
    assert alone == {h for _, h, _ in a} - {h for _, h, _, _ in want}
    rows = [("k", "rbi", 10.0), ("k", "state", 4.0), ("k", "state", 5.0), ("k", "cag", None), ("m", "rbi", 3.0), ("m", "state", 3.5)]
    found = crosscheck.discrepancies(spark.createDataFrame(rows, "head string, source string, amount double"), ["head"], 0.5)
    assert [tuple(r) for r in found.collect()] == [("k", 2, "state", "rbi", 1.0)]
