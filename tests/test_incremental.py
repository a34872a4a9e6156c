"""Incremental runs in several batches, readers of what isn't there, and anchored groups against a fold in Python."""

import datetime as dt
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from ledgerspark.operators import windows as win
from ledgerspark.plans.stream_queries import code_list, registry
from ledgerspark.sources import readers
from ledgerspark.streaming.incremental import Snapshots

DOCS = "doc_id long, source string, n_chars long"
EVENTS = "event_id long, user_id long, event_type string, ts timestamp"


def at(day):
    return dt.datetime(2024, 1, day)


def put(spark, folder, number, rows, schema):
    """One file, written an hour after the one before it."""
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/in-{number}")
    for name in os.listdir(f"{folder}/in-{number}"):
        if name.endswith(".parquet"):
            os.utime(f"{folder}/in-{number}/{name}", (1_700_000_000 + 3600 * number,) * 2)


def test_last_reading_wins_over_batches(spark):
    folder = tempfile.mkdtemp(prefix="spark-inc-", dir="/tmp")
    schema = spark.createDataFrame([], DOCS).schema
    run = lambda: {r.doc_id: r.state for r in registry(spark, f"{folder}/in-*", schema, f"{folder}/out").collect()}
    put(spark, folder, 1, [(1, "z", 1), (2, "a", 1)], DOCS)
    put(spark, folder, 2, [(1, "m", 1)], DOCS)
    assert run() == {1: "m", 2: "a"}
    put(spark, folder, 3, [(1, "y", 1), (3, "b", 1)], DOCS)
    assert run() == {1: "y", 2: "a", 3: "b"}
    # the third file touched two buckets at most; the others are where the first run left them
    table = Snapshots(spark, f"{folder}/out")
    last = table.latest()
    assert last == 1 and sum(n == last for n in table.buckets(last).values()) <= 2
    assert run() == {1: "y", 2: "a", 3: "b"}


def test_a_missing_version_fails(spark):
    folder = tempfile.mkdtemp(prefix="spark-inc-", dir="/tmp")
    schema = spark.createDataFrame([], DOCS).schema
    put(spark, folder, 1, [(1, "z", 1)], DOCS)
    registry(spark, f"{folder}/in-*", schema, f"{folder}/out").count()
    os.rename(f"{folder}/out/version-000000000", f"{folder}/out/lost")
    put(spark, folder, 2, [(2, "z", 1)], DOCS)
    with pytest.raises(Exception, match="missing"):
        registry(spark, f"{folder}/in-*", schema, f"{folder}/out").count()


def test_no_files_give_no_rows(spark):
    folder = tempfile.mkdtemp(prefix="spark-inc-", dir="/tmp")
    os.mkdir(f"{folder}/in-1")
    schema = spark.createDataFrame([], DOCS).schema
    assert registry(spark, f"{folder}/in-*", schema, f"{folder}/out").count() == 0
    assert readers.read_payload(spark, f"{folder}/none.json", "rows", "struct<a: int>").count() == 0


def test_code_list_over_batches(spark):
    folder = tempfile.mkdtemp(prefix="spark-inc-", dir="/tmp")
    schema = spark.createDataFrame([], EVENTS).schema
    run = lambda: {r.code: r.label for r in code_list(spark, f"{folder}/in-*", schema, f"{folder}/out").collect()}
    put(spark, folder, 1, [(1, 1, "signup", at(1)), (2, 2, "signup", at(1)), (3, 3, "signup", at(1))], EVENTS)
    assert run() == {"0001": "L1", "0002": "L2", "0003": "L3"}
    put(spark, folder, 2, [(4, 1, "click", at(3)), (5, 2, "error", at(2))], EVENTS)
    assert run() == {"0001": "L4", "0003": "L3"}
    # an event that comes late, between two that are there
    put(spark, folder, 3, [(6, 1, "error", at(2)), (7, 2, "signup", at(4))], EVENTS)
    assert run() == {"0002": "L7", "0003": "L3"}


def test_anchored_groups_against_a_fold(spark):
    rng = random.Random(1)
    rows = [(k % 3, round(rng.uniform(0, 60), 1)) for k in range(300)] + [(4, None), (5, 2.0), (5, 2.0), (5, 5.0)]
    want = []
    for key in {k for k, _ in rows}:
        groups = []
        for y in sorted(y for k, y in rows if k == key and y is not None):
            if groups and abs(y - groups[-1][0]) < 3:
                groups[-1][1] += 1
            else:
                groups.append([y, 1])
        want += [(key, n, a, c) for n, (a, c) in enumerate(groups)]
    got = win.anchored_groups(spark.createDataFrame(rows, "k long, y double"), ["k"], "y", 3.0)
    assert sorted(map(tuple, got.select("k", "group_no", "anchor", "n").collect())) == sorted(want)


def test_csv_and_manifest_files(spark):
    folder = tempfile.mkdtemp(prefix="spark-inc-", dir="/tmp")
    rows = spark.createDataFrame([(1, "a,b"), (2, None)], "id long, name string")
    readers.write_csv(rows, f"{folder}/csv", ["id", "name"])
    assert sorted(map(tuple, readers.read_csv_table(spark, f"{folder}/csv", ["id", "name"]).collect())) == [("1", "a,b"), ("2", None)]
    for status in ("failed", "downloaded"):
        readers.write_manifest(rows, f"{folder}/m", F.lit(status))
    assert sorted(map(tuple, readers.read_manifest(spark, f"{folder}/m", "id long, status string").collect())) == [(1, "downloaded"), (1, "failed"), (2, "downloaded"), (2, "failed")]
