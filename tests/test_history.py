"""A code list's past against a replay in Python, with a code that holds half of the events, over many parts."""

from datetime import datetime, timedelta
from random import Random

import pytest
from pyspark.sql import functions as F

from ledgerspark.operators import history
from ledgerspark.operators.ordered import carried, ordered
from ledgerspark.operators.ranking import numbered, ranked

START = datetime(2024, 1, 1)
ORDER = ["ts", "event_id"]


@pytest.fixture(autouse=True)
def many_parts(spark):
    names = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "9"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def drawn(seed, n=600):
    draw = Random(seed)
    codes = ["2202"] * 6 + ["2210", "2215", "0020", "3601", "4202", "7999"]
    return [(draw.choice(codes), draw.choice(["INSERT", "RENAME", "DELETE", "UPDATE"]), f"L{k}", START + timedelta(hours=draw.randrange(200)), k) for k in range(n)]


BASE = [("2202", "Education"), ("9999", "Base only")]


def replayed(events, until=None):
    """Labels of live codes and rejected inserts."""
    live, rejected = dict(BASE), []
    for code, action, label, ts, event_id in sorted(events, key=lambda e: (e[3], e[4])):
        if until is not None and ts > until:
            break
        if action == "INSERT" and code in live:
            rejected.append((code, event_id))
        elif action == "INSERT" or action == "RENAME" and code in live:
            live[code] = label
        elif action == "DELETE":
            live.pop(code, None)
    return live, rejected


def frames(spark, events):
    return spark.createDataFrame(events, "code string, action string, label string, ts timestamp, event_id long"), spark.createDataFrame(BASE, "code string, label string")


def test_as_of_any_time(spark):
    events = drawn(1)
    own, base = frames(spark, events)
    times = [START - timedelta(days=1), START, *[START + timedelta(hours=h, minutes=30) for h in range(0, 200, 23)], START + timedelta(days=90)]
    got = history.live_at(history.intervals(own, ORDER, base), times).collect()
    want = {(t, c, label) for t in times for c, label in replayed(events, t)[0].items()}
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert sorted((r.code, r.event_id) for r in history.rejects(own, ORDER, base).collect()) == sorted(replayed(events)[1])


def test_questions_of_a_hot_code(spark):
    events = drawn(2)
    own, base = frames(spark, events)
    draw = Random(3)
    asked = [(draw.choice(["2202", "2202", "0020", "9999", "none"]), START + timedelta(hours=draw.randrange(-5, 210)), k) for k in range(500)]
    got = history.labels_at(own, ORDER, spark.createDataFrame(asked, "code string, day timestamp, n long"), "day", base).collect()
    want = {(code, day, n, replayed(events, day)[0].get(code)) for code, day, n in asked}
    assert {(r.code, r.day, r.n, r.label) for r in got} == want and len(got) == 500
    assert history.labels_at(own, ORDER, spark.createDataFrame([], "code string, day timestamp"), "day").count() == 0
    assert history.intervals(own.limit(0), ORDER).count() == 0


def test_vocabulary_of_a_code_renamed_twice_deleted_and_inserted_again(spark):
    at = lambda d: START + timedelta(days=d)
    events = [("1", "RENAME", "B", at(1), 1), ("1", "RENAME", "C", at(2), 2), ("1", "DELETE", "C", at(3), 3), ("1", "INSERT", "D", at(4), 4), ("2", "RENAME", "X", at(1), 5), ("2", "RENAME", "Y", at(2), 6), ("3", "UPDATE", "U", at(5), 7)]
    own, _ = frames(spark, events)
    heads = spark.createDataFrame([("1", "A"), ("4", "Quiet")], "code string, label string")
    got = {tuple(r) for r in history.vocabulary_history(own, ORDER, heads).collect()}
    assert got == {
        ("1", "prefLabel", "C"), ("1", "altLabel", "A"), ("1", "altLabel", "B"), ("1", "created", "2024-01-05"), ("1", "deprecated", "true"),
        *[("1", "modified", f"2024-01-0{d}") for d in (2, 3, 4)], ("1", "historyNote", "Renamed from 'A' to 'B' on 2024-01-02"), ("1", "historyNote", "Renamed from 'B' to 'C' on 2024-01-03"),
        ("2", "prefLabel", "Y"), ("2", "altLabel", "X"), ("2", "modified", "2024-01-02"), ("2", "modified", "2024-01-03"), ("2", "historyNote", "Renamed from 'None' to 'X' on 2024-01-02"), ("2", "historyNote", "Renamed from 'X' to 'Y' on 2024-01-03"),
        ("3", "prefLabel", "U"), ("3", "modified", "2024-01-06"), ("3", "historyNote", "Updated on 2024-01-06"), ("4", "prefLabel", "Quiet"),
    }


def test_carried_values_of_a_hot_key(spark):
    draw = Random(5)
    rows = [(None if draw.random() < 0.1 else draw.choice(["hot"] * 8 + ["a", "b"]), k, draw.choice([None, None, k])) for k in range(800)]
    frame = ordered(spark.createDataFrame(rows, "key string, pos long, value long"), ["key"], [F.col("pos")])
    got = carried(frame, ["key"], last={"l": F.col("value")}, before={"b": F.col("value")}, total={"t": F.col("value")}, following={"f": F.col("value")})
    assert got.select("__part").distinct().count() > 4
    assert max(r["count"] for r in got.groupBy("__part").count().collect()) < 400  # the hot key is split
    want = set()
    for key in {r[0] for r in rows}:
        own = [(p, v) for k, p, v in rows if k == key]
        for i, (p, _) in enumerate(own):
            known = [v for _, v in own[: i + 1] if v is not None]
            earlier = [v for _, v in own[:i] if v is not None]
            want.add((key, p, known[-1] if known else None, earlier[-1] if earlier else None, sum(known), own[i + 1][1] if i + 1 < len(own) else None))
    assert {(r.key, r.pos, r.l, r.b, r.t, r.f) for r in got.collect()} == want


def test_ranks_by_parts(spark):
    draw = Random(7)
    rows = [(k, draw.choice(["hot"] * 8 + ["a", None]), draw.choice([None, *range(40)])) for k in range(700)]
    frame = spark.createDataFrame(rows, "id long, key string, value long")
    for keys in ([], ["key"]):
        got = numbered(frame, keys, [F.desc_nulls_last("value"), F.col("id")])
        plan = got._jdf.queryExecution().toString()
        assert "Window" not in plan or keys
        for key in {r[1] for r in rows} if keys else [0]:
            own = sorted((r for r in rows if not keys or r[1] == key), key=lambda r: (r[2] is None, -(r[2] or 0), r[0]))
            assert [r.id for r in sorted((r for r in got.collect() if not keys or r.key == key), key=lambda r: r.rank)] == [r[0] for r in own]
    shared = {r.id: r.rank for r in ranked(frame, "value", ["id"]).collect()}
    for k, _, v in rows:
        assert shared[k] == 1 + sum((o is not None and (v is None or o > v)) for _, _, o in rows)
    assert numbered(frame.limit(0), [], [F.col("id")]).count() == 0
