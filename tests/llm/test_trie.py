"""The trie of conversations against a brute-force version, over one part and many."""

import hashlib
import re
import zlib

import numpy as np
import pytest

from ledgerspark.llm.trie import NODE, RangeMinimum, op12_prefix_trie, trie

SF = "/root/testdata/sf0.001"
NAMES = [c.split()[0] for c in NODE.split(", ")]
SCHEMA = "conv_id long, turn long, role string, text string, n long, token string, prefix string, part string"


def brute(rows):
    """Nodes by their prefix, members by comparing every conversation."""
    own = {}
    for r in rows:
        if r[0] is not None:
            digest = hashlib.sha256(f"{len(r[2] or '')}:{r[2] or ''}{r[3] or ''}".encode()).hexdigest()[:32]
            own.setdefault(r[0], []).append((r[1] is not None, r[1] or 0, digest, (r[2] or "", r[3] or "")))
    own = {c: [t[3] for t in sorted(ts)] for c, ts in own.items()}
    convs = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        convs[c] = tuple(own.get(c - c % 20, [])[:h] + ts[h:])
    members = {}
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members.setdefault(convs[c][:d], []).append(c)
    out = []
    for p, cs in members.items():
        under = [q for q in members if q[: len(p)] == p]
        children = {q: sum(x[:-1] == q for x in members if x) for q in under}
        saved = sum((len(members[q]) - 1) * len(re.findall(r"[^\x20\x09-\x0d]+", q[-1][1])) for q in under if q)
        ends = ",".join(str(c) for c in cs if convs[c] == p)
        out.append((cs[0], len(p), members[p[:-1]][0] if p else None, len(cs), children[p], sum(n == 0 for n in children.values()), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def same(frame, rows):
    got = [tuple(r[c] for c in NAMES) for r in frame.collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)


@pytest.fixture
def many_parts(spark):
    names = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "13"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def drawn(seed, n, turns, kinds):
    draw = np.random.default_rng(seed)
    rows = []
    for c in range(n):
        copy = c % 3 == 0  # a third are one conversation
        for t in range(4 if copy else draw.integers(0, turns + 1)):
            rows.append((c, t, "user" if t % 2 == 0 else "bot", f"say {0 if copy else draw.integers(0, kinds)}", 1, "t", "p", "x"))
    return rows


def test_many_parts(spark, many_parts):
    for rows in (drawn(1, 150, 6, 2), drawn(2, 60, 9, 1)):
        same(trie(spark.createDataFrame(rows, SCHEMA)), rows)


def test_one_part_and_the_query(spark):
    rows = drawn(3, 80, 5, 3)
    same(trie(spark.createDataFrame(rows, SCHEMA)), rows)
    conversations = spark.read.parquet(f"{SF}/conversations.parquet")
    same(op12_prefix_trie(spark, SF), [tuple(r) for r in conversations.select("conv_id", "turn", "role", "text").collect()])


def test_odd_rows(spark, many_parts):
    long = "word " * 20000
    rows = [
        (1, None, "user", "first", 1, "t", "p", "x"), (1, 0, None, None, 1, "t", "p", "x"), (1, 0, "", "", 1, "t", "p", "x"), (1, 5, "user", long, None, None, None, None),
        (2, 1, "user", "a"), (2, 1, "user", "a"), (2, 1, "bot", "a"), (3, 0, "user", "\t one\x0btwo \n"), (None, 0, "user", "lost"), (None, None, None, None),
        (20, 0, "user", "first"), (20, 1, "bot", ""), (21, 0, "user", "x"), (22, 0, "user", "y"), (23, 0, "user", "z"), (23, 9, "1:", "w"), (23, 10, "1", ":w"), (10**12, 0, "user", long),
        *[(40, k, "user", f"t{k}") for k in range(300)], *[(k, 0, "user", "same") for k in range(600, 640)], *[(41, k, "user", f"t{k}") for k in range(299)],
    ]
    rows = [(*r, *[None] * (8 - len(r))) for r in rows]
    same(trie(spark.createDataFrame(rows, SCHEMA)), rows)
    assert trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_ids_are_hashed_in_order_across_runs(spark, many_parts):
    ids = [20 * 10**6 + 20 * k for k in range(1500)]  # each its own base: one conversation, over 59 runs of ids
    rows = [(c, 0, "user", "same") for c in ids]
    got = trie(spark.createDataFrame([(*r, *[None] * 4) for r in rows], SCHEMA)).where("depth = 1").first()
    assert got.n_convs == 1500 and got.ends_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_range_minimum():
    draw = np.random.default_rng(5)
    for n in (1, 2, 3, 8, 37):
        x = draw.integers(0, 6, n)
        table = RangeMinimum(x)
        left, right = (v.ravel() for v in np.meshgrid(np.arange(n), np.arange(n)))
        left, right = left[left <= right], right[left <= right]
        assert table.least(left, right).tolist() == [x[a : b + 1].min() for a, b in zip(left, right, strict=True)]
        for depth in range(7):
            start = np.arange(n)
            ahead = [next((k for k in range(n - s) if x[s + k] < depth), n - s) for s in start]
            back = [next((k for k in range(s + 1) if x[s - k] < depth), s + 1) for s in start]
            assert table.reach(start, np.full(n, depth), True).tolist() == ahead
            assert table.reach(start, np.full(n, depth), False).tolist() == back
