"""Collocations against brute force; the parse against its definition."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerspark.llm import collocations as c

LETTERS = str.maketrans({chr(k): chr(k + 32) for k in range(65, 91)})
SCHEMA = "doc_id long, text string, lang string, f long, phrase string, chunk string, n long, __at long"


def grams(text):
    for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LETTERS)):
        words = re.findall("[^ \t]+", piece)
        for n in range(1, 4):
            for k in range(len(words) - n + 1):
                yield tuple(words[k : k + n])


def brute(rows, least, top):
    f = defaultdict(Counter)
    for text, lang in rows:
        f["und" if lang is None else lang].update(grams(text))
    out = []
    for lang, own in f.items():
        n = sum(v for g, v in own.items() if len(g) == 1)
        candidates = {g: a for g, a in own.items() if len(g) > 1 and a >= least}
        kept = []
        for g, a in candidates.items():
            if any(100 * v >= 50 * a for x, v in candidates.items() if len(x) == 3 and len(g) == 2 and g in (x[:2], x[1:])):
                continue
            score, _, left, right = min((10**6 * a * a // (own[g[:k]] * own[g[k:]]), k, own[g[:k]], own[g[k:]]) for k in range(1, len(g)))
            kept.append((-score, -a, " ".join(g).encode(), left, right))
        out += [(lang, k + 1, p.decode(), -a, left, right, n, -s) for k, (s, a, p, left, right) in enumerate(sorted(kept)[:top])]
    return sorted(out)


def found(frame):
    return sorted(tuple(r) for r in frame.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.fixture
def many_parts(spark):
    names = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "7"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_words_and_hashes():
    texts = ["Ab  c,d\téÉ \U0001f642x.", "", "  \n ", "one", ".,;", "a\x0bb\x0cc\rd\x85e f", "A" * 70000]
    w = c.Words([t.encode() for t in texts])
    got = [(s, w.text[a : a + n].tobytes().decode()) for s, a, n in zip(w.source.tolist(), w.at.tolist(), w.size.tolist(), strict=True)]
    want = [(k, x) for k, t in enumerate(texts) for p in re.split("[.,;:!?\x0a-\x0d]", t.translate(LETTERS)) for x in re.findall("[^ \t]+", p)]
    assert got == want
    for powers in c.POWERS:
        h = w.hashes(powers).tolist()
        assert len(set(h)) == len({x for _, x in want})
        again = c.Words([b"xx yy " + x.encode() for _, x in want]).hashes(powers)[2::3].tolist()
        assert again == h


def test_chunks_overlap_by_two_words_and_depend_on_content():
    import pyarrow as pa

    draw = np.random.default_rng(4)
    passage = " ".join(f"w{k}" for k in draw.integers(0, 40, 400))
    texts = [f"{'before ' * 30}{passage} after", passage, "short", "a b"]
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * 4, "text": texts})
    rows = [r for b in c.parsed(iter([batch])) for r in b.to_pylist()]
    whole, k = [], 0
    for _ in texts:
        words = rows[k]["chunk"].split(" ")
        while rows[k]["more"]:
            k += 1
            more = rows[k]["chunk"].split(" ")
            assert more[:2] == words[-2:] and len(more) > 2
            words += more[2:]
        whole.append(" ".join(words))
        k += 1
    assert whole == texts and k == len(rows)
    counts = Counter(r["chunk"] for r in rows)
    assert sum(v == 2 for v in counts.values()) > 15  # inside the passage both texts are cut alike


def test_different_grams_of_one_hash_stay_apart():
    keys = np.array([7, 3, 7, 7, 3], np.uint64), np.array([1, 2, 5, 1, 2], np.uint64)
    chosen, sums = c.summed(keys, np.array([1, 10, 100, 1000, 10000]))
    assert {(int(keys[0][k]), int(keys[1][k])): int(s) for k, s in zip(chosen, sums, strict=True)} == {(3, 2): 10010, (7, 1): 1001, (7, 5): 100}


def test_against_brute_force(spark, many_parts):
    draw = np.random.default_rng(8)
    words = ["the", "The", "new", "york", "city", "of", "été", "a", "b"]
    marks = [" ", " ", " ", " ", " ", "  ", "\t", ", ", ".", "\n"]
    rows = []
    for k in range(60):
        text = "".join(words[draw.integers(0, len(words))] + marks[draw.integers(0, len(marks))] for _ in range(draw.integers(0, 120)))
        rows.append((text, [None, "en", "de", ""][k % 4]))
    rows += [("new york city of the new york city", "en")] * 40 + [(None, None), ("", "en"), ("z " * 3000, "en"), ("x y z", "de"), ("x y z", "de")]
    docs = spark.createDataFrame([(k, t, lang, 1, "x", "y", 2, 3) for k, (t, lang) in enumerate(rows)], SCHEMA)
    assert found(c.collocations(docs)) == brute(rows, 10, 2000)
    assert found(c.collocations(docs, least=3, top=7)) == brute(rows, 3, 7)
    assert c.collocations(docs.limit(0)).count() == 0
    copies = c.dictionary(docs).where("chunk = 'x y z'").first()
    assert (copies["weight"], copies["more"]) == (2, False)


def test_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.text, r.lang) for r in docs.collect()]
    assert found(c.op11_collocations(spark, "/root/testdata/sf0.001")) == brute(rows, 10, 2000)
