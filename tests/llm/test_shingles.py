"""The pipeline's near-duplicate stage against all pairs in Python."""

import os
import random
import threading

import corpus_pipeline
from ledgerspark.llm import shingles as module
from ledgerspark.llm.common import OPEN, Steps, scratch, staged
from ledgerspark.llm.shingles import near, shingles, verified

SF, SF2 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def brute_kept(rows):
    """Ids of the first document of each component, from every pair."""
    sets = [shingles((r.text or "").encode()) for r in rows]
    parent = list(range(len(rows)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            if 4 * max(len(sets[a]), len(sets[b])) <= 5 * min(len(sets[a]), len(sets[b])) and near(sets[a], sets[b]):
                parent[root(a)] = root(b)
    first = {}
    for a, r in enumerate(rows):
        first[root(a)] = min(first.get(root(a), r.doc_id), r.doc_id)
    return sorted(first.values())


def edited(rng, words, n):
    out = list(words)
    for k in rng.sample(range(len(out)), n):
        out[k] = f"new{rng.getrandbits(40)}"
    return out


def test_near_copies_go(spark):
    rng = random.Random(3)
    base = [f"w{k}" for k in range(200)]
    texts, chain = [base], base
    for n in (1, 2, 3, 4, 4, 6, 9):
        texts += [edited(rng, base, n) for _ in range(15)]
    for _ in range(12):
        texts.append(chain := edited(rng, chain, 2))
    texts += [[f"o{k}_{j}" for j in range(60)] for k in range(20)] + [["a", "b"], ["A", "b"], [], []]
    rng.shuffle(texts)
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    for rows in (docs, spark.read.parquet(f"{SF2}/documents.parquet")):
        got = corpus_pipeline.near_dedup(spark, rows, SF)
        assert got.columns == rows.columns
        assert sorted(r.doc_id for r in got.collect()) == brute_kept(rows.collect())


def test_a_crowd_that_is_mostly_too_far_apart(spark):
    """Hundreds of edits of one text and of texts that share a long passage: buckets are large and their pairs are on
    both sides of the limit."""
    rng = random.Random(8)
    base, passage = [f"w{k}" for k in range(160)], [f"p{k}" for k in range(100)]
    texts = [edited(rng, base, rng.choice([1, 2, 3, 4, 5, 6, 7, 9])) for _ in range(260)]
    texts += [passage + [f"q{k}_{j}" for j in range(rng.randrange(10, 60))] for k in range(120)]
    rng.shuffle(texts)
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, SF).collect()) == brute_kept(docs.collect())


def test_names_with_dots_and_clashes(spark):
    docs = spark.createDataFrame([(1, "a b", 7, 8, "x"), (2, "a b", 9, 1, None), (None, None, None, None, None)], "doc_id long, text string, `a.b` int, node long, `doc` string")
    got = corpus_pipeline.near_dedup(spark, docs, SF)
    assert got.columns == docs.columns
    assert sorted(got.collect(), key=str) == sorted([r for r in docs.collect() if r.doc_id != 2], key=str)


def test_pairs_of_a_crowd_dealt_over_several_places(spark, monkeypatch):
    """Each pair is decided by its own two texts, however many places the others of one text take."""
    monkeypatch.setattr(module, "CROWD", 4)
    rng = random.Random(5)
    bases = [[f"w{j}_{k}" for k in range(80)] for j in range(3)]
    texts = bases + [edited(rng, bases[k % 3], rng.choice([0, 1, 2, 3, 6])) for k in range(60)] + [[]]
    texts = [" ".join(t) for t in texts]
    rows = spark.createDataFrame([(k, (t or None,)) for k, t in enumerate(texts)], "row_id long, doc struct<text:string>")
    nodes = spark.createDataFrame([(100 + k, (k,)) for k in range(len(texts))], "node long, label struct<row_id:long>")
    asked = [(100 + a, 100 + b) for b in range(3) for a in range(len(texts)) if a != b]
    got = verified(spark.createDataFrame(asked, "a long, b long"), nodes, rows).collect()
    sets = [shingles(t.encode()) for t in texts]
    want = [(a, b) for a, b in asked if near(sets[a - 100], sets[b - 100])]
    assert sorted((r.a, r.b) for r in got) == sorted(want) and 20 < len(want) < len(asked)


def folders(*tables):
    return [os.path.dirname(t.inputFiles()[0].removeprefix("file:").replace("///", "/")) for t in tables]


def test_steps_remove_what_earlier_ones_of_their_run_staged(spark):
    docs, run, other_run = spark.range(3), Steps(), Steps()
    with run.step(0, docs):
        read, other = staged(docs, "read"), staged(docs, "other")
    with other_run.step(0, docs):
        kept = staged(docs, "kept")
    lazy = kept.where("id > 0")
    places = folders(read, other)
    with run.step(1, read):
        assert [os.path.exists(f) for f in places] == [True, False]
    with run.step(2, docs):
        assert not os.path.exists(places[0])
    assert lazy.count() == 2  # the run beside it has gone on, and this one's table is there
    with other_run.step(1, docs):
        assert not os.path.exists(folders(kept)[0])
    assert not OPEN.open


def test_blocks_of_threads_do_not_mix(spark):
    docs, entered, left = spark.range(3), threading.Event(), threading.Event()

    def beside():
        with scratch(spark):
            entered.set()
            left.wait(60)

    worker = threading.Thread(target=beside)
    worker.start()
    entered.wait(60)
    run = Steps()
    with run.step(0, docs):
        table = staged(docs, "own")
    left.set()
    worker.join()
    assert table.count() == 3 and len(run.left) == 1


def test_a_lazy_result_outlives_another_run_of_the_pipeline(spark):
    own = corpus_pipeline.Steps()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    lazy = corpus_pipeline.near_dedup(spark, docs, "/root/testdata/sf0.001", own)
    corpus_pipeline.secret_scan(spark, docs, "/root/testdata/sf0.001", Steps())
    assert 0 < lazy.count() <= 200
