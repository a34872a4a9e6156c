"""Search, packing, near-duplicates, classifiers and the pipeline against brute force or held-out labels."""

import random
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerspark.llm.components import connected_components
from ledgerspark.llm.labels import labelled
from ledgerspark.llm.packing import combinations, occurrences, op9_packing, pack, pieces, plan, repeats, windows
from ledgerspark.llm.quality_model import WIDTH, Kernel, fitted, kept_by_model, op8_quality_model, scored, summed
from ledgerspark.llm.simhash import block_masks, components, deduplicated, fingerprint_words, near_duplicates, op10_simhash
from ledgerspark.llm.topk import op6_top_k, top_k
from ledgerspark.llm.toxicity import buckets_of, hashed, lexicons, logistic, op7_toxicity, part_column, part_of, toxic

SF, SF2 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
WORD = public_tokenizers.path("word_bpe_49k.json")


def brute_top(rows, k=20):
    fit = [(at, r.vec_id, [int(np.floor(64 * float(x))) for x in r.embedding]) for at, r in enumerate(rows) if r.vec_id is not None and r.embedding is not None and all(x is not None and np.isfinite(x) for x in r.embedding)]
    out = []
    for at, q, v in fit:
        if q % 20 == 0:
            found = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), c) for other, c, w in fit if other != at and len(w) == len(v))
            out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(found[:k])]
    return sorted(out)


def test_top_k(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    assert sorted(map(tuple, op6_top_k(spark, SF).collect())) == brute_top(table.collect())
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, None), (2, [nan, 1.0]), (3, [inf, 0.0]), (4, [None, 1.0]), (5, [0.5, -0.5]), (6, [0.5, -0.5]), (20, []), (21, []), (None, [1.0, 1.0]), (40, [3.0]), (60, [-0.01, 0.01]), (7, [1.0, 2.0])]
    odd = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, row long, id long")
    assert sorted(map(tuple, top_k(odd, F.col("vec_id") % 20 == 0).collect())) == brute_top(odd.collect())
    assert top_k(odd.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_top_k_over_many_blocks(spark, monkeypatch):
    from ledgerspark.llm import topk

    for name, value in {"QUERIES": 7, "CANDIDATES": 30, "FEWEST": 10, "RUNS": (3, 5, 8), "SEEDS": 40, "DIMENSIONS": 8}.items():
        monkeypatch.setattr(topk, name, value)
    table = spark.read.parquet(f"{SF}/embeddings.parquet").withColumn("embedding", F.when(F.col("vec_id") % 3 == 0, F.col("embedding")).otherwise(F.transform("embedding", lambda x: F.round(x, 1))))
    assert sorted(map(tuple, topk.top_k(table, F.col("vec_id") % 20 == 0, k=5).collect())) == brute_top(table.collect(), 5)


def test_large_components_are_exact(spark):
    rng = random.Random(4)
    rows = [(0, [1.0]), (1, [4.0e6]), (2, [3.0e6]), (20, [4.0e6]), (3, [-4.0e6])]
    rows += [(100 + k, [rng.uniform(-1, 1) * 10 ** rng.choice([0, 3, 7, 7, 15]) * (1 if rng.random() < 0.5 else 1e-9) for _ in range(3)]) for k in range(60)]
    frame = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows if max(map(abs, v)) < 1e8], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, top_k(frame, F.col("vec_id") % 20 == 0, k=4).collect())) == brute_top(frame.collect(), 4)
    # a query and a candidate too large for 64-bit scores, whose best still fit
    wide = spark.createDataFrame([(0, [2.0**55, 1.0]), (1, [1.0, 0.0]), (2, [0.5, 2.0]), (3, [-(2.0**50), 0.0]), (20, [1 / 64, 1 / 64])], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, top_k(wide, F.col("vec_id") == 20, k=3).collect())) == [r for r in brute_top(wide.collect(), 3) if r[0] == 20]


def check_packing(docs, got):
    library = Tokenizer.from_file(WORD)
    want = sorted(((d.doc_id is not None, d.doc_id or 0), b"".join(i.to_bytes(4, "little") for i in [*library.encode(d.text or "", add_special_tokens=False).ids, 1])) for d in docs)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length and r.length > 0
        by_doc[(r.doc_id is not None, r.doc_id or 0)].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert sorted((k, r.start, bytes(r.ids)) for k, v in by_doc.items() for r in v) == sorted((k, at // 4, raw[at : at + 8192]) for k, raw in want for at in range(0, len(raw), 8192))
    total = padded = 0
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
        total, padded = total + at, padded + (at if at & (at - 1) == 0 else 2048)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    return padded / max(1, total)


def test_packing(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert check_packing(docs.collect(), pack(docs, WORD).collect()) < 1.03
    check_packing(odd.collect(), pack(odd, WORD).collect())
    assert pack(odd.limit(0), WORD).count() == 0
    assert op9_packing(spark, SF).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_pieces_of_arrays(spark):
    assert [x.tolist() for x in windows(np.array([1, 9, 4, 8]), 4)] == [[0, 1, 1, 1, 2, 3, 3], [0, 0, 4, 8, 0, 0, 4], [1, 4, 4, 1, 4, 4, 4]]
    assert occurrences(np.array([5, 3, 5, 5, 3, 9])).tolist() == [0, 0, 1, 2, 1, 0]
    # one document of more than a batch of pieces, among others and a null id
    docs = [(7, "a b"), (1, "a " * 2_200_000 + "end"), (None, "c"), (3, None)]
    got = pieces(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1), WORD).collect()
    library = Tokenizer.from_file(WORD)
    a, b, c, last = (library.encode(w, add_special_tokens=False).ids for w in ("a", "b", "c", "end"))
    ids = {7: a + b + [1], 1: a * 2_200_000 + last + [1], None: c + [1], 3: [1]}
    assert [(r.doc_id, r.start) for r in got] == [(d, at) for d, _ in docs for at in range(0, len(ids[d]), 2048)]
    for r in got:
        own = np.array(ids[r.doc_id][r.start : r.start + 2048], "<u4").tobytes()
        assert (bytes(r.ids), r.length, r.ids_crc32, r.doc_tokens) == (own, len(own) // 4, zlib.crc32(own), len(ids[r.doc_id]))
    assert [r.number for r in got] == occurrences(np.array([r.length for r in got])).tolist()


def test_plan_uses_every_length():
    rng = np.random.default_rng(3)
    for size in (0, 1, 50, 20_000):
        counts = np.bincount(rng.integers(1, 2048, size), minlength=2049)
        used = np.zeros_like(counts)
        for times, use in plan(counts):
            assert times > 0 and sum(n * m for n, m in use) <= 2048
            for n, m in use:
                used[n] += times * m
        assert (used == counts).all()
    waste = sum(t * (2048 - sum(n * m for n, m in use)) for t, use in plan(counts))
    assert waste < 0.01 * (counts * np.arange(2049)).sum()


def brute_print(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, distance=2):
    """Smallest id of each row's component; prints: (id, fingerprint)."""
    parent = list(range(len(prints)))

    def root(a):
        while parent[a] != a:
            parent[a] = a = parent[parent[a]]
        return a

    for a in range(len(prints)):
        for b in range(a):
            if bin(prints[a][1] ^ prints[b][1]).count("1") <= distance:
                parent[root(a)] = root(b)
    low = {}
    for a, (i, _) in enumerate(prints):
        low[root(a)] = min((x for x in (low.get(root(a)), i) if x is not None), default=None)
    return [(i, p, low[root(a)]) for a, (i, p) in enumerate(prints)]


def test_near_duplicates(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    base = " ".join(f"w{k}" for k in range(400))
    near = spark.createDataFrame([(500 - k, base.replace(f"w{k} ", f"v{k} ") if k else base) for k in range(60)], "doc_id long, text string")
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    for rows in (docs, odd, near):
        got = sorted(((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in near_duplicates(rows).collect()), key=key)
        assert got == sorted(brute_components([(d.doc_id, brute_print(d.text)) for d in rows.collect()]), key=key)
        kept = deduplicated(rows)
        assert kept.columns == rows.columns
        groups = {}
        for i, p, c in got:
            groups.setdefault((c, p if c is None else 0), i)
        assert sorted((r.doc_id is not None, r.doc_id or 0) for r in kept.collect()) == sorted((c is not None, c or 0) for c, _ in groups)
    assert near_duplicates(odd.limit(0)).count() == 0
    assert op10_simhash(spark, SF).count() == 200


def test_fingerprint_of_long_text():
    text = " ".join(f"a{k % 5000}" for k in range(140_000))
    assert fingerprint_words(text.encode()) % (1 << 64) == brute_print(text)


def test_crowded_buckets_lose_no_link(spark):
    rng = random.Random(5)
    prints = {rng.getrandbits(64) for _ in range(40)}
    while len(prints) < 400:
        p = rng.choice(sorted(prints))
        for _ in range(rng.choice([1, 2, 2, 3, 4])):
            p ^= 1 << rng.choice([*range(6), 63, 40, 41])
        prints.add(p)
    rows = [(k, k, p - (1 << 64) if p >> 63 else p) for k, p in enumerate(sorted(prints))]
    frame = spark.createDataFrame(rows, "doc_id long, row_id long, fingerprint long")
    for distance, buckets in ((2, (1, 64)), (1, (4,)), (3, (4,))):
        want = {p: c for _, p, c in brute_components([(r[0], r[2] % (1 << 64)) for r in rows], distance)}
        for bucket in buckets:
            assert {r.node % (1 << 64): r.label.d for r in components(frame, distance, bucket).collect()} == want
    assert len(block_masks(2)) == 6


def test_one_bit_links_of_a_dense_set(spark):
    rng = random.Random(9)
    prints = sorted(rng.sample(range(1 << 12), 300))
    frame = spark.createDataFrame([(k, k, p) for k, p in enumerate(prints)], "doc_id long, row_id long, fingerprint long")
    want = {p: c for _, p, c in brute_components(list(enumerate(prints)), 1)}
    for bucket in (4, 64):
        assert {r.node: r.label.d for r in components(frame, 1, bucket).collect()} == want


def test_components_of_a_chain_and_a_star(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 50)] + [(7, 7)], "a long, b long")
    nodes = spark.range(200).select(F.col("id").alias("node"), F.struct((-F.col("id")).alias("d"), F.col("id").alias("node")).alias("label"))
    got = {r.node: r.label.node for r in connected_components(nodes, edges).collect()}
    assert got == {k: 40 if k <= 40 else 149 if 100 <= k < 150 else k for k in range(200)}


def held_out(spark, rows, label):
    labels = spark.read.parquet(f"{SF2}/labels.parquet").where("crc32(cast(cast(doc_id as string) as binary)) % 4 = 2")
    return [(r[0], r[1]) for r in rows.join(labels, "doc_id").select(label, "out").collect()]


def test_quality_model(spark, odd):
    rows = op8_quality_model(spark, SF2)
    assert rows.columns == ["doc_id", "held_out", "score", "predicted"] and rows.count() == 1000
    got = held_out(spark, rows.select("doc_id", F.col("predicted").alias("out")), "quality")
    assert np.mean([p for y, p in got if y == 1]) > 0.97
    assert np.mean([p for y, p in got if y == 0]) < 0.35
    labels = labelled(spark, SF, "quality")
    out = scored(odd, labels).collect()
    assert len(out) == odd.count() and all(0 <= r.score <= 1 for r in out)
    assert {r.score for r in scored(odd, labels.limit(0)).collect()} == {1.0}
    by_id = {}
    for r in out:
        by_id.setdefault(r.doc_id, set()).add(r.score)
    assert all(len(v) == 1 for k, v in by_id.items() if k is not None)
    assert scored(odd.limit(0), labels).count() == 0
    assert kept_by_model(odd, labels).columns == odd.columns


def f1(got):
    hit = sum(1 for y, p in got if y == p == 1)
    return 2 * hit / max(1, sum(y + p for y, p in got))


def test_toxicity(spark, odd):
    rows = op7_toxicity(spark, SF2)
    assert rows.count() == 1000
    got = held_out(spark, rows.select("doc_id", F.col("toxic").alias("out")), "toxic")
    assert np.mean([p for y, p in got if y == 1]) > 0.6
    assert np.mean([p for y, p in got if y == 0]) < 0.02
    labels = labelled(spark, SF, "toxic")
    found = toxic(odd, labels).collect()
    assert len(found) == odd.count() and {r.toxic for r in found} <= {0, 1} and all(0 <= p <= 1 for r in found for p in (r.p_insult, r.p_severe, r.p_toxic))
    assert {(r.toxic, r.p_toxic) for r in toxic(odd, labels.limit(0)).collect()} == {(0, 0.0)}
    assert toxic(odd.limit(0), labels).count() == 0


def test_chain_against_its_last_model_alone(spark):
    docs, labels = spark.read.parquet(f"{SF2}/documents.parquet"), labelled(spark, SF2, "toxic")
    chain, single = (f1(held_out(spark, toxic(docs, labels, depth).select("doc_id", F.col("toxic").alias("out")), "toxic")) for depth in (3, 1))
    assert chain >= single - 0.02


def test_labels_beyond_the_broadcast(spark, monkeypatch):
    from ledgerspark.llm import toxicity

    docs, labels = spark.read.parquet(f"{SF2}/documents.parquet"), labelled(spark, SF2, "toxic")
    want = sorted(map(tuple, toxic(docs, labels).collect()))
    monkeypatch.setattr(toxicity, "BROADCAST", 10)
    assert sorted(map(tuple, toxic(docs, labels).collect())) == want


def test_lexicons_against_counts_in_python(spark):
    docs, labels = spark.read.parquet(f"{SF2}/documents.parquet"), labelled(spark, SF2, "toxic")
    y = {r.doc_id: r.y for r in labels.collect()}
    rows = [(y[d.doc_id], part_of(d.doc_id), buckets_of(d.text or "")) for d in docs.collect() if d.doc_id in y]
    known = hashed(docs.select("doc_id", "text").join(labels.select("doc_id", "y", part_column().alias("part")), "doc_id"))
    for left_out, got in zip((None, 0, 1, 2), lexicons(known), strict=True):
        own = [r for r in rows if r[1] != left_out]
        n = {v: sum(r[0] == v for r in own) for v in (0, 1)}
        count = {v: Counter(b for r in own if r[0] == v for b in r[2]) for v in (0, 1)}
        lift = {b: (c + 0.5) / (count[0][b] + 0.5) * (n[0] / n[1]) for b, c in count[1].items() if c >= 4}
        want = sorted((b for b in lift if lift[b] >= 8), key=lambda b: (-count[1][b] * np.log(lift[b]), b))[:128]
        assert got == want and want


def test_logistic_is_at_its_minimum():
    rng = np.random.default_rng(1)
    x = np.column_stack([rng.normal(size=(400, 5)), np.ones(400)])
    y, w = (x[:, 0] + rng.normal(size=400) > 0).astype(float), rng.integers(1, 4, 400).astype(float)
    weights = logistic(x, y, w)
    ridge_ = np.array([1.0] * 5 + [1e-3])
    assert np.abs(x.T @ (w * (1 / (1 + np.exp(-x @ weights)) - y)) + ridge_ * weights).max() < 1e-3


def test_model_against_one_pass_in_numpy(spark):
    rng = np.random.default_rng(7)
    stats, y = rng.normal(size=(600, WIDTH)), rng.integers(0, 2, 600)
    stats[:, 0] += y
    rows = spark.createDataFrame([(x.tolist(), int(v), bool(k % 4 == 3)) for k, (x, v) in enumerate(zip(stats, y, strict=True))], "stats array<double>, y int, calibrates boolean").repartition(9)
    for fan_in in (2, 32):
        assert np.allclose(summed(rows, lambda x, y: np.r_[len(y), x.sum(axis=0)], fan_in), np.r_[600, stats.sum(axis=0)])
    model = fitted(rows)
    kernel = Kernel(stats.mean(axis=0), stats.std(axis=0) + 1e-6)
    fit, cal = np.arange(600) % 4 != 3, np.arange(600) % 4 == 3
    z = kernel(stats[fit])
    penalty = 1e-4 * (fit.sum() + 100)
    # the ridge solution by least squares on rows with the penalty's own rows below
    direct = np.linalg.lstsq(np.vstack([z, np.sqrt(penalty) * np.eye(z.shape[1])]), np.r_[y[fit], np.zeros(z.shape[1])], rcond=None)[0]
    assert np.allclose(kernel(stats) @ direct, model.raw(stats), atol=1e-6)
    at = np.rint((model.raw(stats[cal]) + 1) * 200).astype(int)
    there = sorted(set(at))
    n, good = (np.array([f(at == b) for b in there], float) for f in (np.sum, lambda m: y[cal][m].sum()))
    # isotonic levels are max over starts of min over ends of the mean between
    level = [max(min(good[j : k + 1].sum() / n[j : k + 1].sum() for k in range(i, len(n))) for j in range(i + 1)) for i in range(len(n))]
    pooled = {}
    for b, v, c in zip(there, level, n, strict=True):
        pooled.setdefault(round(v, 9), []).append((b / 200 - 1, c))
    want = sorted((sum(x * c for x, c in p) / sum(c for _, c in p), v) for v, p in pooled.items())
    assert np.allclose(np.array(model.steps).T, want, atol=1e-6)


def test_repeat_counts_solve_the_least_squares():
    rng = np.random.default_rng(3)
    counts = np.bincount(np.clip(rng.lognormal(5, 1, 20_000).astype(int), 1, 2047), minlength=2049)
    combos = combinations(counts)
    x, a = np.array(repeats(combos, counts)), np.zeros((len(combos), 2049))
    for k, combo in enumerate(combos):
        for n in combo:
            a[k, n] += 1
    slope = a @ (x @ a - counts)
    # no repeat count could fall or rise by more than a fraction to some use
    assert (x >= 0).all() and slope.min() > -2 and np.abs(slope[x > 0]).max() < 2


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF2}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF2)
        assert out.schema.simpleString() == docs.schema.simpleString()
        assert 0 < out.count() <= docs.count()
        docs = spark.createDataFrame(out.collect(), out.schema)
    check_packing(docs.collect(), corpus_pipeline.run(spark, SF2).collect())


def test_pipeline_of_odd_rows(spark, odd):
    for rows in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, rows, SF).columns == odd.columns
        assert "sequence_id" in corpus_pipeline.STAGES[-1][1](spark, rows, SF).columns
