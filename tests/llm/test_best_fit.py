"""Best-fit packing against its contract, brute force and the bound on bins."""

import zlib
from itertools import pairwise

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerspark.llm.best_fit import best_fit, best_fit_pack, fewest, op13_best_fit, plan, searched

SF = "/root/testdata/sf0.001"
WORD = public_tokenizers.path("word_bpe_49k.json")


def bins_of(packed):
    return sum(times for times, _ in packed)


def squares(packed):
    return sum(times * sum(n * m for n, m in use.items()) ** 2 for times, use in packed)


def used(packed, size):
    out = np.zeros(size, np.int64)
    for times, use in packed:
        for n, m in use.items():
            out[n] += times * m
    return out


def fitted_one_by_one(lengths, window):
    """Best fit over falling lengths, piece by piece."""
    space = []
    for n in sorted(lengths, reverse=True):
        able = [k for k, s in enumerate(space) if s >= n]
        if able:
            space[min(able, key=lambda k: space[k])] -= n
        else:
            space.append(window - n)
    return sorted(space)


def optimum(lengths, window):
    """The fewest bins, by trying all places of each piece."""
    best = len(lengths)

    def put(k, space):
        nonlocal best
        if len(space) >= best:
            return
        if k == len(lengths):
            best = len(space)
            return
        for at in range(len(space)):
            if space[at] >= lengths[k] and space[at] not in space[:at]:
                put(k + 1, [*space[:at], space[at] - lengths[k], *space[at + 1 :]])
        put(k + 1, [*space, window - lengths[k]])

    put(0, [])
    return best


@pytest.mark.parametrize("seed", range(40))
def test_start_and_search_against_brute_force(seed):
    draw = np.random.default_rng(seed)
    window = 30
    low, high = sorted(draw.integers(1, window + 1, 2))
    lengths = sorted(draw.integers(low, high + 1, 11).tolist(), reverse=True)
    counts = np.bincount(lengths, minlength=window + 1)
    start = best_fit(counts, window)
    spaces = sorted(window - sum(n * m for n, m in use.items()) for times, use in start for _ in range(times))
    assert spaces == fitted_one_by_one(lengths, window)
    found = searched(start, counts, window)
    assert (used(found, window + 1) == counts).all()
    assert all(times > 0 and sum(n * m for n, m in use.items()) <= window for times, use in found)
    assert squares(found) >= squares(start) and bins_of(found) <= bins_of(start)
    exact = optimum(lengths, window)
    assert fewest(counts, window) <= exact <= bins_of(found) <= exact + 1


def test_search_empties_bins_that_the_start_leaves():
    gained = 0
    for seed in range(20):
        counts = np.bincount(np.random.default_rng(seed).integers(600, 1000, 300), minlength=2049)
        start = best_fit(counts, 2048)
        found = searched(start, counts, 2048)
        assert bins_of(found) <= bins_of(start)
        gained += bins_of(start) - bins_of(found)
    assert gained >= 20  # one a run at least, on average


def test_classes_do_not_grow_with_the_documents():
    counts = np.bincount(np.random.default_rng(1).integers(500, 1100, 3000), minlength=2049).astype(np.int64)
    patterns = plan(counts * 10**9)
    assert len(patterns) < 4 * 2048
    assert sum(t * m for t, use in patterns for _, m in use) == 3000 * 10**9


def held(rows, window, docs, end):
    library = Tokenizer.from_file(WORD)
    library.no_truncation()
    library.no_padding()
    want = []
    for d in docs:
        ids = np.array([*library.encode(d.text or "", add_special_tokens=False).ids, end], "<u4")
        want += [(d.doc_id is not None, d.doc_id or 0, at // window, at, len(ids[at : at + window]), zlib.crc32(ids[at : at + window].tobytes())) for at in range(0, len(ids), window)]
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        places.sort()
        assert places[0][0] == 0 and all(a + n == b for (a, n), (b, _) in pairwise(places))
        assert sum(places[-1]) <= window
    return len(by_sequence)


def test_query_holds_its_contract(spark):
    rows = op13_best_fit(spark, SF).collect()
    n = held(rows, 2048, spark.read.parquet(f"{SF}/documents.parquet").collect(), 0)
    assert n - sum(r.length == 2048 for r in rows) == fewest(np.bincount([r.length for r in rows if r.length < 2048], minlength=2049), 2048)


def test_odd_rows(spark, odd):
    held(best_fit_pack(odd, WORD, window=64).collect(), 64, odd.collect(), 0)
    assert best_fit_pack(odd.limit(0), WORD).count() == 0
