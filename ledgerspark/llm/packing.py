"""Packing token sequences: non-negative least squares over length combinations, rounding, greedy residuals."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from .common import bind, documents, staged, text_or_empty
from .encoding import encoded_columns

WORD_BPE = "word_bpe_49k.json"
WINDOW, END = 2048, 1
#: What is known of a piece.
PIECE = ["doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens"]
#: Lengths from which triples are formed, the most frequent ones; sweeps of the solver at most, and the largest change of
#: a repeat count in a sweep after which it has converged.
TRIPLE_LENGTHS, SWEEPS, SETTLED = 96, 500, 0.01
#: Bytes of the parts' bases (a long for each length) up to which they are broadcast; beyond, parts are joined by a shuffle.
BROADCAST = 64 << 20
#: Bytes of ids that a batch of pieces holds at most, or one piece.
BATCH = 8_000_000


def combinations(counts: np.ndarray, window: int = WINDOW) -> list[tuple[int, ...]]:
    """Shallow combinations of present lengths that fill the window: all pairs, and triples whose two shorter lengths are
    among the most frequent."""
    there = counts > 0
    pairs = [(a, window - a) for a in range(1, window // 2 + 1) if there[a] and there[window - a]]
    common = sorted(sorted(np.flatnonzero(there).tolist(), key=lambda n: (-counts[n], n))[:TRIPLE_LENGTHS])
    triples = [(a, b, window - a - b) for k, a in enumerate(common) for b in common[k:] if window - a - b >= b and there[window - a - b]]
    return pairs + triples


def repeats(combos: list[tuple[int, ...]], counts: np.ndarray) -> list[float]:
    """How often to use each combination: x >= 0 that minimises |A x - counts|^2, column k of A holding how often
    combination k uses each length. Coordinate descent, each step solving one x exactly, until no x moves by more than
    ``SETTLED``: repeat counts are rounded, so nearer is of no use."""
    rest, x = counts.astype(float).tolist(), [0.0] * len(combos)
    norms = [sum(c.count(n) ** 2 for n in set(c)) for c in combos]
    for _ in range(SWEEPS):
        moved = 0.0
        for k, combo in enumerate(combos):
            new = x[k] + sum([rest[n] for n in combo]) / norms[k]
            if new < 0:
                new = 0.0
            if step := new - x[k]:
                x[k] = new
                moved = max(moved, abs(step))
                for n in combo:
                    rest[n] -= step
        if moved <= SETTLED:
            break
    return x


def plan(counts: np.ndarray, window: int = WINDOW) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns (repeat count, [(length, how often), ...]) that use each length exactly ``counts`` times.

    Repeat counts of the least-squares solution are rounded down and held to what is left of each length, largest first.
    The residuals are packed greedily: the longest length left, then the longest that still fits, and so on; such a
    pattern is repeated as long as its lengths last.
    """
    left = counts.astype(np.int64).copy()
    combos = combinations(left, window)
    solved = repeats(combos, left)
    out = []
    for k in sorted(range(len(combos)), key=lambda k: (-solved[k], k)):
        use = [(n, combos[k].count(n)) for n in sorted(set(combos[k]), reverse=True)]
        times = min([int(solved[k] + 1e-9), *(int(left[n]) // m for n, m in use)])
        if times > 0:
            out.append((times, use))
            for n, m in use:
                left[n] -= times * m
    while left.any():
        space, use = window, []
        for n in np.flatnonzero(left)[::-1].tolist():
            if n <= space:
                m = min(space // n, int(left[n]))
                use.append((n, m))
                space -= n * m
            if not space:
                break
        times = min(int(left[n]) // m for n, m in use)
        out.append((times, use))
        for n, m in use:
            left[n] -= times * m
    return out


class Places:
    """Where the r-th piece of a length goes: sorted starts of ranks, and what follows from each."""

    def __init__(self, patterns: list[tuple[int, list[tuple[int, int]]]], first: int):
        used: dict[int, int] = {}
        keys, rows, sequence = [], [], first
        for times, use in patterns:
            offset = 0
            for n, m in use:
                at = used.get(n, 0)
                keys.append(n << 44 | at)
                rows.append((at, sequence, m, offset))
                used[n] = at + times * m
                offset += n * m
            sequence += times
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        self.keys, self.rows, self.sequences = np.array(keys, np.int64)[order], np.array(rows, np.int64).reshape(-1, 4)[order], sequence

    def __call__(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at, sequence, times, offset = self.rows[np.searchsorted(self.keys, length << 44 | rank, "right") - 1].T
        return sequence + (rank - at) // times, offset + (rank - at) % times * length


def windows(sizes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document (its position), start in it and length of each piece of documents of these sizes (1 at least), in order."""
    n = -(-sizes // window)
    doc = np.repeat(np.arange(len(sizes)), n)
    start = window * (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n))
    return doc, start, np.minimum(window, sizes[doc] - start)


def occurrences(values: np.ndarray) -> np.ndarray:
    """How often each value stands before, in an array of one value at least."""
    order = np.argsort(values, kind="stable")
    at, new = np.arange(len(values)), np.r_[True, np.diff(values[order]) != 0]
    out = np.empty(len(values), np.int64)
    out[order] = at - np.maximum.accumulate(np.where(new, at, 0))
    return out


def pieces(docs: DataFrame, vocabulary: str, window: int = WINDOW, end: int = END) -> DataFrame:
    """Documents encoded, ended and cut: as many whole windows as there are, then the remainder. doc_id, start, length,
    ids (binary, little-endian unsigned 32-bit), ids_crc32, doc_tokens, and the piece's number among those of its length
    in its part."""

    def cut(batches: Iterator) -> Iterator:
        import zlib

        import pyarrow as pa
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), np.zeros(window + 1, np.int64)
        names = ["doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "part", "number"]
        most = max(1, BATCH // (4 * window))
        for batch in batches:
            for first, ids, sizes in encoded_columns(vocabulary, batch.column(1)):
                ids, sizes = np.insert(ids, np.cumsum(sizes), end), sizes + 1
                doc, start, length = windows(sizes, window)
                number = seen[length] + occurrences(length)
                seen += np.bincount(length, minlength=window + 1)
                ends = np.cumsum(length)
                for k in range(0, len(doc), most):
                    own, here, size = doc[k : k + most], ends[k : k + most], length[k : k + most]
                    raw = ids[here[0] - size[0] : here[-1]].astype("<u4").tobytes()
                    offsets = 4 * np.r_[0, np.cumsum(size)]
                    view, bounds = memoryview(raw), offsets.tolist()
                    crc = [zlib.crc32(view[a:b]) for a, b in pairwise(bounds)]
                    binary = pa.Array.from_buffers(pa.binary(), len(own), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(raw)])
                    columns = [batch.column(0).take(pa.array(first + own)), start[k : k + most], size, binary, pa.array(crc, pa.int64()), sizes[own], np.full(len(own), part, np.int32), number[k : k + most]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(cut, "doc_id long, start long, length long, ids binary, ids_crc32 long, doc_tokens long, part int, number long")


def pack(docs: DataFrame, vocabulary: str, window: int = WINDOW, end: int = END, columns: list[str] | None = None, planner: Callable = plan) -> DataFrame:
    """One row per piece of ``docs`` (doc_id, text): ``columns`` (by default doc_id, start, length, ids, ids_crc32,
    doc_tokens; length has to be there), sequence_id, offset. Sequences hold at most ``window`` ids; sequence ids and offsets have no gaps.

    A null text counts as empty: it has ``end`` alone. Repeated rows are packed as often as they occur. No rows give no
    rows. Other columns are ignored. ``planner`` makes the patterns of lengths that fill sequences. The driver sees the histogram of lengths (``window`` rows at most) and the plan that
    follows from it, whose size depends on the window alone. Pieces are numbered within their part and length; what
    comes before that is summed up over parts, so no task holds a length. Each part has one row of such sums, as many as
    the window is long; these are broadcast up to ``BROADCAST`` bytes.
    """
    cut = staged(pieces(docs, vocabulary, window, end), "pieces")
    sizes = staged(cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "sizes")
    counts = np.zeros(window + 1, np.int64)
    for row in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[row["length"]] = row["n"]
    full, counts[window] = int(counts[window]), 0
    places = Places([(full, [(window, 1)])] * bool(full) + planner(counts, window), 0)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    by_length = F.map_from_entries(F.collect_list(F.struct("length", "base")))
    bases = bases.groupBy("part").agg(bind(by_length, lambda m: F.transform(F.sequence(F.lit(1), F.lit(window)), lambda n: F.coalesce(F.try_element_at(m, n.cast("long")), F.lit(0)))).alias("bases"))
    bases = staged(bases, "bases")
    bases = F.broadcast(bases) if bases.count() * window * 8 <= BROADCAST else bases
    known = cut.sparkSession.sparkContext.broadcast((places.keys, places.rows))

    def place(batches: Iterator) -> Iterator:
        import pyarrow as pa

        own = Places.__new__(Places)
        own.keys, own.rows = known.value
        for batch in batches:
            if batch.num_rows:
                length, rank = (np.asarray(batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False), np.int64) for n in ("length", "rank"))
                sequence, offset = own(length, rank)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sequence), pa.array(offset)], [*batch.schema.names, "sequence_id", "offset"])

    ranked = cut.join(bases, "part").withColumn("rank", F.get("bases", F.col("length").cast("int") - 1) + F.col("number"))
    rows = ranked.select(*(PIECE if columns is None else columns), "rank")
    return rows.mapInArrow(place, StructType([*rows.schema.fields]).add("sequence_id", LongType()).add("offset", LongType())).drop("rank")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 ids."""
    return pack(documents(spark, sf_dir), public_tokenizers.path(WORD_BPE), columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
