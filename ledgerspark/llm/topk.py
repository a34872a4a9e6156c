"""Exact top-k inner products by columnar branch-and-bound."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from .common import staged

#: Vectors in a block of queries and in a block of candidates at most; candidates in a block at least, if there are so many.
QUERIES, CANDIDATES, FEWEST = 8192, 16384, 2048
#: Dimensions accumulated between two prunings; candidates in the first runs of a block, the longest ones, and in later ones.
DIMENSIONS, RUNS = 16, (1024, 4096)
#: Queries whose scores grow together; share of survivors below which they are moved together.
TOGETHER, COMPACTED = 64, 0.8
#: Longest vectors that are broadcast to give each query a first bound.
SEEDS = 1024


def runs(count: int) -> Iterator[slice]:
    at, sizes = 0, iter(RUNS)
    size = 0
    while at < count:
        size = next(sizes, size)
        yield slice(at, min(count, at + size))
        at += size


def best(queries: np.ndarray, candidates: np.ndarray, ids: np.ndarray, skip: np.ndarray, k: int, least: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each query: positions and scores of its ``k`` best candidates of score ``least`` or more (score, then smaller
    id).

    ``candidates`` lie vertically, a row for each dimension, the longest vectors first. ``skip`` is the position of a
    query's own row, or -1. A run of candidates of which even the longest can't reach the k-th score so far is left out.
    In the others, the scores of some queries grow together, block by block of dimensions. What the rest can still add or
    take is at most the product of the two rests' lengths (Cauchy and Schwarz). A candidate whose upper bound is below a
    query's k-th score, or below its k-th largest lower bound in the run, is out for that query; those that are out for
    all of these queries leave, and the survivors are moved together.
    """
    width, count = candidates.shape
    cuts = [*range(0, width, DIMENSIONS), width] if width else [0, 0]
    c_rest = [np.sqrt((candidates[at:].astype(float) ** 2).sum(axis=0)) for at in cuts]
    margin = 1 if queries.dtype == np.float64 else 4096
    for first_query in range(0, len(queries), TOGETHER):
        some = slice(first_query, first_query + TOGETHER)
        part, floor = queries[some], least[some].copy()
        kept = [(np.empty(0, np.int64), np.empty(0, queries.dtype))] * len(part)
        # rounding is covered by this factor and the margin; integers beyond 2^53 are compared as doubles
        q_rest = [np.sqrt((part[:, at:].astype(float) ** 2).sum(axis=1)) * (1 + 1e-9) for at in cuts]
        for run in runs(count):
            reached = np.flatnonzero(q_rest[0] * c_rest[0][run.start] + margin >= floor)
            if not len(reached):
                break
            live, scores = np.arange(run.start, run.stop), np.zeros((len(reached), run.stop - run.start), queries.dtype)
            there = live[None, :] != skip[some][reached][:, None]
            for low, high, at in zip(cuts, cuts[1:], range(1, len(cuts)), strict=False):
                scores += part[reached, low:high] @ candidates[low:high, live]
                slack = q_rest[at][reached][:, None] * c_rest[at][live][None, :] + margin
                lower = floor[reached]
                if len(live) > k and (open_ := np.flatnonzero(lower == -np.inf)).size:
                    sure = np.where(there[open_], scores[open_] - slack[open_], -np.inf)
                    lower[open_] = np.partition(sure, len(live) - k, axis=1)[:, len(live) - k]
                there &= scores + slack >= lower[:, None]
                wanted = there.any(axis=0)
                if wanted.mean() < COMPACTED:
                    live, scores, there = live[wanted], scores[:, wanted], there[:, wanted]
            for n, q in enumerate(reached):
                own = np.flatnonzero(there[n])
                at, found = np.r_[kept[q][0], live[own]], np.r_[kept[q][1], scores[n, own]]
                order = np.lexsort((ids[at], -found))[:k]
                kept[q] = at[order], found[order]
                if len(order) == k:
                    floor[q] = max(floor[q], kept[q][1][-1])
        for q, (live, scores) in enumerate(kept):
            keep = scores >= least[first_query + q]
            yield live[keep], scores[keep]


def matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    return np.asarray(flat.flatten().to_numpy(zero_copy_only=False), np.int64).reshape(len(flat), -1)


def kind_for(*blocks: np.ndarray) -> type:
    """float, in which whole numbers below 2^53 are exact, if no score can be larger; else 64-bit integers."""
    bound = float(blocks[0].shape[-1]) if len(blocks[0]) else 1.0
    for x in blocks:
        bound *= float(np.abs(x).max(initial=0))
    return np.float64 if bound < 2**52 else np.int64


def vertical(block: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Candidates by falling length: vertical layout, ids, row numbers."""
    order = np.argsort(-(block.astype(float) ** 2).sum(axis=1), kind="stable")
    return np.ascontiguousarray(block[order].T), ids[order], rows[order]


def positions(rows: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    where = {r: at for at, r in enumerate(rows.tolist())}
    return np.array([where.get(r, -1) for r in wanted.tolist()], np.int64)


def with_floor(asked: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """``asked`` with a score that each query's k best reach: the k-th among the ``SEEDS`` longest vectors."""
    seeds = rows.where(~F.col("big")).orderBy(F.desc("norm"), "row").limit(SEEDS).select("row", "id", "width", "v").collect()
    by_width: dict[int, list] = {}
    for r in seeds:
        by_width.setdefault(r["width"], []).append(r)
    blocks = {w: vertical(np.array([r["v"] for r in own], np.int64).reshape(len(own), w), *(np.array([r[c] for r in own], np.int64) for c in ("id", "row"))) for w, own in by_width.items()}
    known = asked.sparkSession.sparkContext.broadcast(blocks)
    names = asked.columns

    def add(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            at = {n: batch.schema.get_field_index(n) for n in names}
            widths, big = (np.asarray(batch.column(at[n]).to_numpy(zero_copy_only=False)) for n in ("width", "big"))
            own_rows = np.asarray(batch.column(at["row"]).to_numpy(zero_copy_only=False), np.int64)
            floor = np.full(batch.num_rows, -np.inf)
            for width, (c, ids, c_rows) in known.value.items():
                here = np.flatnonzero((widths == width) & ~big)
                if len(here):
                    q = matrix(batch.column(at["v"]).take(pa.array(here)))
                    kind = kind_for(q, c)
                    found = best(q.astype(kind), c.astype(kind), ids, positions(c_rows, own_rows[here]), k, np.full(len(q), -np.inf))
                    floor[here] = [float(s[-1]) - (abs(float(s[-1])) * 1e-15 if kind is np.int64 else 0) if len(s) == k else -np.inf for _, s in found]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(floor)], [*names, "floor"])

    return asked.mapInArrow(add, StructType([*asked.schema.fields]).add("floor", DoubleType()))


def top_k(vectors: DataFrame, is_query, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = 64) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` rows of largest inner product with each row for which ``is_query``, but
    itself; ties go to the smaller id. Components x count as floor(scale * x).

    Null vectors, and those with null or non-finite components, take no part, nor do rows without an id. Vectors meet
    others of their own length only; empty ones score 0. Of repeated rows each is a candidate, and a query of its own if
    it is one. Fewer than k others: all. No rows give no rows. Other columns are ignored. Scores are exact whatever the
    components: vectors so large that a score might not fit in 64 bits are scored in whole numbers of any size. A
    component beyond 64 bits, or such a score among a query's best, is an error.

    Queries are a stated set. A first pass gives each a bound from the ``SEEDS`` longest vectors. Then queries and
    candidates are dealt into blocks of bounded size by row number; each pair of blocks is one task, which returns what
    reaches the query's bound, k rows a query at most. There are few blocks of queries, as each is sent all candidates. A
    common vector is spread over blocks like any other.
    """
    whole = F.transform(embedding, lambda x: F.floor(F.lit(scale) * x.cast("double")))
    top = F.aggregate(embedding, F.lit(0.0), lambda acc, x: F.greatest(acc, F.abs(F.lit(scale) * x.cast("double")) + 1))
    fit = F.col(vec_id).isNotNull() & F.col(embedding).isNotNull() & F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    rows = vectors.where(fit).select(F.col(vec_id).cast("long").alias("id"), whole.alias("v"), F.size(embedding).alias("width"), is_query.alias("asks"), top.alias("top"), F.monotonically_increasing_id().alias("row"))
    rows = rows.withColumn("v", F.when(F.col("top") >= 2.0**63, F.raise_error(F.lit("a component beyond 64 bits"))).otherwise(F.col("v")))
    norm = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    rows = rows.withColumns({"big": F.col("top") * F.col("top") * F.col("width") >= 2.0**62, "norm": norm}).drop("top")
    rows = staged(rows, "vectors")
    counts = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("asks"), 1)).alias("q")).first()
    q_blocks = math.ceil(counts["q"] / QUERIES) or 1
    most = math.ceil(2 * vectors.sparkSession.sparkContext.defaultParallelism / q_blocks)
    c_blocks = max(math.ceil(counts["n"] / CANDIDATES), min(most, math.ceil(counts["n"] / FEWEST))) or 1
    block = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = staged(with_floor(rows.where("asks").select("row", "id", "width", "big", "v"), rows, k), "asked")
    asked = asked.select("width", block(q_blocks).alias("qb"), each(c_blocks).alias("cb"), "row", "id", "big", "v", "floor")
    there = rows.select("width", each(q_blocks).alias("qb"), block(c_blocks).alias("cb"), "row", "id", "big", "v")

    def meet(left, right):
        import pyarrow as pa

        out = {"query_row": [], "query_id": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            q, c = matrix(left.column("v")), matrix(right.column("v"))
            q_rows, q_ids, c_rows, c_ids = (np.asarray(t.column(n).to_numpy(), np.int64) for t in (left, right) for n in ("row", "id"))
            q_big, c_big = (np.asarray(t.column("big").to_numpy()) for t in (left, right))
            floor = np.asarray(left.column("floor").to_numpy())
            few, many = np.flatnonzero(~q_big), np.flatnonzero(~c_big)
            kind = kind_for(q[few], c[many])
            laid, ids, rows_c = vertical(c[many], c_ids[many], c_rows[many])
            found = [[] for _ in range(len(q))]
            for n, (at, scores) in zip(few, best(q[few].astype(kind), laid.astype(kind), ids, positions(rows_c, q_rows[few]), k, floor[few]), strict=True):
                found[n] = [(-int(s), int(i)) for s, i in zip(scores, ids[at], strict=True)]
            for n in range(len(q)):
                beside = np.flatnonzero(np.ones(len(c), bool) if q_big[n] else c_big)
                if len(beside):
                    exact = c[beside].astype(object) @ q[n].astype(object) if c.shape[1] else np.zeros(len(beside), int)
                    found[n] += [(-int(s), int(i)) for s, i, r in zip(exact, c_ids[beside], c_rows[beside], strict=True) if r != q_rows[n]]
                own = sorted(found[n])[:k]
                out["query_row"] += [int(q_rows[n])] * len(own)
                out["query_id"] += [int(q_ids[n])] * len(own)
                out["score"] += [-s for s, _ in own]
                out["vec_id"] += [i for _, i in own]
        return pa.table({n: pa.array(x, pa.int64()) for n, x in out.items()})

    near = asked.groupBy("width", "qb", "cb").cogroup(there.groupBy("width", "qb", "cb")).applyInArrow(meet, "query_row long, query_id long, vec_id long, score long")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every row of ``embeddings`` whose vec_id is divisible by 20."""
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)
