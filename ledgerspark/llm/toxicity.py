"""Toxicity by a classifier chain over terms that tell toxic labels apart."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from .common import documents, scratch, staged
from .labels import labelled

#: Buckets that terms are counted in (a bound: terms that fall together count as one); terms of a lexicon at most, the
#: most telling ones; labelled rows that the linear models are fitted on at most.
BUCKETS, TERMS, SAMPLE = 1 << 20, 128, 12_000
#: Toxic rows that a term needs, how much more often it must occur in them, and letters of the word beginnings that
#: count as terms beside whole words.
SUPPORT, LIFT, STEMS = 4, 8.0, (5, 7)
#: The chain: a lexicon term is there; several are; the label itself.
CATEGORIES = ["insult", "severe", "toxic"]
SEVERE, FOLDS, PENALTY, ROUNDS = 3, 3, 1.0, 8
#: Labelled ids (two numbers each) that are broadcast at most.
BROADCAST = 1_000_000
WORDS = re.compile(r"[^\W\d_]+").findall


@lru_cache(maxsize=400_000)
def terms(word: str) -> tuple[int, ...]:
    """Buckets of a lower-case word and of its beginnings."""
    return tuple({zlib.crc32(t.encode()) % BUCKETS for t in (word, *("^" + word[:n] for n in STEMS if len(word) > n))})


def buckets_of(text: str) -> set[int]:
    return {b for w in set(WORDS(text.lower())) for b in terms(w)}


def part_of(doc_id: int | None) -> int:
    """The part of the labelled rows, for out-of-fold predictions, that an id is in."""
    return zlib.crc32(str(doc_id).encode()) // 4 % FOLDS


def hashed(rows: DataFrame) -> DataFrame:
    """doc_id and terms (different buckets) of ``rows`` (doc_id, text), with the columns after these."""
    kept = rows.columns[2:]

    def find(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = pa.array([sorted(buckets_of(t.as_py() or "")) for t in batch.column(1)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), found, *batch.columns[2:]], ["doc_id", "terms", *kept])

    schema = StructType([rows.schema[0]]).add("terms", ArrayType(IntegerType()))
    return rows.mapInArrow(find, StructType([*schema.fields, *rows.schema.fields[2:]]))


def term_counts(rows: DataFrame) -> DataFrame:
    """y, part, bucket, n: in how many rows of ``rows`` (terms, y, part) a bucket's terms occur. A task sums up in arrays
    of fixed size before anything is shuffled."""

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        sums = np.zeros((2 * FOLDS, BUCKETS), np.int32)
        for batch in batches:
            terms_, y, part = batch.columns
            group = np.repeat(np.asarray(y) * FOLDS + np.asarray(part), np.diff(np.asarray(terms_.offsets)))
            np.add.at(sums, (group, np.asarray(terms_.flatten())), 1)
        for group in range(2 * FOLDS):
            there = np.flatnonzero(sums[group])
            if len(there):
                same = lambda x: np.full(len(there), x, np.int32)  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([pa.array(same(group // FOLDS)), pa.array(same(group % FOLDS)), pa.array(there.astype(np.int32)), pa.array(sums[group][there].astype(np.int64))], ["y", "part", "bucket", "n"])

    return rows.select("terms", "y", "part").mapInArrow(count, "y int, part int, bucket int, n long").groupBy("y", "part", "bucket").agg(F.sum("n").alias("n"))


def lexicons(rows: DataFrame) -> list[list[int]]:
    """The lexicon of all of ``rows`` (terms, y, part), then for each part that of the rows of other parts: buckets of
    terms that ``SUPPORT`` toxic rows hold, ``LIFT`` times as often as other rows do, the ``TERMS`` most telling ones.
    No more than these come to the driver. Nothing without rows of both kinds."""
    sizes = {(r["y"], r["part"]): r["n"] for r in rows.groupBy("y", "part").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len({y for y, _ in sizes}) < 2:
        return []
    cells = [(y, k) for y in (0, 1) for k in range(FOLDS)]
    of = lambda y, k: F.sum(F.when((F.col("y") == y) & (F.col("part") == k), F.col("n")).otherwise(0)).alias(f"n{y}_{k}")
    counts = staged(term_counts(rows).groupBy("bucket").agg(*[of(y, k) for y, k in cells]), "terms")

    def without(left_out: int | None) -> list[int]:
        parts = [k for k in range(FOLDS) if k != left_out]
        sums = [sum((F.col(f"n{y}_{k}") for k in parts), F.lit(0)) for y in (0, 1)]
        n_clean, n_toxic = (sum(sizes.get((y, k), 0) for k in parts) for y in (0, 1))
        if not n_toxic or not n_clean:
            return []
        lift = (sums[1] + 0.5) / (sums[0] + 0.5) * (n_clean / n_toxic)
        telling = counts.where((sums[1] >= SUPPORT) & (lift >= LIFT)).orderBy(F.desc(sums[1] * F.log(lift)), "bucket").limit(TERMS)
        return [r["bucket"] for r in telling.select("bucket").collect()]

    return [without(k) for k in (None, *range(FOLDS))]


def hits(docs: DataFrame, chosen: list[int]) -> DataFrame:
    """row_id, doc_id, hits (which terms of the lexicon occur, as their numbers) and n_words of every row."""
    number = {b: k for k, b in enumerate(chosen)}

    def find(batches: Iterator) -> Iterator:
        import pyarrow as pa

        near: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            found, sizes = [], []
            for text in batch.column(2):
                words = WORDS((text.as_py() or "").lower())
                own: set[int] = set()
                for w in set(words):
                    if (at := near.get(w)) is None:
                        if len(near) > 400_000:
                            near.clear()
                        at = near[w] = tuple(number[b] for b in terms(w) if b in number)
                    own.update(at)
                found.append(sorted(own))
                sizes.append(len(words))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32())), pa.array(sizes, pa.int64())], ["row_id", "doc_id", "hits", "n_words"])

    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(find, "row_id long, doc_id long, hits array<int>, n_words long")


def inputs(found: list, n_words: list, lexicon: np.ndarray) -> np.ndarray:
    """A column for each term of ``lexicon``, then the number of terms (logarithm) and their share of the words, and a
    constant. ``lexicon`` gives the column of each term number in ``found``, or -1."""
    width = int(lexicon.max(initial=-1)) + 1
    out = np.zeros((len(found), width + 3))
    for k, (own, n) in enumerate(zip(found, n_words, strict=True)):
        at = lexicon[own] if len(own) else lexicon[:0]
        at = at[at >= 0]
        out[k, at] = 1
        out[k, width : width + 2] = np.log1p(len(at)), len(at) / max(1, n)
    out[:, -1] = 1
    return out


def targets(found: list, y: np.ndarray, lexicon: np.ndarray) -> list[np.ndarray]:
    """The chain's categories of labelled rows, by one lexicon."""
    n = np.array([(lexicon[own] >= 0).sum() if len(own) else 0 for own in found])
    return [y * (n >= 1), y * (n >= SEVERE), y]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Weights of a ridge logistic model for rows that stand ``w`` times, by Newton's method."""
    weights = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], PENALTY)
    ridge[-1] = 1e-3
    for _ in range(ROUNDS):
        p = sigmoid(x @ weights)
        step = np.linalg.solve((x * (w * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge), x.T @ (w * (y - p)) - ridge * weights)
        weights += step
        if np.abs(step).max() < 1e-3:
            break
    return weights


class Chain:
    """A linear model for each category; later ones read the probabilities of earlier ones too.

    What later models are trained with, and the threshold comes from, is said of each row by models that have seen
    neither the row's label nor a lexicon or weak label that it took part in: those of a part's complement, with its own
    lexicon. ``lexicons``: that of all rows, then that of each part's complement. ``depth``: categories, from the last.
    """

    def __init__(self, found: list, n_words: list, y: np.ndarray, w: np.ndarray, parts: np.ndarray, lexicons: list[np.ndarray], depth: int = len(CATEGORIES)):
        self.models, self.lexicon = [], lexicons[0]
        xs, ts = [inputs(found, n_words, own) for own in lexicons], [targets(found, y, own)[-depth:] for own in lexicons]
        for c in range(depth):
            self.models.append(logistic(xs[0], ts[0][c], w))
            unseen = np.zeros(len(y))
            for k in range(FOLDS):
                rest = parts != k
                if rest.any() and not rest.all():
                    unseen[~rest] = sigmoid(xs[k + 1][~rest] @ logistic(xs[k + 1][rest], ts[k + 1][c][rest], w[rest]))
            xs = [np.column_stack([unseen, x]) for x in xs]
        self.threshold = best_threshold(unseen, y, w)

    def __call__(self, found: list, n_words: list) -> np.ndarray:
        x, out = inputs(found, n_words, self.lexicon), []
        for weights in self.models:
            out.append(sigmoid(x @ weights))
            x = np.column_stack([out[-1], x])
        return np.array(out)


def best_threshold(p: np.ndarray, y: np.ndarray, w: np.ndarray) -> float:
    """The probability from which predicting 1 has the largest F1 measure."""
    order = np.argsort(-p, kind="stable")
    hit, all_ = np.cumsum((w * y)[order]), np.cumsum(w[order])
    f1 = 2 * hit / (all_ + (w * y).sum())
    f1[:-1][np.diff(p[order]) == 0] = 0
    return float(p[order][np.argmax(f1)]) if len(p) and y.any() else 2.0


def fitted(known: DataFrame, lexicons: list[np.ndarray], depth: int = len(CATEGORIES)) -> Chain | None:
    """A chain from at most ``SAMPLE`` rows of ``known`` (row_id, doc_id, hits, n_words, y), those of smallest hash; equal
    inputs are put together."""
    rows = known.orderBy(F.xxhash64("doc_id"), "row_id").limit(SAMPLE).collect()
    if not rows:
        return None
    groups: dict[tuple, int] = {}
    for r in rows:
        key = (tuple(r["hits"]), r["n_words"] if r["hits"] else 0, r["y"], part_of(r["doc_id"]))
        groups[key] = groups.get(key, 0) + 1
    keys = sorted(groups)
    found = [np.array(k[0], np.int64) for k in keys]
    return Chain(found, [k[1] for k in keys], np.array([k[2] for k in keys], float), np.array([groups[k] for k in keys], float), np.array([k[3] for k in keys]), lexicons, depth)


def toxic(docs: DataFrame, labels: DataFrame, depth: int = len(CATEGORIES)) -> DataFrame:
    """doc_id, p_insult, p_severe, p_toxic (the last ``depth`` of them), toxic (0 or 1) of every row of ``docs`` (doc_id,
    text), from ``labels`` (doc_id, y).

    The chain's categories come from the label and the lexicon that the labelled rows give: insult (a toxic row with a
    term of it), severe (with ``SEVERE`` or more), toxic (the label). Terms are counted over all labelled rows; the linear
    models are fitted on ``SAMPLE`` of them at most. Scores depend on texts alone. A null text counts as empty. Repeated
    rows get equal scores. No rows give no rows; without labels of both kinds all probabilities are 0 and nothing is
    toxic. Labels are joined to texts by a broadcast up to ``BROADCAST`` rows, and else by a shuffle of the texts' terms.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    names = CATEGORIES[-depth:]
    with scratch(docs.sparkSession):
        few = staged(labels.select("doc_id", "y", part_column().alias("part")), "labels")
        known = hashed(rows.join(F.broadcast(few), "doc_id")) if few.count() <= BROADCAST else hashed(rows).join(few, "doc_id")
        own = lexicons(staged(known, "known"))
    chosen = sorted(set().union(*own))
    found = staged(hits(docs, chosen), "hits")
    columns = []
    for lexicon in own:
        columns.append(np.full(len(chosen), -1, np.int64))
        columns[-1][np.searchsorted(chosen, lexicon)] = np.arange(len(lexicon))
    chain = fitted(found.join(labels, "doc_id"), columns, depth) if own and own[0] else None

    def score(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for first in range(0, batch.num_rows, 4096):
                part = batch.slice(first, 4096)
                p = chain([np.array(h, np.int64) for h in part.column(2).to_pylist()], part.column(3).to_pylist()) if chain else np.zeros((depth, part.num_rows))
                flag = (p[-1] >= (chain.threshold if chain else 2.0)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column(1), *map(pa.array, p), pa.array(flag)], ["doc_id", *[f"p_{c}" for c in names], "toxic"])

    return found.mapInArrow(score, "doc_id long, " + ", ".join(f"p_{c} double" for c in names) + ", toxic int")


def part_column():
    """``part_of`` as a column of doc_id."""
    return (F.expr("crc32(cast(cast(doc_id as string) as binary)) div 4") % FOLDS).cast("int")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents."""
    return toxic(documents(spark, sf_dir), labelled(spark, sf_dir, "toxic"))
