"""Quality scores: random Fourier features of text statistics, ridge by partition-summed normal equations, isotonic
calibration."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType

from .common import documents, scratch, staged, whole_row
from .labels import HELD_OUT, few, fold, labelled

#: Random features, ridge penalty for each labelled row, seed, fold for calibration, bins of a raw score's unit.
FEATURES, PENALTY, SEED, CALIBRATION, BINS = 256, 1e-4, 20, 3, 200
THRESHOLD = 0.7
#: Partial sums that one task, or the driver, adds up at most.
FAN_IN = 32
KINDS = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&<>", b"|", b"!", b".,;:?", b"()[]{}\"'`/\\=+_~^@-", bytes(range(128, 192)), b"\n"]


def text_statistics(text: str) -> list[float]:
    """Statistics of a whole text. Shares are of bytes, words or lines; an empty text has zeros."""
    raw = text.encode()
    words, size = raw.split(), max(1, len(raw))
    n = max(1, len(words))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    lengths = list(map(len, words))
    own = set(words)
    low = len({w.lower() for w in own})
    out = [math.log1p(len(words)), sum(lengths) / n, math.log1p(max(lengths, default=0)), sum(x <= 3 for x in lengths) / n]
    out += [(len(raw) - len(raw.translate(None, kind))) / size for kind in KINDS]
    out += [len(own) / n, low / n, math.log1p(len(lines)), 1 - len(set(lines)) / max(1, len(lines)), math.log1p(n / max(1, len(lines)))]
    # words that come with the same next word as before: phrases said again
    out.append(1 - len(set(zip(words, words[1:], strict=False))) / max(1, len(words) - 1) if len(words) > 1 else 0.0)
    return out


WIDTH = len(text_statistics(""))


def with_statistics(docs: DataFrame, carry: list[str]) -> DataFrame:
    """doc (struct of ``carry``), doc_id and stats (array) of every row."""

    def add(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            stats = pa.array([text_statistics(t.as_py() or "") for t in batch.column(2)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), stats], ["doc", "doc_id", "stats"])

    rows = docs.select(whole_row(carry).alias("doc"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = StructType([*rows.schema.fields[:2]]).add("stats", ArrayType(DoubleType()))
    return rows.mapInArrow(add, schema)


def matrix(column) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), float).reshape(len(column), -1)


class Kernel:
    """Random Fourier features of a Gaussian kernel over statistics scaled to unit variance."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray):
        rng = np.random.default_rng(SEED)
        self.mean, self.spread = mean, spread
        self.turn = rng.normal(size=(len(mean), FEATURES)) / math.sqrt(len(mean))
        self.shift = rng.uniform(0, 2 * math.pi, FEATURES)

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        scaled = np.clip((stats - self.mean) / self.spread, -8, 8)
        waves = np.cos(scaled @ self.turn + self.shift) * math.sqrt(2 / FEATURES)
        return np.hstack([waves, scaled, np.ones((len(stats), 1))])


def summed(rows: DataFrame, part, fan_in: int = FAN_IN) -> np.ndarray | None:
    """The sum of ``part(stats, y)`` (a flat array) over all batches of ``rows`` (stats, y): first within a partition,
    then level by level over ``fan_in`` sums, the last of them on the driver. None if there are no rows."""

    def partial(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        total = None
        for batch in batches:
            if batch.num_rows:
                own = part(matrix(batch.column(0)), np.asarray(batch.column(1).to_numpy(zero_copy_only=False), float))
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_pydict({"k": pa.array([TaskContext.get().partitionId()], pa.int32()), "sums": [total.tobytes()]})

    def add(table):
        import pyarrow as pa

        total = np.zeros(0)
        for raw in table.column("sums"):
            own = np.frombuffer(raw.as_py())
            total = own + total if len(total) else own
        return pa.table({"k": table.column("k").slice(0, 1), "sums": pa.array([total.tobytes()], pa.binary())})

    left = rows.rdd.getNumPartitions()
    sums = rows.select("stats", "y").mapInArrow(partial, "k int, sums binary")
    while left > fan_in:
        sums = sums.select(F.expr(f"k div {fan_in}").cast("int").alias("k"), "sums").groupBy("k").applyInArrow(add, "k int, sums binary")
        left = -(-left // fan_in)
    got = sums.collect()
    return sum(np.frombuffer(r["sums"]) for r in got) if got else None


class Model:
    def __init__(self, kernel: Kernel | None, weights: np.ndarray | None, steps: tuple[np.ndarray, np.ndarray]):
        self.kernel, self.weights, self.steps = kernel, weights, steps

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.kernel(stats) @ self.weights if self.kernel else np.zeros(len(stats))

    def score(self, stats: np.ndarray) -> np.ndarray:
        """Calibrated, with a thousandth of the raw score's own order within a level of the calibration."""
        if self.kernel is None:
            return np.ones(len(stats))
        raw = self.raw(stats)
        return 0.999 * np.interp(raw, *self.steps) + 0.001 / (1 + np.exp(-raw))


def isotonic(at: np.ndarray, weight: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: rising levels, at their pools' mean positions."""
    pools: list[list[float]] = []
    for x, w, y in zip(at, weight, share, strict=True):
        pools.append([x * w, w, y * w])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            x2, w2, y2 = pools.pop()
            pools[-1] = [pools[-1][0] + x2, pools[-1][1] + w2, pools[-1][2] + y2]
    return np.array([p[0] / p[1] for p in pools]), np.array([p[2] / p[1] for p in pools])


def ridge(gram: np.ndarray, moment: np.ndarray, n: float) -> np.ndarray:
    """Weights that minimise the squared error of ``n`` rows plus ``PENALTY`` (n + 100) times the weights' square."""
    return np.linalg.solve(gram + PENALTY * (n + 100) * np.eye(len(gram)), moment)


def fitted(rows: DataFrame) -> Model:
    """A model from every row of ``rows`` (stats, y, calibrates), a staged table. Without rows the score is 1."""
    fit, calibrate = rows.where("not calibrates"), rows.where("calibrates")
    sums = summed(rows, lambda x, y: np.r_[len(y), x.sum(axis=0), (x**2).sum(axis=0)])
    if sums is None:
        return Model(None, None, (np.array([0.0]), np.array([1.0])))
    mean = sums[1 : 1 + WIDTH] / sums[0]
    kernel = Kernel(mean, np.sqrt(np.maximum(sums[1 + WIDTH :] / sums[0] - mean**2, 0)) + 1e-6)

    def normal(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = kernel(x)
        return np.r_[(z.T @ z).ravel(), z.T @ y, len(y)]

    wide = FEATURES + WIDTH + 1
    sums = summed(fit, normal)
    sums = summed(rows, normal) if sums is None else sums
    weights = ridge(sums[: wide**2].reshape(wide, wide), sums[wide**2 : -1], sums[-1])
    model = Model(kernel, weights, (np.array([0.0]), np.array([1.0])))

    def binned(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        at = np.clip(np.rint((model.raw(x) + 1) * BINS), 0, 3 * BINS).astype(int)
        return np.r_[np.bincount(at, minlength=3 * BINS + 1), np.bincount(at, y, 3 * BINS + 1)].astype(float)

    counts = summed(calibrate, binned)
    counts = summed(rows, binned) if counts is None else counts
    n, good = counts.reshape(2, -1)
    there = n > 0
    model.steps = isotonic(np.arange(3 * BINS + 1)[there] / BINS - 1, n[there], good[there] / n[there])
    return model


def scored(docs: DataFrame, labels: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """doc (struct of ``carry``; by default of all columns), doc_id, score, predicted of every row of ``docs``
    (doc_id, text), by a model from ``labels`` (doc_id, y).

    Labels are joined to statistics, not texts; every labelled row counts. Scores depend on texts alone. A null text
    counts as empty and gets a score too. Repeated rows get equal scores. No rows give no rows; no labels give score 1;
    labels of one kind only give that kind.
    """
    rows = staged(with_statistics(docs, docs.columns if carry is None else carry), "statistics")
    with scratch(docs.sparkSession):
        known = rows.select("doc_id", "stats").join(F.broadcast(labels) if few(labels) else labels, "doc_id").select("stats", "y", (fold() == CALIBRATION).alias("calibrates"))
        model = fitted(staged(known, "labelled"))

    def add(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = model.score(matrix(batch.column(2))) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.float64())], ["doc", "doc_id", "score"])

    out = rows.mapInArrow(add, StructType([*rows.schema.fields[:2]]).add("score", DoubleType()))
    return out.withColumn("score", F.greatest(F.least("score", F.lit(1.0)), F.lit(0.0))).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def kept_by_model(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the model predicts as good, with all their columns."""
    return scored(docs, labels).where("predicted = 1").select("doc.*")


def op8_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents."""
    out = scored(documents(spark, sf_dir), labelled(spark, sf_dir, "quality"), ["doc_id"])
    return out.select("doc_id", (fold() == HELD_OUT).alias("held_out"), "score", "predicted")
