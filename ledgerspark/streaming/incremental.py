"""Incremental runs with Structured Streaming: what is new is merged into a snapshot table."""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: A bucket: how many low bits of a key's hash it goes by, and these bits.
Bucket = tuple[int, int]


class Snapshots:
    """Versions of a table under ``folder``, cut into buckets by the low bits of a key's hash. A version is a list of
    buckets: which batch wrote each last, and its rows. A batch writes the buckets only that it touches; one that gets
    more than ``capacity`` rows is split as it is written, by as many more bits as that takes, so buckets stay as large
    as they were while the table grows, and a batch of few keys rewrites an ever smaller share. Data come before the list;
    a failed batch leaves the last version whole, and a batch that is run again replaces its own files only. The last
    ``keep`` versions stay for readers; what only older ones use is removed.
    """

    def __init__(self, spark: SparkSession, folder: str, capacity: int = 1_000_000, keep: int = 3):
        self.spark, self.folder, self.capacity, self.keep = spark, folder, capacity, keep
        self.paths = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.fs = self.paths(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def there(self, path: str) -> bool:
        return self.fs.exists(self.paths(path))

    def version(self, number: int) -> str:
        return f"{self.folder}/version-{number:09d}"

    def data(self, bucket: Bucket, batch: int) -> str:
        return f"{self.folder}/data-{batch:09d}/bucket={bucket[0]}-{bucket[1]}"

    def latest(self) -> int | None:
        """The number of the last version, read off the folder's own list."""
        root = self.paths(self.folder)
        names = [s.getPath().getName() for s in self.fs.listStatus(root)] if self.fs.exists(root) else []
        found = [int(m[1]) for n in names if (m := re.fullmatch(r"version-(\d+)", n)) and self.there(f"{self.folder}/{n}/_SUCCESS")]
        return max(found, default=None)

    def directory(self, number: int) -> dict[Bucket, tuple[int, int]]:
        """Batch and rows of each bucket. One row a bucket, so a table's rows over the capacity."""
        return {(r["depth"], r["id"]): (r["batch"], r["n"]) for r in self.spark.read.parquet(self.version(number)).collect()}

    def buckets(self, number: int) -> dict[Bucket, int]:
        return {b: batch for b, (batch, _) in self.directory(number).items()}

    def read(self, of: dict[Bucket, int]) -> DataFrame | None:
        """The rows of the buckets ``of`` (bucket to batch); a bucket without rows has no files."""
        found = [p for b, batch in of.items() if self.there(p := self.data(b, batch))]
        return self.spark.read.parquet(*found) if found else None

    def located(self, rows: DataFrame, key: str | None, targets: dict[Bucket, int]) -> DataFrame:
        """``rows`` with the bucket (``__depth``, ``__id``) of each and, as ``bucket``, the name of the one of ``targets`` depth
        that it goes to."""
        low = F.xxhash64(key) if key else F.lit(0).cast("long")
        bits = lambda depth: low.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), depth) - 1)
        places = F.array(*[F.struct(F.lit(d).alias("__depth"), bits(F.lit(d)).alias("__id")) for d in sorted({d for d, _ in targets})])
        known = self.spark.createDataFrame([(d, k, t) for (d, k), t in targets.items()], "__depth int, __id long, __target int")
        found = rows.withColumn("__place", F.explode(places)).select("*", "__place.*").drop("__place").join(F.broadcast(known), ["__depth", "__id"])
        return found.withColumn("bucket", F.concat_ws("-", "__target", bits(F.col("__target")))).drop("__target")

    def apply(self, number: int, new: DataFrame, key: str | None, merge: Callable[[DataFrame | None, DataFrame], DataFrame]) -> None:
        """Version ``number``: the one before, with ``new`` merged into the buckets that it touches."""
        known: dict[Bucket, tuple[int, int]] = {(0, 0): (-1, 0)}
        if number:
            if not self.there(f"{self.version(number - 1)}/_SUCCESS"):
                raise RuntimeError(f"version {number - 1} of {self.folder} is missing")
            known = self.directory(number - 1)
        come = {(r["__depth"], r["__id"]): r["n"] for r in self.located(new, key, {b: b[0] for b in known}).groupBy("__depth", "__id").agg(F.count(F.lit(1)).alias("n")).collect()}
        more = lambda n: math.ceil(math.log2(n / self.capacity)) if key and n > self.capacity else 0
        targets = {b: b[0] + more(known[b][1] + n) for b, n in come.items()}
        merged = merge(self.read({b: known[b][0] for b in come}), new)
        written = f"{self.folder}/data-{number:09d}"
        if come:
            self.located(merged, key, targets).drop("__depth", "__id").write.mode("overwrite").partitionBy("bucket").parquet(written)
        rows = self.spark.read.parquet(written).groupBy(F.col("bucket").cast("string").alias("bucket")).count().collect() if come and not merged.isEmpty() else []
        sizes = {r["bucket"]: r["count"] for r in rows}
        made = {(t, k | high << d): (number, sizes.get(f"{t}-{k | high << d}", 0)) for (d, k), t in targets.items() for high in range(1 << t - d)}
        after = {b: x for b, x in known.items() if b not in come} | made
        rows = [(d, k, batch, n) for (d, k), (batch, n) in after.items()]
        self.spark.createDataFrame(rows, "depth int, id long, batch int, n long").coalesce(1).write.mode("overwrite").parquet(self.version(number))
        self.forget(number - self.keep)

    def forget(self, number: int) -> None:
        """Remove version ``number`` and the data that no later one uses."""
        if number < 0 or not self.there(self.version(number)):
            return
        later = set(self.buckets(number + 1).items())  # what the next version dropped, no later one has
        for bucket, batch in self.buckets(number).items():
            if (bucket, batch) not in later:
                self.fs.delete(self.paths(self.data(bucket, batch)), True)
        self.fs.delete(self.paths(self.version(number)), True)


def run_incremental(spark: SparkSession, source: str, schema, folder: str, merge: Callable[[DataFrame | None, DataFrame], DataFrame], key: str | None = None, prepare=None, capacity: int = 1_000_000) -> DataFrame:
    """Take every file of ``source`` that no earlier run took and merge it into the snapshot under ``folder``.

    ``prepare(rows)`` gives rows with the column ``key`` (by default they have it), and with ``arrived``, when their file
    was written, if it keeps that. ``merge(rows of the touched buckets or None, batch)`` gives these buckets anew; it
    must keep every key. Without a ``key`` all rows are one bucket. A batch whose predecessor's version is missing fails. Without any row the result is empty.
    """
    prepare = prepare or (lambda rows: rows.drop("arrived"))
    table = Snapshots(spark, folder, capacity)
    stream = spark.readStream.schema(schema).parquet(source).select("*", F.col("_metadata.file_modification_time").alias("arrived"))
    apply = lambda batch, number: table.apply(number, prepare(batch), key, merge)
    query = stream.writeStream.foreachBatch(apply).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).queryName(f"run_{uuid.uuid4().hex}").start()
    query.awaitTermination()
    last = table.latest()
    found = table.read(table.buckets(last)) if last is not None else None
    if found is None:
        nothing = spark.createDataFrame([], schema).withColumn("arrived", F.lit(None).cast("timestamp"))
        return merge(None, prepare(nothing))
    return found.drop("bucket")
