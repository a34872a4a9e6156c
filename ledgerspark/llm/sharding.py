"""Rendezvous hashing of records over weighted shards. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import column, documents, staged, text_or_empty

#: Rows that one task numbers, about.
SLOT_ROWS = 200_000


def score(key: Column, shard: int, weight: float) -> Column:
    """A shard's draw for a key: -weight / ln(u), u in (0, 1) from the hash of both. The largest draw wins."""
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.lit(float(weight)) / F.log(u)


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a key: it depends on the key, the shards' numbers and their weights alone. A further shard takes
    keys into itself only, as the draws of the others stay. Ties (of probability 2^-53) go to the larger number."""
    draws = [F.struct(score(key, s, w).alias("draw"), F.lit(s).alias("shard")) for s, w in enumerate(weights)]
    return (F.greatest(*draws) if len(draws) > 1 else draws[0])["shard"]


def sharded(docs: DataFrame, weights: Sequence[float], grown: Sequence[float], key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs`` (``key``, text): key, size, text_crc32, shard, slot, grown_shard.

    ``weights`` are the shards'; ``grown`` those with further shards. size is the text's UTF-8 bytes plus 1; a null
    text counts as empty. Keys are hashed as longs, so a key has one shard whatever integer type its column has; a null key
    is a key like any other. Slots count from 0 in each shard without a gap, by
    bucket, key and row; rows of one key, however many, are dealt over many buckets by their row number. No rows give no
    rows. Other columns are ignored.

    Slots take two steps, so that no task holds a shard: rows are numbered in buckets of about ``SLOT_ROWS``, and a
    bucket starts where the sizes of those before it in its shard add up to.
    """
    text, own = text_or_empty(), column(key).cast("long")
    rows = docs.select(
        own.alias(key),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        rendezvous(own, weights).cast("int").alias("shard"),
        rendezvous(own, grown).cast("int").alias("grown_shard"),
        F.monotonically_increasing_id().alias("row_id"),
    )
    rows = staged(rows, "shards")
    buckets = rows.count() // SLOT_ROWS // len(weights) + 16
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("row_id"), F.lit(buckets)))
    sizes = rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = staged(sizes.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "bases")
    own = Window.partitionBy("shard", "bucket").orderBy(F.col(key).asc_nulls_first(), "row_id")
    numbered = rows.withColumn("at", F.row_number().over(own) - 1)
    return numbered.join(bases, ["shard", "bucket"]).select(
        key, "size", "text_crc32", "shard", (F.col("base") + F.col("at")).cast("long").alias("slot"), "grown_shard"
    )


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents over shards 0 to 7 of equal weight, under the law ``key``."""
    out = sharded(documents(spark, sf_dir), [1.0] * 8, [1.0] * 9)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
