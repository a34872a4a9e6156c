"""Labelled rows for the operators that learn, and their folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Of the folds 0 to 3, the one that no operator learns from.
HELD_OUT = 2


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4. Null ids are of fold 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4, F.lit(0)).cast("int")


def labelled(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    """doc_id, y (0 or 1) of the rows in ``labels`` that may be learned from: not null, not held out. Of an id that is
    there more than once the smallest label counts."""
    rows = spark.read.parquet(f"{sf_dir}/labels.parquet").select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
    rows = rows.where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & (fold() != HELD_OUT))
    return rows.groupBy("doc_id").agg(F.min("y").alias("y"))


#: Labels (two longs each) up to which they are broadcast; beyond, joins with them are shuffled.
BROADCAST = 1_000_000


def few(labels: DataFrame) -> bool:
    """Whether labels may be broadcast."""
    return labels.count() <= BROADCAST
