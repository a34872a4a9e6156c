"""SimHash near-duplicates: fingerprints, pigeonhole blocks, verified links, components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, scratch, staged, whole_row
from .components import connected_components

#: Fingerprints in a block's bucket up to which they are compared with each other.
BUCKET = 64
#: Words in a shingle of the query's contract.
WORDS = 3
SEED = 42
NO_ID = 2**63 - 1


def fingerprint_words(text: bytes, words: int = WORDS) -> int:
    """The fingerprint of one UTF-8 text as a signed long; zero if it has no word."""
    import xxhash

    # bytes.lower() changes A-Z only, and bytes.split() cuts at U+0009 to U+000D and the space
    parts = text.lower().split()
    if not parts:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(parts), SEED)]
    if len(parts) > words:
        line, ends, at = b" ".join(parts), [], -1
        for part in parts:
            at += len(part) + 1
            ends.append(at)
        starts = [0, *(end + 1 for end in ends[: len(parts) - words])]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[start:end], SEED) for start, end in zip(starts, ends[words - 1 :], strict=True)]
    return majority(hashes)


def majority(hashes) -> int:
    """The bits that are set in over half of ``hashes`` (unsigned), as a signed long."""
    import numpy as np

    counts = np.zeros(64, np.int64)
    for first in range(0, len(hashes), 65536):
        part = np.array(hashes[first : first + 65536], ">u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes))
    return int(bits.view(">i8")[0])


def with_fingerprints(docs: DataFrame, words: int = WORDS, text: str = "text") -> DataFrame:
    """``docs`` with a column ``fingerprint`` (signed long). Words are cut at white space and shingled whole, however
    long the text; a null text has no words, and so fingerprint zero, which links like any other."""
    from pyspark.sql.types import LongType, StructType

    def add(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).cast(pa.large_binary())
            found = pa.array([fingerprint_words(t.as_py() or b"", words) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, "fingerprint"])

    return docs.mapInArrow(add, StructType([*docs.schema.fields]).add("fingerprint", LongType()))


def block_masks(distance: int) -> list[int]:
    """Masks (signed longs) of every two of ``distance`` + 2 blocks. Fingerprints that differ in ``distance`` bits leave
    two blocks untouched at least, so they agree under one mask at least."""
    cuts = [64 * k // (distance + 2) for k in range(distance + 3)]
    blocks = [(1 << high) - (1 << low) for low, high in zip(cuts, cuts[1:], strict=False)]
    signed = [a | b for a, b in combinations(blocks, 2)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in signed]


def far(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(prints: DataFrame, distance: int = 2, bucket: int = BUCKET) -> DataFrame:
    """Links a, b between different fingerprints of ``prints`` (fp, unique) that keep every component whole.

    Candidates share two blocks. Buckets of at most ``bucket`` fingerprints are compared in full and every pair is
    verified. In a larger bucket, pairs could be as many as its square, so ``crowded`` links its members through values
    that they can both be turned into.
    """
    masks = block_masks(distance)
    keyed = prints.select(
        "fp", F.explode(F.array(*[F.struct(F.lit(k).alias("block"), F.col("fp").bitwiseAND(F.lit(m)).alias("value")) for k, m in enumerate(masks)])).alias("key")
    ).select("fp", "key.block", "key.value")
    sizes = keyed.groupBy("block", "value").agg(F.count(F.lit(1)).alias("n"))
    several = staged(sizes.where("n > 1"), "buckets")
    many = several.where(F.col("n") > bucket)
    near = staged(keyed.join(several, ["block", "value"]), "keyed")
    left = near.where(F.col("n") <= bucket)
    right = left.select("block", "value", F.col("fp").alias("other"))
    pairs = left.join(right, ["block", "value"]).where((F.col("fp") < F.col("other")) & (far(F.col("fp"), F.col("other")) <= distance))
    found = pairs.select(F.col("fp").alias("a"), F.col("other").alias("b"))
    if many.isEmpty():
        return found.distinct()
    return found.unionByName(crowded(near.where(F.col("n") > bucket), masks, distance)).distinct()


def crowded(near: DataFrame, masks: list[int], distance: int) -> DataFrame:
    """Links inside buckets that are too large to compare all their pairs. ``near``: fp, block, value.

    A hub is a value that a fingerprint becomes by flipping bits outside of the shared blocks. Those that reach a hub
    with ``distance`` // 2 flips are its inner members, those that need one more (if ``distance`` is odd) its outer ones.
    Two fingerprints within ``distance`` always have a hub of which one is an inner member and the other a member. The
    smallest inner member is within ``distance`` of every member, so linking all members to it is right and leaves no
    such pair apart.
    """
    bits = [F.lit(1 << k if k < 63 else -(1 << 63)) for k in range(64)]
    outside = lambda mask: lambda b: b.bitwiseAND(F.lit(mask)) == 0
    flips = F.get(F.array(*[F.filter(F.array(*bits), outside(m)) for m in masks]), F.col("block"))
    wider = lambda ball: F.array_distinct(F.concat(ball, F.flatten(F.transform(ball, lambda x: F.transform(flips, lambda b: x.bitwiseXOR(b))))))
    inner = F.array("fp")
    for _ in range(distance // 2):
        inner = wider(inner)
    outer = F.array_except(wider(inner), inner) if distance % 2 else F.array().cast("array<bigint>")
    marked = lambda values, own: F.transform(values, lambda v: F.struct(v.alias("hub"), F.lit(own).alias("inner")))
    hubs = near.select("fp", "block", F.explode(F.concat(marked(inner, True), marked(outer, False))).alias("h")).select("fp", "block", "h.hub", "h.inner")
    first = hubs.groupBy("block", "hub").agg(F.min(F.when(F.col("inner"), F.col("fp"))).alias("a"), F.count(F.lit(1)).alias("n"))
    first = staged(first.where("n > 1 and a is not null").select("block", "hub", "a"), "hubs")
    return hubs.join(first, ["block", "hub"]).where(F.col("fp") != F.col("a")).select("a", F.col("fp").alias("b")).distinct()


def components(rows: DataFrame, distance: int = 2, bucket: int = BUCKET) -> DataFrame:
    """fingerprint, label for every fingerprint of ``rows`` (doc_id, row_id, fingerprint); label is the smallest
    (d, row_id, node) reachable, d being the doc_id (null: the largest long)."""
    first = F.min(F.struct(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("d"), F.col("row_id"), F.col("fingerprint").alias("node")))
    nodes = staged(rows.groupBy("fingerprint").agg(first.alias("label")).withColumnRenamed("fingerprint", "node"), "prints")
    edges = links(nodes.select(F.col("node").alias("fp")), distance, bucket)
    return connected_components(nodes, edges)


def near_duplicates(docs: DataFrame, words: int = WORDS, distance: int = 2, bucket: int = BUCKET) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id that is reachable over links of at most ``distance`` differing bits. Null or
    blank texts have fingerprint zero and link like others. Repeated rows stay, in one component. A null doc_id never
    names a component unless no other is in it; then component_id is null. No rows give no rows. Other columns are
    ignored.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text").withColumn("row_id", F.monotonically_increasing_id())
    rows = staged(with_fingerprints(rows, words).select("doc_id", "row_id", "fingerprint"), "fingerprints")
    with scratch(spark):
        labels = staged(components(rows, distance, bucket), "components", keep=True)
    labels = labels.select(F.col("node").alias("fingerprint"), F.col("label.d").alias("d"))
    return rows.join(labels, "fingerprint").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.when(F.col("d") != NO_ID, F.col("d")).alias("component_id"),
    )


def deduplicated(docs: DataFrame, words: int = WORDS, distance: int = 2) -> DataFrame:
    """``docs`` with one row of each component: the one of the smallest doc_id, the first of equals. All columns stay."""
    rows = docs.select(whole_row(docs.columns).alias("doc"), "doc_id", "text").withColumn("row_id", F.monotonically_increasing_id())
    rows = staged(with_fingerprints(rows, words).drop("text"), "fingerprinted")
    with scratch(docs.sparkSession):
        labels = components(rows.select("doc_id", "row_id", "fingerprint"), distance)
        roots = staged(labels.select(F.col("label.row_id").alias("row_id")).distinct(), "roots", keep=True)
    return rows.join(roots, "row_id", "left_semi").select("doc.*")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents by three-word shingles and two bits."""
    return near_duplicates(documents(spark, sf_dir))
