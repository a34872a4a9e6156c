"""Near copies by word shingles: SimHash blocks and MinHash bands propose pairs, the shingle sets of both texts decide,
components."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch, staged, whole_row
from .components import connected_components
from .simhash import NO_ID, links, majority

#: Words in a shingle; shared shingles of all shingles of two texts (a fraction) from which they are near copies.
WORDS, SHARED, OF = 5, 4, 5
#: Minima in a band, bands. A pair at 0.8 agrees in a band with 0.8**5, so in none of 24 with 7e-5.
ROWS, BANDS = 5, 24
SEED = 42
#: Bytes of longs up to which row ids, of the texts to compare or of the copies to drop, are broadcast; beyond, the join
#: is shuffled.
BROADCAST = 32 << 20
#: Others of one text that are compared with it in one place.
CROWD = 1000
#: Others that a node is compared with first, of those that share a bucket with it.
ENDS = 2
#: Counters of how common shingles are.
COUNTERS = 1 << 20


def shingles(text: bytes, words: int = WORDS) -> set[bytes]:
    """The different shingles of one UTF-8 text: its words in lower case (A-Z), the whole text if it has fewer."""
    parts = text.lower().split()
    return {b" ".join(parts[k : k + words]) for k in range(max(1, len(parts) - words + 1))} if parts else set()


def near(a: set[bytes], b: set[bytes]) -> bool:
    """Jaccard similarity of ``SHARED`` / ``OF`` or more, in whole numbers. Two texts without words are equal."""
    both = len(a & b)
    return both * OF >= SHARED * (len(a) + len(b) - both)


def sketch(text: bytes, words: int = WORDS) -> tuple[int, int, list[int]]:
    """A digest of the shingle set, its SimHash fingerprint and one key for each band (signed longs). No words: zeros and
    no keys."""
    import numpy as np
    import xxhash

    found = shingles(text, words)
    if not found:
        return 0, 0, []
    hashes = np.array(sorted(xxhash.xxh64_intdigest(s, SEED) for s in found), np.uint64)
    random = np.random.default_rng(SEED)
    flip, odd = (random.integers(0, 1 << 64, ROWS * BANDS, np.uint64) for _ in range(2))
    low = np.full(ROWS * BANDS, (1 << 64) - 1, np.uint64)
    for first in range(0, len(hashes), 1024):
        low = np.minimum(low, ((hashes[first : first + 1024, None] ^ flip) * (odd | np.uint64(1))).min(axis=0))
    keys = [xxhash.xxh64_intdigest(low[k * ROWS : (k + 1) * ROWS].tobytes(), k) for k in range(BANDS)]
    digest, *signed = [x - (1 << 64) if x >> 63 else x for x in (xxhash.xxh64_intdigest(hashes.tobytes(), SEED), *keys)]
    return digest, majority(hashes), signed


def with_sketches(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``docs`` with columns ``node`` (the digest), ``fp`` and ``keys``, without ``text``."""
    from pyspark.sql.types import ArrayType, LongType, StructType

    kept = [name for name in docs.columns if name != "text"]

    def add(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).cast(pa.large_binary())
            found = list(zip(*(sketch(t.as_py() or b"", words) for t in texts), strict=True)) or [(), (), ()]
            new = [pa.array(f, kind) for f, kind in zip(found, (pa.int64(), pa.int64(), pa.list_(pa.int64())), strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(k)) for k in kept], *new], [*kept, "node", "fp", "keys"])

    schema = StructType([docs.schema[k] for k in kept]).add("node", LongType()).add("fp", LongType()).add("keys", ArrayType(LongType()))
    return docs.mapInArrow(add, schema)


def small(longs: DataFrame) -> DataFrame:
    """For a broadcast, if all its longs take at most ``BROADCAST`` bytes."""
    return F.broadcast(longs) if longs.count() * len(longs.columns) * 8 <= BROADCAST else longs


def texts_of(ids: DataFrame, nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """node, text of the nodes in ``ids`` (node, unique): the text of the row that stands for each."""
    ids = staged(nodes.join(ids, "node", "left_semi").select("node", F.col("label.row_id").alias("row_id")), "compared")
    ids = small(ids)
    return staged(rows.select("row_id", F.col("doc.text").alias("text")).join(ids, "row_id").select("node", "text"), "texts")


def verified(pairs: DataFrame, nodes: DataFrame, rows: DataFrame, words: int = WORDS) -> DataFrame:
    """Those of ``pairs`` (a, b) whose texts are ``near``.

    The texts of all a of one b are shuffled to where the text of b is, each text once for each of its pairs. A b with more
    than ``CROWD`` others is dealt over as many places as that takes, with its text in each.
    """
    crowd = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / CROWD).alias("places"))
    others = pairs.join(crowd, "b").select(F.col("a").alias("node"), F.col("b").alias("hub"), F.pmod(F.xxhash64("a"), "places").alias("place"))
    hubs = crowd.select(F.col("b").alias("node"), F.col("b").alias("hub"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("places") - 1)).alias("place"))
    sent = others.unionByName(hubs).join(nodes.select("node", F.col("label.row_id").alias("row_id")), "node")
    sent = staged(sent.select("row_id", "hub", "place", "node"), "sent")
    sent = small(sent)
    texts = rows.select("row_id", F.col("doc.text").alias("text")).join(sent, "row_id").select("hub", "place", "node", "text")
    met = texts.repartition("hub", "place").sortWithinPartitions("hub", "place", F.col("node") != F.col("hub"))

    def compare(batches: Iterator) -> Iterator:
        import pyarrow as pa

        own: set[bytes] = set()
        for batch in batches:
            a, b = [], []
            for hub, node, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).cast(pa.large_binary()), strict=True):
                found = shingles(text.as_py() or b"", words)
                if node == hub:
                    own = found
                elif near(found, own):
                    a.append(node)
                    b.append(hub)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return staged(met.mapInArrow(compare, "a long, b long"), "near")


def once(pairs: DataFrame) -> DataFrame:
    """Each of ``pairs`` (a, b) of different nodes once, whichever way round it occurs."""
    both = (F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"))
    return pairs.where("a <> b").groupBy(*both).agg(F.min(F.struct("a", "b")).alias("pair")).select("pair.*")


def across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) whose nodes are in different components."""
    part = lambda node, out: labels.select(F.col("node").alias(node), F.col("label.node").alias(out))
    return pairs.join(part("a", "x"), "a").join(part("b", "y"), "b").where("x <> y").select("a", "b")


def fingerprint_pairs(nodes: DataFrame) -> DataFrame:
    """a, b of nodes (node, fp) whose fingerprints are within two bits, as a pigeonhole join on blocks finds them: of
    equal fingerprints each with the smallest node, and these with each other."""
    first = staged(nodes.groupBy("fp").agg(F.min("node").alias("rep")), "reps")
    equal = nodes.join(first, "fp").select(F.col("rep").alias("a"), F.col("node").alias("b"))
    side = lambda name, rep: first.select(F.col("fp").alias(name), F.col("rep").alias(rep))
    return equal.unionByName(links(first.select("fp")).join(side("a", "x"), "a").join(side("b", "y"), "b").select(F.col("x").alias("a"), F.col("y").alias("b")))


def hashed(texts, words: int) -> Iterator:
    """The hashes of each text's shingles (different ones), for an Arrow column of texts."""
    import numpy as np
    import pyarrow as pa
    import xxhash

    for t in texts.cast(pa.large_binary()):
        yield np.array(sorted(xxhash.xxh64_intdigest(s, SEED) for s in shingles(t.as_py() or b"", words)), np.uint64)


def rarity(texts: DataFrame, words: int = WORDS):
    """How many shingles of all ``texts`` (node, part, text) fall into each of ``COUNTERS`` counters, as an array."""
    import numpy as np

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        sums = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for hashes in hashed(batch.column(2), words):
                np.add.at(sums, (hashes % np.uint64(COUNTERS)).astype(np.int64), 1)
        there = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(sums[there])], ["counter", "n"])

    rows = texts.select("node", "part", "text").mapInArrow(count, "counter int, n long").groupBy("counter").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(COUNTERS, np.int64)
    out[rows.column("counter").to_numpy()] = rows.column("n").to_numpy()
    return np.minimum(out, 2**31 - 1).astype(np.int32)


def prefixes(texts: DataFrame, words: int = WORDS) -> DataFrame:
    """h, node, part, n, own, pos: the shingles (hashed) of ``texts`` (node, part, text) that a near copy must share one
    of, with the size of the set and the shingle's place in it, rarest first.

    A near copy shares four fifths of a set, so it holds one of its first n - ceil(4n / 5) + 1 shingles in any order
    that is the same for all sets. In the order of rarity these are the text's own edits. Rarity is read off counters,
    so that no shingle is shuffled for it; shingles that share a counter look more common than they are, which puts
    them later and costs candidates, not links. ``own`` are alone in their counter, so in no other text, and left out.
    """
    import numpy as np

    counts = texts.sparkSession.sparkContext.broadcast(rarity(texts, words))

    def first(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            out = [[] for _ in range(6)]
            for node, part, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), hashed(batch.column(2), words), strict=True):
                common = counts.value[(h % np.uint64(COUNTERS)).astype(np.int64)]
                n, own = len(h), int((common == 1).sum())
                length = n - -(-n * SHARED // OF) + 1
                at = np.arange(own, min(length, n))
                if len(at):
                    chosen = h[np.lexsort((h, common))[at]].view(np.int64)
                    for column, values in zip(out, (chosen, *(np.full(len(at), x, np.int64) for x in (node, part, n, own)), at), strict=True):
                        column.append(values)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["h", "node", "part", "n", "own", "pos"])

    return staged(texts.select("node", "part", "text").mapInArrow(first, "h long, node long, part long, n long, own long, pos long"), "prefixes")


def possible(a: str, b: str):
    """Whether entries ``a`` and ``b`` of ``prefixes`` for one shingle, the first that they share, may be near copies in
    different components: by their sizes, and by what comes after the shingle in both."""
    x = lambda c: F.col(f"{a}.{c}")
    y = lambda c: F.col(f"{b}.{c}")
    sizes = (OF * x("n") >= SHARED * y("n")) & (OF * y("n") >= SHARED * x("n"))
    shared = F.least(x("n") - x("pos"), y("n") - y("pos"))
    return (x("part") != y("part")) & sizes & ((SHARED + OF) * shared >= SHARED * (x("n") + y("n")))


def pairs_across(entries: DataFrame, central: bool) -> DataFrame:
    """Pairs of nodes in different components that share a shingle of their prefixes and may be near copies: all, or
    only each with the most central one of the shingle, that is the one with fewest shingles of its own."""
    each = entries.select("h", F.struct("own", "node", "part", "n", "pos").alias("e"))
    first = each.groupBy("h").agg(F.min("e").alias("o"), F.count(F.lit(1)).alias("m")).where("m > 1").drop("m")
    met = each.join(first if central else each.withColumnRenamed("e", "o"), "h").where(possible("e", "o"))
    return once(met.select(F.col("e.node").alias("a"), F.col("o.node").alias("b")))


def with_parts(df: DataFrame, labels: DataFrame) -> DataFrame:
    """``df`` (node, ...) with the component of each node as ``part``."""
    return df.join(labels.select("node", F.col("label.node").alias("part")), "node")


def labelled_components(rows: DataFrame, words: int = WORDS) -> DataFrame:
    """node, label of every different shingle set in ``rows`` (doc with text, doc_id, row_id, node, fp, keys).

    First each is compared with one other, the smallest or largest node of most of its MinHash buckets, then with further
    ones (``ENDS`` in all) and with those within two bits of SimHash, where these are in other components. That is as much
    work as there are nodes and joins nearly all copies. Nodes of buckets that hold several components still are then compared by the rare shingles that near copies must share (``prefixes``): with the
    most central node of each such shingle first, then all pairs that are in different components still. Pairs within a
    component can't change it, and a large bucket is never compared with itself, so no link is lost that the bands
    propose, however large a bucket.
    """
    first = F.min(F.struct(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("d"), F.col("row_id"), F.col("node")))
    nodes = staged(rows.groupBy("node").agg(first.alias("label"), F.first("fp").alias("fp")), "nodes")
    keyed = rows.select("node", F.explode("keys").alias("key"))
    several = staged(keyed.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high"), "buckets")
    members = staged(keyed.join(several, "key").distinct(), "members")
    ends = members.select("node", F.explode(F.array("low", "high")).alias("end")).where("node <> end").groupBy("node", "end").agg(F.count(F.lit(1)).alias("bands"))
    order = Window.partitionBy("node").orderBy(F.desc("bands"), "end")
    ends = ends.withColumn("place", F.row_number().over(order)).where(F.col("place") <= ENDS).select(F.col("node").alias("a"), F.col("end").alias("b"), "place")
    ends = staged(ends, "ends")
    edges = verified(staged(once(ends.where("place = 1").select("a", "b")), "pairs"), nodes, rows, words)
    labels = staged(connected_components(nodes.select("node", "label"), edges), "components")
    rest = ends.where("place > 1").select("a", "b").unionByName(fingerprint_pairs(nodes.select("node", "fp")))
    more = verified(staged(once(across(rest, labels)), "pairs"), nodes, rows, words)
    if not more.isEmpty():
        edges = edges.unionByName(more)
        labels = staged(connected_components(nodes.select("node", "label"), edges), "components")

    parts = with_parts(members.select("key", "node"), labels)
    mixed = parts.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high").select("key")
    open_ = staged(members.join(mixed, "key", "left_semi").select("node").distinct(), "open")
    if open_.isEmpty():
        return labels
    entries = prefixes(with_parts(texts_of(open_, nodes, rows), labels), words)
    for central in (True, False):
        more = verified(staged(pairs_across(entries, central), "pairs"), nodes, rows, words)
        if not more.isEmpty():
            edges = edges.unionByName(more)
            labels = staged(connected_components(nodes.select("node", "label"), edges), "components")
            entries = with_parts(entries.drop("part"), labels)
    return labels


def without_near_copies(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``docs`` with one row of each component of near copies: the one of the smallest doc_id, the first of equals. All
    columns stay. Texts without words are copies of each other. No rows give no rows."""
    spark = docs.sparkSession
    rows = docs.select(whole_row(docs.columns).alias("doc"), "doc_id", "text").withColumn("row_id", F.monotonically_increasing_id())
    rows = staged(with_sketches(rows, words), "sketched")
    with scratch(spark):
        roots = labelled_components(rows, words).select("node", F.col("label.row_id").alias("root"))
        copies = rows.select("row_id", "node").join(roots, "node").where("row_id <> root").select("row_id")
        copies = staged(copies, "copies", keep=True)
    copies = small(copies)
    return rows.join(copies, "row_id", "left_anti").select("doc.*")
