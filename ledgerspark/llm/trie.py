"""Prefix trie of conversations: members, children, leaves and what sharing prefixes saves, for each node.

Distinct conversations are sorted as strings of fixed-width turns. A node is an interval of that order: the conversations
that start with its turns. Each part of the order finds its intervals alone: a sparse table over the common prefixes of
neighbours answers range minima, and every prefix searches its left and right end on its own. Intervals that touch an end
of a part are pieces of a node that may go on in the next part; those are few (the prefixes of a part's first and last
conversation) and are summed up by their prefix afterwards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WHITESPACE, staged, text_or_empty

#: Bytes of a turn in a key: a digest of role and text, and the number of words, which follows from the text.
DIGEST, TURN = 16, 20
#: Conversations of which ids are joined in one row, before they are hashed in order, as a power of two.
IDS = 9
EMPTY = hashlib.sha256(b"").hexdigest()
#: Border rows (about 200 bytes each) up to which they are broadcast; beyond, joins shuffle.
BORDERS = 200_000


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, at (a turn's place), token (hex: digest of role and text, number of words)."""
    role, text = text_or_empty("role"), text_or_empty()
    digest = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * DIGEST)
    words = F.lpad(F.hex(F.regexp_count(text, F.lit(f"[^{WHITESPACE}]+")).cast("long")), 8, "0")
    return conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("at"), F.lower(F.concat(digest, words)).alias("token"))


def rebuilt(conversations: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """conv_id, key: the first turns of the conversation whose id is the last multiple of ``every``, as many as the id's
    crc32 modulo ``most`` says, then the own turns after as many. Turns are ordered by number, null first; those of one
    number by digest. A conversation is one row of ``TURN`` bytes a turn."""
    base = F.col("conv_id") - F.col("conv_id") % every
    own = turns(conversations).repartition(base).groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "token"))), lambda t: t["token"]).alias("own"))
    heads = own.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.slice("own", 1, most - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % most).cast("int")
    sequence = F.concat(F.slice(F.coalesce("head", F.array().cast("array<string>")), F.lit(1), h), F.slice("own", h + 1, F.size("own")))
    return own.withColumn("base", base).join(heads, "base", "left").select("conv_id", F.unhex(F.array_join(sequence, "")).alias("key"))


def distinct_keys(rows: DataFrame) -> DataFrame:
    """key, chunk, ids (joined, ascending), n, least: what conversations of one key and one run of ids have. Runs split a
    key that many share."""
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    return rows.groupBy("key", F.shiftright("conv_id", IDS).alias("chunk")).agg(ids.alias("ids"), F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"))


class RangeMinimum:
    """Sparse table over an array: row k has the minima of runs of 2^k values."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        while 2 << len(self.rows) - 1 <= len(values):
            last, step = self.rows[-1], 1 << len(self.rows) - 1
            self.rows.append(np.minimum(last[:-step], last[step:]))

    def least(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Minima of values[left..right], both ends included."""
        level = np.frexp((right - left + 1).astype(float))[1] - 1
        out = np.empty(len(left), self.rows[0].dtype)
        for k in np.unique(level).tolist():
            own = level == k
            row = self.rows[k]
            out[own] = np.minimum(row[left[own]], row[right[own] - (1 << k) + 1])
        return out

    def reach(self, start: np.ndarray, depth: np.ndarray, forward: bool) -> np.ndarray:
        """How many values from each start on, in one direction, stay at ``depth`` or more: a binary search for each."""
        found = np.zeros(len(start), np.int64)
        for k in range(len(self.rows) - 1, -1, -1):
            row, size = self.rows[k], 1 << k
            first = start + found if forward else start - found - size + 1
            able = (first >= 0) & (first < len(row))
            able[able] = row[first[able]] >= depth[able]
            found[able] += size
        return found


class Part:
    """Distinct conversations of one part, in order: lengths, common prefixes with the one before, counts, smallest ids,
    hashes of ids, and the words of the turns that the one before doesn't share. Only the last key is kept."""

    def __init__(self):
        self.length, self.common, self.n, self.least, self.ends, self.words = [], [], [], [], [], []
        self.key, self.first, self.hash = None, b"", None

    def add(self, key: bytes, ids: str, n: int, least: int) -> None:
        if key == self.key:
            self.hash.update(b"," + ids.encode())
            self.n[-1] += n
            self.least[-1] = min(self.least[-1], least)
            return
        self.close()
        raw = np.frombuffer(key, np.uint8).reshape(-1, TURN)
        common = 0
        if self.key is None:
            self.first = key
        else:
            before = np.frombuffer(self.key, np.uint8).reshape(-1, TURN)
            both = min(len(raw), len(before))
            differs = (raw[:both] != before[:both]).any(1)
            common = int(differs.argmax()) if differs.any() else both
        self.length.append(len(raw))
        self.common.append(common)
        self.n.append(n)
        self.least.append(least)
        self.words.append(np.ascontiguousarray(raw[:, DIGEST:]).view(">u4").ravel().astype(np.int64))
        self.key, self.hash = key, hashlib.sha256(ids.encode())

    def close(self) -> None:
        if self.hash is not None:
            self.ends.append(self.hash.hexdigest())

    def nodes(self) -> dict[str, np.ndarray | list]:
        """Every prefix that starts in this part, in preorder: left end, depth and what its interval holds. What touches
        an end of the part is marked and counts nothing to others: nodes inside sum up nodes inside alone."""
        self.close()
        size, length, n, least = len(self.length), np.array(self.length), np.array(self.n, np.int64), np.array(self.least, np.int64)
        # candidates: every conversation with every depth; a prefix is kept at its first conversation
        at, words = np.repeat(np.arange(size), length + 1), np.concatenate([np.concatenate([[0], w]) for w in self.words])
        first = np.cumsum(length + 1) - (length + 1)
        depth = np.arange(len(at)) - first[at]
        table = RangeMinimum(np.array(self.common[1:], np.int64)) if size > 1 else None
        left = at - table.reach(at - 1, depth, False) if table else at
        right = at + table.reach(at, depth, True) if table else at
        new = left == at
        place = np.cumsum(new) - 1  # of the node at a candidate that is kept
        parent = np.where(depth[new] > 0, place[first[left] + depth][np.maximum(np.flatnonzero(new) - 1, 0)], -1)
        left, right, depth, words = left[new], right[new], depth[new], words[new]
        inside = (left > 0) & (right < size - 1)
        before = lambda x: np.concatenate([[0], np.cumsum(x)])
        count = before(n)
        members = count[right + 1] - count[left]
        children = np.bincount(parent[inside], minlength=len(left)) if inside.any() else np.zeros(len(left), np.int64)
        after = np.searchsorted(left, right, "right")  # preorder: a subtree is a run of nodes
        own = np.arange(len(left))
        leaf, saved = before(inside & (children == 0)), before(np.where(inside, (members - 1) * words, 0))
        full = length[left] == depth
        return {
            "left": left, "right": right, "depth": depth, "words": words, "inside": inside, "parent": parent, "n_convs": members, "n_children": children,
            "n_leaves": leaf[after] - leaf[own], "saved_tokens": saved[after] - saved[own], "conv_id": RangeMinimum(least).least(left, right),
            "ends_sha256": [self.ends[k] if f else None for k, f in zip(left.tolist(), full.tolist(), strict=True)],
        }


NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
#: ``side`` is null for nodes inside a part, else 0 for prefixes of its first conversation, 1 for those of its last one;
#: ``again`` marks those of the last one that are prefixes of the first one, too.
ROWS = f"part int, side int, again boolean, prefix binary, parent_prefix binary, words long, {NODE}"


def prefixes(key: bytes) -> list[bytes]:
    """A digest for each prefix of a key, the empty one first."""
    state, out = hashlib.sha256(), []
    for at in range(0, len(key) + 1, TURN):
        out.append(state.digest()[:DIGEST])
        state.update(key[at : at + TURN])
    return out


def part_rows(batches: Iterator) -> Iterator:
    """Nodes inside a part, and its border rows."""
    import pyarrow as pa
    from pyspark import TaskContext

    part, number = Part(), TaskContext.get().partitionId()
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("key", "ids", "n", "least")]
        for row in zip(*columns, strict=True):
            part.add(*row)
    if part.key is None:
        return
    x = part.nodes()
    left, right, depth, inside, parent = x["left"], x["right"], x["depth"], x["inside"], x["parent"]
    paths = prefixes(part.first), prefixes(part.key)
    at_start = left == 0
    from_parent = np.where(parent >= 0, parent, 0)
    known = inside & inside[from_parent] & (parent >= 0)
    border = np.flatnonzero(~inside)
    # prefixes of the first conversation all start at 0; those of the last one end at the last
    chosen = [(np.flatnonzero(inside), None), (border[at_start[border]], 0), (border[right[border] == len(part.length) - 1], 1)]
    for nodes, side in chosen:
        for k in range(0, len(nodes), 20_000):
            own = nodes[k : k + 20_000]
            d, p = depth[own].tolist(), from_parent[own]
            if side is None:
                mine = [None] * len(own)
                above = [None if f else paths[0 if s else 1][e - 1] for f, s, e in zip(known[own].tolist(), at_start[p].tolist(), d, strict=True)]
                ends = [e or EMPTY for e in (x["ends_sha256"][i] for i in own.tolist())]
            else:
                mine = [paths[side][e] for e in d]
                above = [paths[side][e - 1] if e else None for e in d]
                ends = [x["ends_sha256"][i] for i in own.tolist()]
            again = at_start[own] if side == 1 else np.zeros(len(own), bool)
            over = pa.array(x["conv_id"][p], pa.int64(), mask=~known[own])
            fill = lambda v, kind: pa.array([v] * len(own), kind)  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays(
                [fill(number, pa.int32()), fill(side, pa.int32()), pa.array(again), pa.array(mine, pa.binary()), pa.array(above, pa.binary()), pa.array(x["words"][own]),
                 pa.array(x["conv_id"][own]), pa.array(depth[own]), over, *[pa.array(x[c][own]) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")], pa.array(ends, pa.string())],
                [f.split()[0] for f in ROWS.split(", ")],
            )


def border_nodes(pieces: DataFrame) -> DataFrame:
    """prefix, parent_prefix and the node's columns, for prefixes of parts' first and last conversations.

    Pieces of a prefix are summed up. What border nodes add to their ancestors, which all are border nodes, goes along the
    path of one conversation: each node belongs to the first path that it is on, sums from the deepest node up give what a
    path adds to each of its prefixes, and those are summed up by prefix. A path is one conversation long.
    """
    value = lambda c: F.sum(F.when(~F.col("again"), F.col(c)).otherwise(0))
    whole = staged(
        pieces.groupBy("prefix").agg(
            F.min("parent_prefix").alias("parent_prefix"), F.max("depth").alias("depth"), F.max("words").alias("words"), F.min("conv_id").alias("conv_id"), F.max("ends_sha256").alias("ends_sha256"),
            value("n_convs").alias("n_convs"), value("n_children").alias("inner_children"), value("n_leaves").alias("inner_leaves"), value("saved_tokens").alias("inner_saved"),
            F.min(F.struct("part", "side")).alias("owner"),
        ),
        "borders",
    )
    below = whole.where("parent_prefix is not null").groupBy(F.col("parent_prefix").alias("prefix")).agg(F.count(F.lit(1)).alias("below"))
    whole = staged(whole.join(below, "prefix", "left").withColumn("n_children", F.col("inner_children") + F.coalesce("below", F.lit(0))), "borders")
    adds = whole.select("prefix", "owner", (F.col("n_children") == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    mine = F.col("owner") == F.struct("part", "side")
    path = Window.partitionBy("part", "side").orderBy(F.desc("depth"))
    sums = (
        pieces.select("prefix", "part", "side", "depth").join(small(adds), "prefix")
        .select("prefix", *[F.sum(F.when(mine, F.col(c)).otherwise(0)).over(path).alias(c) for c in ("leaf", "saved")])
        .groupBy("prefix").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
    )
    return staged(
        whole.join(sums, "prefix").select(
            "prefix", "parent_prefix", "conv_id", "depth", "n_convs", "n_children", (F.col("inner_leaves") + F.col("leaf")).alias("n_leaves"), (F.col("inner_saved") + F.col("saved")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
        ),
        "borders",
    )


def small(df: DataFrame) -> DataFrame:
    """For a broadcast, if it has few rows."""
    return F.broadcast(df) if df.count() <= BORDERS else df


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node (see ``NODE``): every distinct sequence of first turns of the rebuilt conversations.

    A null conv_id's rows take no part; null role and text are empty; null turns come first; turns of one number are
    ordered by a digest of role and text, repeated rows stay repeated turns. Conversations without turns belong to the
    root. No conversations give no rows, not even a root. Other columns are ignored. Turns are told apart by 128 bits of a
    SHA-256. Only keys of 20 bytes a turn are sorted and shuffled. A part is sorted by range of distinct keys, so neither
    a conversation that many share nor a common first turn fills a part; ids that end at one node are hashed in order,
    in one task, as SHA-256 needs, from rows that hold runs of them.
    """
    keys = distinct_keys(rebuilt(conversations))
    found = staged(keys.repartitionByRange("key").sortWithinPartitions("key", "chunk").select("key", "ids", "n", "least").mapInArrow(part_rows, ROWS), "trie")
    names = [c.split()[0] for c in NODE.split(", ")]
    borders = border_nodes(found.where("side is not null"))
    above = small(borders.select(F.col("prefix").alias("parent_prefix"), F.col("conv_id").alias("border_parent")))
    over: Column = F.coalesce("parent_conv_id", "border_parent").alias("parent_conv_id")
    every = found.where("side is null").select("parent_prefix", *names).unionByName(borders.select("parent_prefix", *[F.lit(None).cast("long").alias(c) if c == "parent_conv_id" else c for c in names]))
    return every.join(above, "parent_prefix", "left").select(*[over if c == "parent_conv_id" else c for c in names])


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the rebuilt conversations' trie."""
    return trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
