"""Phrases that occur more often than their parts would: n-grams counted over a prefix-free parse.

Texts are cut into chunks where a hash of two words says so, so equal passages are cut alike; neighbours overlap by those
two words. Each distinct chunk is stored once, with how often the parse uses it, and its n-grams are counted once with
that weight: a passage copied a thousand times costs as much as one. An n-gram that starts in an overlap belongs to the
chunk that comes next, so none is counted twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranking import numbered
from .common import documents, scratch, staged, text_or_empty

#: Words of a phrase at most; neighbours share one word fewer. A parse cuts at one pair of words in ``TRIGGER``.
WORDS, TRIGGER = 3, 16
LEAST, TOP = 10, 2000
#: A phrase goes if a longer one has this share of its occurrences, in percent.
INSIDE = 50
#: Bytes of texts or chunks that a task takes up at once; bytes of chunks for each bucket of n-grams; buckets at least.
SLICE, BUCKET, BUCKETS = 3 << 19, 1 << 20, 1024
BLOCK = 1 << 20

#: What bytes are: 0 in a word, 1 between words, 2 between pieces.
KIND = np.zeros(256, np.uint8)
KIND[[9, 32]] = 1
KIND[[10, 11, 12, 13, *b".,;:!?"]] = 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of unsigned 64-bit integers spread over the whole word."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Powers:
    """Powers of an odd number and of its inverse modulo 2^64, as many as a slice needs."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, b, np.uint64)])) for b in (self.base, self.inverse))
        return self.up, self.down


POWERS = [Powers(0x2545F4914F6CDD1D), Powers(0xBF58476D1CE4E5B9)]


class Words:
    """Words of lower-cased texts in one buffer: ``text`` (each word followed by a space), ``at`` (start there), ``size``,
    ``piece`` (number, rising), ``source`` (number of the text)."""

    def __init__(self, texts: list[bytes]):
        raw = LOWER[np.frombuffer(b"\n".join([*texts, b""]), np.uint8)]
        kind = KIND[raw]
        inside = kind == 0
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if len(raw) and inside[0]:
            edge = np.concatenate([[0], edge])
        start, end = edge[::2], edge[1::2]
        self.size = end - start
        keep = inside.copy()
        keep[end] = True
        self.text = np.where(kind[keep] > 0, np.uint8(32), raw[keep])
        self.at = np.cumsum(self.size + 1) - (self.size + 1)
        self.piece = np.cumsum(kind == 2)[start]
        bounds = np.cumsum([len(t) + 1 for t in texts])
        self.source = np.searchsorted(bounds, start, "right")

    def hashes(self, powers: Powers) -> np.ndarray:
        """A polynomial of each word's bytes modulo 2^64."""
        up, down = powers.of(len(self.text) + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((self.text.astype(np.uint64) + np.uint64(1)) * up[: len(self.text)])])
        return mixed((sums[self.at + self.size] - sums[self.at]) * down[self.at] + self.size.astype(np.uint64))

    def spans(self, first: np.ndarray, last: np.ndarray, after: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the words first..last of each span, joined by spaces, with ``after`` bytes that follow, and the offsets
        of the spans. Copied by blocks, as the places of bytes take eight times as much as the bytes."""
        start = self.at[first]
        size = self.at[last] + self.size[last] - start + after
        offsets = np.concatenate([[0], np.cumsum(size)])
        out = np.empty(offsets[-1], np.uint8)
        bounds = np.unique([*np.searchsorted(offsets, np.arange(0, offsets[-1], BLOCK)), len(first)])
        for a, b in zip(bounds, bounds[1:], strict=False):
            places = np.arange(offsets[a], offsets[b]) + np.repeat(start[a:b] - offsets[a:b], size[a:b])
            out[offsets[a] : offsets[b]] = self.text[places]
        return out, offsets


def strings(data: np.ndarray, offsets: np.ndarray):
    import pyarrow as pa

    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes()))


def slices(batches: Iterator, text: str) -> Iterator[tuple[list[bytes], list[dict]]]:
    """Texts as bytes, up to about ``SLICE`` at once, with the other columns of their rows."""
    texts, rows, size = [], [], 0
    for batch in batches:
        names = [n for n in batch.schema.names if n != text]
        columns = [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]
        for t, *other in zip(batch.column(batch.schema.get_field_index(text)).to_pylist(), *columns, strict=True):
            texts.append(t.encode() if isinstance(t, str) else t)
            rows.append(other)
            size += len(texts[-1])
            if size >= SLICE:
                yield texts, rows
                texts, rows, size = [], [], 0
    if texts:
        yield texts, rows


def parsed(batches: Iterator) -> Iterator:
    """Chunks of texts: lang, chunk, more (whether another chunk of the piece follows)."""
    import pyarrow as pa

    for texts, rows in slices(batches, "text"):
        w = Words(texts)
        n = len(w.at)
        if not n:
            continue
        h = w.hashes(POWERS[0])
        opens = np.concatenate([[True], w.piece[1:] != w.piece[:-1]])
        closes = np.concatenate([opens[1:], [True]])
        # a chunk starts at the first word of a trigger, and the one before ends with its second word
        pair = np.zeros(n, bool)
        pair[:-1] = (mixed(h[:-1] * np.uint64(3) + h[1:]) & np.uint64(TRIGGER - 1)) == 0
        cut = pair & ~opens & ~closes
        cut[:-1] &= ~closes[1:]
        first = np.flatnonzero(opens | cut)
        more = np.concatenate([~opens[first[1:]], [False]])
        last = np.concatenate([first[1:] - 1, [n - 1]]) + 2 * more
        data, offsets = w.spans(first, last)
        lang = pa.array([r[0] for r in rows], pa.string()).take(pa.array(w.source[first]))
        # a chunk of a long text is one value: batches are cut by bytes
        bounds = [*np.searchsorted(offsets, np.arange(0, offsets[-1], 4 << 20)).tolist(), len(first)]
        chunks = strings(data, offsets)
        for a, b in zip(bounds, bounds[1:], strict=False):
            if a < b:
                yield pa.RecordBatch.from_arrays([lang[a:b], chunks[a:b].cast(pa.string()), pa.array(more[a:b])], ["lang", "chunk", "more"])


def summed(keys: tuple[np.ndarray, np.ndarray], weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of ``weight`` over equal pairs of hashes, in order of the first: one member's place, and the sum."""
    order = np.argsort(keys[0], kind="stable")
    for _ in range(2):
        a, b = keys[0][order], keys[1][order]
        new = np.ones(len(order), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        if len(order) == 0 or not (new[1:] & (a[1:] == a[:-1])).any():
            break
        order = np.lexsort(keys[::-1])  # different n-grams that fall together in the first hash
    at = np.flatnonzero(new)
    return order[at], np.add.reduceat(weight[order], at) if len(at) else np.zeros(0, np.int64)


def chain(powers: Powers, w: Words, lang: np.ndarray) -> list[np.ndarray]:
    """For n from 1 on: hashes of the n-grams of each word and its followers, with their language."""
    h = w.hashes(powers)
    out = [mixed(h ^ lang)]
    for n in range(1, WORDS):
        out.append(mixed(out[-1][: len(h) - n] * np.uint64(5) + h[n:] + np.uint64(n)) if len(h) > n else np.zeros(0, np.uint64))
    return out


def language_hashes(langs: list[str]) -> np.ndarray:
    from hashlib import sha256

    known = {x: int.from_bytes(sha256(x.encode()).digest()[:8], "little") for x in set(langs)}
    return np.array([known[x] for x in langs], np.uint64)


def counted(buckets: int):
    """N-grams of weighted chunks, summed up within a task and dealt to ``buckets``: bucket, lang, raw (bytes), packed
    (phrases, one a line), counts (signed 64-bit integers)."""
    shift = np.uint64(64 - (buckets.bit_length() - 1))

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for texts, rows in slices(batches, "chunk"):
            w = Words(texts)
            langs, more, weight = ([r[k] for r in rows] for k in range(3))
            source, n = w.source, len(w.at)
            own = language_hashes(langs)[source]
            # words from the start of which n-grams belong to the chunk: not the last two, if another chunk follows
            last = np.searchsorted(source, np.arange(len(texts)), "right")[source]
            counts_here = np.arange(n) < last - (WORDS - 1) * np.array(more)[source]
            chains = [chain(p, w, own) for p in POWERS]
            firsts, sizes = [], []
            for k in range(WORDS):
                at = np.flatnonzero(counts_here[: max(n - k, 0)] & (source[: max(n - k, 0)] == source[k:]))
                firsts.append(at)
                sizes.append(np.full(len(at), k))
            first, size = np.concatenate(firsts), np.concatenate(sizes)
            keys = tuple(np.concatenate([c[k][at] for k, at in enumerate(firsts)]) for c in chains)
            chosen, sums = summed(keys, np.array(weight, np.int64)[source[first]])
            bucket = (keys[0][chosen] >> shift).astype(np.int64)
            codes = {x: k for k, x in enumerate(sorted(set(langs)))}
            code = np.array([codes[x] for x in langs])[source[first[chosen]]]
            order = np.lexsort((code, bucket))
            chosen, sums, bucket, code = chosen[order], sums[order], bucket[order], code[order]
            lines, offsets = w.spans(first[chosen], first[chosen] + size[chosen], after=1)
            ends = offsets[1:]
            lines[ends - 1] = 10
            new = np.flatnonzero(np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (code[1:] != code[:-1])])) if len(bucket) else np.zeros(0, int)
            names, out, held = sorted(codes), [], 0
            for a, b in zip(new.tolist(), [*new[1:].tolist(), len(bucket)], strict=True) if len(new) else []:
                raw = lines[0 if a == 0 else ends[a - 1] : ends[b - 1]].tobytes()
                out.append((int(bucket[a]), names[code[a]], len(raw), pa.compress(raw, "zstd", asbytes=True), sums[a:b].tobytes()))
                held += len(out[-1][3]) + len(out[-1][4])
                if held > 4 * SLICE:
                    yield blobs(out)
                    out, held = [], 0
            if out:
                yield blobs(out)

    return count


def blobs(rows: list[tuple]):
    import pyarrow as pa

    kinds = [pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["bucket", "lang", "raw", "packed", "counts"])


def merged(least: int):
    """Sums over a bucket and language, whose rows follow each other: lang, n, phrase, f of those with ``least`` or more;
    and one row with n = 0 and f all occurrences of single words."""

    def sums_of(lang: str, lines: list[bytes], counts: list[np.ndarray]):
        import pyarrow as pa

        phrases = b"".join(lines).split(b"\n")[:-1]
        w, own = Words(phrases), np.concatenate(counts)
        size = np.bincount(w.source, minlength=len(phrases))
        at = np.searchsorted(w.source, np.arange(len(phrases)))
        seed = language_hashes([lang])
        keys = []
        for p in POWERS:
            chains, key = chain(p, w, np.repeat(seed, len(w.at))), np.zeros(len(phrases), np.uint64)
            for k in range(WORDS):
                key[size == k + 1] = chains[k][at[size == k + 1]]
            keys.append(key)
        chosen, f = summed((keys[0], keys[1]), own)
        n, words = size[chosen], int(own[size == 1].sum())
        kept = f >= least
        found = [phrases[k].decode() for k in chosen[kept].tolist()]
        return pa.RecordBatch.from_arrays([pa.array([lang] * (len(found) + 1)), pa.array([*n[kept].tolist(), 0], pa.int32()), pa.array([*found, None], pa.string()), pa.array([*f[kept].tolist(), words], pa.int64())], ["lang", "n", "phrase", "f"])

    def merge(batches: Iterator) -> Iterator:
        import pyarrow as pa

        key, lines, counts = None, [], []
        for batch in batches:
            for bucket, lang, raw, packed, sums in zip(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("bucket", "lang", "raw", "packed", "counts")], strict=True):
                if (bucket, lang) != key:
                    if lines:
                        yield sums_of(key[1], lines, counts)
                    key, lines, counts = (bucket, lang), [], []
                lines.append(pa.decompress(packed, raw, "zstd", asbytes=True))
                counts.append(np.frombuffer(sums, np.int64))
        if lines:
            yield sums_of(key[1], lines, counts)

    return merge


def dictionary(docs: DataFrame) -> DataFrame:
    """lang (null: ``und``), chunk, more, weight: the distinct chunks and how often the parse uses each."""
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), text_or_empty().alias("text"))
    chunks = rows.mapInArrow(parsed, "lang string, chunk string, more boolean")
    return chunks.groupBy("lang", "chunk", "more").agg(F.count(F.lit(1)).alias("weight"))


def gram_counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """lang, n, phrase, f of all n-grams with ``least`` or more occurrences, and rows with n = 0 (see ``merged``)."""
    known = staged(dictionary(docs), "dictionary")
    size = known.agg(F.sum(F.octet_length("chunk"))).first()[0] or 0
    buckets = max(BUCKETS, 1 << (size // BUCKET).bit_length())
    grams = known.select("lang", "more", "weight", "chunk").mapInArrow(counted(buckets), "bucket long, lang string, raw long, packed binary, counts binary")
    return grams.repartition("bucket").sortWithinPartitions("bucket", "lang").mapInArrow(merged(least), "lang string, n int, phrase string, f long")


def scored(counts: DataFrame) -> DataFrame:
    """lang, phrase, words, a, l, r, score of each phrase: its lowest-scoring cut, the shortest first part among equals."""
    f = counts.where("n > 0").select("lang", "phrase", "f")
    words = F.split("phrase", " ")
    cut = lambda k: F.struct(F.lit(k).alias("k"), F.array_join(F.slice(words, 1, k), " ").alias("first"), F.array_join(F.slice(words, k + 1, WORDS), " ").alias("rest"))
    cuts = F.filter(F.array(*[cut(k) for k in range(1, WORDS)]), lambda c: c["rest"] != "")
    rows = counts.where("n > 1").select("lang", "phrase", F.col("n").alias("words"), F.col("f").alias("a"), F.explode(cuts).alias("c")).select("lang", "phrase", "words", "a", "c.*")
    rows = rows.join(f.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"]).join(f.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    score = F.expr("(cast(1000000 as decimal(7,0)) * (cast(a as decimal(15,0)) * cast(a as decimal(15,0)))) div (cast(l as decimal(16,0)) * cast(r as decimal(16,0)))")
    best = rows.withColumn("score", score).groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    return best.select("lang", "phrase", "words", "a", "b.l", "b.r", "b.score")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score (see the contract in README).

    Null text is empty; null lang is ``und``; repeated rows count as often as they occur; no words give no rows; other
    columns are ignored. Ties go to the larger count, then to the smaller phrase in byte order. Chunks and n-grams are
    told apart by strings in shuffles and by 128 bits of hashes within a task. Counts hold up to 10^15; the arithmetic of
    scores is decimal. Ranks are made by range of score, so no task holds a language.
    """
    counts = staged(gram_counts(docs, least), "grams")
    words = F.split("phrase", " ")
    longer = counts.where(F.col("n") == WORDS).select("lang", F.col("f").alias("longer"), F.explode(F.array(*[F.array_join(F.slice(words, k, WORDS - 1), " ") for k in (1, 2)])).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = scored(counts).join(longer, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < INSIDE * F.col("a")))
    rows = numbered(kept.drop("longer", "words"), ["lang"], [F.desc("score"), F.desc("a"), F.col("phrase")], stage=staged).where(F.col("rank") <= top)
    total = counts.where("n = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    return rows.join(F.broadcast(total), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 strongest phrases of two or three words in each language of ``documents``."""
    with scratch(spark):
        return staged(collocations(documents(spark, sf_dir)), "collocations", keep=True)
