"""BPE encoding and decoding: batched numpy merge rounds over the symbols of many words."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents
from .encoding import ENTRY, WordEncoder, in_slices

WORD_BPE = "word_bpe_49k.json"
NEVER = np.iinfo(np.int64).max


class Merger:
    """Merge rules of a vocabulary whose words end in a suffix, as sorted arrays.

    A pair of symbols is one 64-bit key, left id and right id; the keys are sorted, and beside each are the rank of its
    rule and the symbol that it makes.
    """

    def __init__(self, path: str):
        told = json.loads(Path(path).read_text())["model"]
        self.vocabulary, self.suffix = told["vocab"], told["end_of_word_suffix"] or ""
        rules = [r.split(" ") if isinstance(r, str) else r for r in told["merges"]]
        left, right, made = (np.array([self.vocabulary[f(a, b)] for a, b in rules], np.int64) for f in (lambda a, b: a, lambda a, b: b, lambda a, b: a + b))
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]

    def rules(self, left: np.ndarray, right: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of each neighbouring pair; NEVER where there is no rule or ``own`` is false."""
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(own & (self.keys[at] == wanted), self.ranks[at], NEVER), self.made[at]

    def merge(self, words: list[list[int]]) -> list[np.ndarray]:
        """Ids of each word, given as its first symbols.

        All words lie in one flat array. In a round each word finds its lowest rank; every pair of that rank is merged,
        from the left where pairs overlap. Words without a rule left leave the array.
        """
        out: list[np.ndarray] = [np.array(w, np.int64) for w in words]
        live = np.array([k for k, w in enumerate(words) if len(w) > 1], np.int64)
        symbols = np.concatenate([out[k] for k in live]) if len(live) else np.empty(0, np.int64)
        word = np.repeat(np.arange(len(live)), [len(words[k]) for k in live])
        while len(symbols):
            rank, made = self.rules(symbols[:-1], symbols[1:], word[:-1] == word[1:])
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            best = np.minimum.reduceat(np.r_[rank, NEVER], starts)
            chosen = np.flatnonzero((rank != NEVER) & (rank == best[np.cumsum(np.r_[True, word[1:] != word[:-1]])[:-1] - 1]))
            # in a run of overlapping pairs (as of equal symbols) every second one, from the left, is merged
            new_run = np.r_[True, np.diff(chosen) != 1] if len(chosen) else np.empty(0, bool)
            at = np.arange(len(chosen))
            chosen = chosen[(at - np.maximum.accumulate(np.where(new_run, at, 0))) % 2 == 0]
            symbols[chosen] = made[chosen]
            keep = np.ones(len(symbols), bool)
            keep[chosen + 1] = False
            symbols, word = symbols[keep], word[keep]
            done = best == NEVER
            if done.any():
                ends = np.searchsorted(word, np.arange(len(live) + 1))
                for k in np.flatnonzero(done):
                    out[live[k]] = symbols[ends[k] : ends[k + 1]].copy()
                keep = ~done[word]
                number = np.cumsum(~done) - 1
                symbols, word, live = symbols[keep], number[word[keep]], live[~done]
        return out


class BatchEncoder(WordEncoder):
    """Cuts texts into pieces as the vocabulary says and merges the new pieces of a batch together."""

    def __init__(self, path: str):
        import regex

        super().__init__(path)
        self.merger = Merger(path)
        vocabulary = self.merger.vocabulary
        symbol = {chr(b): c for b, c in (self.table | {b: chr(b) for b in range(256) if b not in self.table}).items()}
        self.inner = {raw: vocabulary[c] for raw, c in symbol.items()}
        self.last = {raw: vocabulary[c + self.merger.suffix] for raw, c in symbol.items()}
        added = json.loads(Path(path).read_text())["added_tokens"]
        self.added = {t["content"]: t["id"] for t in added}
        self.cut_added = regex.compile("(" + "|".join(regex.escape(t) for t in self.added) + ")").split
        self.shown = {i: s for s, i in vocabulary.items()} | {t["id"]: t["content"] for t in added}

    def pieces(self, word: str) -> list[str]:
        """What the vocabulary's normalizer and pattern make of a word without white space of one byte."""
        if not word.isascii() and max(word) >= "ɐ" or not word.isprintable():
            return self.cut(self.tokenizer.normalizer.normalize_str(word))
        word = word.lower()
        return (self.cut_ascii if word.isascii() else self.cut)(word)

    def remember(self, known, words):
        new = list(set().union(*words).difference(known))
        cut = [[(p, True) if p in self.added else (q, False) for p in self.cut_added(w) if p for q in ([p] if p in self.added else self.pieces(p))] if "<|" in w else [(q, False) for q in self.pieces(w)] for w in new]
        fresh = list({q for pieces in cut for q, added in pieces if not added}.difference(self.parts))
        symbols = []
        for piece in fresh:
            raw = piece.encode().decode("latin-1")
            symbols.append([*map(self.inner.__getitem__, raw[:-1]), self.last[raw[-1]]])
        for piece, ids in zip(fresh, self.merger.merge(symbols), strict=True):
            self.parts[piece] = ids.astype("<u4").tobytes()
        self.held += sum([ENTRY + 2 * len(w) for w in (*new, *fresh)])
        for word, pieces in zip(new, cut, strict=True):
            known[word] = b"".join([self.added[q].to_bytes(4, "little") if added else self.parts[q] for q, added in pieces])
        return known

    def decode(self, raw: bytes) -> str:
        """The text that the library's decode() gives: this vocabulary has no decoder, so its tokens stand as they are,
        with a space between two."""
        return " ".join(map(self.shown.__getitem__, np.frombuffer(raw, "<u4").tolist()))


@lru_cache(maxsize=2)
def batch_encoder(path: str) -> BatchEncoder:
    return BatchEncoder(path)


def encode_decode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit) and decoded text of every whole text of ``docs``.

    A null text counts as empty and has no ids and an empty decoded text. Rows stay one for one, repeated ones too; no
    rows give no rows. Other columns are ignored. Very long texts are one slice of their own. Nothing is shuffled.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        coder = batch_encoder(vocabulary)
        for batch in batches:
            first = 0
            for part in in_slices([t or "" for t in batch.column(1).to_pylist()]):
                raws = coder.encode(part)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(part)), pa.array(raws, pa.binary()), pa.array([coder.decode(r) for r in raws], pa.string())], ["doc_id", "ids", "decoded"]
                )
                first += len(part)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, ids binary, decoded string")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return encode_decode(documents(spark, sf_dir), public_tokenizers.path(WORD_BPE)).select(
        "doc_id", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256")
    )
