"""Token ids of many texts by the tokenizers library, each distinct word encoded once in a worker."""

from __future__ import annotations

import json
import re
from codecs import charmap_decode
from collections.abc import Iterable, Iterator
from functools import lru_cache
from pathlib import Path
from struct import pack
from typing import TYPE_CHECKING

import numpy as np

if TYPE_CHECKING:
    import pyarrow as pa

#: Bytes of words and ids, with what a dictionary takes for them, that a worker remembers, about; then it starts over. What
#: one slice of texts adds comes on top.
REMEMBERED, ENTRY = 160_000_000, 200
#: Letters below U+0250 have the same class and case in every Unicode version in use, and don't combine. This finds others.
UNUSUAL = re.compile("[ɐ-\U0010ffff]").search


def byte_alphabet() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1 stands for itself, the others
    follow from U+0100 on."""
    kept = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = (b for b in range(256) if b not in kept)
    return {b: chr(b) for b in kept} | {b: chr(256 + k) for k, b in enumerate(other)}


def marked(*values: int) -> np.ndarray:
    """A table of bytes, true for these."""
    out = np.zeros(256, bool)
    out[list(values)] = True
    return out


#: Bytes before which a text may be cut after any that ends no white space of one byte, and after letters.
SPACES, SOLID = marked(*b" \n"), marked(*range(33, 256))
MARKS, LETTERS = marked(*b",.;:!?"), marked(*range(65, 91), *range(97, 123))


def spaced_pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Pieces of texts without nulls, one after another and over the texts' own bytes, and where each text's begin and
    the last one's end. Together a text's pieces are the text.

    Cuts are before a space or line feed that doesn't follow white space, and between an ASCII letter and one of
    ``MARKS``. The pattern of byte-level vocabularies ends a part at all of these and looks at nothing before one.
    """
    import pyarrow as pa

    texts = texts.cast(pa.large_string())
    _, offsets, raw = texts.buffers()
    ends = np.frombuffer(offsets, "<i8", len(texts) + 1, 8 * texts.offset) if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(raw or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    before, after = data[:-1], data[1:]
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = SPACES[after] & SOLID[before] | MARKS[after] & LETTERS[before]
    # white space of two bytes starts with C2, of three with E1 to E3: nothing is cut after any character of these
    wide = np.flatnonzero(cut[1:-1] & (before >= 0x80)) + 1
    second, third = data[wide - 2], data[wide - 3]
    cut[wide[(second == 0xC2) | (third >= 0xE1) & (third <= 0xE3)]] = False
    cut[ends] = True
    bounds = np.flatnonzero(cut) if len(data) else np.zeros(1, np.int64)
    return pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds), pa.py_buffer(data)), np.searchsorted(bounds, ends)


class WordEncoder:
    """Encodes whole texts as ``Tokenizer.encode(text, add_special_tokens=False)`` of the vocabulary at ``path`` does.

    Texts are cut where no token can cross: as ``spaced_pieces`` says, for byte-level vocabularies; at white space, for
    vocabularies that drop it. Pieces are remembered. A new piece of common letters is cut further as the vocabulary's
    own pattern says and its parts go to the library's BPE model; any other piece goes to the whole tokenizer.

    A part that stands alone is its own only part, so pieces and parts share one memory.
    """

    def __init__(self, path: str, limit: int = REMEMBERED):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        told = json.loads(Path(path).read_text())
        self.spaced = told["normalizer"] is None
        letters = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+" if self.spaced else told["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.cut = regex.compile(letters).findall
        ascii_only = letters.replace(r"\s\p{L}\p{N}", r"\sA-Za-z0-9").replace(r"[\p{L}]", "[A-Za-z]").replace(r"[\p{N}]", "[0-9]").replace(r"\p{L}", "[A-Za-z]").replace(r"\p{N}", "[0-9]")
        self.cut_ascii = re.compile(ascii_only, re.ASCII).findall
        assert all("<|" in t["content"] and not any(c in " \n,.;:!?" for c in t["content"]) for t in told["added_tokens"])
        self.table = {b: c for b, c in byte_alphabet().items() if chr(b) != c}
        self.alphabet = "".join(self.table.get(b, chr(b)) for b in range(256))
        self.model, self.limit = self.tokenizer.model, limit
        self.parts: dict[str, bytes] = {}
        self.words = self.parts
        self.held = 0

    def part(self, piece: str) -> bytes:
        """Ids of what the pattern yields as one, which are remembered."""
        ids = [t.id for t in self.model.tokenize(charmap_decode(piece.encode(), "strict", self.alphabet)[0])]
        raw = self.parts[piece] = pack(f"<{len(ids)}I", *ids)
        self.held += ENTRY + 2 * len(piece)
        return raw

    def letters(self, words: Iterable[str]) -> None:
        """Remember those new words of a byte-level vocabulary that are common letters alone, or after a space: each is
        one part. They are shown as the vocabulary's bytes all at once."""
        plain = [w for w in words if w[w[:1] == " " :].isalpha() and (w.isascii() or not UNUSUAL(w))]
        shown = charmap_decode("\0".join(plain).encode(), "strict", self.alphabet)[0].split(self.alphabet[0])
        tokenize = self.model.tokenize
        for word, symbols in zip(plain, shown, strict=False):
            ids = [t.id for t in tokenize(symbols)]
            self.parts[word] = pack(f"<{len(ids)}I", *ids)
        self.held += ENTRY * len(plain) + 2 * sum(map(len, plain))

    def new_word(self, word: str) -> bytes:
        ascii_only, known, shown = word.isascii(), self.parts, word
        unusual = not ascii_only and UNUSUAL(word)
        if not self.spaced:
            shown = word.lower()
            if not unusual and shown.isalpha():
                return known.get(shown) or self.part(shown)
        if unusual or "<|" in word or not self.spaced and not word.isprintable():
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
            return pack(f"<{len(ids)}I", *ids)
        out = b""
        for piece in (self.cut_ascii if ascii_only else self.cut)(shown):
            out += known.get(piece) or self.part(piece)
        return out

    def remember(self, known: dict[str, bytes], words: Iterable[list[str]]) -> dict[str, bytes]:
        ids = {w: self.new_word(w) for w in set().union(*words).difference(known)}
        self.held += sum([ENTRY + 2 * len(w) for w in ids if w not in known])
        known.update(ids)
        return known

    def start_over(self) -> None:
        """Forget all, if it's too much by now."""
        if self.held > self.limit:
            self.words.clear()
            self.parts.clear()
            self.held = 0

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another (unsigned 32-bit), and how many each text has; null is an empty text.

        Texts are cut in arrays and Arrow numbers their distinct pieces, so each is looked up once; the numbers then pick
        its ids as often as it occurs.
        """
        import pyarrow.compute as pc

        texts = texts.fill_null("")
        self.start_over()
        if self.spaced:
            pieces, bounds = spaced_pieces(texts)
        else:
            cut = pc.ascii_split_whitespace(texts)
            pieces, bounds = cut.flatten(), cut.offsets.to_numpy()
        coded = pieces.dictionary_encode()
        words, code = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        known, new = self.words, self.new_word
        raws = list(map(known.get, words))
        if self.spaced:
            self.letters([word for word, raw in zip(words, raws, strict=True) if raw is None])
            raws = list(map(known.get, words))
        for k in [k for k, raw in enumerate(raws) if raw is None]:
            raws[k] = raw = new(word := words[k])
            if word not in known:
                known[word] = raw
                self.held += ENTRY + 2 * len(word)
        sizes = np.fromiter(map(len, raws), np.int64, len(raws)) // 4
        size = sizes[code]
        ends = np.r_[0, np.cumsum(size)]
        at = np.repeat((np.cumsum(sizes) - sizes)[code] - ends[:-1], size)
        at += np.arange(len(at))
        return np.frombuffer(b"".join(raws), "<u4")[at], np.diff(ends[bounds])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if self.spaced:
            import pyarrow as pa

            ids, sizes = self.encode_column(pa.array(texts, pa.string()))
            raw, ends = ids.tobytes(), (4 * np.cumsum(sizes)).tolist()
            return [raw[a:z] for a, z in zip([0, *ends], ends, strict=False)]
        self.start_over()
        cut = [t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for t in texts]
        get = self.remember(self.words, cut).__getitem__
        return [b"".join(map(get, words)) for words in cut]


@lru_cache(maxsize=4)
def encoder(path: str) -> WordEncoder:
    """One encoder for each vocabulary in a Python worker."""
    return WordEncoder(path)


def in_slices(texts: list, rows: int = 256, chars: int = 4_000_000) -> Iterator[list]:
    """Runs of at most ``rows`` texts with about ``chars`` characters, or one longer text."""
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text)
        if len(part) >= rows or size >= chars:
            yield part
            part, size = [], 0
    if part:
        yield part


def encoded_columns(path: str, texts: pa.Array, rows: int = 4096, size: int = 4_000_000) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of at most ``rows`` texts with about ``size`` bytes, or one longer text: the first one's position, the ids of
    all, and how many each has."""
    import pyarrow.compute as pc

    known = encoder(path)
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    first = 0
    while first < len(texts):
        most = np.searchsorted(ends, (ends[first - 1] if first else 0) + size, "right")
        last = max(first + 1, min(int(most), first + rows))
        yield first, *known.encode_column(texts.slice(first, last - first))
        first = last
