"""Word by word ids against the library's own over whole texts."""

import random

import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerspark.llm.encoding import WordEncoder, encoded_columns, spaced_pieces

NAMES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
KNOWN = {n: (WordEncoder(public_tokenizers.path(n)), Tokenizer.from_file(public_tokenizers.path(n))) for n in NAMES}
PARTS = ["Hello", " ", "  ", "\n", "\t", "\r\n", "\x1c", "\x85", "\xa0", " ", "it's", "WE'LL", "don't", "été", "ÄÖ", "ß", "İ", "Σας", "ΟΔΟΣ", "é", "ﬁ", "12345", "½²", "٣", "漢字かな", "🙂👍🏽", "%%%", "<|endoftext|>", "<|startoftext|>", "<|", "...", "a_b", "\x00", "\x07", "‍", "ñandú!!", "|", "ª"]


def same(name, texts):
    ours, library = KNOWN[name]
    for text, raw in zip(texts, ours.encode(texts), strict=True):
        assert raw == b"".join(i.to_bytes(4, "little") for i in library.encode(text, add_special_tokens=False).ids), repr(text)


@pytest.mark.parametrize("name", NAMES)
def test_mixed_parts(name):
    rng = random.Random(7)
    same(name, ["", " ", "\n", *("".join(rng.choice(PARTS) for _ in range(rng.randint(1, 14))) for _ in range(3000))])


@pytest.mark.parametrize("name", NAMES)
def test_long_text_and_small_memory(name):
    ours = WordEncoder(public_tokenizers.path(name), limit=5)
    text = " ".join(f"word{k}x été{k % 7}" for k in range(20000))
    want = KNOWN[name][1].encode(text, add_special_tokens=False).ids
    for _ in range(2):
        assert ours.encode([text])[0] == b"".join(i.to_bytes(4, "little") for i in want)


@pytest.mark.parametrize("name", NAMES)
@settings(max_examples=300, deadline=None)
@given(text=st.text(max_size=40))
def test_any_text(name, text):
    same(name, [text])


def test_unusual_parts_of_arrow_texts():
    for name, (ours, library) in KNOWN.items():
        rng = random.Random(11)
        texts = [None, "", " ", "\x0b \x0c", *("".join(rng.choice([*PARTS, "\x0b", "\x0c", "ẞ", "K", "ŉ"]) for _ in range(rng.randint(1, 14))) for _ in range(2000)), None]
        ids, sizes = ours.encode_column(pa.array(texts, pa.string()))
        want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w], name


@pytest.mark.parametrize("name", NAMES)
def test_runs_of_arrow_texts(name):
    path = public_tokenizers.path(name)
    texts = pa.array(["skipped", "a b", None, "x " * 50, "", "last"], pa.string()).slice(1)
    runs = [(first, sizes.tolist()) for first, _, sizes in encoded_columns(path, texts, rows=2, size=20)]
    assert [first for first, _ in runs] == [0, 2, 3]
    assert sum((sizes for _, sizes in runs), []) == [len(KNOWN[name][1].encode(t or "", add_special_tokens=False).ids) for t in texts.to_pylist()]
    assert list(encoded_columns(path, pa.array([], pa.string()))) == []


def test_each_distinct_word_of_a_run_is_looked_up_once():
    ours = WordEncoder(public_tokenizers.path("word_bpe_49k.json"))

    class Counted(dict):
        asked = 0

        def get(self, *key):
            Counted.asked += 1
            return super().get(*key)

    ours.words = ours.parts = Counted()
    ids, sizes = ours.encode_column(pa.array(["the cat and the dog " * 500, "the dog"]))
    # five words, the empty one among them, each once more as a part at most
    assert Counted.asked <= 10 and len(sizes) == 2 and len(ids) == sizes.sum()


def test_each_distinct_piece_of_a_run_is_looked_up_once_for_byte_vocabularies():
    ours = WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))

    class Counted(dict):
        asked = 0

        def get(self, *key):
            Counted.asked += 1
            return super().get(*key)

        def __getitem__(self, key):
            Counted.asked += 1
            return super().__getitem__(key)

    ours.words = ours.parts = Counted()
    ids, sizes = ours.encode_column(pa.array(["the cat and the dog, " * 500, "the dog"]))
    # "the", " the", " cat", " and", " dog", "," and the last space: each again once it is known, and as a part at most
    assert Counted.asked <= 21 and len(sizes) == 2 and len(ids) == sizes.sum()


def test_pieces_of_byte_vocabularies():
    texts = pa.array(["skipped", "a bc, d\ne", "", " x  y\r\nz", "ä b\u3000 c\xa0 d ", "!?it's.", "", "日 本"]).slice(1)
    pieces, bounds = spaced_pieces(texts)
    got = [pieces[a:z].to_pylist() for a, z in zip(bounds, bounds[1:], strict=False)]
    assert got == [["a", " bc", ",", " d", "\ne"], [], [" x", "  y\r\nz"], ["ä", " b\u3000 c\xa0 d", " "], ["!?it's", "."], [], ["日", " 本"]]
    assert [len(spaced_pieces(pa.array(none, pa.string()))[0]) for none in ([], ["", ""])] == [0, 0]


def test_any_white_space_beside_spaces_and_marks():
    white = [chr(c) for c in range(0x10000) if chr(c).isspace() or c in (0x180E, 0x200B, 0xFEFF)]
    for name in NAMES:
        same(name, [f"{a}{w}{b}{w}{c}" for w in white for a in ("x", "é", "x.", " ") for b in (" ", "\n", "", ",") for c in ("y", ";", "'s", " z")])
