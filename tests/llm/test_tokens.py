"""Token files, BPE and their brute-force versions."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from ledgerspark.llm.bpe import batch_encoder, encode_decode, op4_bpe
from ledgerspark.llm.tokenfiles import NULL_ID, Part, mapped, op2_token_files, read_tokens, store, write_tokens

SF = "/root/testdata/sf0.001"
BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def raw(ids):
    return np.array(ids, "<u4").tobytes()


def test_token_files_match_the_library(spark):
    library, start = Tokenizer.from_file(BYTE), 0
    got = {r.doc_id: r for r in op2_token_files(spark, SF).collect()}
    for doc in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect():
        ids = raw([*library.encode(doc.text or "", add_special_tokens=False).ids, 2])
        assert (got[doc.doc_id].start, got[doc.doc_id].n_tokens, got[doc.doc_id].ids_crc32) == (start, len(ids) // 4, zlib.crc32(ids))
        start += len(ids) // 4
    assert len(got) == 200


def test_token_files_of_odd_rows(spark, odd, tmp_path):
    library = Tokenizer.from_file(BYTE)
    got = read_tokens(write_tokens(odd, str(tmp_path / "a"), BYTE), str(tmp_path / "a")).collect()
    want = sorted([(d.doc_id is not None, d.doc_id or 0, raw([*library.encode(d.text or "", add_special_tokens=False).ids, 2])) for d in odd.collect()])
    assert sorted((r.doc_id is not None, r.doc_id or 0, bytes(r.ids)) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    empty = odd.limit(0)
    assert read_tokens(write_tokens(empty, str(tmp_path / "b"), BYTE), str(tmp_path / "b")).count() == 0


def test_runs_of_documents_are_added_to_a_part(tmp_path):
    part = Part(str(tmp_path / "p"), 3, "<u2", 2)
    part.add(np.array([NULL_ID, 4, 5]), np.array([7, 8, 9], "<u4"), np.array([0, 3, 0]))
    part.add(np.array([6]), np.array([50255], "<u4"), np.array([1]))
    assert part.close() == (4, 8)
    files, folder = store(str(tmp_path / "p"))
    got = [mapped(files, f"{folder}/000003.{x}", kind).tolist() for x, kind in (("bin", "<u2"), ("off", "<u8"), ("doc", "<i8"))]
    assert got == [[2, 7, 8, 9, 2, 2, 50255, 2], [0, 1, 5, 6, 8], [NULL_ID, 4, 5, 6]]


def test_bpe_matches_the_library(spark, odd):
    library = Tokenizer.from_file(WORD)
    library.no_truncation()
    library.no_padding()

    def want(doc):
        ids = library.encode(doc.text or "", add_special_tokens=False).ids
        return doc.doc_id, raw(ids), library.decode(ids, skip_special_tokens=False)

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for rows in (docs, odd):
        got = [(r.doc_id, bytes(r.ids), r.decoded) for r in encode_decode(rows, WORD).collect()]
        assert got == [want(d) for d in rows.collect()]
    first = op4_bpe(spark, SF).orderBy("doc_id").first()
    _, ids, text = want(docs.orderBy("doc_id").first())
    assert (first.n_tokens, first.ids_sha256, first.decoded_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    assert encode_decode(odd.limit(0), WORD).count() == 0


def test_merge_rounds_on_repeated_symbols():
    coder, library = batch_encoder(WORD), Tokenizer.from_file(WORD)
    words = ["a" * n for n in range(1, 40)] + ["ab" * n for n in range(1, 20)] + ["lll" + "eee" * 9, "x" * 3000, "日本語", "é́", "\x85a", "<|endoftext|>b", "K", "İstanbul", "ΟΔΟΣ"]
    assert coder.encode(words) == [raw(library.encode(w, add_special_tokens=False).ids) for w in words]
