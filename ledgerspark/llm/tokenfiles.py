"""Flat files of unsigned token ids with 64-bit document offsets, memory-mapped on reading.

A dataset is a folder of parts. Part k has ``k.bin`` (ids, little-endian unsigned 16-bit where every id of the vocabulary
fits, else 32-bit), ``k.off`` (n + 1 offsets into it, in ids, unsigned 64-bit) and ``k.doc`` (n document ids, signed 64-bit; the smallest long stands for null). Parts and
the documents in them are in ascending order of the document id (null first; rows of one id by their text). Where a
part's ids start in the whole dataset is the prefix sum of the parts' lengths before it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, shared_dir, staged, text_or_empty
from .encoding import encoded_columns

NULL_ID = -(2**63)
BYTE_BPE = "byte_bpe_50k.json"
END = 2


def store(uri: str):
    """The file system and path of a shared folder, for a Python worker."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def put(files, path: str, raw: bytes) -> None:
    """Write under a name of this attempt's own and rename, so that a retried task can't leave half a file."""
    own = f"{path}.{uuid.uuid4().hex}"
    with files.open_output_stream(own) as out:
        out.write(raw)
    files.move(own, path)


def mapped(files, path: str, kind: str) -> np.ndarray:
    """An array over a file: memory-mapped where it is local, read otherwise."""
    if files.type_name == "local":
        return np.memmap(path, kind, "r") if files.get_file_info(path).size else np.empty(0, kind)
    with files.open_input_file(path) as f:
        return np.frombuffer(f.readall(), kind)


def width(vocabulary: str, end: int = END) -> str:
    """The kind of unsigned integer that holds every id."""
    from tokenizers import Tokenizer

    return "<u2" if max(Tokenizer.from_file(vocabulary).get_vocab_size() - 1, end) < 1 << 16 else "<u4"


class Part:
    """Writes one part; ids go out as they come, offsets and document ids (16 bytes a document) at the end."""

    def __init__(self, uri: str, number: int, kind: str, end: int):
        self.kind, self.end = kind, end
        self.files, folder = store(uri)
        self.files.create_dir(folder, recursive=True)
        self.path, self.own = f"{folder}/{number:06d}", uuid.uuid4().hex
        self.out = self.files.open_output_stream(f"{self.path}.bin.{self.own}")
        self.offsets, self.docs, self.n_ids = [np.zeros(1, "<u8")], [], 0

    def add(self, docs: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """A run of documents: their ids one after another, and how many each has. Each gets ``end``."""
        ends = np.cumsum(sizes + 1)
        own = np.ones(len(ids) + len(sizes), bool)
        own[ends - 1] = False
        out = np.full(len(own), self.end, self.kind)
        out[own] = ids
        self.out.write(out.tobytes())
        self.offsets.append((self.n_ids + ends).astype("<u8"))
        self.docs.append(docs)
        self.n_ids += len(out)

    def close(self) -> tuple[int, int]:
        self.out.close()
        self.files.move(f"{self.path}.bin.{self.own}", f"{self.path}.bin")
        put(self.files, f"{self.path}.off", np.concatenate(self.offsets).tobytes())
        docs = np.concatenate(self.docs).astype("<i8")
        put(self.files, f"{self.path}.doc", docs.tobytes())
        return len(docs), self.n_ids


def write_tokens(docs: DataFrame, folder: str, vocabulary: str, end: int = END) -> DataFrame:
    """Encode every whole text of ``docs`` (doc_id, text), append ``end``, write the parts and return their index.

    Index: part (int), kind (of integer), n_docs, n_ids, base (long; ids in the parts before). With the folder it is all
    that a reader needs.
    A null text counts as empty and has ``end`` alone. Repeated rows are written as often as they occur. No documents
    give no parts. Other columns are ignored. Rows are dealt by range of doc_id, so a part is as large as its share; a
    task that is run again writes the same bytes to the same names.
    """
    from pyspark import TaskContext

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa

        part = None
        for batch in batches:
            docs = batch.column(0).fill_null(NULL_ID).to_numpy()
            for first, ids, sizes in encoded_columns(vocabulary, batch.column(1)):
                if part is None:
                    part = Part(folder, number := TaskContext.get().partitionId(), kind, end)
                part.add(docs[first : first + len(sizes)], ids, sizes)
        if part is not None:
            n_docs, n_ids = part.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([number], pa.int32()), "n_docs": [n_docs], "n_ids": [n_ids]})

    kind = width(vocabulary, end)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    parts = staged(ordered.mapInArrow(write, "part int, n_docs long, n_ids long"), "parts")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("kind", F.lit(kind)).withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_tokens(index: DataFrame, folder: str) -> DataFrame:
    """Documents of a dataset from its files: doc_id, start (ids before it in the whole dataset), n_tokens, ids (binary,
    little-endian unsigned 32-bit)."""

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa

        files, path = store(folder)
        for batch in batches:
            for part, base, kind in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids, offsets, docs = (mapped(files, f"{path}/{part:06d}.{x}", k) for x, k in (("bin", kind), ("off", "<u8"), ("doc", "<i8")))
                for first in range(0, len(docs), 1024):
                    own = docs[first : first + 1024]
                    cut = offsets[first : first + len(own) + 1].astype(np.int64)
                    raws = [ids[a:z].astype("<u4").tobytes() for a, z in zip(cut, cut[1:], strict=False)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own, pa.int64(), mask=own == NULL_ID), pa.array(base + cut[:-1]), pa.array(np.diff(cut)), pa.array(raws, pa.binary())], ["doc_id", "start", "n_tokens", "ids"]
                    )

    # a task for each part, as a number of partitions that is asked for is never merged
    tasks = index.select("part", "base", "kind").repartition(max(1, index.count()))
    return tasks.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back: doc_id, start, n_tokens, ids_crc32."""
    folder = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    index = write_tokens(documents(spark, sf_dir), folder, public_tokenizers.path(BYTE_BPE))
    return read_tokens(index, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
