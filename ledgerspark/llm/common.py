"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Word separators of the text contracts: space and U+0009 to U+000D.
WHITESPACE = "\\x20\\x09-\\x0D"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Where the setting is absent, one folder is made and kept for the session; on a cluster that would be a different
    one on each machine, so there it is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="spark-shared-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


class Blocks(threading.local):
    """Staged folders of each open ``scratch`` block or step of this thread, innermost last."""

    def __init__(self):
        self.open: list[list[str]] = []


OPEN = Blocks()


def removed(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is staged in this block is removed at its end, but for tables staged with ``keep``: those belong to the
    block around it. No other table may leave the block unless it has been read by then."""
    OPEN.open.append([])
    try:
        yield
    finally:
        for folder in OPEN.open.pop():
            removed(spark, folder)


class Steps:
    """What the steps of one run have staged. Each step works on the table that the step before returned, once that has
    been written. Runs know nothing of each other, so one never removes what another reads."""

    def __init__(self):
        self.left: list[tuple[int, str]] = []

    @contextmanager
    def step(self, number: int, docs: DataFrame) -> Iterator[None]:
        """What steps of lower numbers of this run staged goes at the start, but for what ``docs`` reads itself. What is
        staged in this block stays for the table that it returns, until a later step of the run starts."""
        reads = docs.inputFiles() if any(k < number for k, _ in self.left) else []
        for left in [x for x in self.left if x[0] < number and not any(x[1] in file for file in reads)]:
            removed(docs.sparkSession, left[1])
            self.left.remove(left)
        OPEN.open.append([])
        try:
            yield
        finally:
            self.left.extend((number, folder) for folder in OPEN.open.pop())


def staged(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    This cuts the lineage: what follows doesn't depend on shuffle files of executors that may be lost, and values such
    as row ids stay the same however often the result is read. Inside a ``scratch`` block the folder goes with the block.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    if keep:
        if len(OPEN.open) > 1:
            OPEN.open[-2].append(path)
    elif OPEN.open:
        OPEN.open[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


def column(name: str) -> Column:
    """The column of that very name, whatever characters are in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_row(names: Sequence[str]) -> Column:
    """A struct of the columns ``names``. Fields inside it can't clash with columns beside it; one without fields gets
    an unused one, as Parquet needs it."""
    return F.struct(*[column(n).alias(n) for n in names]) if names else F.struct(F.lit(0).alias("none"))


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, although ``body`` uses it many times or in a lambda."""
    return F.get(F.transform(F.array(value), body), 0)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
