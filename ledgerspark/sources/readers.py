"""Scans and sinks of the shapes that budget documents come in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.staging import staged


def read_csv_table(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Headered CSV, every column a string, empty means missing."""
    rows = spark.read.schema(", ".join(f"`{c}` string" for c in columns)).csv(path, header=True)
    return rows.select(*[F.nullif(F.col(c), F.lit("")).alias(c) for c in columns])


def there(spark: SparkSession, path: str) -> bool:
    """Whether ``path``, which may be a glob, has any file."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(found))


def read_payload(spark: SparkSession, path: str, key: str, schema: str) -> DataFrame:
    """JSON files that hold a list, or an object with the list under ``key``. A file that isn't there holds no rows."""
    if not there(spark, path):
        return spark.createDataFrame([], schema)
    value = F.trim("value")
    rows = spark.read.text(path, wholetext=True)
    found = F.when(value.startswith("["), F.from_json(value, f"array<{schema}>")).otherwise(F.from_json(value, f"struct<`{key}`: array<{schema}>>")[key])
    return rows.select(F.explode(found).alias("r")).select("r.*")


def read_map(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON objects with keys that aren't known before: key, and the fields of its value."""
    rows = spark.read.text(path, wholetext=True)
    return rows.select(F.explode(F.from_json("value", f"map<string,{schema}>")).alias("key", "r")).select("key", "r.*")


def read_manifest(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def cells_of(line: Column) -> Column:
    """Cells of a CSV line: a quoted one may hold commas and doubled quotes; blanks around are cut; empty ones are null."""
    raw = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(',(\\s*"(?:[^"]|"")*"\\s*|[^,]*)'), F.lit(1))
    bare = lambda c: F.when(F.trim(c).rlike('(?s)^".*"$'), F.replace(F.regexp_extract(c, '(?s)"(.*)"', 1), F.lit('""'), F.lit('"'))).otherwise(c)
    return F.transform(raw, lambda c: F.nullif(F.trim(bare(c)), F.lit("")))


def read_grid(spark: SparkSession, path: str, skip: int = 0) -> DataFrame:
    """Headerless CSV: doc_id (the file), row_no, cells. Rows are lines, numbered from 0 in their file.

    A large file is read by several tasks: each numbers the lines of its split, and what comes before is the sum of the
    splits before it in the file, one row a split. Line breaks within quotes aren't known. Empty lines count, but for
    what follows a file's last line break.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("doc_id"), F.col("_metadata.file_block_start").alias("split"), F.regexp_replace("value", "\r$", "").alias("line"), F.monotonically_increasing_id().alias("at"))
    rows = staged(lines, "lines")
    splits = rows.groupBy("doc_id", "split").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("doc_id").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    bases = splits.select("doc_id", "split", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("base"))
    numbered = rows.join(bases, ["doc_id", "split"]).withColumn("row_no", (F.col("at") + F.col("base")).cast("int"))
    return numbered.where(F.col("row_no") >= skip).select("doc_id", "row_no", cells_of(F.col("line")).alias("cells"))


def registry(docs: DataFrame, state: str | None = None, limit: int | None = None) -> DataFrame:
    """Documents, of one state if asked (its name with blanks or underscores), in order of id."""
    rows = docs if state is None else docs.where(F.col("state").isin(state, state.replace(" ", "_")))
    return rows if limit is None else rows.orderBy("doc_id").limit(limit)


def links(pages: DataFrame, suffix: Column | None = None) -> DataFrame:
    """page_id, pos, href, title, url of every link; relative links are resolved against the page's own."""
    pattern = '(?s)<a[^>]*href="([^"]*)"[^>]*>(.*?)</a>'
    pairs = F.arrays_zip(F.regexp_extract_all("html", F.lit(pattern), F.lit(1)).alias("href"), F.regexp_extract_all("html", F.lit(pattern), F.lit(2)).alias("title"))
    rows = pages.select("page_id", F.col("url").alias("page"), F.posexplode(pairs).alias("pos", "l")).select("page_id", "pos", "page", "l.href", F.trim(F.regexp_replace("l.title", "<[^>]*>", "")).alias("title"))
    host = F.regexp_extract("page", "^([a-z]+://[^/]*)", 1)
    folder = F.regexp_replace("page", "[^/]*$", "")
    url = F.when(F.col("href").rlike("^[a-z]+:"), F.col("href")).when(F.col("href").startswith("/"), F.concat(host, "href")).otherwise(F.concat(folder, "href"))
    rows = rows.withColumn("url", url).drop("page")
    return rows if suffix is None else rows.where(suffix)


def table_rows(pages: DataFrame) -> DataFrame:
    """page_id, row_no, cells of every table row; a cell that spans n columns is followed by n - 1 empty ones."""
    rows = pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit("(?s)<tr.*?</tr>"), F.lit(0))).alias("row_no", "tr"))
    cells = F.regexp_extract_all("tr", F.lit("(?s)<td.*?</td>"), F.lit(0))
    spans = lambda c: F.coalesce(F.regexp_extract(c, 'colspan="?([0-9]+)', 1).try_cast("int"), F.lit(1))
    text = lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]*>", " "), "\\s+", " "))
    full = F.flatten(F.transform(cells, lambda c: F.concat(F.array(text(c)), F.array_repeat(F.lit(""), F.greatest(spans(c) - 1, F.lit(0))))))
    return rows.where(F.size(cells) > 0).select("page_id", "row_no", full.alias("cells"))


def write_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    df.select(*columns).write.csv(path, header=True, emptyValue="")


def append(df: DataFrame, path: str) -> None:
    """Adds rows to a table, equal ones too."""
    df.write.mode("append").parquet(path)


def write_manifest(df: DataFrame, path: str, status) -> None:
    """Adds a JSON line for each row, with what became of it."""
    df.withColumn("status", status).write.mode("append").json(path)


def json_payload(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """One JSON text per key, its rows as a list."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.to_json(F.struct(F.array_sort(F.collect_list(F.struct(*rest))).alias(name))).alias("payload"))


def triple_lines(triples: DataFrame) -> DataFrame:
    return triples.select(F.concat_ws(" ", "s", "p", "o", F.lit(".")).alias("value")).distinct()


#: Characters that a literal of an N-Triples line must not hold as they are.
ESCAPES = [("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")]


def n_triples(triples: DataFrame, base: str, terms: dict[str, str], links: list[str]) -> DataFrame:
    """N-Triples lines of ``triples`` (s, p, o): subjects under ``base``, predicates by ``terms``, objects of the predicates in
    ``links`` as addresses under ``base``, the others as literals. Predicates without a term are an error."""
    iri = lambda c: F.concat(F.lit("<" + base), F.regexp_replace(c, "[^A-Za-z0-9._~-]", "_"), F.lit(">"))
    text = F.col("o")
    for sign, escaped in ESCAPES:
        text = F.replace(text, F.lit(sign), F.lit(escaped))
    known = F.create_map(*[F.lit(x) for pair in terms.items() for x in pair])
    term = F.coalesce(F.try_element_at(known, F.col("p")), F.raise_error(F.concat(F.lit("no term for "), F.col("p"))))
    value = F.when(F.col("p").isin(*links), iri(F.col("o"))).otherwise(F.concat(F.lit('"'), text, F.lit('"')))
    return triples.select(F.concat_ws(" ", iri(F.col("s")), F.concat(F.lit("<"), term, F.lit(">")), value, F.lit(".")).alias("value")).distinct()
