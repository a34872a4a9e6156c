"""Filters, joins, aggregates and set operations over fiscal tables. Each takes DataFrames and returns one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fiscal, values


def first_per(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in a total order; Spark keeps only candidates before the shuffle."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__n = 1").drop("__n")


def latest_reading(df: DataFrame, keys: list[str], by: str, payload: list[str]) -> DataFrame:
    """The payload of the largest ``by`` for each key, as an aggregate with a partial step."""
    return df.groupBy(*keys).agg(F.max_by(F.struct(*payload), by).alias("p")).select(*keys, "p.*")


def latest_period(df: DataFrame, keys: list[str], period: str, wanted: str) -> DataFrame:
    """``keys`` and a period: the wanted one where the key has it, else its last."""
    return df.groupBy(*keys).agg(F.coalesce(F.max(F.when(F.col(period) == wanted, F.col(period))), F.max(period)).alias(period))


def upsert(existing: DataFrame, new: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Last write wins: ``new``, its first row in ``order`` for each key, replaces what is there."""
    own = first_per(new, keys, order)
    return existing.join(own.select(*keys), keys, "left_anti").unionByName(own.select(*existing.columns))


def insert_if_absent(existing: DataFrame, new: DataFrame, keys: list[str], order: list) -> DataFrame:
    """First write wins."""
    own = first_per(new, keys, order).join(existing.select(*keys), keys, "left_anti")
    return existing.unionByName(own.select(*existing.columns))


def replace_slices(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Drops every slice that the batch has rows for, then appends the batch. An empty batch drops nothing."""
    return existing.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def with_defaults(df: DataFrame, columns: dict[str, object]) -> DataFrame:
    """Missing columns with their defaults."""
    return df.withColumns({n: F.lit(v) for n, v in columns.items() if n not in df.columns})


def keep_data_rows(df: DataFrame, name: str, cells: list[str]) -> DataFrame:
    """Named rows that are no total or heading and have a number in one cell at least."""
    number = F.lit(False)
    for cell in cells:
        number = number | F.col(cell).try_cast("double").isNotNull()
    return df.where(F.col(name).isNotNull() & (F.lower(name) != "nan") & ~values.contains_any(F.col(name), values.SKIPPED) & number)


def missing_parents(heads: DataFrame) -> DataFrame:
    """Parent codes that are referred to but not there."""
    parents = heads.select(F.col("parent_code").alias("code")).where("code is not null").distinct()
    return parents.join(heads.select("code"), "code", "left_anti")


def sector_rollup(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Sums by (sector, sub-sector), sector and in total, for each of ``keys``; lines of amount zero don't count."""
    sector, label = fiscal.classify(F.col("major"))
    by_head = lines.where("amount <> 0").groupBy(*keys, "major").agg(F.sum("amount").alias("amount"))
    named = by_head.select(*keys, sector.alias("sector"), label.alias("sub_sector"), "amount")
    columns = [*keys, "sector", "sub_sector"]
    sets = [columns, columns[:-1], keys]
    level = (F.grouping("sector").cast("int") * 2 + F.grouping("sub_sector").cast("int")).alias("level")
    return named.groupingSets(sets, *columns).agg(level, F.sum("amount").alias("amount"))


def version_diff(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """diff (added, removed, modified) and from_*, to_* of each key whose rows differ."""
    left = old.select(key, *[F.col(c).alias(f"from_{c}") for c in columns], F.lit(True).alias("in_old"))
    right = new.select(key, *[F.col(c).alias(f"to_{c}") for c in columns], F.lit(True).alias("in_new"))
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"from_{c}").eqNullSafe(F.col(f"to_{c}"))
    rows = left.join(right, key, "full").withColumn("diff", F.when(F.col("in_old").isNull(), "added").when(F.col("in_new").isNull(), "removed").when(~same, "modified"))
    return rows.where("diff is not null").drop("in_old", "in_new")


def change_of(diff: DataFrame) -> DataFrame:
    """INSERT, DELETE, RENAME or UPDATE for each row of a version diff."""
    blank = lambda c: F.when(F.trim(c) != "", F.col(c))
    renamed = blank("from_label").isNotNull() & blank("to_label").isNotNull() & (F.col("from_label") != F.col("to_label"))
    action = F.when(F.col("diff") == "added", "INSERT").when(F.col("diff") == "removed", "DELETE").when(renamed, "RENAME").otherwise("UPDATE")
    return diff.select("code", action.alias("action"), F.coalesce(blank("to_label"), blank("from_label")).alias("label"), F.when(renamed, F.col("from_label")).alias("old_label"))


def siblings(heads: DataFrame) -> DataFrame:
    """Heads of the same label, in either case, and another account class."""
    own = heads.select("code", F.lower("label").alias("key"), fiscal.account_class(F.col("code")).alias("cls"))
    other = own.select(F.col("code").alias("sibling"), "key", F.col("cls").alias("sibling_cls"))
    return own.join(other, "key").where("cls <> sibling_cls").select("code", "sibling")


def label_classes(heads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Siblings as classes, linear in the heads: (label_key, n_members, n_links) of every label, in lower case, that heads of
    several account classes bear, and (label_key, code, account_class) of its members. Links are the ordered pairs that
    ``siblings`` gives: all pairs of members less those of one account class."""
    own = heads.select(F.lower("label").alias("label_key"), "code", fiscal.account_class(F.col("code")).alias("account_class"))
    sizes = own.groupBy("label_key", "account_class").agg(F.count(F.lit(1)).alias("n"))
    links = (F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))).alias("n_links")
    classes = sizes.groupBy("label_key").agg(F.sum("n").alias("n_members"), links).where("n_links > 0")
    return classes, own.join(classes.select("label_key"), "label_key", "left_semi")


def siblings_of(heads: DataFrame, asked: DataFrame) -> DataFrame:
    """code, sibling for the heads of ``asked`` (code) only."""
    own = heads.select("code", F.lower("label").alias("key"), fiscal.account_class(F.col("code")).alias("cls"))
    mine = own.join(asked.select("code").distinct(), "code", "left_semi")
    other = own.select(F.col("code").alias("sibling"), "key", F.col("cls").alias("sibling_cls"))
    return mine.join(other, "key").where("cls <> sibling_cls").select("code", "sibling")


def children(heads: DataFrame) -> DataFrame:
    """How many heads hang on each head."""
    own = heads.where("parent_code is not null").groupBy(F.col("parent_code").alias("code")).agg(F.count(F.lit(1)).alias("n_children"))
    return heads.select("code", "label").join(own, "code", "left").select("code", "label", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"))


def ancestors(heads: DataFrame) -> DataFrame:
    """code, path from the top. The chart has three levels, so two joins reach it."""
    up = heads.select(F.col("code").alias("p1"), F.col("parent_code").alias("p2"))
    rows = heads.select("code", F.col("parent_code").alias("p1")).join(up, "p1", "left")
    top = heads.select(F.col("code").alias("p2"), F.lit(1).alias("there"))
    rows = rows.join(top, "p2", "left")
    second = F.when(F.col("there") == 1, F.col("p2"))
    return rows.select("code", F.concat_ws(" > ", second, "p1", "code").alias("path"))


def conflicting(heads: DataFrame, payload: list[str]) -> DataFrame:
    """Codes that stand with more than one payload."""
    return heads.groupBy("code").agg(F.countDistinct(F.struct(*payload)).alias("n")).where("n > 1")


def estimate_rows(df: DataFrame, keys: list[str], fy: str, measures: dict[str, str]) -> DataFrame:
    """One wide row to one row per estimate: actual two years back, be and re of last year, be of this one."""
    back = {"actual": ("actual", 2), "be_prev": ("be", 1), "re": ("re", 1), "be": ("be", 0)}
    kinds = [F.struct(F.lit(kind).alias("col_type"), fiscal.earlier_fy(F.col(fy), years).alias("fy"), F.col(measures[name]).alias("total")) for name, (kind, years) in back.items()]
    return df.select(*keys, F.explode(F.array(*kinds)).alias("r")).select(*keys, "r.*")


def national_totals(rows: DataFrame) -> DataFrame:
    """Sums of gsdp, gap and grants over all states, what isn't reported left out, and the gap's share of the gsdp in
    percent (0 without a gsdp). One row."""
    sums = rows.agg(*[F.sum(c).alias(c) for c in ("gsdp", "gap", "grants")])
    return sums.withColumn("intensity", F.when(F.col("gsdp") > 0, 100 * F.col("gap") / F.col("gsdp")).otherwise(0.0))


def top_n(df: DataFrame, measure: str, n: int, tie: str) -> DataFrame:
    """The n largest, unreported ones last; Spark keeps n rows per task."""
    return df.orderBy(F.desc_nulls_last(measure), F.col(tie)).limit(n)


def subject_hits(heads: DataFrame, query: str) -> DataFrame:
    """Heads whose code and label contain every token of the query; none for an empty one."""
    wanted = [t for t in "".join(c if c.isascii() and c.isalnum() else " " for c in query.lower()).split(" ") if t]
    test: Column = F.lit(bool(wanted))
    text = values.normal(F.concat_ws(" ", "code", "label"))
    for t in wanted:
        test = test & text.contains(t)
    return heads.where(test)
