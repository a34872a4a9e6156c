"""Order-dependent operators: fill-forward, continuation, cascades, version replay."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordered import carried, ordered


def fill_forward(df: DataFrame, keys: list[str], order: str, column: str, out: str) -> DataFrame:
    """The last value that isn't null up to and with each row."""
    return df.withColumn(out, F.last(column, ignorenulls=True).over(Window.partitionBy(*keys).orderBy(order)))


def fill_heads(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Carry major and sub down; sub starts anew at each major; rows before any major go."""
    w = Window.partitionBy(*keys).orderBy(order)
    run = df.withColumn("major_run", F.count("major").over(w)).withColumn("cur_major", F.last("major", True).over(w))
    inner = Window.partitionBy(*keys, "major_run").orderBy(order)
    return run.withColumn("cur_sub", F.last("sub", True).over(inner)).where("cur_major is not null")


def continued(df: DataFrame, keys: list[str], order: str, starts, text: str) -> DataFrame:
    """Rows from one start to the next, their text joined by a space; rows before the first start go.

    Runs are numbered over parts, so a key with many of them is split; a run's text is one value, whatever its length.
    """
    rows = df.select(*dict.fromkeys([*keys, order, text]), starts.cast("int").alias("__start"))
    runs = carried(ordered(rows, keys, [F.col(order)]), keys, total={"run": F.col("__start")}).where("run > 0")
    parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t"))))
    return runs.groupBy(*keys, "run").agg(F.array_join(F.transform(parts, lambda p: p["t"]), " ").alias(text))


def anchored_groups(df: DataFrame, keys: list[str], position: str, gap: float) -> DataFrame:
    """Sorted positions in groups: a new one starts ``gap`` or more from the group's first. One row per group: ``keys``,
    group_no, anchor, n. Null positions go.

    A position that is ``gap`` or more from the one before always starts a group, so keys are cut there first, and only
    positions that lie closer together are folded as one list. A position that occurs often is counted before.
    """
    y = F.col(position).cast("double").alias("y")
    counted = df.where(F.col(position).isNotNull()).groupBy(*keys, y).agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy(*keys).orderBy("y")
    cut = (F.col("y") - F.lag("y").over(order) >= gap).cast("int")
    runs = counted.withColumn("cut", F.coalesce(cut, F.lit(0))).withColumn("run", F.sum("cut").over(order))

    def step(acc, p):
        last = F.try_element_at(acc, F.lit(-1))
        fresh = (F.size(acc) == 0) | (F.abs(p["y"] - F.coalesce(last["y"], F.lit(0.0))) >= gap)
        more = F.struct(last["y"].alias("y"), (last["n"] + p["n"]).alias("n"))
        return F.when(fresh, F.concat(acc, F.array(p))).otherwise(F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(more)))

    groups = F.aggregate(F.array_sort(F.collect_list(F.struct("y", "n"))), F.array().cast("array<struct<y:double,n:bigint>>"), step)
    rows = runs.groupBy(*keys, "run").agg(groups.alias("g")).select(*keys, F.explode("g").alias("g"))
    number = F.row_number().over(Window.partitionBy(*keys).orderBy("g.y")) - 1
    return rows.select(*keys, number.alias("group_no"), F.col("g.y").alias("anchor"), F.col("g.n").alias("n"))


def replay(events: DataFrame, order: list[str]) -> DataFrame:
    """Current code list after INSERT, RENAME and DELETE in order: code, label of the codes that are live.

    A code is live if an INSERT follows its last DELETE. The first such INSERT makes it; later ones clash with a live
    code and are rejected (``rejected_inserts``). Its label is that of the last RENAME after that INSERT, else the
    INSERT's. A RENAME or DELETE of an absent code does nothing. Aggregates per code with a partial step, no sort; what
    is joined to the events is one row per code.
    """
    at = F.struct(*order)
    own = events.where(F.col("action").isin("INSERT", "DELETE", "RENAME")).select("code", "action", "label", at.alias("at"))
    kind = lambda a: F.col("action") == a
    gone = own.where(kind("DELETE")).groupBy("code").agg(F.max("at").alias("gone"))
    later = own.where(~kind("DELETE")).join(gone, "code", "left").where(F.col("gone").isNull() | (F.col("at") > F.col("gone")))
    state = later.groupBy("code").agg(
        F.min(F.when(kind("INSERT"), F.struct("at", "label"))).alias("ins"),
        F.max(F.when(kind("RENAME"), F.struct("at", "label"))).alias("ren"),
    )
    live = state.where(F.col("ins").isNotNull())
    return live.select("code", F.when(F.col("ren.at") > F.col("ins.at"), F.col("ren.label")).otherwise(F.col("ins.label")).alias("label"))


def rejected_inserts(events: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """INSERTs of codes that are live already: those whose last INSERT or DELETE before is an INSERT."""
    w = Window.partitionBy(*keys).orderBy(*order)
    own = events.where(F.col("action").isin("INSERT", "DELETE")).withColumn("__before", F.lag("action").over(w))
    return own.where((F.col("action") == "INSERT") & (F.col("__before") == "INSERT")).drop("__before")


def vocabulary(events: DataFrame, order: list[str]) -> DataFrame:
    """code, pref_label, deprecated: a DELETE only deprecates, the last RENAME names, else the first label seen."""
    at = F.struct(*order)
    return events.groupBy("code").agg(
        F.coalesce(F.max_by(F.when(F.col("action") == "RENAME", F.col("label")), F.when(F.col("action") == "RENAME", at)), F.min_by("label", at)).alias("pref_label"),
        F.max((F.col("action") == "DELETE").cast("int")).alias("deprecated"),
    )


def binned_words(df: DataFrame, keys: list[str], x: str, word: str, bins: list[tuple[float, str]], rest: str) -> DataFrame:
    """``keys``, bin, words: words of a line by column, in order of their position; each bin ends below its bound."""
    name = None
    for bound, label in bins:
        name = F.when(F.col(x) < bound, label) if name is None else name.when(F.col(x) < bound, label)
    parts = F.array_sort(F.collect_list(F.struct(F.col(x).alias("x"), F.col(word).alias("w"))))
    return df.groupBy(*keys, name.otherwise(rest).alias("bin")).agg(F.array_join(F.transform(parts, lambda p: p["w"].cast("string")), " ").alias("words"))
