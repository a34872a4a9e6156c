"""What a code list was at any time: changes that count, validity intervals, labels as of a time, a vocabulary's past."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import AT, carried, ordered, without_order


def first_nulls(order: list[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in order]


def checked_changes(events: DataFrame, order: list[str], base: DataFrame | None = None) -> DataFrame:
    """INSERT, RENAME and DELETE events (code, action, label, ``order``) after the rows of ``base`` (code, label), which
    count as inserts before all time, with ``counts``: an INSERT does where its code isn't live, the others where it is.
    Rows keep their order for ``carried``."""
    rows = events.where(F.col("action").isin("INSERT", "RENAME", "DELETE")).select("code", "action", "label", *order)
    if base is not None:
        kinds = dict(events.select(*order).dtypes)
        rows = rows.unionByName(base.select("code", F.lit("INSERT").alias("action"), "label", *[F.lit(None).cast(kinds[c]).alias(c) for c in order]))
    life = F.when(F.col("action").isin("INSERT", "DELETE"), F.col("action"))
    seen = carried(ordered(rows, ["code"], first_nulls(order)), ["code"], before={"__before": life})
    live = F.coalesce(F.col("__before") == "INSERT", F.lit(False))
    return seen.withColumn("counts", (F.col("action") == "INSERT") != live).drop("__before")


def rejects(events: DataFrame, order: list[str], base: DataFrame | None = None) -> DataFrame:
    """Inserts of codes that are live already, those of ``base`` among them."""
    return without_order(checked_changes(events, order, base).where("action = 'INSERT' AND NOT counts").drop("counts"))


def intervals(events: DataFrame, order: list[str], base: DataFrame | None = None) -> DataFrame:
    """code, label, valid_from (null: from ``base``), valid_to (null: open): when each code had which label, the first
    column of ``order`` being the time. From is included, to is not, so what several changes of one time leave in between
    is there with equal ends. A deleted code has no interval until it is inserted anew."""
    own = carried(checked_changes(events, order, base).where("counts"), ["code"], following={"valid_to": F.col(order[0])})
    return own.where("action <> 'DELETE'").select("code", "label", F.col(order[0]).alias("valid_from"), "valid_to")


def live_at(found: DataFrame, times: list) -> DataFrame:
    """as_of, code, label of the codes that are live at each of ``times``, with all changes of that very time done. The
    times are part of the plan, so they should be a report's few, not a table (see ``labels_at``)."""
    hit = lambda t: (F.col("valid_from").isNull() | (F.col("valid_from") <= t)) & (F.col("valid_to").isNull() | (F.col("valid_to") > t))
    asked = F.array(*[F.lit(t) for t in times])
    return found.select(F.explode(F.filter(asked, hit)).alias("as_of"), "code", "label")


def labels_at(events: DataFrame, order: list[str], asked: DataFrame, time: str, base: DataFrame | None = None) -> DataFrame:
    """``asked`` (code, ``time``, any others) with the label that its code had then; null where it wasn't live.

    Questions and changes are sorted together and each question takes the last change before it, so a code with many of
    either spreads over parts. Questions come after the changes of their time. A null time asks for ``base``.
    """
    payload = [c for c in asked.columns if c not in ("code", time)]
    at, seq = order[0], order[1:]
    changes = without_order(checked_changes(events, order, base).where("counts"))
    kinds = dict(changes.dtypes)
    rest = lambda row: row.alias("__asked")
    shape = F.struct(*[F.col(f"`{c}`") for c in payload]) if payload else F.struct(F.lit(0).alias("none"))
    questions = asked.select("code", F.col(time).cast(kinds[at]).alias("__time"), F.lit(1).alias("__kind"), *[F.lit(None).cast(kinds[c]).alias(c) for c in seq], F.lit(None).cast("struct<action:string,label:string>").alias("__change"), rest(shape))
    known = changes.select("code", F.col(at).alias("__time"), F.lit(0).alias("__kind"), *seq, F.struct("action", "label").alias("__change"), rest(F.lit(None).cast(questions.schema["__asked"].dataType)))
    rows = carried(ordered(known.unionByName(questions), ["code"], first_nulls(["__time", "__kind", *seq])), ["code"], last={"__state": F.col("__change")})
    label = F.when(F.col("__state.action") != "DELETE", F.col("__state.label"))
    return rows.where("__kind = 1").select("code", F.col("__time").alias(time), *[F.col("__asked").getField(c).alias(c) for c in payload], label.alias("label"))


def named_events(events: DataFrame, order: list[str], heads: DataFrame) -> DataFrame:
    """Events with ``old_label``: the name that their code had before, null where it wasn't known. A code is named by its
    head or else by its first event, and anew by each RENAME; other events don't name. Rows of the heads come first, as
    action HEAD. ``naming`` marks the rows that give a name."""
    kinds = dict(events.select(*order).dtypes)
    rows = events.select("code", "action", "label", *order).unionByName(heads.select("code", F.lit("HEAD").alias("action"), "label", *[F.lit(None).cast(kinds[c]).alias(c) for c in order]))
    numbered = carried(ordered(rows, ["code"], first_nulls(order)), ["code"], total={"__n": F.lit(1)})
    naming = (F.col("__n") == 1) | (F.col("action") == "RENAME")
    named = numbered.withColumn("naming", naming)
    return carried(named, ["code"], before={"old_label": F.when(F.col("naming"), F.col("label"))}).drop("__n")


def vocabulary_history(events: DataFrame, order: list[str], heads: DataFrame) -> DataFrame:
    """code, p, o: what a vocabulary says of each code over its past. A DELETE only deprecates; each RENAME keeps the name
    before as an alternate one; INSERTs give dates of creation, other changes dates of change. The first column of
    ``order`` is the time. Equal statements are made once."""
    rows = named_events(events, order, heads)
    pref = rows.groupBy("code").agg(F.max_by("label", F.when(F.col("naming"), F.col(AT))).alias("o")).select("code", F.lit("prefLabel").alias("p"), "o")
    day = F.col(order[0]).cast("date").cast("string")
    is_a = lambda *a: F.col("action").isin(*a)
    one = lambda test, p, o: F.when(test, F.struct(F.lit(p).alias("p"), o.alias("o")))
    note = F.concat(F.lit("Renamed from '"), F.coalesce("old_label", F.lit("None")), F.lit("' to '"), F.col("label"), F.lit("' on "), day)
    said = F.array(
        one(is_a("RENAME"), "altLabel", F.col("old_label")), one(is_a("RENAME"), "historyNote", note), one(is_a("UPDATE"), "historyNote", F.concat(F.lit("Updated on "), day)),
        one(is_a("INSERT"), "created", day), one(is_a("RENAME", "UPDATE", "DELETE"), "modified", day), one(is_a("DELETE"), "deprecated", F.lit("true")),
    )
    told = rows.where("action <> 'HEAD'").select("code", F.explode(said).alias("t")).where("t.o is not null").select("code", "t.p", "t.o")
    return pref.unionByName(told.distinct())
