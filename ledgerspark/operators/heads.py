"""The chart of accounts as a reader sees it: one head in full, all heads for a browser, and what is wrong with a chart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fiscal
from . import relational as rel
from .jobs import head_history
from .staging import staged

CELLS = ["kind", "parent_code", "label"]


def blank(c: str) -> Column:
    return F.coalesce(F.trim(c), F.lit("")) == ""


def checked_heads(rows: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(heads, rejects) of ``rows`` (code, parent_code, kind, label). Equal rows of a code count once. rejects (code, reason)
    names each code whose rows are ``incomplete`` (no code, kind or label), stand with different cells (``conflict``) or
    name a parent that no complete row has (``missing parent``). ``strict``: reading the heads fails if there are any.

    Each code is one row of least and greatest cells, so a code that half of all rows bear is summed up before it is
    shuffled.
    """
    bad = blank("code") | blank("kind") | blank("label")
    cells = F.struct(*CELLS)
    own = rows.where(~bad).groupBy("code").agg(F.min(cells).alias("low"), F.max(cells).alias("high"))
    own = staged(own, "heads")
    known = own.select(F.col("code").alias("parent_code"), F.lit(True).alias("known"))
    same = own.where(F.col("low").eqNullSafe(F.col("high"))).select("code", "low.*")
    placed = same.join(known, "parent_code", "left")
    fits = blank("parent_code") | F.col("known").isNotNull()
    rejects = rows.where(bad).select("code", F.lit("incomplete").alias("reason")).distinct()
    rejects = rejects.unionByName(own.where(~F.col("low").eqNullSafe(F.col("high"))).select("code", F.lit("conflict").alias("reason")))
    rejects = rejects.unionByName(placed.where(~fits).select("code", F.lit("missing parent").alias("reason")))
    heads = placed.where(fits).select("code", *CELLS)
    if strict:
        said = F.raise_error(F.concat(F.lit("head "), F.coalesce("code", F.lit("without a code")), F.lit(": "), F.col("reason")))
        heads = heads.unionByName(rejects.select(*[said.cast("string").alias(c) for c in ["code", *CELLS]]))
    return heads, rejects


def head_details(heads: DataFrame, notes: DataFrame, events: DataFrame, booked: DataFrame, asked: DataFrame) -> DataFrame:
    """code, section, item, text, amount, exact: all that is known of the heads of ``asked`` (code), a row for each thing.

    head: its kind and label; class: its account class; path: each head above it; child: each head right below it;
    note: number and text of its notes (code, note_number, note); sibling: heads of the same label in other account
    classes; change: id, action and code of changes under its major (``events``: code, action, event_id), exact where
    one names this minor head; booked: year and amount of what was budgeted under it (``booked``: code, fy, amount).
    ``heads`` holds each code once; codes that it lacks, null ones and repeated ones in ``asked`` add nothing. A path ends
    where a parent isn't a head. Rows follow the asked heads, no list is gathered. ``heads`` is read several times.
    """
    mine = staged(heads.join(asked.select("code").distinct(), "code", "left_semi").select("code", "parent_code", "kind", "label"), "asked")

    def part(rows: DataFrame, section: str, item: Column, text: Column, amount: Column | None = None, exact: Column | None = None) -> DataFrame:
        some = F.lit(None).cast("double") if amount is None else amount.cast("double")
        flag = F.lit(None).cast("boolean") if exact is None else exact
        return rows.select("code", F.lit(section).alias("section"), item.cast("string").alias("item"), text.cast("string").alias("text"), some.alias("amount"), flag.alias("exact"))

    c = F.col
    none = F.lit(None)
    up = heads.select(c("code").alias("above"), c("parent_code").alias("next"), c("label").alias("above_label"))
    first = mine.select("code", c("parent_code").alias("above")).join(up, "above")
    second = first.select("code", c("next").alias("above")).join(up, "above")
    below = heads.select(c("parent_code").alias("code"), c("code").alias("child"), "label").join(mine.select("code"), "code", "left_semi")
    named = heads.select(c("code").alias("sibling"), "label")
    ours = lambda df: df.join(mine.select("code"), "code", "left_semi")
    found = [
        part(mine, "head", c("kind"), c("label")),
        part(mine, "class", fiscal.account_class(c("code")), none),
        part(first.unionByName(second), "path", c("above"), c("above_label")),
        part(below, "child", c("child"), c("label")),
        part(ours(notes), "note", c("note_number"), c("note")),
        part(rel.siblings_of(heads, mine).join(named, "sibling"), "sibling", c("sibling"), c("label")),
        part(head_history(mine, events), "change", c("event_id"), F.concat_ws(" ", "action", "event_code"), exact=c("exact")),
        part(ours(booked), "booked", c("fy"), none, amount=c("amount")),
    ]
    out = found[0]
    for rows in found[1:]:
        out = out.unionByName(rows)
    return out


def json_of(**columns: Column) -> Column:
    return F.to_json(F.struct(*[c.alias(n) for n, c in columns.items()]), {"ignoreNullFields": "false"})


def browser_payload(heads: DataFrame, notes: DataFrame, changes: DataFrame) -> DataFrame:
    """part, id, payload: JSON of each node, note, change, event and of the counts (``meta``), a row for each.

    ``heads``: code, parent_code, kind, label; ``notes``: code, note_number, note; ``changes``: slip, date, event_id, action,
    code, kind, label, old_label. An event is all changes of a slip and date, with the majors that they touch (at most as
    many as four digits name). A node's keys: c code, p parent, t kind, d label, k account class, mh, sm, mn its parts.
    Null cells are JSON nulls. Empty tables give the counts alone.
    """
    c = F.col
    pieces = F.split("code", "-")
    major = F.when(~blank("code"), F.split_part("code", F.lit("-"), F.lit(1)))
    node = json_of(c=c("code"), p=c("parent_code"), t=c("kind"), d=c("label"), k=fiscal.account_class(c("code")), mh=major, sm=F.get(pieces, F.lit(1)), mn=F.get(pieces, F.lit(2)))
    nodes = heads.select(F.lit("node").alias("part"), c("code").alias("id"), node.alias("payload"))
    noted = notes.select(F.lit("note").alias("part"), c("code").alias("id"), json_of(num=c("note_number"), text=c("note")).alias("payload"))
    own = changes.withColumn("major", major)
    change = json_of(slip=c("slip"), action=c("action"), code=F.coalesce("code", F.lit("")), mh=c("major"), type=c("kind"), label=c("label"), old_label=c("old_label"))
    changed = own.select(F.lit("change").alias("part"), c("event_id").cast("string").alias("id"), change.alias("payload"))
    grouped = own.groupBy("slip", "date").agg(F.sort_array(F.collect_set("major")).alias("majors"), F.count(F.lit(1)).alias("n"))
    events = grouped.select(F.lit("event").alias("part"), c("slip").alias("id"), json_of(date=c("date").cast("string"), slip=c("slip"), majors=c("majors"), n_changes=c("n")).alias("payload"))
    kinds = {"major": "major", "sub_major": "submajor", "minor": "minor"}
    counts = heads.agg(F.count(F.lit(1)).alias("total"), *[F.count(F.when(c("kind") == k, 1)).alias(n) for n, k in kinds.items()])
    counts = counts.crossJoin(notes.agg(F.count(F.lit(1)).alias("notes"))).crossJoin(grouped.agg(F.count(F.lit(1)).alias("events")))  # three single rows
    meta = counts.select(F.lit("meta").alias("part"), F.lit(None).cast("string").alias("id"), json_of(**{n: c(n) for n in counts.columns}).alias("payload"))
    return nodes.unionByName(noted).unionByName(changed).unionByName(events).unionByName(meta)
