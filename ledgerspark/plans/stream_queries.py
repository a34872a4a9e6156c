"""Incremental jobs: files of a table as a stream, merged into a snapshot."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import relational as rel
from ..operators import windows as win
from ..streaming.incremental import run_incremental
from .bindings import table
from .registry import query, shared_folder
from .table_queries import REPLAY


@query("str_01", "SELECT doc_id, source AS state, n_chars FROM documents")
def str_01(spark, sf_dir):
    """Document registry: the last reading of an id wins, by when its file was written."""
    return registry(spark, f"{sf_dir}/documents.parquet*", table(spark, sf_dir, "documents").schema, shared_folder(spark, "registry")).drop("arrived")


def registry(spark, source, schema, folder):
    order = [F.desc("arrived"), "state", "n_chars"]

    def merge(before, batch):
        return rel.first_per(batch, ["doc_id"], order) if before is None else rel.upsert(before, batch, ["doc_id"], order)

    return run_incremental(spark, source, schema, folder, merge, "doc_id", lambda rows: rows.select("doc_id", F.col("source").alias("state"), "n_chars", "arrived"))


@query("str_02", "SELECT user_id, min(event_id) AS event_id FROM events GROUP BY 1")
def str_02(spark, sf_dir):
    """Rows by key, the first one stays."""

    def merge(before, batch):
        return rel.first_per(batch, ["user_id"], ["event_id"]) if before is None else rel.insert_if_absent(before, batch, ["user_id"], ["event_id"])

    return run_incremental(spark, f"{sf_dir}/events.parquet*", table(spark, sf_dir, "events").schema, shared_folder(spark, "rows"), merge, "user_id", lambda rows: rows.select("user_id", "event_id"))


def slip_rows(rows):
    kind = F.col("event_type")
    action = F.when(kind == "signup", "INSERT").when(kind == "error", "DELETE").when(kind == "click", "RENAME").when(kind == "purchase", "UPDATE")
    named = rows.select(F.lpad((F.col("user_id") % 9000).cast("string"), 4, "0").alias("code"), action.alias("action"), F.concat(F.lit("L"), F.col("event_id").cast("string")).alias("label"), "ts", "event_id")
    return named.where("action is not null")


def code_list(spark, source, schema, folder):
    """The code list after all change events so far: a batch replays the events of the buckets that its codes are in.
    Events are kept, as one that comes late may change what follows it; live codes are rows with action LIVE."""

    def merge(before, batch):
        events = batch if before is None else before.where("action <> 'LIVE'").select(*batch.columns).unionByName(batch)
        live = win.replay(events, ["ts", "event_id"]).select("code", F.lit("LIVE").alias("action"), "label")
        return events.unionByName(live, allowMissingColumns=True)

    return run_incremental(spark, source, schema, folder, merge, "code", slip_rows).where("action = 'LIVE'").select("code", "label")


@query("str_03", REPLAY)
def str_03(spark, sf_dir):
    """Change events to the current code list; codes without new events aren't replayed again."""
    return code_list(spark, f"{sf_dir}/events.parquet*", table(spark, sf_dir, "events").schema, shared_folder(spark, "slips"))
