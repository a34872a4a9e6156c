"""Readers and sinks of files: the given tables are written in a format's shape and read back; joins and residuals of jobs
by themselves; extension points with adapters and sources that a caller passes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import jobs
from ..sources import readers
from . import extensions as ext
from .bindings import LINES, budget_lines, table
from .registry import query, shared_folder


@query("src_01", "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, CASE WHEN p_partkey % 7 <> 0 THEN p_name END AS p_name, p_brand FROM part")
def src_01(spark, sf_dir):
    rows, path = table(spark, sf_dir, "part"), shared_folder(spark, "csv")
    columns = ["p_partkey", "p_name", "p_brand"]
    readers.write_csv(rows.withColumn("p_name", F.when(F.col("p_partkey") % 7 != 0, F.col("p_name"))), path, columns)
    return readers.read_csv_table(spark, path, columns)


@query("src_02", "SELECT c_custkey AS id, c_nationkey AS nation FROM customer")
def src_02(spark, sf_dir):
    """Lists, and objects with the list under a key; a path without a file adds nothing."""
    path = shared_folder(spark, "payload")
    rows = table(spark, sf_dir, "customer").select((F.col("c_custkey") % 40).alias("k"), F.struct(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation")).alias("r"))
    groups = rows.groupBy("k").agg(F.collect_list("r").alias("rows"))
    groups.select("k", F.when(F.col("k") % 2 == 0, F.to_json("rows")).otherwise(F.to_json(F.struct("rows"))).alias("value")).write.partitionBy("k").text(path)
    kind = "struct<id: bigint, nation: bigint>"
    return readers.read_payload(spark, f"{path}/k=*", "rows", kind).unionByName(readers.read_payload(spark, f"{path}-missing", "rows", kind)).select("id", F.col("nation").cast(table(spark, sf_dir, "customer").schema["c_nationkey"].dataType).alias("nation"))


@query("src_03", "SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderstatus AS state, o_custkey AS customer FROM orders")
def src_03(spark, sf_dir):
    path = shared_folder(spark, "map")
    orders = table(spark, sf_dir, "orders")
    one = F.struct(F.col("o_orderkey").cast("string").alias("key"), F.struct(F.col("o_orderstatus").alias("state"), F.col("o_custkey").alias("customer")).alias("value"))
    orders.groupBy((F.col("o_orderkey") % 40).alias("k")).agg(F.to_json(F.map_from_entries(F.collect_list(one))).alias("value")).write.partitionBy("k").text(path)
    return readers.read_map(spark, f"{path}/k=*", f"struct<state: string, customer: {orders.schema['o_custkey'].dataType.simpleString()}>")


@query("src_04", "SELECT o_orderkey AS report_no, o_orderpriority AS title FROM orders")
def src_04(spark, sf_dir):
    """A blank line after each entry."""
    path, rows = shared_folder(spark, "manifest"), table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("report_no"), F.col("o_orderpriority").alias("title"))
    rows.select(F.explode(F.array(F.to_json(F.struct("report_no", "title")), F.lit(""))).alias("value")).write.text(path)
    return readers.read_manifest(spark, path, f"report_no {rows.schema['report_no'].dataType.simpleString()}, title string")


@query("src_09", "SELECT p_partkey AS page_id, CAST(1 AS INT) AS row_no, p_name || '||' || p_brand AS cells FROM part")
def src_09(spark, sf_dir):
    """A heading row, whose cells aren't data, then a cell that spans two columns."""
    html = F.concat(F.lit("<table><tr><th>n</th></tr><tr><td colspan=2> <b>"), "p_name", F.lit("</b>\n</td><td>"), "p_brand", F.lit("</td></tr></table>"))
    rows = readers.table_rows(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("page_id"), html.alias("html")))
    return rows.select("page_id", "row_no", F.array_join("cells", "|").alias("cells"))


@query("snk_04", "SELECT p_partkey, CAST(CASE WHEN p_partkey % 3 = 0 THEN 2 ELSE 1 END AS BIGINT) AS n FROM part")
def snk_04(spark, sf_dir):
    path, rows = shared_folder(spark, "appended"), table(spark, sf_dir, "part").select("p_partkey")
    readers.append(rows, path)
    readers.append(rows.where("p_partkey % 3 = 0"), path)
    return spark.read.schema(rows.schema).parquet(path).groupBy("p_partkey").agg(F.count(F.lit(1)).alias("n"))


@query("snk_06", "SELECT c_custkey || ',' || CASE WHEN c_custkey % 5 <> 0 THEN c_name ELSE '' END AS line FROM customer")
def snk_06(spark, sf_dir):
    path, rows = shared_folder(spark, "csv"), table(spark, sf_dir, "customer")
    readers.write_csv(rows.withColumn("c_name", F.when(F.col("c_custkey") % 5 != 0, F.col("c_name"))), path, ["c_custkey", "c_name"])
    return spark.read.text(path).where("value <> 'c_custkey,c_name'").select(F.col("value").alias("line"))


@query("snk_08", "SELECT o_orderkey AS report_no, CASE WHEN o_orderkey % 4 = 0 THEN 'failed' WHEN o_orderkey % 4 = 1 THEN 'skipped' ELSE 'downloaded' END AS status FROM orders")
def snk_08(spark, sf_dir):
    path, rows = shared_folder(spark, "manifest"), table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("report_no"))
    key = F.col("report_no") % 4
    readers.write_manifest(rows, path, F.when(key == 0, "failed").when(key == 1, "skipped").otherwise("downloaded"))
    return readers.read_manifest(spark, path, f"report_no {rows.schema['report_no'].dataType.simpleString()}, status string")


SERIES = LINES + """, y AS (SELECT fy AS fiscal_year, CAST(substr(fy, 1, 4) AS INT) AS y, sum(CASE WHEN col_type = 're' THEN amount END) AS demanded, sum(CASE WHEN col_type = 'be' THEN amount END) AS be, sum(CASE WHEN col_type = 'actual' THEN amount END) AS actual FROM lines GROUP BY 1, 2)"""


@query("joi_06", f"WITH {SERIES} SELECT fiscal_year, CAST(CASE WHEN y % 2 = 1 THEN demanded END AS DOUBLE) AS demanded, CAST(CASE WHEN y % 4 = 1 THEN be / 2 WHEN coalesce(be, 0) <> 0 THEN be WHEN y % 2 = 1 THEN 0 END AS DOUBLE) AS allocated, CAST(actual AS DOUBLE) AS actual, CAST(CASE WHEN y % 3 = 0 THEN actual * 2 END AS DOUBLE) AS full_scheme, CASE WHEN y > 1993 THEN 100.0 + y END AS deflator FROM y")
def joi_06(spark, sf_dir):
    of = lambda kind: F.sum(F.when(F.col("col_type") == kind, F.col("amount")))
    series = budget_lines(spark, sf_dir).groupBy(F.col("fy").alias("fiscal_year"), F.substring("fy", 1, 4).cast("int").alias("y")).agg(of("re").alias("demanded"), of("be").alias("be"), of("actual").alias("actual"))
    y = F.col("y")
    demand = series.where(y % 2 == 1).select("fiscal_year", "demanded", F.when(y % 4 == 1, F.col("be") / 2).otherwise(F.lit(0)).alias("allocated"))
    external = series.where(y % 3 == 0).select("fiscal_year", (F.col("actual") * 2).alias("full_scheme"))
    deflators = series.where(y > 1993).select("fiscal_year", (100.0 + y).alias("deflator"))
    rows = jobs.spine_join(series.select("fiscal_year"), demand, series.select("fiscal_year", "be", "actual"), external, deflators)
    return rows.select("fiscal_year", *[F.col(c).cast("double").alias(c) for c in ("demanded", "allocated", "actual", "full_scheme", "deflator")])


@query("joi_14", "SELECT o_orderkey AS report_no, CAST(CASE WHEN o_orderkey % 6 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS DOUBLE) AS projected, CASE WHEN o_orderkey % 3 = 0 THEN 'manual' ELSE 'text' END AS confidence FROM orders")
def joi_14(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("report_no"), F.col("o_custkey").cast("double").alias("projected"), F.lit("text").alias("confidence"))
    key = F.col("report_no")
    manual = rows.where(key % 3 == 0).select("report_no", F.when(key % 6 != 0, F.lit(7.0)).alias("projected"), F.lit("manual").alias("confidence"))
    return jobs.with_overrides(rows, manual, "report_no", ["projected", "confidence"])


AGGREGATES = ["own_tax", "own_nontax", "devolution", "grants", "recovery", "rev_dev_social", "cap_social", "rev_dev_econ", "cap_econ", "rev_exp", "cap_outlay"]
PICKED = ", ".join(f"coalesce(sum(CASE WHEN CAST(major AS INT) % 11 = {k} THEN amount END), 0) AS {c}" for k, c in enumerate(AGGREGATES))
RESIDUAL = f"""a AS (SELECT state, fy, {PICKED} FROM lines GROUP BY 1, 2), u AS (SELECT *, rev_dev_social + cap_social AS social, rev_dev_econ + cap_econ AS economic, rev_exp - rev_dev_social - rev_dev_econ + cap_outlay - cap_social - cap_econ AS general FROM a)"""


def aggregates(spark, sf_dir):
    picked = [F.coalesce(F.sum(F.when(F.col("major").cast("int") % 11 == k, F.col("amount"))), F.lit(0)).alias(c) for k, c in enumerate(AGGREGATES)]
    return budget_lines(spark, sf_dir).groupBy("state", "fy").agg(*picked)


@query("agg_09", f"WITH {LINES}, {RESIDUAL} SELECT state, fy, CAST(social AS DOUBLE) AS social, CAST(economic AS DOUBLE) AS economic, CAST(general AS DOUBLE) AS general, CAST(social + economic + general - own_tax - own_nontax - devolution - grants - recovery AS DOUBLE) AS net_borrowing FROM u")
def agg_09(spark, sf_dir):
    rows = jobs.from_aggregates(aggregates(spark, sf_dir), ["state", "fy"])
    return rows.select("state", "fy", *[F.col(c).cast("double").alias(c) for c in ("social", "economic", "general", "net_borrowing")])


@query("ext_02", f"WITH {LINES}, {RESIDUAL}, first AS (SELECT min(fy) AS fy, min(state) AS a, max(state) AS z FROM lines) SELECT state, 'pool' AS target, CAST(own_tax AS DOUBLE) AS amount FROM u JOIN first ON u.fy = first.fy AND u.state = first.a UNION ALL SELECT state, 'own', CAST(sum(amount) AS DOUBLE) FROM lines JOIN first ON lines.fy = first.fy AND lines.state = first.z GROUP BY 1")
def ext_02(spark, sf_dir):
    """Two states of one year: one with the default balance adapter, one with an adapter of its own."""
    lines = budget_lines(spark, sf_dir)
    first = lines.agg(F.min("fy").alias("fy"), F.min("state").alias("a"), F.max("state").alias("z")).first()

    def own(spark, state, fy):
        return lines.where((F.col("state") == first["z"]) & (F.col("fy") == fy)).groupBy("state").agg(F.sum("amount").cast("double").alias("amount")).withColumn("target", F.lit("own"))

    adapters = {(ext.ANY, "balance"): ext.balance_adapter(lambda s: aggregates(s, sf_dir)), (ext.state_key(first["z"]), "balance"): own}
    flows = [ext.flow_of(spark, first[k], first["fy"], "balance", adapters) for k in ("a", "z")]
    return flows[0].where("source = 'Own tax'").select("state", "target", "amount").unionByName(flows[1].select("state", "target", "amount"))


@query("ext_03", "SELECT 'own' AS kind, s_suppkey AS id FROM supplier WHERE s_nationkey = (SELECT max(n_nationkey) FROM nation) UNION ALL SELECT 'static', c_custkey FROM customer WHERE c_nationkey = (SELECT min(n_nationkey) FROM nation)")
def ext_03(spark, sf_dir):
    """A state with a wage source of its own, and one that falls back on the static source."""
    states = table(spark, sf_dir, "nation").agg(F.min_by("n_name", "n_nationkey").alias("a"), F.max_by("n_name", "n_nationkey").alias("z")).first()
    nation = table(spark, sf_dir, "nation")

    def rows(name, kind, owner, key, state):
        own = nation.where(F.regexp_replace(F.lower("n_name"), "[ _]", "-") == ext.state_key(state)).select(F.col("n_nationkey").alias(owner))
        return table(spark, sf_dir, name).join(own, owner, "left_semi").select(F.lit(kind).alias("kind"), F.col(key).alias("id"))

    sources = {
        ext.ANY: lambda s, state: rows("customer", "static", "c_nationkey", "c_custkey", state),
        ext.state_key(states["z"]): lambda s, state: rows("supplier", "own", "s_nationkey", "s_suppkey", state),
    }
    return ext.wages_of(spark, states["z"], sources).unionByName(ext.wages_of(spark, states["a"], sources))
