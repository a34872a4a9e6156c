"""Leaderboard and audit of shrinking transfers against figures worked out by hand."""

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerspark.operators import squeeze
from ledgerspark.plans import squeeze_queries  # noqa: F401
from ledgerspark.plans.registry import FOUND


def statement(spark, rows):
    return spark.createDataFrame(rows, "name_cell string, value string")


@pytest.fixture(scope="module")
def parts(spark):
    devolution = statement(spark, [("1. Alpha", "783"), ("2. Beta", "1,566"), ("3. Gamma ", "-"), ("Delta", " "), ("All States and UTs", "9,000"), ("Total", "9,000"), (None, "5"), ("7. Solo", "5")])
    liabilities = statement(spark, [("1. Alpha", "1,000"), ("2. Beta", "500"), ("9. Gamma", "300"), ("Delta", "-"), ("All States and UTs", "5,000"), ("Total", "5,000"), (None, "5"), ("4. Epsilon", "10")])
    percent = statement(spark, [("1. Alpha", "50"), ("1. Alpha", "25"), ("2. Beta", "25.0"), ("3. Gamma", "30"), ("4. Delta", "30"), ("All States and UTs", "25"), ("Total", "25"), (None, "5"), ("4. Epsilon", None)])
    grants = spark.createDataFrame([(2, "ALPHA", 20.0), (1, "alpha", 10.0), (1, "Beta", None), (2, "BETA", 7.0), (3, None, 1.0)], "pos int, state string, amount double")
    return devolution, liabilities, percent, grants


def test_leaderboard(spark, parts):
    _, liabilities, percent, _ = parts
    got = [(r.rank, r.state, r.gsdp, round(r.gap, 4)) for r in squeeze.squeeze_leaderboard(liabilities, percent).orderBy("rank").collect()]
    rate = 0.12 * 0.41 * 0.217
    # a name that stands twice counts twice; equal gaps by name; no value, a dash or an unknown name: no row
    assert got == [
        (1, "All States and UTs", 20000.0, round(20000 * rate, 4)), (2, "Total", 20000.0, round(20000 * rate, 4)), (3, "Alpha", 4000.0, round(4000 * rate, 4)),
        (4, "Alpha", 2000.0, round(2000 * rate, 4)), (5, "Beta", 2000.0, round(2000 * rate, 4)), (6, "Gamma", 1000.0, round(1000 * rate, 4)),
    ]


def test_audit_and_totals(spark, parts):
    audit = squeeze.squeeze_audit(*parts)
    got = [(r.rank, r.state, r.gsdp, round(r.gap, 6), r.grants, r.local_intensity) for r in audit.orderBy("rank").collect()]
    # the first grant counts though it is null; Gamma reports none; what is given to no state has no gap
    assert got == [(1, "Beta", 2000.0, 434.0, None, None), (2, "Alpha", 2000.0, 217.0, 10.0, 0.5), (3, "Alpha", 4000.0, 217.0, 10.0, 0.25), (4, "Gamma", 1000.0, 0.0, None, None)]
    assert [round(r.intensity, 4) for r in audit.orderBy("rank").collect()] == [21.7, 10.85, 5.425, 0.0]
    total = squeeze.audit_totals(audit).first()
    assert (total.gsdp, round(total.gap, 6), total.grants, round(total.intensity, 6)) == (9000.0, 868.0, 20.0, round(868 / 90, 6))


def test_no_rows(spark, parts):
    none = statement(spark, [])
    assert squeeze.squeeze_leaderboard(none, parts[2]).count() == 0
    audit = squeeze.squeeze_audit(none, none, none, parts[3].where("false"))
    assert audit.count() == 0
    assert squeeze.audit_totals(audit).collect()[0].asDict() == {"gsdp": None, "gap": None, "grants": None, "intensity": 0.0}


def test_one_name_many_times(spark):
    """A state that a statement names for half of all rows spreads over the ranks' parts."""
    many = spark.range(4000).select(F.when(F.col("id") % 2 == 0, "1. Hot").otherwise(F.concat(F.lit("2. S"), F.col("id"))).alias("name_cell"), F.lit("25").alias("value"))
    one = many.dropDuplicates(["name_cell"]).withColumn("value", F.lit("100"))
    board = squeeze.squeeze_leaderboard(one, many)
    assert board.count() == 4000 and board.where("state = 'Hot'").count() == 2000
    assert board.agg(F.min("rank"), F.max("rank"), F.countDistinct("rank")).first() == (1, 4000, 4000)


def test_leaderboard_of_products_one_bit_apart(spark):
    """465 at 9.3 % is one bit less than 365 at 7.3 %, though both come to one gap: the product ranks, not the name."""
    liabilities, percent = statement(spark, [("1. A", "465"), ("2. B", "365"), ("3. C", "465")]), statement(spark, [("1. A", "9.3"), ("2. B", "7.3"), ("3. C", "9.3")])
    got = squeeze.squeeze_leaderboard(liabilities, percent).orderBy("rank").collect()
    assert len({r.gap for r in got}) == 1
    assert [(r.rank, r.state, r.gsdp) for r in got] == [(1, "B", 5000.0), (2, "A", 4999.999999999999), (3, "C", 4999.999999999999)]


def test_leaderboard_query_matches_its_sql_on_near_ties_and_halves(spark, tmp_path):
    """Customers whose products differ in the last bit, and whose gaps are halves of a cent."""
    run, sql = FOUND["job_16_leaderboard"]
    balances = {40: 365.0, 42: 465.0, 45: 615.0, 80: 912.5, 82: 5012.5, 122: 6187.5, 162: 6837.5, 202: 9137.5, 240: 9762.5}
    duck = duckdb.connect()
    rows = " UNION ALL ".join(f"SELECT {k}::BIGINT AS c_custkey, {v}::DOUBLE AS c_acctbal" for k, v in balances.items())
    duck.execute(f"COPY ({rows}) TO '{tmp_path}/customer.parquet'")
    duck.execute(f"COPY (SELECT 1::BIGINT AS o_orderkey, 40::BIGINT AS o_custkey, 1::DOUBLE AS o_totalprice, '1-URGENT' AS o_orderpriority) TO '{tmp_path}/orders.parquet'")
    for name in ("customer", "orders"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet'")
    want = duck.sql(sql).fetchall()
    assert len(want) == len(balances) + 1
    assert sorted(map(tuple, run(spark, str(tmp_path)).collect())) == sorted(want)
