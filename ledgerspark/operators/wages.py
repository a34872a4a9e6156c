"""Wages that no notification states: a table of states' lowest rates, and whether an employment is scheduled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Days of a month's wage, and what the table's rows stand for.
DAYS = 26
BENCHMARK = "Unskilled (Static Benchmark)"
NOTIFICATION = "2024 Static Aggregation"
# Rates of states with a source of their own: state, employment, skill, daily, monthly.
RATES = [
    ("rajasthan", "Creche Attendant / Unskilled", "unskilled", 285.0, 7410.0),
    ("rajasthan", "Creche-in-charge / Semi-Skilled", "semi_skilled", 297.0, 7722.0),
    ("tamil-nadu", "Anganwadi Worker", "time_scale_level_4", None, 7700.0),
    ("tamil-nadu", "Anganwadi Helper", "time_scale_level_2", None, 4100.0),
    ("uttar-pradesh", "All Scheduled (Unskilled)", "unskilled", None, 10701.0),
    ("madhya-pradesh", "All Scheduled (Unskilled)", "unskilled", None, 12425.0),
]
# What is known of employments: state, employment, status, year of the notification.
STATUS = [
    ("kerala", "anganwadi_worker", "never_scheduled", None), ("kerala", "anganwadi_helper", "never_scheduled", None), ("kerala", "mid_day_meal", "preliminary_excluded", None),
    ("kerala", "domestic_work", "scheduled", 2017), ("kerala", "shops_commercial", "scheduled", 2016), ("kerala", "agricultural", "scheduled", 2025),
    ("rajasthan", "anganwadi_worker", "scheduled", None), ("rajasthan", "anganwadi_helper", "scheduled", None), ("rajasthan", "shops_commercial", "scheduled", 2024),
    ("tamil-nadu", "anganwadi_worker", "never_scheduled", None), ("tamil-nadu", "anganwadi_helper", "never_scheduled", None),
    ("uttar-pradesh", "anganwadi_worker", "never_scheduled", None), ("uttar-pradesh", "anganwadi_helper", "never_scheduled", None), ("uttar-pradesh", "shops_commercial", "scheduled", 2024),
    ("madhya-pradesh", "anganwadi_worker", "never_scheduled", None), ("madhya-pradesh", "anganwadi_helper", "never_scheduled", None),
]
# Employments that are taken for never scheduled in a state of which nothing is known.
ASSUMED = ["anganwadi_worker", "anganwadi_helper"]
WAGES = "state string, employment string, skill string, daily double, monthly double"


def state_key(state: Column) -> Column:
    return F.translate(F.lower(F.trim(state)), " _", "--")


def own_rates(states: DataFrame) -> DataFrame:
    """state, employment, skill, daily, monthly of those of ``states`` (state) that have fixed rates."""
    fixed = states.sparkSession.createDataFrame(RATES, WAGES).withColumnRenamed("state", "key")
    return states.select("state").distinct().join(F.broadcast(fixed), state_key(F.col("state")) == F.col("key")).drop("key")


def wages_from_table(states: DataFrame, rates: DataFrame) -> DataFrame:
    """state, employment, skill, daily, monthly, notification, note of each of ``states`` (state) that ``rates`` (pos, state,
    low, note, all but pos text) names in either case, its own name with ``_`` read as blanks. The first row by pos with
    a low rate counts; a rate that isn't a number is an error, as a wrong table shall not pass for an empty one. States
    without a row give none, repeated and null states no further ones."""
    rate = F.col("low").cast("double")
    known = rates.where("state is not null and coalesce(low, '') <> ''").groupBy(F.lower("state").alias("key")).agg(F.min_by(F.struct(rate.alias("daily"), "note"), "pos").alias("own"))
    rows = states.select("state").distinct().join(known, F.translate(F.lower("state"), "_", " ") == F.col("key"))
    fixed = lambda text: F.lit(text)
    return rows.select(
        "state", fixed(BENCHMARK).alias("employment"), fixed("unskilled").alias("skill"), F.col("own.daily").alias("daily"), (F.col("own.daily") * DAYS).alias("monthly"),
        fixed(NOTIFICATION).alias("notification"), F.coalesce("own.note", F.lit("")).alias("note"),
    )


def state_wages(states: DataFrame, rates: DataFrame) -> DataFrame:
    """state, employment, skill, daily, monthly, source: fixed rates where a state has any, else its row of ``rates``."""
    own = own_rates(states)
    others = states.join(own.select("state").distinct(), "state", "left_anti")
    cells = ["state", "employment", "skill", "daily", "monthly"]
    return own.select(*cells, F.lit("own").alias("source")).unionByName(wages_from_table(others, rates).select(*cells, F.lit("static").alias("source")))


def scheduling_status(states: DataFrame, more: DataFrame | None = None) -> DataFrame:
    """state, employment, status, year for each of ``states`` (state): what is known of it, else the assumed employments
    as never scheduled. ``more`` (state, employment, status, year) adds to what is known."""
    spark = states.sparkSession
    known = spark.createDataFrame(STATUS, "state string, employment string, status string, year int")
    known = known if more is None else known.unionByName(more.select(known.columns))
    known = known.select(state_key(F.col("state")).alias("key"), "employment", "status", "year")
    own = states.where("state is not null").select("state").distinct().withColumn("key", state_key(F.col("state")))
    assumed = own.join(known.select("key"), "key", "left_anti").select("state", F.explode(F.array(*map(F.lit, ASSUMED))).alias("employment"), F.lit("never_scheduled").alias("status"), F.lit(None).cast("int").alias("year"))
    return own.join(known, "key").select("state", "employment", "status", "year").unionByName(assumed)
