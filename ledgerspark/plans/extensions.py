"""Extension points: text signals, flow adapters and wage sources that a user may add."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import values
from ..operators import jobs

#: name to a function from a text column to {score name: column}. Users may add their own, a pandas UDF among them.
SIGNALS: dict[str, Callable[[Column], dict[str, Column]]] = {}
#: (state, view) to a function of (spark, state, fiscal year) that returns lines or balance flows.
ADAPTERS: dict[tuple[str, str], Callable[[SparkSession, str, str], DataFrame]] = {}
#: state key to a function of (spark, state) that returns wage rows.
WAGE_SOURCES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: The adapter of a view whose state has none, and the wage source of states without one.
ANY = "*"


def by_markers(text: Column) -> dict[str, Column]:
    """The default text signals: occurrences of the fixed markers."""
    return {"austerity_score": values.signal(text, values.AUSTERITY), "extravagance_score": values.signal(text, values.EXTRAVAGANCE)}


SIGNALS["markers"] = by_markers


def text_signals(df: DataFrame, text: str, provider: str | Callable[[Column], dict[str, Column]] = "markers") -> DataFrame:
    """``df`` with the scores of a provider, given by its name or itself."""
    return df.withColumns((SIGNALS[provider] if isinstance(provider, str) else provider)(df[text]))


def state_key(state: str) -> str:
    return state.strip().lower().replace(" ", "-").replace("_", "-")


def add_adapter(state: str, view: str, load: Callable[[SparkSession, str, str], DataFrame]) -> None:
    ADAPTERS[(state_key(state), view)] = load


def flow_of(spark: SparkSession, state: str, fy: str, view: str, adapters: dict | None = None) -> DataFrame:
    """The flow by the state's own adapter of the view, else by the view's default one. ``adapters``: those of the
    caller in place of the registered ones."""
    known = ADAPTERS if adapters is None else adapters
    load = known.get((state_key(state), view)) or known.get((ANY, view))
    if load is None:
        raise KeyError(f"no adapter for {state}, {view}")
    return load(spark, state, fy)


def balance_adapter(aggregates: Callable[[SparkSession], DataFrame]) -> Callable[[SparkSession, str, str], DataFrame]:
    """The default adapter of the balance view: edges from a table of aggregates (state, fy and the columns that
    ``jobs.from_aggregates`` reads)."""

    def load(spark: SparkSession, state: str, fy: str) -> DataFrame:
        own = aggregates(spark).where((F.regexp_replace(F.lower(F.trim("state")), "[ _]", "-") == state_key(state)) & (F.col("fy") == fy))
        return jobs.balance_flow(jobs.from_aggregates(own, ["state", "fy"]), ["state", "fy"])

    return load


def wages_of(spark: SparkSession, state: str, sources: dict | None = None) -> DataFrame:
    """Wage rows of a state by its own source, else by the static one. ``sources``: as ``adapters`` above."""
    known = WAGE_SOURCES if sources is None else sources
    load = known.get(state_key(state)) or known.get(ANY)
    if load is None:
        raise KeyError(f"no wage source for {state}")
    return load(spark, state)
