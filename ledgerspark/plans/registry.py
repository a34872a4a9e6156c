"""Registered queries of the fiscal operators: name to (query, the same in SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.staging import shared_folder  # noqa: F401

FOUND: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        FOUND[name] = (f, sql)
        return f

    return add

