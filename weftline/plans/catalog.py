"""Registered queries: each a function of (spark, folder) with, where SQL can say the same, DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import spread
from ..sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


class Tables:
    """The tables of a folder, by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return table(self.spark, self.folder, name)

    def texts(self, *columns: str) -> DataFrame:
        """These columns of ``documents``, on all cores if the table is small."""
        return spread(self.documents.select(*columns))


def query(sql: str | None):
    """Registers a function of ``Tables`` under its name."""

    def register(f):
        QUERIES[f.__name__] = lambda spark, folder: f(Tables(spark, folder))
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register
