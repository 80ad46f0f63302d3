"""Registered queries and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quern.common import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given parquet tables of one scale folder: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self._folder = spark, folder

    def texts(self, *columns: str) -> DataFrame:
        """Documents for work that is heavy per text, dealt out if they sit in too few splits."""
        return spread(self.documents.select("doc_id", *columns), "doc_id")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register a function of the tables under ``name`` with its SQL, if there is one."""

    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def sql_list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)
