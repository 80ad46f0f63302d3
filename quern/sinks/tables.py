"""Catalog tables, delimited text and per-key output.

A table is a view over numbered, immutable versions. A job that rewrites a table it reads builds
the next version beside the current one and then swaps the view in one statement, so a lost
executor or a failed job leaves the old contents in place.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.common import broadcast_if_small, materialize


def _versions(spark: SparkSession, db: str, table: str) -> list[tuple[int, str]]:
    """Number and name of the stored versions, oldest first."""
    names = spark.sql(f"SHOW TABLES IN `{db}` LIKE '{table}__v*'").select("tableName").collect()
    found = (re.fullmatch(re.escape(table.lower()) + r"__v(\d+)_[0-9a-f]{8}", r[0]) for r in names)
    return sorted((int(m.group(1)), m.group(0)) for m in found if m)


def table_exists(spark: SparkSession, db: str, table: str) -> bool:
    return spark.catalog.tableExists(f"`{db}`.`{table}`")


def _publish(df: DataFrame, db: str, table: str) -> None:
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
    old = _versions(spark, db, table)
    number = max(old, default=(-1, ""))[0] + 1
    # Managed by the warehouse, so that dropping a version frees its files; the suffix keeps two writers apart.
    version = f"{table}__v{number}_{uuid.uuid4().hex[:8]}"
    df.write.saveAsTable(f"`{db}`.`{version}`")
    spark.sql(f"CREATE OR REPLACE VIEW `{db}`.`{table}` AS SELECT * FROM `{db}`.`{version}`")
    # The version just replaced stays for queries that are still reading it.
    for _, stale in old[:-1]:
        spark.sql(f"DROP TABLE IF EXISTS `{db}`.`{stale}`")


def load_table(df: DataFrame, db: str, table: str, merge_schema: bool = False) -> DataFrame:
    """Replace the contents of a table; ``merge_schema`` keeps stored columns that ``df`` lacks."""
    spark = df.sparkSession
    if merge_schema and table_exists(spark, db, table):
        stored = spark.table(f"`{db}`.`{table}`").schema
        missing = [f for f in stored.fields if f.name not in df.columns]
        df = df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])
    _publish(df, db, table)
    return spark.table(f"`{db}`.`{table}`")


def upsert_rows(stored: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored rows with those of equal key replaced, and new keys added.

    Keys match null-safely and repeated incoming keys raise. Only the incoming keys meet the stored
    table: they are written once and counted, and a batch of moderate size is broadcast, so that the
    stored table is not shuffled.
    """
    names = list(keys)
    # Written once: the keys that are checked are those of the rows that are stored.
    incoming = materialize(incoming, "incoming")
    seen = materialize(incoming.groupBy(*names).agg(F.count(F.lit(1)).alias("_n")), "keys")
    if not seen.filter("_n > 1").isEmpty():
        raise ValueError(f"incoming rows repeat a key in {names}")
    match = reduce(lambda a, b: a & b, [F.col(f"s.`{k}`").eqNullSafe(F.col(f"i.`{k}`")) for k in names])
    few = broadcast_if_small(seen.drop("_n"), 1_000_000)
    kept = stored.alias("s").join(few.alias("i"), match, "left_anti")
    return kept.unionByName(incoming, allowMissingColumns=True)


def upsert_table(df: DataFrame, db: str, table: str, keys: Sequence[str]) -> DataFrame:
    """Upsert ``df`` into a stored table, creating the table on first use."""
    spark = df.sparkSession
    if table_exists(spark, db, table):
        stored = spark.table(f"`{db}`.`{table}`")
    else:
        stored = df.limit(0)
    _publish(upsert_rows(stored, df, keys), db, table)
    return spark.table(f"`{db}`.`{table}`")


def write_text_table(df: DataFrame, path: str, header: bool = True, sep: str = ",") -> None:
    """Delimited text files with a header line and no index column."""
    df.write.option("header", header).option("sep", sep).option("escape", '"').csv(path)


def write_per_key(df: DataFrame, key: str, path: str, format: str = "parquet") -> None:
    """One output folder per value of ``key``.

    Rows are rebalanced by key first: without it every task would write a small file for every key.
    The hint lets Spark split a frequent key over many files of a good size.
    """
    df.hint("rebalance", key).write.partitionBy(key).format(format).save(path)
