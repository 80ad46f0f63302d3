"""Rows and cell arrays to typed frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def from_rows(spark: SparkSession, rows: Sequence[tuple], names: Sequence[str]) -> DataFrame:
    """Literal rows under given names."""
    return spark.createDataFrame(list(rows)).toDF(*names)


def rows_to_frame(df: DataFrame, names: Sequence[str], cells: str = "cells") -> DataFrame:
    """Positional columns from an array of cells.

    Short rows are padded with nulls and long rows cut; ``n_cells`` keeps the true width.
    """
    return df.select(
        *[F.get(F.col(cells), F.lit(i)).alias(n) for i, n in enumerate(names)],
        F.size(cells).alias("n_cells"),
    )


def apply_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rename by position and convert each column; a value that does not convert becomes null."""
    if len(df.columns) != len(schema.fields):
        raise ValueError(f"{len(df.columns)} columns do not match {len(schema.fields)} fields")
    return df.select(
        *[F.col(f"`{c}`").try_cast(f.dataType).alias(f.name) for c, f in zip(df.columns, schema.fields)]
    )
