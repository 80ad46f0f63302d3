"""Projections, filters, ranks, limits and unions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.common import broadcast_if_small, with_row_number


def project_rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Select the columns of ``mapping`` in its order under their new names."""
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in mapping.items()])


def _without_nan(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        column = F.when(~F.isnan(column), column)
    elif isinstance(field.dataType, T.StringType):
        column = F.when(F.lower(column) != "nan", column)
    return column.alias(field.name)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN numbers and the text ``nan`` in any case become null, in every column."""
    return df.select(*[_without_nan(f) for f in df.schema.fields])


def coerce(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """Convert columns in place; what does not convert becomes null.

    Integers are read through double, so ``'12.9'`` gives 12.
    """
    whole = {"tinyint", "smallint", "int", "integer", "bigint", "long"}

    def convert(name: str) -> Column:
        if name not in casts:
            return F.col(f"`{name}`")
        column, kind = F.col(f"`{name}`"), casts[name]
        if kind in whole:
            column = column.try_cast("double")
        return column.try_cast(kind).alias(name)

    return df.select(*[convert(c) for c in df.columns])


def trim_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.trim(F.col(f"`{c}`")) for c in cols})


def require_key(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull())


def exclude_rows(
    df: DataFrame,
    not_null: Sequence[str] = (),
    not_in: Mapping[str, Sequence[Any]] | None = None,
) -> DataFrame:
    """Rows whose ``not_null`` columns are set and whose ``not_in`` columns hold other values.

    By three-valued logic a null in a ``not_in`` column also drops the row.
    """
    rules = [F.col(c).isNotNull() for c in not_null]
    rules += [~F.col(c).isin(*values) for c, values in (not_in or {}).items()]
    return df.filter(reduce(lambda a, b: a & b, rules, F.lit(True)))


def drop_repeated_header(df: DataFrame, col: str, label: str) -> DataFrame:
    """Drop rows that repeat the header text; null rows stay."""
    return df.filter(~F.col(col).eqNullSafe(F.lit(label)))


def require_nonempty(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Only ``cols``, and only rows where each is neither null nor empty."""
    filled = reduce(lambda a, b: a & b, [F.col(c).isNotNull() & (F.col(c) != "") for c in cols])
    return df.select(*cols).filter(filled)


def exclude_record(df: DataFrame, record: Mapping[str, Any], required: str | None = None) -> DataFrame:
    """Drop rows equal to ``record`` in all its columns, and rows without ``required``."""
    same = reduce(lambda a, b: a & b, [F.col(c) == F.lit(v) for c, v in record.items()])
    return df.filter(~same if required is None else ~same & F.col(required).isNotNull())


def drop_by_id(df: DataFrame, ids: DataFrame | Sequence[Any], key: str) -> DataFrame:
    """Drop listed rows; a table of ids is broadcast only after a check of its size."""
    if not isinstance(ids, DataFrame):
        return df.filter(~F.coalesce(F.col(key).isin(*ids), F.lit(False)))
    return df.join(broadcast_if_small(ids.select(key).distinct()), key, "left_anti")


def slice_rows(df: DataFrame, order: Sequence[str | Column], lo: int, hi: int) -> DataFrame:
    """Rows at places ``lo`` to ``hi - 1`` of the given order.

    A slice near the start is a bounded top-k; any other one goes through the distributed ranking.
    """
    if hi <= 10_000:
        return df.orderBy(*order).offset(lo).limit(hi - lo)
    placed = with_row_number(df, order, "_place")
    return placed.filter((F.col("_place") >= lo) & (F.col("_place") < hi)).drop("_place")


def add_default_column(df: DataFrame, col: str, value: Any) -> DataFrame:
    return df if col in df.columns else df.withColumn(col, F.lit(value))


def append_rows(df: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both by column name; missing columns are null."""
    return df.unionByName(new, allowMissingColumns=True)


def append_tables(dfs: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def factorize(df: DataFrame, col: str, order: str, name: str = "code") -> DataFrame:
    """Code values by first appearance in ``order``; null gets -1.

    The distinct values are ranked by range partitions, so a column of high cardinality does not
    pass through one task, and the join back is broadcast only if the stored list is small.
    """
    first = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.min(order).alias("_first"))
    codes = with_row_number(first, ["_first", col], "_code").select(col, "_code")
    return (
        df.join(codes, col, "left").withColumn(name, F.coalesce("_code", F.lit(-1))).drop("_code")
    )


def top_n_per_group(
    df: DataFrame, group: Sequence[str], n: int, by: str, tie: Sequence[str]
) -> DataFrame:
    """The ``n`` largest rows of each group, best first in column ``rank``.

    Spark keeps the first ``n`` rows per group in every task before the shuffle, so a frequent
    group sends no more than ``n`` rows per task.
    """
    best = Window.partitionBy(*group).orderBy(F.desc(by), *tie)
    return df.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n)


def last_n(df: DataFrame, order: Sequence[str], n: int, where: Column | None = None) -> DataFrame:
    kept = df if where is None else df.filter(where)
    return kept.orderBy(*[F.desc(c) for c in order]).limit(n)


def first_n(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def argmax_index(vector: str | Column) -> Column:
    """Zero-based place of the largest element, the first one on ties."""
    v = F.col(vector) if isinstance(vector, str) else vector
    return (F.array_position(v, F.array_max(v)) - 1).cast("int")


def argmax_label(df: DataFrame, vec: str, name: str = "best") -> DataFrame:
    return df.withColumn(name, argmax_index(vec))
