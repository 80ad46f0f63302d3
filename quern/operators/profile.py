"""Column profiles, frequencies, quantiles and outliers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.common import materialize


def _long(structs: Sequence[Column]) -> Column:
    return F.explode(F.array(*structs)).alias("_r")


def missing_data(df: DataFrame) -> DataFrame:
    """Per column: nulls, their percentage of all rows, and the type. One scan, one result row
    turned into one row per column."""
    fields = df.schema.fields
    totals = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(f"`{f.name}`").isNull()).alias(f"_{i}") for i, f in enumerate(fields)],
    )
    return totals.select(
        "_rows",
        _long(
            [
                F.struct(
                    F.lit(f.name).alias("column_name"),
                    F.col(f"_{i}").alias("total"),
                    F.lit(f.dataType.simpleString()).alias("type"),
                )
                for i, f in enumerate(fields)
            ]
        ),
    ).select(
        "_r.column_name",
        "_r.total",
        F.try_divide(F.col("_r.total") * 100.0, "_rows").alias("percent"),
        "_r.type",
    )


def value_counts_by_column(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, value, n)`` of all non-null values as text, from one shuffle.

    Counts are combined before the shuffle, so a frequent value sends one row per task.
    """
    pairs = _long(
        [
            F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value"))
            for c in cols or df.columns
        ]
    )
    return (
        df.select(pairs)
        .select("_r.*")
        .filter(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _all_columns(df: DataFrame, found: DataFrame) -> DataFrame:
    """Add the columns that hold nothing but nulls."""
    names = df.sparkSession.createDataFrame([(c,) for c in df.columns], "column_name string")
    return names.join(found, "column_name", "left")


def unique_values(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Per column the non-null count and the number of distinct values."""
    if approximate:
        sums = df.agg(
            *[F.count(F.col(f"`{c}`")).alias(f"t{i}") for i, c in enumerate(df.columns)],
            *[F.approx_count_distinct(F.col(f"`{c}`")).alias(f"u{i}") for i, c in enumerate(df.columns)],
        )
        return sums.select(
            _long(
                [
                    F.struct(
                        F.lit(c).alias("column_name"),
                        F.col(f"t{i}").alias("total"),
                        F.col(f"u{i}").alias("uniques"),
                    )
                    for i, c in enumerate(df.columns)
                ]
            )
        ).select("_r.*")
    found = (
        value_counts_by_column(df)
        .groupBy("column_name")
        .agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("uniques"))
    )
    return _all_columns(df, found).select(
        "column_name",
        F.coalesce("total", F.lit(0)).alias("total"),
        F.coalesce("uniques", F.lit(0)).alias("uniques"),
    )


def most_frequent_values(df: DataFrame) -> DataFrame:
    """Per column the commonest value (smallest text on ties), its count and share."""
    found = (
        value_counts_by_column(df)
        .groupBy("column_name")
        .agg(
            F.sum("n").alias("total"),
            F.min(F.struct((-F.col("n")).alias("neg"), "value")).alias("top"),
        )
    )
    n = -F.col("top.neg")
    return _all_columns(df, found).select(
        "column_name",
        F.coalesce("total", F.lit(0)).alias("total"),
        F.col("top.value").alias("most_frequent"),
        n.alias("frequency"),
        F.round(n * 100 / F.col("total"), 3).alias("percent"),
    )


SKETCH_ACCURACY = 10_000


def exact_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], limit: int = 1_000_000
) -> dict[tuple[str, float], float | None]:
    """Quantiles with linear interpolation, exact for any number of rows.

    ``percentile`` would gather every distinct value of a column in one task. Here a mergeable
    sketch brackets the two ranks of each quantile, the rows below the bracket are counted, and
    only the distinct values inside it are ranked. A bracket with more than ``limit`` distinct values
    is narrowed again by a sketch of its own. NaN counts as missing.
    """
    clean = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in cols])
    slack = 2.0 / SKETCH_ACCURACY
    shares = [max(0.0, p - slack) for p in probs] + [min(1.0, p + slack) for p in probs]
    sums = clean.agg(
        *[
            F.struct(
                F.count(c).alias("n"),
                F.min(c).alias("lo"),
                F.max(c).alias("hi"),
                F.percentile_approx(c, shares, SKETCH_ACCURACY).alias("q"),
            ).alias(c)
            for c in cols
        ]
    ).first()
    out: dict[tuple[str, float], float | None] = {}
    ranks: dict[tuple[str, float], tuple[int, int]] = {}
    brackets: dict[tuple[str, float], tuple[float, float]] = {}
    for c in cols:
        n = sums[c]["n"]
        for i, p in enumerate(probs):
            if n == 0:
                out[c, p] = None
                continue
            first = int(p * (n - 1))
            ranks[c, p] = (first, min(first + 1, n - 1))
            brackets[c, p] = (sums[c]["q"][i], sums[c]["q"][len(probs) + i])
    whole = {k: (sums[k[0]]["lo"], sums[k[0]]["hi"]) for k in ranks}
    while ranks:
        brackets, below, inside = _checked(clean, ranks, brackets, whole)
        found = _ranked(clean, ranks, brackets, below, limit)
        for (c, p), (low, high) in found.items():
            place = p * (sums[c]["n"] - 1)
            out[c, p] = low + (high - low) * (place - int(place))
            del ranks[c, p]
        if ranks:
            whole = dict(brackets)
            brackets = _tightened(clean, ranks, brackets, below, inside)
    return out


def _inside(c: str, bracket: tuple[float, float]) -> Column:
    return F.col(c).between(F.lit(bracket[0]), F.lit(bracket[1]))


def _checked(clean, ranks, brackets, whole):
    """Rows below and inside each bracket; one that misses its ranks falls back to the wider one."""
    keys = list(ranks)

    def count(tried):
        row = clean.agg(
            *[F.count_if(F.col(k[0]) < F.lit(tried[k][0])).alias(f"b{i}") for i, k in enumerate(keys)],
            *[F.count_if(_inside(k[0], tried[k])).alias(f"n{i}") for i, k in enumerate(keys)],
        ).first()
        return {k: row[f"b{i}"] for i, k in enumerate(keys)}, {k: row[f"n{i}"] for i, k in enumerate(keys)}

    tried = {k: brackets[k] for k in keys}
    below, inside = count(tried)
    missed = [k for k in keys if not below[k] <= ranks[k][0] <= ranks[k][1] < below[k] + inside[k]]
    if missed:
        tried.update({k: whole[k] for k in missed})
        below, inside = count(tried)
    return tried, below, inside


def _tightened(clean, ranks, brackets, below, inside):
    """Narrower brackets from sketches over the rows inside the present ones."""
    keys, slack = list(ranks), 2.0 / SKETCH_ACCURACY
    aggs = []
    for i, k in enumerate(keys):
        first, last = ((r - below[k]) / inside[k] for r in ranks[k])
        shares = [max(0.0, first - slack), min(1.0, last + slack)]
        x = F.when(_inside(k[0], brackets[k]), F.col(k[0]))
        aggs.append(F.percentile_approx(x, shares, SKETCH_ACCURACY).alias(f"q{i}"))
    row = clean.agg(*aggs).first()
    return {k: (row[f"q{i}"][0], row[f"q{i}"][1]) for i, k in enumerate(keys)}


def _ranked(clean, ranks, brackets, below, limit):
    """Values at the wanted ranks, for all brackets with few enough distinct values."""
    found = {k: brackets[k] for k in ranks if brackets[k][0] == brackets[k][1]}
    keys = [k for k in ranks if k not in found]
    if not keys:
        return found
    hits = [_inside(k[0], brackets[k]) for k in keys]
    targets = F.explode(
        F.array(
            *[
                F.struct(F.lit(i).alias("target"), F.when(hit, F.col(k[0])).alias("x"))
                for i, (k, hit) in enumerate(zip(keys, hits))
            ]
        )
    ).alias("s")
    counts = (
        clean.filter(reduce(lambda a, b: a | b, hits))
        .select(targets)
        .select("s.*")
        .filter(F.col("x").isNotNull())
        .groupBy("target", "x")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    counts = materialize(counts, "quantiles")
    sizes = counts.groupBy("target").agg(F.count(F.lit(1)).alias("d")).collect()
    ready = [r["target"] for r in sizes if r["d"] <= limit]
    if not ready:
        return found
    wanted = F.create_map(
        *[
            v
            for i in ready
            for v in (F.lit(i), F.array(*[F.lit(r - below[keys[i]]) for r in ranks[keys[i]]]))
        ]
    )
    upto = Window.partitionBy("target").orderBy("x")
    places = (
        counts.filter(F.col("target").isin(ready))
        .withColumn("end", F.sum("n").over(upto))
        .select("target", "x", "n", "end", F.explode(F.element_at(wanted, F.col("target"))).alias("rank"))
        .filter((F.col("rank") < F.col("end")) & (F.col("rank") >= F.col("end") - F.col("n")))
        .groupBy("target")
        .agg(F.min("x").alias("low"), F.max("x").alias("high"))
    )
    found.update({keys[r["target"]]: (r["low"], r["high"]) for r in places.collect()})
    return found


def describe(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum of the numeric columns."""
    cols = list(cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)])
    quarters = (0.25, 0.5, 0.75)
    q = exact_quantiles(df, cols, quarters)
    x = {c: F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in cols}
    sums = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(x[c]).alias("count"),
                F.avg(x[c]).alias("mean"),
                F.stddev_samp(x[c]).alias("std"),
                F.min(x[c]).alias("min"),
                *[F.lit(q[c, p]).cast("double").alias(f"q{int(p * 100)}") for p in quarters],
                F.max(x[c]).alias("max"),
            ).alias(c)
            for c in cols
        ]
    )
    return sums.select(_long([F.col(f"`{c}`") for c in cols])).select("_r.*")


def schema_info(df: DataFrame) -> DataFrame:
    """Per column: position, type, non-null count and the shape of the frame."""
    fields = df.schema.fields
    sums = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.col(f"`{f.name}`")).alias(f"_{i}") for i, f in enumerate(fields)],
    )
    return sums.select(
        F.col("_rows").alias("n_rows"),
        _long(
            [
                F.struct(
                    F.lit(i).alias("position"),
                    F.lit(f.name).alias("column_name"),
                    F.lit(f.dataType.simpleString()).alias("type"),
                    F.col(f"_{i}").alias("non_null"),
                )
                for i, f in enumerate(fields)
            ]
        ),
    ).select("_r.*", "n_rows", F.lit(len(fields)).alias("n_columns"))


def top_value_share(df: DataFrame, col: str, n: int = 20) -> DataFrame:
    """The ``n`` commonest values with their percentage of all rows, nulls included in the total.

    The total is a scalar subquery that counts without reading any column.
    """
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return counts.orderBy(F.desc("n"), col).limit(n).withColumn("percent", F.col("n") * 100.0 / total)


def class_share(df: DataFrame, col: str) -> DataFrame:
    """Counts of all classes and their share of the non-null total."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / df.agg(F.count(col)).scalar())


def category_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def zscore_outliers(df: DataFrame, col: str, k: float = 1.5) -> DataFrame:
    """Rows further than ``k`` sample deviations from the mean; dates count in seconds."""
    kind = df.schema[col].dataType
    x = F.col(col)
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        x = F.unix_micros(x.cast("timestamp")) / 1e6
    stats = df.agg(F.struct(F.avg(x).alias("mean"), F.stddev_samp(x).alias("sd")).alias("s"))
    s = stats.scalar()
    return df.filter(F.abs(x - s["mean"]) > F.lit(k) * s["sd"])


def range_outliers(df: DataFrame, col: str, lo: float = -10, hi: float = 50) -> DataFrame:
    """Rows above ``hi`` or below ``lo``, told apart by column ``side``."""
    side = F.when(F.col(col) > hi, "high").when(F.col(col) < lo, "low")
    return df.withColumn("side", side).filter(F.col("side").isNotNull())
