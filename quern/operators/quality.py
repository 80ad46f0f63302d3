"""Checks of data quality, their report, checked loads, run health and a data dictionary.

Each check gives one row per thing checked: ``check_name, target, n_rows, n_failed``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.common import materialize
from quern.sinks.tables import load_table


def _failures(df: DataFrame, check: str, failed: Mapping[str, Column]) -> DataFrame:
    """Rows that fail each condition, from one scan."""
    names = list(failed)
    sums = df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(failed[n]).alias(f"_{i}") for i, n in enumerate(names)])
    each = [F.struct(F.lit(n).alias("target"), F.col(f"_{i}").alias("n_failed")) for i, n in enumerate(names)]
    rows = sums.select("n_rows", F.explode(F.array(*each)).alias("_r"))
    return rows.select(F.lit(check).alias("check_name"), "_r.target", "n_rows", "_r.n_failed")


def check_nulls(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return _failures(df, "nulls", {c: F.col(f"`{c}`").isNull() for c in cols or df.columns})


def check_regex(df: DataFrame, col: str, pattern: str) -> DataFrame:
    """Values, nulls aside, in which the pattern is not found."""
    return _failures(df, "regex", {col: ~F.col(col).rlike(pattern)})


def check_range(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    """Values, nulls aside, outside ``lo`` to ``hi``."""
    return _failures(df, "range", {col: ~F.col(col).between(lo, hi)})


def check_date_format(df: DataFrame, col: str, fmt: str = "yyyy-MM-dd") -> DataFrame:
    """Texts, nulls aside, that are no date of the format."""
    return _failures(df, "date_format", {col: F.col(col).isNotNull() & F.try_to_timestamp(col, F.lit(fmt)).isNull()})


def _repeated(df: DataFrame, check: str, cols: Sequence[str], failed: Column) -> DataFrame:
    groups = df.groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.count(F.lit(1)).alias("_n"))
    n = F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows")
    bad = F.coalesce(F.sum(F.when(F.col("_n") > 1, failed)), F.lit(0)).alias("n_failed")
    return groups.agg(n, bad).select(F.lit(check).alias("check_name"), F.lit(",".join(cols)).alias("target"), "n_rows", "n_failed")


def check_duplicates(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows beyond the first of equal rows; nulls equal each other."""
    return _repeated(df, "duplicates", list(cols or df.columns), F.col("_n") - 1)


def check_unique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows whose key occurs more than once."""
    return _repeated(df, "unique", list(cols), F.col("_n"))


def check_foreign_key(df: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Rows whose key, nulls aside, is missing in the parent. Rows are counted per key before the join."""
    counts = df.groupBy(F.col(col).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    keys = parent.select(F.col(parent_col).alias("_k")).where("_k IS NOT NULL").distinct().withColumn("_there", F.lit(True))
    joined = counts.join(keys, "_k", "left")
    lost = F.when(F.col("_k").isNotNull() & F.col("_there").isNull(), F.col("_n"))
    sums = joined.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum(lost), F.lit(0)).alias("n_failed"))
    return sums.select(F.lit("foreign_key").alias("check_name"), F.lit(col).alias("target"), "n_rows", "n_failed")


def quality_report(checks: Mapping[str, Sequence[DataFrame]]) -> DataFrame:
    """All checks of all tables with the share that failed and the verdict."""
    parts = [c.withColumn("table_name", F.lit(name)) for name, found in checks.items() for c in found]
    rows = reduce(lambda a, b: a.unionByName(b), parts)
    percent = F.coalesce(F.try_divide(F.col("n_failed") * 100.0, F.col("n_rows")), F.lit(0.0))
    return rows.select(
        "table_name", "check_name", "target", "n_rows", "n_failed", percent.alias("percent_failed"),
        (F.col("n_failed") == 0).alias("passed"),
    )


@dataclass(frozen=True)
class Load:
    """One checked load: where rows come from, the checks they must pass and the table they go to."""

    name: str
    read: Callable[[], DataFrame]
    db: str
    table: str
    checks: Sequence[Callable[[DataFrame], DataFrame]] = field(default_factory=tuple)


def run_pipeline(spark: SparkSession, loads: Sequence[Load]) -> DataFrame:
    """Run each load and return its log: ``name, n_rows, n_checks, n_failed_checks, state``.

    A load whose checks fail leaves its table as it was and is logged as ``rejected``. The rows are stored once,
    so that what was checked is what is loaded. Retries and alerts belong to the job runner, which reads the log.
    """
    log = []
    for load in loads:
        rows = materialize(load.read(), "load")
        failed = 0
        for check in load.checks:
            failed += not check(rows).where("n_failed > 0").isEmpty()
        if not failed:
            load_table(rows, load.db, load.table)
        log.append((load.name, rows.count(), len(load.checks), failed, "rejected" if failed else "loaded"))
    return spark.createDataFrame(log, "name string, n_rows bigint, n_checks int, n_failed_checks int, state string")


def pipeline_health(
    run_log: DataFrame, period: str = "week", name: str = "name", at: str = "started", ok: str = "ok",
    seconds: str = "seconds", cost: str | None = None, alert_below: float = 90.0,
) -> DataFrame:
    """Runs, failures, success in percent, mean run time and cost per pipeline and period, with an alert mark."""
    good = F.count_if(F.col(ok))
    sums = run_log.groupBy(F.col(name).alias("name"), F.to_date(F.date_trunc(period, at)).alias("period")).agg(
        F.count(F.lit(1)).alias("n_runs"),
        (F.count(F.lit(1)) - good).alias("n_failures"),
        (good * 100.0 / F.count(F.lit(1))).alias("success_percent"),
        F.avg(seconds).alias("mean_seconds"),
        (F.sum(cost) if cost else F.lit(None).cast("double")).alias("cost"),
    )
    return sums.withColumn("alert", F.col("success_percent") < alert_below)


def data_dictionary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per table and column: position, type, rows, non-null rows, smallest and largest value as text; one scan a table."""
    parts = []
    for table, df in tables.items():
        fields = df.schema.fields
        stats = [
            x
            for i, f in enumerate(fields)
            for x in (
                F.count(F.col(f"`{f.name}`")).alias(f"_c{i}"),
                *(
                    _unsigned_zero(fn(F.col(f"`{f.name}`")), f).cast("string").alias(f"_{m}{i}")
                    if _ordered(f)
                    else F.lit(None).cast("string").alias(f"_{m}{i}")
                    for m, fn in (("l", F.min), ("h", F.max))
                ),
            )
        ]
        sums = df.agg(F.count(F.lit(1)).alias("_rows"), *stats)
        each = [
            F.struct(
                F.lit(i).alias("position"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("type"),
                F.col(f"_c{i}").alias("non_null"), F.col(f"_l{i}").alias("low"), F.col(f"_h{i}").alias("high"),
            )
            for i, f in enumerate(fields)
        ]
        rows = sums.select("_rows", F.explode(F.array(*each)).alias("_r"))
        parts.append(rows.select(F.lit(table).alias("table_name"), "_r.*", F.col("_rows").alias("n_rows")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def _unsigned_zero(value: Column, f) -> Column:
    """-0.0 and 0.0 are equal, so either may be the smallest: both read 0.0."""
    kind = f.dataType.simpleString()
    return F.when(value == 0, F.lit(0.0).cast(kind)).otherwise(value) if kind in ("float", "double") else value


def _ordered(f) -> bool:
    return not f.dataType.simpleString().startswith(("array", "map", "struct", "binary", "variant"))


def relationships(tables: Mapping[str, DataFrame], pairs: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """For each pair (child, column, parent, column) whether all child keys occur in the parent."""
    parts = [
        check_foreign_key(tables[c], col, tables[p], key).select(
            F.lit(c).alias("child"), F.lit(col).alias("child_column"), F.lit(p).alias("parent"), F.lit(key).alias("parent_column"),
            (F.col("n_failed") == 0).alias("included"),
        )
        for c, col, p, key in pairs
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def find_relationships(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(child, child_column, parent, parent_column, n_values, parent_is_key)``: columns whose values all occur in another.

    Integer columns are compared with integer columns and text with text; nulls are no values, and a column without
    values is no child. ``parent_is_key`` says that the other column holds a different value in every row. All
    columns of all tables go through one shuffle: for each value the set of columns that hold it, combined in the
    tasks, then the number of values for each set of columns, from which the pairs are added up.
    """
    parts, columns = [], []
    for table, df in tables.items():
        cells = []
        for f in df.schema.fields:
            kind = "int" if f.dataType.simpleString() in ("tinyint", "smallint", "int", "bigint") else f.dataType.simpleString()
            if kind not in ("int", "string"):
                continue
            value = F.col(f"`{f.name}`").cast("string")
            # Long texts travel as digests, which no short one equals.
            short = value if kind == "int" else F.when(F.length(value) < 64, value).otherwise(F.sha2(value, 256))
            cells.append(F.struct(F.lit(kind).alias("kind"), short.alias("value"), F.lit(len(columns)).alias("code")))
            columns.append((len(columns), table, f.name))
        if cells:
            parts.append(df.select(F.explode(F.array(*cells)).alias("_c")).select("_c.*").filter("value is not null"))
    spark = next(iter(tables.values())).sparkSession
    if not parts:
        schema = "child string, child_column string, parent string, parent_column string, n_values bigint, parent_is_key boolean"
        return spark.createDataFrame([], schema)
    values = reduce(lambda a, b: a.unionByName(b), parts).groupBy("kind", "value").agg(F.sort_array(F.collect_set("code")).alias("codes"))
    sets = materialize(values.groupBy("codes").agg(F.count(F.lit(1)).alias("n")), "sets")
    sizes = sets.select(F.explode("codes").alias("code"), "n").groupBy("code").agg(F.sum("n").alias("size"))
    pairs = sets.select(F.explode("codes").alias("a"), "codes", "n").select("a", F.explode("codes").alias("b"), "n").filter("a <> b")
    both = pairs.groupBy("a", "b").agg(F.sum("n").alias("n"))
    counts = [df.select(F.lit(t).alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n_rows")) for t, df in tables.items()]
    # One row for each column, however large the tables are.
    names = spark.createDataFrame(columns, "code int, t string, c string").join(sizes, "code").join(
        reduce(lambda a, b: a.unionByName(b), counts), "t"
    )
    names = materialize(names, "columns")
    child = names.select(F.col("code").alias("a"), F.col("t").alias("child"), F.col("c").alias("child_column"), "size")
    parent = names.select(
        F.col("code").alias("b"), F.col("t").alias("parent"), F.col("c").alias("parent_column"),
        (F.col("size") == F.col("n_rows")).alias("parent_is_key"),
    )
    return both.join(child, "a").filter("n = size").join(parent, "b").select(
        "child", "child_column", "parent", "parent_column", F.col("n").alias("n_values"), "parent_is_key"
    )
