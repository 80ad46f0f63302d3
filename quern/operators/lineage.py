"""Graph of reports and the tables they read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def relationship_edges(df: DataFrame, src: str = "report", entries: str = "entries") -> DataFrame:
    """``TABLE (column)`` entries to ``(src, dst, column, pos)``; without parentheses ``column`` is empty."""
    rows = df.select(F.col(src).alias("src"), F.posexplode(entries).alias("pos", "entry"))
    both = F.col("entry").contains("(") & F.col("entry").contains(")")
    inner = F.get(F.split("entry", r"\("), F.lit(1))
    return rows.select(
        "src",
        F.when(both, F.trim(F.substring_index("entry", "(", 1))).otherwise(F.trim("entry")).alias("dst"),
        F.when(both, F.regexp_replace(inner, r"^\)+|\)+$", "")).otherwise("").alias("column"),
        "pos",
    )


def graph_nodes(reports: DataFrame, edges: DataFrame, src: str = "report") -> DataFrame:
    """Reports, also those without entries, and tables. Names are case-sensitive."""
    return (
        reports.select(F.col(src).alias("node"))
        .union(edges.select("src"))
        .union(edges.select("dst"))
        .distinct()
    )


def edge_labels(edges: DataFrame, mode: str = "last") -> DataFrame:
    """One label per edge: the last named column, or with ``all`` every named column once, in order."""
    named = F.col("column") != ""
    by_edge = edges.groupBy("src", "dst")
    if mode == "last":
        return by_edge.agg(
            F.coalesce(F.max_by(F.when(named, F.col("column")), F.when(named, F.col("pos"))), F.lit("")).alias("label")
        )
    # Distinct columns first: a table read through one column many times stays one row.
    columns = edges.groupBy("src", "dst", "column").agg(F.min("pos").alias("pos"))
    listed = F.array_sort(F.collect_list(F.when(named, F.struct("pos", "column"))))
    return columns.groupBy("src", "dst").agg(
        F.array_join(F.transform(listed, lambda s: s["column"]), ", ").alias("label")
    )
