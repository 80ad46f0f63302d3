"""Connected components of a graph that is stored as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.common import materialize


def connected(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (one node of its component) for every node of ``edges`` (``a``, ``b``, both bigint).

    Each round sends every node to the neighbour (or itself) whose hash is lowest and goes on with the edges
    between the nodes sent to. A constant share of the nodes goes in each round, also in paths and stars, so the
    rounds grow with the logarithm of the component size. Minima are combined before the shuffle, so a node with
    most of the edges is not gathered anywhere. Only the count of the edges left comes to the driver.
    """
    rank = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("id"))
    both = edges.select("a", "b").where("a <> b")
    both = materialize(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    first, rounds = both, []
    while not both.isEmpty():
        sent = both.groupBy(F.col("a").alias("node")).agg(F.min(rank("b")).alias("low"))
        sent = materialize(sent.select("node", F.least(F.col("low"), rank("node"))["id"].alias("to")), "sent")
        rounds.append(sent)
        for end in ("a", "b"):
            both = both.join(sent.withColumnsRenamed({"node": end, "to": "_to"}), end)
            both = both.drop(end).withColumnRenamed("_to", end)
        both = materialize(both.where("a <> b").select("a", "b").distinct(), "edges")
    # A node's root is found along the rounds; a node that a round does not list stays where it is.
    roots = first.select(F.col("a").alias("node")).distinct().withColumn("root", F.col("node"))
    for sent in rounds:
        step = sent.select(F.col("node").alias("root"), "to")
        roots = roots.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return materialize(roots, "roots")
