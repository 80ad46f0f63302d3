"""Hard negatives by inner product, with bounds along a spanning tree of the anchors.

Anchors are taken in blocks of bounded size, which are sent to the tasks that hold the rows; rows are never shuffled
or paired. The anchors of a block form a minimum spanning tree. A row's score at a child anchor differs from its score
at the parent by at most the length of the edge times the row's norm, so bounds are handed down the tree, and only rows
whose bounds overlap what the child still looks for are scored again, which makes their bounds exact. Two
passes: the best rows of the anchor's own label (positives), then the best rows of other labels in the score window
of each positive. Every task reports its few best, and these are merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.common import materialize, scratch_path, spread, with_row_number

SCALE = 256
POSITIVES, NEGATIVES = 5, 5
# The window of a positive with score p: LOW * p <= 100 * score <= HIGH * p.
LOW, HIGH = 80, 100
# Bound of what is sent at once: anchors of a block (times the vector's length, eight bytes each).
BLOCK_ANCHORS = 2048
# Beyond this share of rows to score again the whole batch is scored, as gathering rows costs more.
DENSE = 0.25
_FOUND = "anchor bigint, place int, score bigint, vec_id bigint"


@dataclass(frozen=True)
class Tree:
    """Anchors in an order in which parents come before their children, and the smaller subtrees of a parent first."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    parent: np.ndarray  # place of the parent in this order, -1 for the root
    edge: np.ndarray  # length of the edge to the parent
    last: np.ndarray  # place of the last child, after which the bounds of a node are dropped


def spanning_tree(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> Tree:
    """Minimum spanning tree by Prim's rule; as the largest subtree comes last, few bounds are held at once."""
    n = len(ids)
    parent, near = np.full(n, -1), np.full(n, np.inf)
    open_, added, at = np.ones(n, dtype=bool), [], 0
    real = vectors.astype(np.float64)
    for _ in range(n):
        open_[at] = False
        added.append(at)
        far = np.sqrt(((real - real[at]) ** 2).sum(axis=1))
        nearer = open_ & (far < near)
        near[nearer], parent[nearer] = far[nearer], at
        if open_.any():
            at = int(np.argmin(np.where(open_, near, np.inf)))
    size = np.ones(n, dtype=np.int64)
    children: list[list[int]] = [[] for _ in range(n)]
    for node in reversed(added[1:]):
        size[parent[node]] += size[node]
        children[parent[node]].append(node)
    order, stack = [], [added[0]] if n else []
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(sorted(children[node], key=lambda c: -size[c]))
    order_ = np.array(order, dtype=np.int64)
    place = np.empty(n, dtype=np.int64)
    place[order_] = np.arange(n)
    up = np.array([place[parent[k]] if parent[k] >= 0 else -1 for k in order], dtype=np.int64)
    edge = np.where(up < 0, 0.0, near[order_])
    last = np.full(n, -1, dtype=np.int64)
    for child, p in enumerate(up):
        if p >= 0:
            last[p] = child
    return Tree(ids[order_], labels[order_], vectors[order_], up, edge, last)


@dataclass(frozen=True)
class Goal:
    """What an anchor looks for: rows of its own label (or of others) in score windows; the best ``most`` of each."""

    own_label: bool
    low: list[np.ndarray]  # least score of each window of each anchor
    high: list[np.ndarray]  # greatest score
    most: int


class Best:
    """The best rows seen so far for each window of each anchor, as sorted lists of (-score, id)."""

    def __init__(self, goal: Goal):
        self.goal = goal
        self.rows: list[list[list[tuple[int, int]]]] = [[[] for _ in low] for low in goal.low]
        # The least score that still counts in each window.
        self.floors = [low.astype(np.float64) for low in goal.low]

    def add(self, anchor: int, scores: np.ndarray, ids: np.ndarray) -> None:
        order = np.lexsort((ids, -scores))
        down, ids = -scores[order], ids[order]
        for w, high in enumerate(self.goal.high[anchor]):
            first = int(np.searchsorted(down, -high, side="left"))
            end = int(np.searchsorted(down, -self.floors[anchor][w], side="right"))
            end = min(end, first + self.goal.most)
            if first < end:
                held = self.rows[anchor][w]
                held += zip(down[first:end].astype(np.int64).tolist(), ids[first:end].tolist(), strict=True)
                held.sort()
                del held[self.goal.most :]
                if len(held) == self.goal.most:
                    self.floors[anchor][w] = max(self.floors[anchor][w], -held[-1][0])


def _scores(rows: np.ndarray, vector: np.ndarray, small: bool) -> np.ndarray:
    """Exact inner products; through floating point where every sum stays below 2 ** 53."""
    return rows @ vector if small else (rows.astype(np.int64) @ vector.astype(np.int64))


def search(tree: Tree, goal: Goal, best: Best, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> int:
    """Add the rows of one batch to ``best``; returns how many scores were computed."""
    if not len(rows) or not len(tree.ids):
        return 0
    most = max(float(np.abs(rows).max(initial=0)), float(np.abs(tree.vectors).max(initial=0)))
    small = most * most * max(rows.shape[1], 1) < 2.0**53
    rows = rows.astype(np.float64) if small else rows
    anchors = tree.vectors.astype(np.float64) if small else tree.vectors
    norms = np.sqrt((rows.astype(np.float64) ** 2).sum(axis=1))
    bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    computed = 0
    for at in range(len(tree.ids)):
        up = int(tree.parent[at])
        if up < 0:
            low = high = _scores(rows, anchors[at], small).astype(np.float64)
            computed += len(rows)
        else:
            # A little wider than the edge, for rounding.
            reach = norms * (tree.edge[at] * (1 + 1e-9)) + 1e-6
            low, high = bounds[up][0] - reach, bounds[up][1] + reach
            if tree.last[up] == at:
                del bounds[up]
        if len(goal.low[at]):
            wanted = (labels == tree.labels[at]) if goal.own_label else (labels != tree.labels[at])
            wanted &= (high >= best.floors[at].min()) & (low <= goal.high[at].max())
            if goal.own_label:
                wanted &= ids != tree.ids[at]
            chosen = np.flatnonzero(wanted)
            if len(chosen):
                if up < 0:
                    exact = low[chosen]
                elif len(chosen) > DENSE * len(rows):
                    low = high = _scores(rows, anchors[at], small).astype(np.float64)
                    exact = low[chosen]
                    computed += len(rows)
                else:
                    exact = _scores(rows[chosen], anchors[at], small).astype(np.float64)
                    low[chosen] = high[chosen] = exact
                    computed += len(chosen)
                best.add(at, exact, ids[chosen])
        if tree.last[at] >= 0:
            bounds[at] = (low, high)
    return computed


def _pass(sent, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, goal = sent.value
        best = Best(goal)
        for batch in batches:
            rows = batch["v"].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)
            search(tree, goal, best, batch["vec_id"].to_numpy(), batch["label"].to_numpy(), rows)
        for at, windows in enumerate(best.rows):
            found = [(w, -down, i) for w, held in enumerate(windows) for down, i in held]
            if found:
                place, score, ids = zip(*found, strict=True)
                yield pa.RecordBatch.from_pydict(
                    {"anchor": pa.array([int(tree.ids[at])] * len(found), pa.int64()), "place": pa.array(place, pa.int32()),
                     "score": pa.array(score, pa.int64()), "vec_id": pa.array(ids, pa.int64())}
                )

    return run


def prepared(rows: DataFrame, key: str, label: str, vector: str, scale: int = SCALE) -> DataFrame:
    """``vec_id``, ``label`` and the components ``floor(scale * x)`` of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    infinite = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    told = rows.select(F.col(key).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), v.alias("v"))
    told = told.where("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL").where(~F.exists("v", infinite))
    return told.withColumn("v", F.transform("v", lambda x: F.floor(x * scale).cast("long")))


def _top(found: DataFrame, by: list[str], most: int) -> DataFrame:
    ranks = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", ranks).where(F.col("rank") <= most)


def hard_negatives(
    rows: DataFrame,
    key: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    every: int = 100,
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and ``negative_score``.

    Anchors are the rows whose key is divisible by ``every``. Scores are inner products of ``floor(scale * x)``;
    higher ones come first, ties by the smaller key. Positives are an anchor's first other rows (rows with
    another key) of its label; negatives of a positive are the first rows of other labels with low * p <= 100 * score <=
    high * p. All are returned where there are fewer; an anchor without positives, or a positive without
    negatives, gives no rows.

    Rows with a null key, label or vector, or with a null, infinite or undefined component take no part. Shorter vectors
    count as filled up with zeros. Rows that repeat a key are rows of their own as positives and negatives; of a repeated
    anchor the one with the least label and vector stands. Scores are exact up to 2 ** 53. Other columns are not read; a table
    without anchors gives no rows.
    """
    spark = rows.sparkSession
    stored = materialize(spread(prepared(rows, key, label, vector, scale), "vec_id"), "vectors")
    sizes = stored.agg(F.min(F.size("v")).alias("a"), F.max(F.size("v")).alias("b")).first()
    width = sizes["b"] or 0
    if sizes["a"] != sizes["b"]:
        filled = F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("v")))
        stored = materialize(stored.withColumn("v", filled), "vectors")
    anchors = stored.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("one"))
    anchors = with_row_number(anchors.select("vec_id", "one.label", "one.v"), ["vec_id"], "no")
    blocks = -(-(anchors.agg(F.max("no") + 1).first()[0] or 0) // BLOCK_ANCHORS)
    path = scratch_path(spark, "negatives")
    done = spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    done.write.parquet(path)
    for block in range(blocks):
        own = anchors.where((F.col("no") >= block * BLOCK_ANCHORS) & (F.col("no") < (block + 1) * BLOCK_ANCHORS)).orderBy("no").collect()
        tree = spanning_tree(
            np.array([r["vec_id"] for r in own], dtype=np.int64), np.array([r["label"] for r in own], dtype=np.int64),
            np.array([r["v"] for r in own], dtype=np.int64).reshape(len(own), width),
        )
        any_score = [np.array([-np.inf])] * len(own), [np.array([np.inf])] * len(own)
        sent = spark.sparkContext.broadcast((tree, Goal(True, *any_score, positives)))
        found = _top(stored.mapInArrow(_pass(sent, width), _FOUND), ["anchor"], positives)
        # At most ``positives`` rows for each anchor of the block.
        found = materialize(found.select("anchor", "rank", "score", "vec_id"), "positives")
        scores: dict[int, list[int]] = {}
        for r in found.orderBy("anchor", "rank").collect():
            scores.setdefault(r["anchor"], []).append(r["score"])
        told = [np.array(scores.get(int(i), []), dtype=np.int64) for i in tree.ids]
        # The least and the greatest whole score of each window.
        least, greatest = [-(-low * p // 100) for p in told], [high * p // 100 for p in told]
        sent = spark.sparkContext.broadcast((tree, Goal(False, least, greatest, negatives)))
        best = _top(stored.mapInArrow(_pass(sent, width), _FOUND), ["anchor", "place"], negatives)
        pairs = found.select(
            F.col("anchor"), (F.col("rank") - 1).alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
        )
        best.join(pairs, ["anchor", "place"]).select(
            F.col("anchor").alias("anchor_id"), "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score"),
        ).write.mode("append").parquet(path)
    return spark.read.schema(done.schema).parquet(path)
