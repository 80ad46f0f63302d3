"""Similarity join of texts on the Jaccard index of their word shingles, with signature trees.

Texts with the same set of shingles form one class, which is handled once. Classes are then dealt into clusters
such that every pair that may be similar enough shares one: the shingles of a set are shared out by their
hash over more parts than two similar sets can differ in, so one part at least is equal in both, and the hash of
each part is a key. Inside a cluster a signature tree joins the sets exactly: its nodes hold the combined
bitmaps and the size ranges of the sets below, and pairs of nodes that cannot reach the overlap are not
descended into.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.common import materialize
from quern.llm.graph import connected
from quern.llm.slices import lists, sliced
from quern.llm.words import lower_ascii, space_words

SHINGLE = 3
PERCENT = 90
# Sets and shingles of one block (a longer set is one alone); larger clusters are cut into blocks that are joined
# pair by pair.
BLOCK_SETS, BLOCK_SHINGLES = 2000, 2_000_000
# A list of (key, cluster) rows up to this size is sent to the texts; beyond, the texts are shuffled to it.
BROADCAST_ROWS = 250_000
# Below this similarity parts hold so few shingles that a passage shared by many texts would make most of them
# one cluster; then shingles that are frequent in one text of FREQUENT_SAMPLE are left out of the parts, which
# can only make parts of two sets more alike. The list is bounded and changes the clusters, never the links.
STRONG_PERCENT = 90
FREQUENT_SAMPLE, FREQUENT_TEXTS, FREQUENT_MOST = 8, 3, 500_000
# Pairs of sets that are collected before they are compared, and shingles that are looked up at once.
PAIRS_AT_ONCE, SHINGLES_AT_ONCE = 200_000, 1_000_000
BITS = 2048
FANOUT = 8

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all others."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``size`` word hashes; fewer words are one run; none give none."""
    if not len(words):
        return words
    run = min(size, len(words))
    count = len(words) - run + 1
    out = np.full(count, run, dtype=np.uint64)
    for i in range(run):
        out = _mix(out * _STEP + words[i : i + count])
    return np.unique(out)


def _share_with_empty(size: int, parts: int, least: int) -> float:
    """Share of sets that leave ``least`` parts or more empty, by the Poisson distribution."""
    mean = parts * math.exp(-size / parts) if parts > 1 else 0.0
    return 1.0 - sum(math.exp(-mean) * mean**k / math.factorial(k) for k in range(least))


class SizeClasses:
    """Ranges of set sizes so that similar sets are in the same or in neighbouring ranges.

    For each range there is a number of parts, ``spare`` more than two similar sets (the smaller one in the
    range) can differ in, so that many parts at least are equal. ``spare`` is chosen so that few sets leave
    as many parts empty: the others share a part that is not.
    """

    def __init__(self, percent: int, most: int = 1 << 31):
        self.starts, self.parts, self.spare, start = [], [], [], 1
        while start <= most:
            end = start * 100 // percent
            self.starts.append(start)
            differ = (100 - percent) * (end + end * 100 // percent) // (100 + percent)
            # More spare parts make all parts smaller, which weighs more for small sets.
            spare = min(range(1, 33), key=lambda s: _share_with_empty(start, differ + s, s) + 0.3 * s / start)
            spare = 1 if _share_with_empty(start, differ + 1, 1) < 0.1 else spare
            self.parts.append(differ + spare)
            self.spare.append(spare)
            start = end + 1
        self.percent = percent
        self._starts = np.array(self.starts)

    def of(self, size: int) -> list[int]:
        """Ranges whose keys a set of this size needs: its own, and the one below if a similar set can be there."""
        own = int(np.searchsorted(self._starts, size, side="right")) - 1
        below = own and self.starts[own] * self.percent <= 100 * (self.starts[own] - 1)
        return [own, own - 1] if below else [own]


def _keys(items: np.ndarray, range_: int, classes: SizeClasses, space: int) -> tuple[np.ndarray, bool]:
    """Keys of the parts of a set for one range of sizes, and whether all equal parts might be empty.

    Two similar sets have ``spare`` equal parts. If all of these are empty, both sets have as many empty parts, and
    only then empty parts have keys as well.
    """
    parts = classes.parts[range_]
    part = ((items >> np.uint64(17)) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    found, starts = np.unique(part[order], return_index=True)
    sums = np.zeros(parts, dtype=np.uint64)
    if len(found):
        sums[found] = np.add.reduceat(_mix(items + _STEP)[order], starts)
    label = (np.uint64(2 * range_ + space + 1) << np.uint64(40)) + np.arange(parts, dtype=np.uint64)
    keyed = _mix(sums + _mix(label * _STEP))
    hollow = parts - len(found) >= classes.spare[range_]
    return keyed if hollow and not space else keyed[found], hollow


def part_keys(items: np.ndarray, classes: SizeClasses, frequent: np.ndarray | None = None) -> np.ndarray:
    """One key per part for each range of the set's size.

    Without its frequent shingles a set may be left with so many empty parts that the equal parts of two similar
    sets are all empty. Both sets then have that many, and only then a set also has the keys of all its shingles.
    """
    if not len(items):
        return items
    if frequent is None or not len(frequent):
        return np.concatenate([_keys(items, range_, classes, 0)[0] for range_ in classes.of(len(items))])
    at = np.minimum(np.searchsorted(frequent, items), len(frequent) - 1)
    keys, rare = [], items[frequent[at] != items]
    for range_ in classes.of(len(items)):
        found, hollow = _keys(rare, range_, classes, 1)
        keys.append(found)
        if hollow:
            keys.append(_keys(items, range_, classes, 0)[0])
    return np.concatenate(keys)


# Rows of the first pass. kind 0: a text (key, mark, size, set hashes a and b); 1: a part key a of the set b; 2: sets a and
# b share a key.
_FIRST = "kind int, key bigint, mark bigint, n bigint, a bigint, b bigint"


def _rows(kind: int, count: int, **columns: np.ndarray) -> pa.RecordBatch:
    none = pa.nulls(count, pa.int64())
    arrays = {c: columns[c] if c in columns else none for c in ("key", "mark", "n", "a", "b")}
    signed = {c: pa.array(np.ascontiguousarray(v).view(np.int64)) if isinstance(v, np.ndarray) else v for c, v in arrays.items()}
    return pa.RecordBatch.from_pydict({"kind": pa.array(np.full(count, kind, dtype=np.int32)), **signed})


def _shingles(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, values, ends in sliced(batches, "words"):
            with np.errstate(over="ignore"):
                sets = [shingle_set(values[a:b], shingle) for a, b in zip(ends, ends[1:], strict=False)]
            if sets:
                yield pa.RecordBatch.from_pydict({"shingle": pa.array(np.concatenate(sets).view(np.int64))})

    return run


def _frequent(docs: DataFrame, shingle: int, key: str, text: str):
    """Broadcast, sorted hashes of the commonest shingles of a sample of the texts, chosen by key."""
    sample = docs.where(F.pmod(F.xxhash64(key), F.lit(FREQUENT_SAMPLE)) == 0)
    counts = _hashed(sample, key, text).mapInArrow(_shingles(shingle), "shingle bigint").groupBy("shingle").count()
    best = counts.where(F.col("count") >= FREQUENT_TEXTS).orderBy(F.desc("count"), "shingle").limit(FREQUENT_MOST)
    found = np.array([r["shingle"] for r in best.select("shingle").collect()], dtype=np.int64).view(np.uint64)
    return docs.sparkSession.sparkContext.broadcast(np.sort(found))


def _first_pass(shingle: int, percent: int, held=None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, frequent = SizeClasses(percent), held.value if held else None
        for batch, values, ends in sliced(batches, "words"):
            n = batch.num_rows
            size, a, b = (np.zeros(n, dtype=np.uint64) for _ in range(3))
            keys, owners, seen = [], [], set()
            with np.errstate(over="ignore"):
                for i in range(n):
                    items = shingle_set(values[ends[i] : ends[i + 1]], shingle)
                    if not len(items):
                        continue
                    size[i] = len(items)
                    a[i] = _mix(_mix(items).sum(dtype=np.uint64) + size[i])
                    b[i] = _mix(np.bitwise_xor.reduce(_mix(items * _STEP)) + size[i])
                    if a[i] not in seen:  # copies have the same keys
                        seen.add(a[i])
                        own = part_keys(items, classes, frequent)
                        keys.append(own)
                        owners.append(np.full(len(own), a[i], dtype=np.uint64))
            yield _rows(0, n, key=batch["key"], mark=batch["mark"], n=size, a=a, b=b)
            if keys:
                key, owner = np.concatenate(keys), np.concatenate(owners)
                # Combined before the shuffle: a key leaves the slice once, what else shares it is an edge already.
                key, first, place = np.unique(key, return_index=True, return_inverse=True)
                hub = owner[first]
                yield from _edges(hub[place], owner)
                # Text by text, so that the repeated hash of the set compresses.
                order = np.argsort(first)
                yield _rows(1, len(key), a=key[order], b=hub[order])

    return run


def _edges(x: np.ndarray, y: np.ndarray) -> Iterator[pa.RecordBatch]:
    different = x != y
    if different.any():
        pairs = np.unique(np.stack([x[different], y[different]], axis=1), axis=0)
        yield _rows(2, len(pairs), a=np.ascontiguousarray(pairs[:, 0]), b=np.ascontiguousarray(pairs[:, 1]))


def _second_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Link the sets of equal keys to the first of them. Rows of a partition come sorted by kind and key."""
    last: tuple[np.uint64, np.uint64] | None = None
    for batch in batches:
        kind = batch["kind"].to_numpy()
        for other in (0, 2):
            if (kind == other).any():
                yield batch.filter(pa.array(kind == other))
        keyed = batch.filter(pa.array(kind == 1))
        if not keyed.num_rows:
            continue
        key = keyed["a"].to_numpy().view(np.uint64)
        owner = keyed["b"].to_numpy().view(np.uint64)
        start = np.concatenate(([True], key[1:] != key[:-1]))
        hub = owner[np.maximum.accumulate(np.where(start, np.arange(len(key)), 0))]
        if last is not None and key[0] == last[0]:
            hub[: np.searchsorted(np.cumsum(start), 2)] = last[1]
        last = key[-1], hub[-1]
        yield from _edges(hub, owner)


def _bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(sets), BITS // 64), dtype=np.uint64)
    for i, s in enumerate(sets):
        place = (s >> np.uint64(7)) % np.uint64(BITS)
        np.bitwise_or.at(out[i], (place // np.uint64(64)).astype(np.int64), np.uint64(1) << (place % np.uint64(64)))
    return out


class SignatureTree:
    """Sets in order of size below nodes that hold, level by level, the OR of the bitmaps, the range of the
    sizes and the slack: the most members that any set below has beyond its number of bits."""

    def __init__(self, sets: list[np.ndarray]):
        order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), int(sets[i][0])))
        self.order, self.sets = order, [sets[i] for i in order]
        bits = _bitmaps(self.sets)
        size = np.array([len(s) for s in self.sets], dtype=np.int64)
        self.levels = [(bits, size, size, size - np.bitwise_count(bits).sum(axis=1).astype(np.int64))]
        while len(self.levels[-1][0]) > 1:
            bits, low, high, slack = self.levels[-1]
            at = np.arange(0, len(bits), FANOUT)
            self.levels.append(
                (np.bitwise_or.reduceat(bits, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.maximum.reduceat(slack, at))
            )


def _possible(a: SignatureTree, b: SignatureTree, level: int, x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """Which node pairs may hold a similar pair. A set has at least one member for each of its bits that the
    other side lacks, so the overlap is at most its slack plus the bits in common."""
    bits_a, low_a, high_a, slack_a = a.levels[min(level, len(a.levels) - 1)]
    bits_b, low_b, high_b, slack_b = b.levels[min(level, len(b.levels) - 1)]
    common = np.bitwise_count(bits_a[x] & bits_b[y]).sum(axis=1).astype(np.int64)
    most = np.minimum(np.minimum(slack_a[x], slack_b[y]) + common, np.minimum(high_a[x], high_b[y]))
    least = low_a[x] + low_b[y]
    return (100 + percent) * most >= percent * least


def _children(level: int, tree: SignatureTree, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each node the first child and the number of children one level down."""
    if level >= len(tree.levels):
        return x, np.ones(len(x), dtype=np.int64)
    below = len(tree.levels[level - 1][0])
    return x * FANOUT, np.minimum(FANOUT, below - x * FANOUT)


class _Pairs:
    """Compares pairs of sets exactly: links that connect what similar pairs connect, and for each set the weight
    of all sets that it is similar to. Sets of ``b`` count on after those of ``a``."""

    def __init__(self, a: SignatureTree, b: SignatureTree | None, percent: int, weight: np.ndarray):
        self.percent, self.weight = percent, weight
        sets = a.sets + (b.sets if b else [])
        self.size = np.array([len(s) for s in sets], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size
        # Shingles by their number among those that occur here.
        self.flat = np.unique(np.concatenate(sets), return_inverse=True)[1]
        self.seen = np.zeros(int(self.flat.max()) + 1, dtype=bool)
        self.group, self.degree = np.arange(len(sets)), np.zeros(len(sets), dtype=np.int64)
        self.links: list[tuple[int, int]] = []
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.count = 0

    def add(self, x: np.ndarray, y: np.ndarray) -> None:
        self.waiting.append((x, y))
        self.count += len(x)
        if self.count >= PAIRS_AT_ONCE:
            self.flush()

    def flush(self) -> None:
        if not self.count:
            return
        x = np.concatenate([x for x, _ in self.waiting])
        y = np.concatenate([y for _, y in self.waiting])
        self.waiting, self.count = [], 0
        order = np.argsort(x, kind="stable")
        x, y = x[order], y[order]
        firsts = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1])))
        for start, end in zip(firsts, [*firsts[1:], len(x)], strict=True):
            self._compare(int(x[start]), y[start:end])

    def _compare(self, one: int, others: np.ndarray) -> None:
        own = self.flat[self.start[one] : self.start[one] + self.size[one]]
        self.seen[own] = True
        parts = np.searchsorted(np.cumsum(self.size[others]), np.arange(SHINGLES_AT_ONCE, int(self.size[others].sum()), SHINGLES_AT_ONCE), side="left") + 1
        for some in np.split(others, np.unique(parts)):
            if not len(some):
                continue
            size = self.size[some]
            at = np.cumsum(size) - size
            place = np.repeat(self.start[some] - at, size) + np.arange(int(size.sum()))
            both = np.add.reduceat(self.seen[self.flat[place]].astype(np.int64), at)
            alike = some[100 * both >= self.percent * (self.size[one] + size - both)]
            self.degree[one] += self.weight[alike].sum()
            self.degree[alike] += self.weight[one]
            groups, first = np.unique(self.group[alike], return_index=True)
            new = groups != self.group[one]
            if new.any():
                self.links += [(one, int(other)) for other in alike[first[new]]]
                self.group[np.isin(self.group, groups[new])] = self.group[one]
        self.seen[own] = False


def join_trees(a: SignatureTree, b: SignatureTree | None, percent: int, weight: np.ndarray) -> _Pairs:
    """Compare the sets of ``a`` with those of ``b``, or with each other without ``b``; both trees are descended together.

    ``weight`` is given in the order of the trees, those of ``b`` after those of ``a``.
    """
    other, shift = (a, 0) if b is None else (b, len(a.sets))
    pairs = _Pairs(a, b, percent, weight)

    def descend(level: int, x: np.ndarray, y: np.ndarray) -> None:
        keep = _possible(a, other, level, x, y, percent)
        x, y = x[keep], y[keep]
        if level == 0:
            pairs.add(x, y + shift)
            return
        # Depth first in slabs, so that the pairs in memory stay few.
        for at in range(0, len(x), 256):
            xs, ys = x[at : at + 256], y[at : at + 256]
            x0, nx = _children(level, a, xs)
            y0, ny = _children(level, other, ys)
            pairs_ = nx * ny
            which = np.repeat(np.arange(len(xs)), pairs_)
            k = np.arange(len(which)) - np.repeat(np.cumsum(pairs_) - pairs_, pairs_)
            down_x, down_y = x0[which] + k // ny[which], y0[which] + k % ny[which]
            if b is None:
                # Inside one tree each pair counts once; a node meets itself until the sets are reached.
                once = down_x < down_y if level == 1 else down_x <= down_y
                down_x, down_y = down_x[once], down_y[once]
            descend(level - 1, down_x, down_y)

    top = max(len(a.levels), len(other.levels)) - 1
    if len(other.sets) and (b is not None or len(a.sets) > 1):
        descend(top, np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64))
        pairs.flush()
    return pairs


def similar_links(a: SignatureTree, b: SignatureTree | None, percent: int) -> list[tuple[int, int]]:
    """Links that connect what similar pairs connect, as numbers of the sets given; those of ``b`` count on after those of ``a``."""
    if not a.sets:
        return []
    order = [*a.order, *[len(a.sets) + i for i in (b.order if b else [])]]
    found = join_trees(a, b, percent, np.ones(len(order), dtype=np.int64))
    return [(order[x], order[y]) for x, y in found.links]


# Sides of a task: two blocks that are joined, or one block that is joined with itself.
_FIRST_BLOCK, _SECOND_BLOCK, _ONE_BLOCK = 0, 1, 2
_LINKS = "a bigint, b bigint, n bigint"


def _join_pass(shingle: int, percent: int):
    """Joins the sets of each task. Rows come sorted by task, side and set, and a task's rows are consecutive.

    Returns links (a, b) that connect what is similar, and rows (a, n) with the number of texts similar to the set a.
    """

    def finish(task: list) -> Iterator[pa.RecordBatch]:
        sides = [[t for t in task if t[0] == side] for side in (_FIRST_BLOCK, _SECOND_BLOCK, _ONE_BLOCK)]
        blocks = sides[:2] if task and task[0][0] != _ONE_BLOCK else sides[2:]
        if not task or not all(blocks):
            return
        trees = [SignatureTree([items for _, _, _, items in block]) for block in blocks]
        ordered = [block[i] for block, tree in zip(blocks, trees, strict=True) for i in tree.order]
        names = np.array([name for _, name, _, _ in ordered], dtype=np.int64)
        weight = np.array([docs for _, _, docs, _ in ordered], dtype=np.int64)
        found = join_trees(trees[0], trees[1] if len(trees) == 2 else None, percent, weight)
        if found.links:
            x, y = (names[np.array(end)] for end in zip(*found.links, strict=True))
            yield pa.RecordBatch.from_pydict({"a": pa.array(x), "b": pa.array(y), "n": pa.nulls(len(x), pa.int64())})
            some = found.degree > 0
            yield pa.RecordBatch.from_pydict(
                {"a": pa.array(names[some]), "b": pa.nulls(int(some.sum()), pa.int64()), "n": pa.array(found.degree[some])}
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, task = None, []
        for batch, values, ends in sliced(batches, "words"):
            marks = zip(*[batch[c].to_pylist() for c in ("task", "side", "a", "docs")], strict=True)
            for i, (name, side, a, docs) in enumerate(marks):
                if name != now:
                    yield from finish(task)
                    now, task = name, []
                # A repeated row brings its set again.
                if task and task[-1][:2] == (side, a):
                    continue
                with np.errstate(over="ignore"):
                    items = shingle_set(values[ends[i] : ends[i + 1]], shingle)
                if len(items):
                    task.append((side, a, docs, items))
        yield from finish(task)

    return run


def _mark(text: Column) -> Column:
    """Tells rows of one key with different texts apart."""
    return F.xxhash64(text)


def _hashed(docs: DataFrame, key: str, text: str) -> DataFrame:
    words = space_words(lower_ascii(F.col(text)))
    return docs.select(
        F.col(key).cast("long").alias("key"), _mark(F.col(text)).alias("mark"), F.transform(words, lambda w: F.xxhash64(w)).alias("words")
    )


def _same_row(x: str, y: str) -> Column:
    return F.col(f"{x}.key").eqNullSafe(F.col(f"{y}.key")) & (F.col(f"{x}.mark") == F.col(f"{y}.mark"))


def _block_count(sets: str, shingles: str) -> Column:
    return F.greatest(F.ceil(F.col(sets) / BLOCK_SETS), F.least(F.col(sets), F.ceil(F.col(shingles) / BLOCK_SHINGLES))).cast("int")


def _with_levels(members: DataFrame, percent: int) -> DataFrame:
    """Leave out clusters of one set, and add ``level``: the range of the set's size, or 0 in clusters of one block.

    Similar sets are in the same range or in neighbouring ones, so that only these are joined.
    """
    clusters = members.groupBy("root").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("shingles")).where("sets > 1")
    clusters = materialize(clusters.select("root", (_block_count("sets", "shingles") > 1).alias("cut")), "clusters")
    starts = F.array(*[F.lit(start).cast("long") for start in SizeClasses(percent).starts])
    level = F.when(F.col("cut"), F.size(F.filter(starts, lambda start: start <= F.col("n")))).otherwise(0)
    return members.join(clusters, "root").withColumn("level", level).drop("cut")


def _blocks(members: DataFrame) -> DataFrame:
    """Blocks of each level of each cluster, and those of the levels ``below`` and ``above``; 0 if there are none."""
    counts = members.groupBy("root", "level").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("shingles"))
    counts = materialize(counts.select("root", "level", _block_count("sets", "shingles").alias("blocks")), "block_counts")
    for name, step in (("below", 1), ("above", -1)):
        beside = counts.select("root", (F.col("level") + step).alias("level"), F.col("blocks").alias(name))
        counts = counts.join(beside, ["root", "level"], "left").fillna(0, [name])
    return counts


def _tasks_of_a_set() -> Column:
    """The tasks of a set: its block with itself, with the others of its level, and with those of the levels beside it."""

    def task(x: Column, i: Column, y: Column, j: Column, side: Column) -> Column:
        names = ("x", "i", "y", "j", "side")
        return F.struct(*[c.cast("int").alias(n) for n, c in zip(names, (x, i, y, j, side), strict=True)])

    own, level = F.col("own"), F.col("level")
    first, second, one = F.lit(_FIRST_BLOCK), F.lit(_SECOND_BLOCK), F.lit(_ONE_BLOCK)
    numbers = lambda count: F.filter(F.sequence(F.lit(0), F.col(count)), lambda k: k < F.col(count))
    side = lambda k: F.when(k == own, one).when(own < k, first).otherwise(second)
    within = F.transform(numbers("blocks"), lambda k: task(level, F.least(own, k), level, F.greatest(own, k), side(k)))
    below = F.transform(numbers("below"), lambda k: task(level - 1, k, level, own, second))
    above = F.transform(numbers("above"), lambda k: task(level, own, level + 1, k, first))
    return F.concat(within, below, above)


def _resolved(docs: DataFrame, percent: int, shingle: int, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """One row per text (``key``, ``mark``, set as ``n``, ``a``, ``b``), and one per set: ``group`` (the set that names its
    component), ``low`` (smallest key of the component), ``docs`` (texts with the set) and ``links`` (texts similar to it)."""
    held = _frequent(docs, shingle, key, text) if percent < STRONG_PERCENT else None
    first = _hashed(docs, key, text).mapInArrow(_first_pass(shingle, percent, held), _FIRST)
    # Texts are spread by their key, part keys by themselves.
    spread = F.when(F.col("kind") == 1, F.col("a")).otherwise(F.xxhash64("key", "b"))
    # An expression, not a column, so that what it gives is not shuffled with the rows.
    dealt = first.repartition(spread).sortWithinPartitions("kind", "a")
    passed = materialize(dealt.mapInArrow(_second_pass, _FIRST), "sets")
    texts = passed.where("kind = 0").select("key", "mark", "n", "a", "b")
    edges = passed.where("kind = 2").select("a", "b").distinct()

    # Equal sets are one class, for which its row with the smallest key stands; then the clusters of classes that share keys.
    row = F.struct(F.col("key").isNull().alias("none"), "key", "mark")
    classes = texts.where("n > 0").groupBy("n", "a", "b").agg(F.min(row).alias("row"), F.count(F.lit(1)).alias("docs"))
    classes = materialize(classes, "classes")
    clusters = connected(edges)
    members = classes.join(clusters, F.col("a") == F.col("node")).select("row.key", "row.mark", "a", "n", "docs", "root")
    members = _with_levels(members, percent)
    members = materialize(members, "members")
    members = materialize(members.join(_blocks(members), ["root", "level"]), "blocks")

    chosen = F.broadcast(members) if members.count() <= BROADCAST_ROWS else members
    sets = _hashed(docs, key, text).alias("d").join(chosen.alias("m"), _same_row("d", "m"))
    sets = sets.select("m.a", "root", "level", "blocks", "below", "above", "docs", "words")
    sets = sets.withColumn("own", F.pmod(F.xxhash64("a"), F.col("blocks")).cast("int"))
    sets = sets.withColumn("at", F.explode(_tasks_of_a_set()))
    tasks = sets.select(F.concat_ws("-", "root", "at.x", "at.i", "at.y", "at.j").alias("task"), "at.side", "a", "docs", "words")
    tasks = tasks.repartition("task").sortWithinPartitions("task", "side", "a")
    found = materialize(tasks.mapInArrow(_join_pass(shingle, percent), _LINKS), "links")

    groups = connected(found.where("b IS NOT NULL").select("a", "b"))
    degrees = found.where("n IS NOT NULL").groupBy("a").agg(F.sum("n").alias("links"))
    sets = classes.join(groups, F.col("a") == F.col("node"), "left").join(degrees, "a", "left")
    sets = sets.select("n", "a", "b", F.col("row.key").alias("key"), "docs", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "a").alias("group"))
    sets = materialize(sets, "grouped_sets")
    lows = materialize(sets.groupBy("group").agg(F.min("key").alias("low")), "lows")
    return texts, sets.drop("key").join(lows, "group")


def near_duplicates(
    docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE, key: str = "doc_id", text: str = "text", links: bool = False
) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``n_shingles`` and ``component_id``; with ``links`` also ``n_links``.

    Two texts are linked when 100 x common shingles >= ``percent`` x all their shingles; a component is what links
    connect, named by its smallest key; ``n_links`` counts the other rows that a row is linked with. Words are runs of
    characters other than ASCII white space, A-Z lower-cased. A text of fewer than ``shingle`` words is one shingle; a null
    or empty text, or one without words, has none and is linked with nothing. Keys are integers; of a repeated key each
    row gets the component of its own text; a row with a null key names no component, and a component of such rows has
    the name null. Other columns are not read; an empty table gives no rows.
    """
    texts, sets = _resolved(docs, percent, shingle, key, text)
    found = texts.join(materialize(sets, "labels"), ["n", "a", "b"], "left")
    return found.select(
        F.col("key").alias(key),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("low")).otherwise(F.col("key")).alias("component_id"),
        *([F.coalesce(F.col("links") + F.col("docs") - 1, F.lit(0)).alias("n_links")] if links else []),
    )


def drop_near_duplicates(
    docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with all columns and one row of each component: that with the smallest key (null last), then text mark.

    A row is known by its key and its text, so of one key with two texts each is judged on its own. Of rows that
    repeat key and text one stays, by a hash of all columns. Rows without words stay as they are.
    """
    texts, sets = _resolved(docs, percent, shingle, key, text)
    rows = materialize(texts.where("n > 0").join(sets.select("n", "a", "b", "group"), ["n", "a", "b"]).select("key", "mark", "group"), "text_rows")
    row = F.struct(F.col("key").isNull().alias("none"), "key", "mark")
    crowds = rows.groupBy("group").agg(F.count(F.lit(1)).alias("count"), F.min(row).alias("kept")).where("count > 1")
    joined = rows.alias("r").join(materialize(crowds, "crowds").alias("c"), "group").select("r.key", "r.mark", F.col("kept.key").alias("k"), F.col("kept.mark").alias("m"))
    is_kept = F.col("key").eqNullSafe(F.col("k")) & (F.col("mark") == F.col("m"))
    gone = materialize(joined.where(~is_kept).select("key", "mark").distinct(), "gone")
    twice = materialize(joined.where(is_kept).groupBy("key", "mark").count().where("count > 1").drop("count"), "twice")
    held = docs.select(F.struct(*docs.columns).alias("doc"), F.col(key).cast("long").alias("key"), _mark(F.col(text)).alias("mark")).alias("d")
    gone, twice = (F.broadcast(t) if t.count() <= BROADCAST_ROWS else t for t in (gone, twice))
    left = held.join(gone.alias("g"), _same_row("d", "g"), "left_anti").alias("d")
    once = left.join(twice.alias("t"), _same_row("d", "t"), "left_anti").select("doc")
    of_many = left.join(twice.alias("t"), _same_row("d", "t"), "left_semi")
    of_many = of_many.groupBy("key", "mark").agg(F.min_by("doc", F.xxhash64("doc")).alias("doc")).select("doc")
    return once.unionByName(of_many).select("doc.*")
