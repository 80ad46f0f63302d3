"""Exact removal of repeated word passages by seed and extend.

Seeds are winnowed anchors: of the word 8-grams that start in a window of 35 words the smallest hash is the
window's anchor, so equal windows share it at the same place. The windows of one anchor, a stretch of text that
extends the anchor both ways, are first compared as a whole; only where an anchor stands in stretches that
differ are its windows compared one by one. What the repeated windows cover joins up to the maximal repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.common import materialize
from quern.llm.slices import lists, sliced
from quern.llm.words import SPACE, space_words

WINDOW = 35
ANCHOR = 8
# Places per text are sent to the texts up to this many in all (at most 32 bytes each); beyond, the texts are shuffled to them.
BROADCAST_PLACES = 2_000_000

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def _runs(words: np.ndarray, sizes: tuple[int, ...]) -> dict[int, np.ndarray]:
    """Hashes of all runs of each size, from halves, so that the cost grows with the logarithm of the size."""
    made = {1: _mix(words + _STEP)}

    def join(a: int, b: int) -> np.ndarray:
        x, y = made[a], made[b][a:]
        return _mix(x[: len(y)] * _STEP + y)

    for size in sorted(sizes):
        have = 1
        while have * 2 <= size:
            if have * 2 not in made:
                made[have * 2] = join(have, have)
            have *= 2
        while have < size:
            rest = max(k for k in made if k <= size - have)
            if have + rest not in made:
                made[have + rest] = join(have, rest)
            have += rest
    return {s: made[s] for s in sizes}


def _leftmost_min(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest of each ``width`` consecutive values, the first of equals."""
    place, low, have = np.arange(len(values)), values, 1
    while have < width:
        step = min(have, width - have)
        right = low[step:] < low[: len(low) - step]
        place = np.where(right, place[step:], place[: len(place) - step])
        low = np.where(right, low[step:], low[: len(low) - step])
        have += step
    return place


def stretches(words: np.ndarray, ends: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR):
    """For texts given one after another (``ends`` are their boundaries): for each anchor the text, the start of its
    first window there, its number of windows, the hash of the anchor and of all its windows; and the window hashes."""
    none = np.zeros(0, dtype=np.int64)
    if len(words) < window:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64), none.astype(np.uint64)
    with np.errstate(over="ignore"):
        hashes = _runs(words, (anchor, window))
        place = _leftmost_min(hashes[anchor], window - anchor + 1)[: len(hashes[window])]
        starts = np.arange(len(place))
        text = np.searchsorted(ends, starts, side="right") - 1
        inside = starts + window <= ends[text + 1]
        text, starts, place, full = text[inside], starts[inside], place[inside], hashes[window][inside]
        if not len(starts):
            return none, none, none, none.astype(np.uint64), none.astype(np.uint64), none.astype(np.uint64)
        new = np.concatenate(([True], (place[1:] != place[:-1]) | (text[1:] != text[:-1])))
        first = np.flatnonzero(new)
        count = np.diff(np.concatenate((first, [len(starts)])))
        each = _mix(full + (place - starts).astype(np.uint64) * _STEP)
        whole = _mix(np.add.reduceat(each, first) + count.astype(np.uint64))
    return text[first], starts[first] - ends[text[first]], count, hashes[anchor][place[first]], whole, each


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _anchors(window: int, anchor: int):
    """Rows of one stretch each: the text (key, mark), its first window, their number, and the two hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words, ends in sliced(batches, "words"):
            text, low, count, a, b, _ = stretches(words, ends, window, anchor)
            which = pa.array(text)
            yield pa.RecordBatch.from_pydict(
                {"key": batch["key"].take(which), "mark": batch["mark"].take(which), "low": pa.array(low),
                 "n": pa.array(count.astype(np.int32)), "a": _signed(a), "b": _signed(b)}
            )

    return run


def _windows(window: int, anchor: int):
    """The windows of the chosen stretches of each text, with the weight of the stretch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words, ends in sliced(batches, "words"):
            chosen, weights = batch["lows"], batch["weights"]
            lows, bounds = lists(chosen)
            weight = weights.flatten().to_numpy(zero_copy_only=False)
            text, low, count, a, _, each = stretches(words, ends, window, anchor)
            # Stretches are found again by text and first window; both lists are put in that order.
            owner = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
            order = np.lexsort((lows.view(np.int64), owner))
            span = np.int64(1) << np.int64(40)
            wanted = (owner * span + lows.view(np.int64))[order]
            have = text * span + low
            at = np.searchsorted(have, wanted)
            # Another text of the same key and mark may have no stretch there.
            known = have[np.minimum(at, len(have) - 1)] == wanted if len(have) else np.zeros(len(at), dtype=bool)
            at, order = at[known], order[known]
            counts = count[at]
            inside = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
            first = np.cumsum(count) - count
            which = pa.array(np.repeat(text[at], counts))
            yield pa.RecordBatch.from_pydict(
                {"key": batch["key"].take(which), "mark": batch["mark"].take(which),
                 "low": pa.array(np.repeat(low[at], counts) + inside), "a": _signed(np.repeat(a[at], counts)),
                 "w": _signed(each[np.repeat(first[at], counts) + inside]),
                 "weight": pa.array(np.repeat(weight[order], counts).astype(np.int32))}
            )

    return run


def _mark(text: Column) -> Column:
    """Tells rows of one key with different texts apart."""
    return F.xxhash64(text).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")


def _hashed(docs: DataFrame, key: str, text: str) -> DataFrame:
    words = F.transform(space_words(F.col(text)), lambda w: F.xxhash64(w))
    return docs.select(F.col(key).cast("long").alias("key"), _mark(F.col(text)).alias("mark"), words.alias("words"))


def _attach(texts: DataFrame, places: DataFrame, total: int, how: str) -> DataFrame:
    """Join lists of places, one row per text, to the texts; a text key may be null."""
    places = places.withColumnsRenamed({"key": "_key", "mark": "_mark"})
    places = F.broadcast(places) if total <= BROADCAST_PLACES else places
    same = F.col("key").eqNullSafe(F.col("_key")) & (F.col("mark") == F.col("_mark"))
    return texts.join(places, same, how).drop("_key", "_mark")


def repeated_spans(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, anchor: int = ANCHOR
) -> DataFrame:
    """The maximal spans (``low`` up to, not including, ``high``; word numbers) that windows occurring twice or more cover.

    One row per span with ``key`` and ``mark`` of its text. Every stretch of every whole text takes part, and
    occurrences are counted, never paired, so a passage that a third of all texts share costs one row per text
    and is combined before the shuffles. Window equality is equality of two independent 64-bit hashes.
    """
    found = materialize(
        _hashed(docs, key, text).mapInArrow(_anchors(window, anchor), "key bigint, mark int, low bigint, n int, a bigint, b bigint"),
        "anchors",
    )
    # Seeds: anchors that occur twice. Where all their stretches are equal, these are repeated as a whole.
    seeds = found.groupBy("a").agg(F.count(F.lit(1)).alias("_c"), F.min("b").alias("_x"), F.max("b").alias("_y"))
    seeds = seeds.where("_c > 1").select("a", (F.col("_x") != F.col("_y")).alias("mixed"))
    seeded = materialize(found.join(seeds, "a"), "seeded")
    mixed = seeded.where("mixed").drop("mixed")
    # Elsewhere equal stretches are combined to one, and the windows of those that differ are compared.
    kinds = mixed.groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("c"), F.min(F.struct("low", "key", "mark", "n")).alias("one")
    )
    kinds = materialize(kinds, "kinds")
    many = kinds.where("c > 1").select("a", "b")
    whole = seeded.where("NOT mixed").select("key", "mark", "low", "n").unionByName(
        mixed.join(many, ["a", "b"], "left_semi").select("key", "mark", "low", "n")
    )
    weight = F.least(F.col("c"), F.lit(2)).cast("int")
    places = kinds.select("one.key", "one.mark", F.struct(F.col("one.low").alias("low"), weight.alias("weight")).alias("p"))
    places = places.groupBy("key", "mark").agg(F.collect_list("p").alias("ps"))
    places = materialize(places.select("key", "mark", F.col("ps.low").alias("lows"), F.col("ps.weight").alias("weights")), "places")
    total = places.agg(F.sum(F.size("lows"))).first()[0] or 0
    # A repeated row has no stretch of weight 1, so that its windows may come twice.
    chosen = _attach(_hashed(docs, key, text), places, total, "inner").select("key", "mark", "words", "lows", "weights")
    single = materialize(
        chosen.mapInArrow(_windows(window, anchor), "key bigint, mark int, low bigint, a bigint, w bigint, weight int"), "windows"
    )
    again = single.groupBy("a", "w").agg(F.sum("weight").alias("c")).where("c > 1").select("a", "w")
    alone = single.where("weight = 1").join(again, ["a", "w"], "left_semi")
    alone = alone.select("key", "mark", "low", F.lit(1).alias("n"))

    spans = whole.unionByName(alone).select("key", "mark", "low", (F.col("low") + F.col("n") + (window - 1)).alias("high"))
    by_text = Window.partitionBy("key", "mark").orderBy("low", "high")
    before = F.max("high").over(by_text.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("new", (before.isNull() | (F.col("low") > before)).cast("int"))
    spans = spans.withColumn("no", F.sum("new").over(by_text.rowsBetween(Window.unboundedPreceding, 0)))
    return spans.groupBy("key", "mark", "no").agg(F.min("low").alias("low"), F.max("high").alias("high")).drop("no")


def _spanlists(docs: DataFrame, key: str, text: str, window: int, anchor: int) -> tuple[DataFrame, int]:
    spans = repeated_spans(docs, key, text, window, anchor)
    lists = spans.groupBy("key", "mark").agg(F.sort_array(F.collect_list(F.struct("low", "high"))).alias("spans"))
    lists = materialize(lists, "spans")
    return lists, lists.agg(F.sum(F.size("spans"))).first()[0] or 0


def _left(pieces: str, spans: str) -> Column:
    """The pieces outside the spans."""
    none = F.array().cast("array<bigint>")
    spans = F.coalesce(F.col(spans), F.array().cast("array<struct<low:bigint,high:bigint>>"))
    starts = F.concat(F.array(F.lit(0).cast("long")), F.coalesce(F.transform(spans, lambda s: s["high"]), none))
    stops = F.concat(F.transform(spans, lambda s: s["low"]), F.array(F.size(pieces).cast("long")))
    gaps = F.zip_with(starts, stops, lambda a, b: F.struct(a.cast("int").alias("a"), b.cast("int").alias("b")))
    return F.flatten(F.transform(gaps, lambda g: F.slice(pieces, g["a"] + 1, F.greatest(g["b"] - g["a"], F.lit(0)))))


def kept_words(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, anchor: int = ANCHOR
) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``n_words`` and ``kept`` (the words that stay).

    Words are runs of characters other than ASCII white space. A word goes if it lies in a run of ``window`` words
    of its text that also starts anywhere else, in the same text or another; runs are judged on the input. A null
    or empty text, or one shorter than ``window``, keeps all it has. A repeated row repeats its text; keys are
    integers and may repeat or be null; other columns are not read; an empty table gives no rows.
    """
    lists, total = _spanlists(docs, key, text, window, anchor)
    texts = docs.select(F.col(key).cast("long").alias("key"), _mark(F.col(text)).alias("mark"), F.col(text).alias("text"))
    joined = _attach(texts, lists, total, "left").withColumn("words", space_words(F.col("text")))
    return joined.select(F.col("key").alias(key), F.size("words").cast("long").alias("n_words"), _left("words", "spans").alias("kept"))


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, anchor: int = ANCHOR
) -> DataFrame:
    """``docs`` with all columns; repeated words are cut out of ``text`` with the white space before them.

    Texts without repeats come back unchanged, null texts as null. Otherwise as :func:`kept_words`.
    """
    lists, total = _spanlists(docs, key, text, window, anchor)
    held = docs.select(
        F.struct(*docs.columns).alias("_doc"),
        F.col(key).cast("long").alias("key"), _mark(F.col(text)).alias("mark"), F.col(text).alias("_text"),
    )
    joined = _attach(held, lists, total, "left")
    space, word = SPACE.removesuffix("+"), SPACE.removesuffix("+").replace("[", "[^", 1)
    pieces = F.when(F.col("spans").isNotNull(), F.regexp_extract_all("_text", F.lit(f"{space}*{word}+"), F.lit(0)))
    joined = joined.withColumn("_pieces", pieces)
    cut = F.concat(F.array_join(_left("_pieces", "spans"), ""), F.regexp_extract("_text", f"{space}*$", 0))
    new = F.when(F.col("spans").isNull(), F.col("_text")).otherwise(cut)
    return joined.select(*[new.alias(c) if c == text else F.col("_doc")[c].alias(c) for c in docs.columns])
