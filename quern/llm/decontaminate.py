"""Benchmark decontamination by a broadcast set of normalised word windows.

A bitmap of the window hashes, of bounded size, thins out the positions of each text inside its row; the few
positions left are looked up in the broadcast set by their words, so that no hash collision counts as a hit.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.common import materialize
from quern.llm.words import NOT_ALPHANUMERIC, plain_words, with_window_hashes

WINDOW = 10
# Larger sets of windows are joined by shuffling the candidates, with the same result.
BROADCAST_BYTES = 64 << 20
# The bitmap has up to this many 64-bit cells (1 MB); a fuller bitmap only lets more candidates through.
MAX_CELLS = 1 << 17


def benchmark_windows(items: DataFrame, key: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """Distinct windows of all items: ``window`` (words joined by a space), ``size`` and sorted ``items``.

    An item of fewer than ``size`` words is one window; one without words (or with a null text) has none.
    Repeated items count once; a null id counts as an empty one.
    """
    w = items.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("item"), plain_words(F.col(text)).alias("w"))
    length = F.least(F.size("w"), F.lit(size))
    w = w.where(F.size("w") > 0).select("item", "w", length.alias("size"), F.size("w").alias("n"))
    starts = F.sequence(F.lit(1), F.col("n") - F.col("size") + 1)
    w = w.select("item", "w", "size", F.explode_outer(starts).alias("at"))
    w = w.select("item", "size", F.array_join(F.slice("w", F.col("at"), F.col("size")), " ").alias("window"))
    return w.groupBy("window", "size").agg(F.sort_array(F.collect_set("item")).alias("items"))


def _prepared(items: DataFrame, key: str, text: str, size: int) -> tuple[DataFrame, dict, list[int]]:
    """The stored windows with their hash, how many and how large they are, and which sizes occur (at most ``size``)."""
    sizes = list(range(1, size + 1))
    w = benchmark_windows(items, key, text, size).withColumn("_w", F.split("window", " "))
    w = with_window_hashes(w, "_w", {f"_n{k}": k for k in sizes})
    first = F.coalesce(*[F.when(F.col("size") == k, F.get(f"_n{k}", F.lit(0))) for k in sizes])
    w = materialize(w.select("window", "size", "items", first.alias("hash")), "windows")
    used = F.sum(F.octet_length("window") + 48 + F.aggregate("items", F.lit(0), lambda s, x: s + F.octet_length(x) + 24))
    total = w.agg(F.count(F.lit(1)).alias("n"), F.coalesce(used, F.lit(0)).alias("bytes")).first().asDict()
    return w, total, sorted(r["size"] for r in w.select("size").distinct().collect())


def _bitmap(windows: DataFrame, n: int) -> tuple[Column, int]:
    """A constant array of 64-bit cells in which the bits of all window hashes are set."""
    cells = 64
    while cells < MAX_CELLS and cells * 4 < n:
        cells *= 2
    cell, bit = _place(F.col("hash"), cells)
    set_bits = windows.select(cell.alias("cell"), bit.alias("b")).groupBy("cell")
    set_bits = set_bits.agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("bits"))
    found = {r["cell"]: r["bits"] for r in set_bits.collect()}
    return F.split(F.lit(",".join(str(found.get(c, 0)) for c in range(cells))), ",").cast("array<bigint>"), cells


def _place(value: Column, cells: int) -> tuple[Column, Column]:
    return value.bitwiseAND(F.lit(cells - 1)).cast("int"), F.shiftrightunsigned(value, 58).cast("int")


def find_hits(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW,
) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``n_words``, ``hits`` (sorted ``pos``, ``len`` of each hit window) and ``items``.

    Words are runs of digits, ASCII letters (lower-cased) and characters beyond ASCII. Texts are scanned
    once and whole. A null or empty text has no words; repeated rows and null keys stay rows of their own;
    an empty benchmark hits nothing; other columns are not read, so their names cannot clash.
    """
    windows, total, sizes = _prepared(items, item_key, item_text, size)
    bitmap, cells = _bitmap(windows, total["n"])
    d = docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col(key).alias("_key"), plain_words(F.col(text)).alias("_words")
    )
    d = with_window_hashes(d, "_words", {f"_n{k}": k for k in sizes})

    def maybe(k: int) -> Column:
        def test(h, i):
            cell, bit = _place(h, cells)
            return F.when(F.getbit(F.get(bitmap, cell), bit) == 1, F.struct(i.alias("pos"), F.lit(k).alias("len")))

        return F.array_compact(F.transform(f"_n{k}", test))

    none = F.array().cast("array<struct<pos:int,len:int>>")
    found = reduce(lambda a, b: F.concat(a, b), [maybe(k) for k in sizes], none)
    d = d.select("_row", "_key", "_words", F.size("_words").alias("n_words"), found.alias("_found"))
    d = d.select(
        "_row", "_key", "n_words",
        F.transform(
            "_found",
            lambda c: F.struct(c["pos"], c["len"], F.array_join(F.slice("_words", c["pos"] + 1, c["len"]), " ").alias("window")),
        ).alias("_found"),
    )
    # The outer form keeps a row for each text without candidates, and one text is not read twice.
    d = d.select("_row", "_key", "n_words", F.explode_outer("_found").alias("c"))
    d = d.select("_row", "_key", "n_words", "c.pos", "c.len", "c.window")
    known = windows.select("window", "items")
    known = F.broadcast(known) if total["bytes"] <= BROADCAST_BYTES else known
    d = d.join(known, "window", "left")
    hit = F.when(F.col("items").isNotNull(), F.struct("pos", "len"))
    d = d.groupBy("_row", "_key", "n_words").agg(
        F.sort_array(F.collect_set(hit)).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    return d.select(F.col("_key").alias(key), "n_words", "hits", "items")


def words_hit(hits: Column) -> Column:
    """Number of words inside at least one of the sorted windows."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))

    def add(s, h):
        end = F.greatest(s["end"], h["pos"] + h["len"])
        return F.struct((s["n"] + end - F.greatest(s["end"], h["pos"])).cast("long").alias("n"), end.alias("end"))

    return F.aggregate(hits, start, add, lambda s: s["n"])


def _without(text: Column, hits: str) -> Column:
    """The text less the words inside the windows and the separators before them."""
    separator = NOT_ALPHANUMERIC.removesuffix("+").replace(r"\x3A-\x60", r"\x3A-\x40\x5B-\x60")
    word = separator.replace("[", "[^", 1)
    pieces = F.regexp_extract_all(text, F.lit(f"{separator}*{word}+"), F.lit(0))
    tail = F.regexp_extract(text, f"{separator}*$", 0)
    covered = F.array_distinct(F.flatten(F.transform(hits, lambda h: F.sequence(h["pos"], h["pos"] + h["len"] - 1))))
    # A null stands for each word that goes; array_join leaves nulls out.
    marks = F.map_from_arrays(covered, F.array_repeat(F.lit(True), F.size(covered)))
    left = F.zip_with(
        pieces,
        F.transform(F.sequence(F.lit(0), F.size(pieces) - 1), lambda i: F.element_at(marks, i)),
        lambda p, gone: F.when(gone.isNull(), p),
    )
    return F.concat(F.array_join(left, ""), tail)


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    mode: str = "documents",
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW,
) -> DataFrame:
    """``docs`` without what occurs in the benchmark, with all its columns.

    ``documents`` drops contaminated rows, ``spans`` cuts the hit words (and the separators before them) out
    of their texts. Verdicts are matched to rows by key and text, so repeated rows fare alike, and null keys
    and texts match themselves. A length column of ``docs`` is not recomputed.
    """
    if mode not in ("documents", "spans"):
        raise ValueError(f"unknown mode {mode!r}")
    same = F.struct(F.col(key).alias("key"), F.xxhash64(text).alias("mark"))
    held = docs.select(F.struct(*docs.columns).alias("_doc"), same.alias("_id"), F.col(text).alias("_text"))
    found = find_hits(held, items, "_id", "_text", item_key, item_text, size).where(F.size("hits") > 0)
    found = found.groupBy(F.col("_id").alias("_found")).agg(F.first("hits").alias("_hits"))
    found = materialize(found, "contaminated")
    match = F.col("_id").eqNullSafe(F.col("_found"))
    if mode == "documents":
        return held.join(found.select("_found"), match, "left_anti").select("_doc.*")
    cut = F.when(F.col("_hits").isNull(), F.col("_text")).otherwise(_without(F.col("_text"), "_hits"))
    joined = held.join(found, match, "left")
    return joined.select(*[cut.alias(c) if c == text else F.col("_doc")[c].alias(c) for c in docs.columns])
