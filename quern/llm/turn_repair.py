"""Repair of conversation structure by weighted CYK interval parsing.

A conversation is to read ``system? (user assistant)+`` or nothing. The repair grammar is in Chomsky normal form: a
nonterminal [p, q] spells what leads from state p to state q of that pattern, its rules are [p, r] -> [p, q] [q, r], and
a row is kept, given another role, or deleted by a weighted terminal rule. Inserted turns are folded into the
terminal cells beforehand (insertion closure). A cell holds the cheapest (cost, audit) of one nonterminal over one
span of rows; spans are combined bottom-up by their length.

Rows are dealt into blocks by their place, blocks are parsed apart, and the cells of neighbouring blocks are
the terminals of the next chart, so a conversation that holds most of all rows is never gathered in one task.
Audits of one cell that cost the same are never beginnings of each other (what one had more would be insertions,
which cost), so the least of a concatenation is the concatenation of the least.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.common import materialize, with_group_row_number

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
# Rows of one chart, rows of one block, and blocks of one chart; the last is small, as its cells hold long audits.
CHART_ROWS, BLOCK_ROWS, CHART_BLOCKS = 16, 256, 4
# Edits that one output batch holds.
BATCH = 10_000

# States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant; a conversation may end in 0 or 3.
MOVES = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
STATES, ENDS = range(4), (0, 3)
BLANKS = " \t\n\x0b\x0c\r"

Cell = list  # of (cost, audit) or None, one for each of PAIRS


def _pairs() -> list[tuple[int, int]]:
    reach = {(p, p) for p in STATES} | {(p, q) for (p, _), q in MOVES.items()}
    while more := {(p, s) for p, q in reach for r, s in reach if q == r} - reach:
        reach |= more
    return sorted(reach)


PAIRS = _pairs()
_AT = {pair: i for i, pair in enumerate(PAIRS)}
# The rules [p, r] -> [p, q] [q, r] as places in a cell.
RULES = [(_AT[p, s], _AT[p, q], _AT[q, s]) for p, q in PAIRS for r, s in PAIRS if q == r]


def _join(left: Cell, right: Cell, best: Cell) -> None:
    """Improve ``best`` by all rules over one split."""
    for x, y, z in RULES:
        a, b = left[y], right[z]
        if a is None or b is None:
            continue
        cost, now = a[0] + b[0], best[x]
        if now is None or cost < now[0]:
            best[x] = (cost, a[1] + b[1])
        elif cost == now[0] and (audit := a[1] + b[1]) < now[1]:
            best[x] = (cost, audit)


def _insertions() -> Cell:
    """The empty span: what insertions alone lead to."""
    cell: Cell = [(0, "") if p == q else None for p, q in PAIRS]
    step = list(cell)
    for (p, role), q in MOVES.items():
        if role in "ua":
            step[_AT[p, q]] = (INSERT, "I")
    for _ in STATES:
        longer: Cell = [None] * len(PAIRS)
        _join(cell, step, longer)
        cell = longer
    return cell


CLOSURE = _insertions()


def row_cell(symbol: str) -> Cell:
    """Cell of one row. ``d`` must be deleted; else the initial of its role (``o``: another), upper case if truncated."""
    edits: Cell = [(DELETE, "D") if p == q else None for p, q in PAIRS]
    if symbol != "d":
        more = TRUNCATED if symbol.isupper() else 0
        for (p, role), q in MOVES.items():
            ways = [(KEEP + more, "K")] if role == symbol.lower() else []
            ways += [(REROLE + more, "R")] if role in "ua" else []
            for way in ways:
                edits[_AT[p, q]] = min(way, edits[_AT[p, q]] or way)
    before: Cell = [None] * len(PAIRS)
    _join(CLOSURE, edits, before)
    cell: Cell = [None] * len(PAIRS)
    _join(before, CLOSURE, cell)
    return cell


ROW_CELLS = {symbol: row_cell(symbol) for symbol in "dsuaoSUAO"}


def chart(cells: list[Cell]) -> Cell:
    """Cell of the whole span of consecutive cells, by span length over all splits."""
    n = len(cells)
    table = {(i, i + 1): cell for i, cell in enumerate(cells)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            best: Cell = [None] * len(PAIRS)
            for k in range(i + 1, i + length):
                _join(table[i, k], table[k, i + length], best)
            table[i, i + length] = best
    return table[0, n]


def combine(cells: list[Cell], width: int) -> Cell:
    """Cell of any number of consecutive cells, by charts of at most ``width`` of them."""
    while len(cells) > 1:
        cells = [chart(cells[i : i + width]) for i in range(0, len(cells), width)]
    return cells[0]


@lru_cache(maxsize=4096)
def parse_rows(symbols: str) -> Cell:
    return combine([ROW_CELLS[s] for s in symbols], CHART_ROWS)


def cheapest(cell: Cell) -> tuple[int, str]:
    return min(cell[_AT[0, q]] for q in ENDS if cell[_AT[0, q]] is not None)


def _packed(cells: list[Cell]) -> dict[str, pa.Array]:
    costs = [[-1 if way is None else way[0] for way in cell] for cell in cells]
    audits = [["" if way is None else way[1] for way in cell] for cell in cells]
    return {"costs": pa.array(costs, pa.list_(pa.int64())), "audits": pa.array(audits, pa.list_(pa.string()))}


def _parse_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cells = [parse_rows(s) for s in batch["symbols"].to_pylist()]
        yield pa.RecordBatch.from_pydict({"key": batch["key"], "block": batch["block"], **_packed(cells)})


def _parse_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(batch.num_rows):
            one = batch.slice(at, 1)
            cells = [
                [None if cost < 0 else (cost, audit) for cost, audit in zip(cell["costs"], cell["audits"], strict=True)]
                for cell in one["cells"][0].as_py()
            ]
            packed = _packed([combine(cells, CHART_BLOCKS)])
            yield pa.RecordBatch.from_pydict({"key": one["key"], "block": one["block"], **packed})


def _choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        best = []
        for costs, audits in zip(batch["costs"].to_pylist(), batch["audits"].to_pylist(), strict=True):
            best.append(cheapest([None if c < 0 else (c, a) for c, a in zip(costs, audits, strict=True)]))
        yield pa.RecordBatch.from_pydict(
            {"key": batch["key"], "cost": pa.array([c for c, _ in best], pa.int64()), "audit": pa.array([a for _, a in best], pa.string())}
        )


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per turn of the repaired conversation: its position, the edit, the place of the row and the new role."""
    for batch in batches:
        for at in range(batch.num_rows):
            audit, key = batch["audit"][at].as_py(), batch["key"].slice(at, 1)
            left = len(audit) - audit.count("D")
            place = position = 0
            held: list[tuple] = []
            for letter in audit:
                if letter != "D":
                    # The last turn is the assistant's, so roles are told from the end.
                    role = None if letter == "K" else "assistant" if (left - position) % 2 else "user"
                    held.append((position, letter, None if letter == "I" else place, role))
                    position += 1
                place += letter != "I"
                if len(held) == BATCH:
                    yield _edit_batch(key, held)
                    held = []
            if held:
                yield _edit_batch(key, held)


def _edit_batch(key: pa.Array, held: list[tuple]) -> pa.RecordBatch:
    position, edit, place, role = zip(*held, strict=True)
    return pa.RecordBatch.from_pydict(
        {
            "key": pa.concat_arrays([key] * len(held)), "position": pa.array(position, pa.int64()), "edit": pa.array(edit),
            "place": pa.array(place, pa.int64()), "role": pa.array(role, pa.string()),
        }
    )


def _initial(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first.isin("s", "u", "a"), first).otherwise("o")


def marked_rows(turns: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """The rows in order: ``key``, ``turn``, ``role``, ``text``, their ``place`` and their first ``fault`` or null."""
    rows = turns.select(
        F.col(key).alias("key"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    )
    order = [F.asc_nulls_first("turn"), F.col("role"), F.col("text")]
    placed = with_group_row_number(rows, ["key"], order, "place")
    same = ["key", "role", "h1", "h2"]
    # Two independent hashes stand for the text; only what is repeated travels.
    placed = placed.withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit("again"), "text")})
    again = placed.groupBy(*same).agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first")).where("n > 1").drop("n")
    again = materialize(again, "repeated_turns")
    joined = placed.alias("p").join(again.alias("f"), [F.col(f"p.{c}").eqNullSafe(F.col(f"f.{c}")) for c in same], "left")
    left = F.rtrim(F.col("p.text"), F.lit(BLANKS))
    fault = (
        F.when(left == "", "blank")
        .when(F.col("place") > F.col("first"), "duplicate")
        .when(~F.right(left, F.lit(1)).isin(".", "!", "?"), "truncated")
    )
    return joined.select("p.key", "turn", "p.role", "text", "place", fault.alias("fault"))


def _blocks(marked: DataFrame) -> DataFrame:
    """Per block of rows its symbols and counts. The last row of a block is also shown to the next one, as slot -1."""
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), "d").otherwise(
        F.when(F.col("fault") == "truncated", F.upper("initial")).otherwise(F.col("initial"))
    )
    block, slot = F.floor(F.col("place") / BLOCK_ROWS), (F.col("place") % BLOCK_ROWS).cast("int")
    own = F.struct(block.alias("block"), slot.alias("slot"))
    next_one = F.struct((block + 1).alias("block"), F.lit(-1).alias("slot"))
    rows = marked.withColumn("initial", _initial(F.col("role"))).withColumn("symbol", symbol).select(
        "key", "turn", "initial", "symbol", "fault",
        F.explode(F.when(slot == BLOCK_ROWS - 1, F.array(own, next_one)).otherwise(F.array(own))).alias("at"),
    )
    inside = F.col("at.slot") >= 0
    told = lambda name: F.count_if(inside & (F.col("fault") == name)).alias(name)
    grouped = rows.groupBy("key", F.col("at.block").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("at.slot", "symbol", "initial", "turn"))).alias("rows"),
        told("blank"), told("duplicate"), told("truncated"),
        F.min(F.when(inside, F.col("turn"))).alias("low"), F.max(F.when(inside, F.col("turn"))).alias("high"),
    )
    n = F.size("rows")
    after_first = F.slice("rows", 2, F.greatest(n - 1, F.lit(0)))
    pairs = F.arrays_zip(F.slice("rows", 1, F.greatest(n - 1, F.lit(0))).alias("x"), after_first.alias("y"))
    legal = lambda p: F.concat(p["x"]["initial"], p["y"]["initial"]).isin("su", "ua", "au")
    # A turn that differs from the one before it is new, as rows are in order of their turns and nulls come first.
    new = lambda p: p["y"]["turn"].isNotNull() & ~p["x"]["turn"].eqNullSafe(p["y"]["turn"])
    first_new = (F.col("rows")[0]["slot"] >= 0) & F.col("rows")[0]["turn"].isNotNull()
    own_rows = F.filter("rows", lambda r: r["slot"] >= 0)
    return grouped.select(
        "key", "block", "blank", "duplicate", "truncated", "low", "high",
        F.array_join(F.transform(own_rows, lambda r: r["symbol"]), "").alias("symbols"),
        F.size(F.filter(pairs, lambda p: ~legal(p))).alias("illegal"),
        (F.size(F.filter(pairs, new)) + first_new.cast("int")).alias("turns"),
    ).where("symbols <> ''")


def repair(
    turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """The cheapest repair of each conversation: a report and the repaired turns.

    The report has one row per conversation: ``key``, ``gaps`` (turn numbers missing between the first and the
    last), ``blank``, ``duplicate``, ``truncated`` (rows by their first fault), ``illegal`` (neighbours that are not
    system-user, user-assistant or assistant-user), ``cost`` and ``audit`` (initials of the edits). The repaired
    turns have ``key``, ``position``, ``edit``, ``role`` and ``text``; deleted rows are not among them.

    Keep costs 0, Rerole 3, Delete 4 (required for blank and duplicate rows), Insert 3; a truncated row that stays
    costs 3 more. Of equally cheap repairs the one with the least audit is taken. Rows go by turn, nulls first, equal turns
    by role and text. Null roles and texts are one space; a null key is a conversation of its own; a role is known by its
    first letter (s, u, a), and any other, or an empty one, cannot be kept. Repeated rows are duplicates. Other
    columns are not read; an empty table gives two empty tables. Texts of any length are only compared and
    carried. One audit, which is one value of the report, must fit into a task eleven times over.
    """
    marked = marked_rows(turns, key, turn, role, text)
    kind = turns.schema[key].dataType.simpleString()
    blocks = materialize(_blocks(marked), "turn_blocks")
    cell_schema = f"key {kind}, block bigint, costs array<bigint>, audits array<string>"
    cells = materialize(blocks.select("key", "block", "symbols").mapInArrow(_parse_blocks, cell_schema), "cells")
    done = []
    while not cells.where("block > 0").isEmpty():
        # Blocks of one chart are neighbours; keys that are down to one block wait.
        more = materialize(cells.where("block > 0").select("key").distinct(), "unfinished")
        same = F.col("c.key").eqNullSafe(F.col("m.key"))
        done.append(cells.alias("c").join(more.alias("m"), same, "left_anti"))
        open_cells = cells.alias("c").join(more.alias("m"), same, "left_semi")
        spans = open_cells.groupBy("key", F.floor(F.col("block") / CHART_BLOCKS).alias("block")).agg(
            F.sort_array(F.collect_list(F.struct(F.col("c.block").alias("at"), "costs", "audits"))).alias("cells")
        )
        cells = materialize(spans.mapInArrow(_parse_cells, cell_schema), "cells")
    for part in done:
        cells = cells.unionByName(part)
    chosen = materialize(cells.mapInArrow(_choose, f"key {kind}, cost bigint, audit string"), "audits")

    counts = blocks.groupBy("key").agg(
        *[F.sum(c).cast("long").alias(c) for c in ("blank", "duplicate", "truncated", "illegal")],
        F.coalesce(F.max("high") - F.min("low") + 1 - F.sum("turns"), F.lit(0)).cast("long").alias("gaps"),
    )
    report = counts.alias("n").join(chosen.alias("c"), F.col("n.key").eqNullSafe(F.col("c.key"))).select(
        F.col("n.key").alias(key), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"
    )
    edits = chosen.select("key", "audit").mapInArrow(_edits, f"key {kind}, position bigint, edit string, place bigint, role string")
    met = F.col("e.key").eqNullSafe(F.col("r.key")) & (F.col("e.place") == F.col("r.place"))
    repaired = edits.alias("e").join(marked.alias("r"), met, "left").select(
        F.col("e.key").alias(key), "position", "edit",
        F.coalesce("e.role", "r.role").alias("role"), F.coalesce("r.text", F.lit("")).alias("text"),
    )
    return report, repaired


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of runs of rows with one key, read in order and held one batch at a time."""
    now, sha = None, None
    for batch in batches:
        keys, lines = batch["key"].to_pylist(), batch["line"].to_pylist()
        out = []
        for key, line in zip(keys, lines, strict=True):
            if sha is None or key != now:
                if sha is not None:
                    out.append((now, sha.hexdigest()))
                now, sha = key, hashlib.sha256()
            else:
                sha.update(b"\n")
            sha.update(line.encode())
        if out:
            yield pa.RecordBatch.from_pydict({"key": pa.array([k for k, _ in out], batch["key"].type), "sha256": pa.array([d for _, d in out])})
        last = batch["key"].type
    if sha is not None:
        yield pa.RecordBatch.from_pydict({"key": pa.array([now], last), "sha256": pa.array([sha.hexdigest()])})


def digests(repaired: DataFrame, key: str = "conv_id") -> DataFrame:
    """``key`` and ``sha256`` of the lines ``role:text`` of each conversation, joined by line feeds.

    A digest has to be taken in order, so the rows of one conversation pass through one task, but only as a stream.
    """
    lines = repaired.select(F.col(key).alias("key"), "position", F.concat("role", F.lit(":"), "text").alias("line"))
    dealt = lines.repartition("key").sortWithinPartitions("key", "position").select("key", "line")
    kind = repaired.schema[key].dataType.simpleString()
    return dealt.mapInArrow(_digest, f"key {kind}, sha256 string").withColumnRenamed("key", key)


def damage(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The four columns with faults put in by a checksum of key and turn, for tests and measurements.

    Of twenty rows one each is dropped, emptied, stripped of ``.!?``, repeated and given to the user. Nulls
    in key and turn count as one space in the checksum; null roles and texts become one space.
    """
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(told(key), F.lit(":"), told(turn))) % 20
    rows = turns.select(
        key, turn, F.coalesce(F.col(role), F.lit(" ")).alias(role), F.coalesce(F.col(text), F.lit(" ")).alias(text), fate.alias("_fate")
    ).where("_fate <> 0")
    new_text = F.when(F.col("_fate") == 1, "").when(F.col("_fate") == 2, F.translate(text, ".!?", "")).otherwise(F.col(text))
    times = F.when(F.col("_fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        key, turn, F.when(F.col("_fate") == 4, "user").otherwise(F.col(role)).alias(role), new_text.alias(text), F.explode(times).alias("_copy")
    ).drop("_copy")
