"""SentencePiece encoding with sampled segmentations, and lossless decoding.

All ways to spell a text with pieces form a lattice. Forward filtering sums the weights of all ways up to each
place; backward sampling then draws the pieces from the end, each in proportion to the ways it leaves. The
draws come from a hash of the row key, the place in the text and the step, so that a row is segmented alike
whenever and wherever it is encoded.

The lattice of a text falls apart where no piece can span: before a space that follows something else, and
around a line feed. The parts recur, so their filtered lattices are kept, and a batch draws for all of its
parts at once.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.process import per_process

# Filtered lattices kept per process, and the length from which a part is drawn on its own and not kept.
KEPT_PARTS = 100_000
LONG_PART = 200
BATCH_CHARS = 1 << 19
LEARNED_PARTS = 10_000
BATCH_IDS = 120_000
_PART = re.compile(r" *[^ \n]+|\n| +")
_MARK = "▁"  # stands for a space inside pieces

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def _uniform(seeds: np.ndarray, step: int) -> np.ndarray:
    """Numbers in [0, 1), fixed by seed and step."""
    with np.errstate(over="ignore"):
        return (_mix(seeds + np.uint64(step + 1) * _STEP) >> np.uint64(11)).astype(np.float64) * 2.0**-53


class Pieces:
    """The vocabulary of a model: weights of its pieces, ids of its bytes, and the bytes of each id.

    A piece weighs (1 + rank) ** -``alpha``, its rank being the negative of its score: Zipf's law at 1, all
    segmentations alike at 0. A character without a piece is spelled by its bytes, as is the mark that
    stands for spaces, so that both come back.
    """

    def __init__(self, model: str, alpha: float):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        self.weights: dict[str, tuple[int, float]] = {}
        self.bytes_of: list[bytes] = []
        byte_ids: dict[int, int] = {}
        for i in range(sp.vocab_size()):
            name = sp.id_to_piece(i)
            raw = b""
            if sp.is_byte(i):
                raw = bytes([int(name[1:-1], 16)])
                byte_ids[raw[0]] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                text = name.replace(_MARK, " ")
                if re.search(r"[^ ] |\n", text):
                    raise ValueError(f"piece {name!r} spans parts of a text")
                raw = text.encode()
                self.weights[text] = (i, (1.0 - sp.get_score(i)) ** -alpha)
            self.bytes_of.append(raw)
        if len(byte_ids) != 256:
            raise ValueError("the model has no pieces for single bytes")
        self.size = len(self.bytes_of)
        self.byte_ids = byte_ids
        self.longest = max(map(len, self.weights))
        # Codes from ``size`` up stand for the bytes of a character without a piece.
        self.codes: dict[str, int] = {}
        self.spelled: list[list[int]] = [[i] for i in range(self.size)]
        self._build_trie()

        self.raw = np.frombuffer(b"".join(self.bytes_of), dtype=np.uint8)
        self.raw_length = np.array([len(b) for b in self.bytes_of], dtype=np.int64)
        self.raw_start = np.cumsum(self.raw_length) - self.raw_length

    def spell(self, ids: np.ndarray, n: np.ndarray) -> tuple[bytes, list[int]]:
        """Bytes of all ids one after another, and where those of each text (``n`` ids) begin."""
        length = self.raw_length[ids]
        ends = np.concatenate(([0], np.cumsum(length)))
        inside = np.arange(ends[-1]) - np.repeat(ends[:-1], length)
        raw = self.raw[np.repeat(self.raw_start[ids], length) + inside].tobytes()
        return raw, ends[np.concatenate(([0], np.cumsum(n)))].tolist()

    def _build_trie(self) -> None:
        """Prefixes of the pieces as sorted keys (prefix, next character) -> longer prefix."""
        steps: dict[tuple[int, int], int] = {}
        piece, log_weight = [-1], [0.0]
        for text, (i, weight) in self.weights.items():
            node = 0
            for char in text:
                step = (node, ord(char))
                if step not in steps:
                    steps[step] = len(piece)
                    piece.append(-1)
                    log_weight.append(0.0)
                node = steps[step]
            piece[node], log_weight[node] = i, math.log(weight)
        keys = np.array([n << 21 | c for n, c in steps], dtype=np.int64)
        order = np.argsort(keys)
        self.trie_keys = keys[order]
        self.trie_next = np.fromiter(steps.values(), dtype=np.int64)[order]
        self.trie_piece, self.trie_log_weight = np.array(piece, dtype=np.int32), np.array(log_weight)

    def spans(self, chars: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All pieces in a row of characters that end before ``limit`` of their first character, sorted by their
        last character: first and last character, code and log weight. Characters without a piece have a code."""
        at, node = np.arange(len(chars)), np.zeros(len(chars), dtype=np.int64)
        firsts, lasts, codes, logs = [], [], [], []
        alone = np.ones(len(chars), dtype=bool)
        for length in range(self.longest):
            inside = at + length < limit[at]
            at, node = at[inside], node[inside]
            key = node << 21 | chars[at + length]
            found = np.minimum(np.searchsorted(self.trie_keys, key), len(self.trie_keys) - 1)
            there = self.trie_keys[found] == key
            at, node = at[there], self.trie_next[found[there]]
            ends = self.trie_piece[node] >= 0
            firsts.append(at[ends])
            lasts.append(at[ends] + length)
            codes.append(self.trie_piece[node[ends]])
            logs.append(self.trie_log_weight[node[ends]])
            if not length:
                alone[at[ends]] = False
        odd = np.flatnonzero(alone)
        firsts.append(odd)
        lasts.append(odd)
        codes.append(np.array([self.code(chr(c)) for c in chars[odd]], dtype=np.int32))
        logs.append(np.zeros(len(odd)))
        last = np.concatenate(lasts)
        order = np.argsort(last, kind="stable")
        return np.concatenate(firsts)[order], last[order], np.concatenate(codes)[order], np.concatenate(logs)[order]

    def code(self, char: str) -> int:
        raw = char.encode()
        if len(raw) == 1:
            return self.byte_ids[raw[0]]
        if char not in self.codes:
            self.codes[char] = len(self.spelled)
            self.spelled.append([self.byte_ids[b] for b in raw])
        return self.codes[char]

    def arcs(self, part: str) -> list[tuple[list[float], list[int], list[int]]]:
        """For each place from 1 on: cumulative probabilities, codes and starts of the pieces that end there."""
        ways, out, known = [1.0], [], self.weights
        for end in range(1, len(part) + 1):
            weights, codes, starts = [], [], []
            for start in range(max(0, end - self.longest), end):
                found = known.get(part[start:end])
                if found is not None and ways[start]:
                    weights.append(ways[start] * found[1])
                    codes.append(found[0])
                    starts.append(start)
            if part[end - 1] not in known:
                # Only its bytes spell this character; ways that end before it are all it leaves.
                weights.append(ways[end - 1])
                codes.append(self.code(part[end - 1]))
                starts.append(end - 1)
            total = sum(weights)
            ways.append(total)
            if total < 1e-200:
                # Only ratios count, so the ways still in reach are scaled up together.
                for k in range(max(0, end - self.longest), end + 1):
                    ways[k] *= 1e150
                total = ways[end]
                weights = [w * 1e150 for w in weights]
            running, cumulative = 0.0, []
            for w in weights:
                running += w
                cumulative.append(running / total)
            cumulative[-1] = 1.0
            out.append((cumulative, codes, starts))
        return out


class Sampler:
    """Keeps the filtered lattices of parts as flat arrays: place -> pieces that end there, each with its cumulative
    probability, code and the place before it."""

    def __init__(self, model: str, alpha: float):
        self.pieces = Pieces(model, alpha)
        self._forget()

    def _forget(self) -> None:
        self.ends: dict[str, int] = {}
        self.first_arc = np.zeros(1, dtype=np.int32)
        self.cumulative = np.zeros(0)
        self.codes = np.zeros(0, dtype=np.int32)
        self.before = np.zeros(0, dtype=np.int32)

    def _learn(self, parts: list[str]) -> None:
        """Filter the lattices of new parts, in groups of bounded size, and put them behind the known ones."""
        known = [(self.first_arc, self.cumulative, self.codes, self.before)]
        places, arcs = len(self.first_arc) - 1, len(self.codes)
        for at in range(0, len(parts), LEARNED_PARTS):
            new = self._filtered(parts[at : at + LEARNED_PARTS], places, arcs)
            places, arcs = places + len(new[0]), arcs + len(new[1])
            known.append(new)
        self.first_arc, self.cumulative, self.codes, self.before = (np.concatenate(c) for c in zip(*known, strict=True))

    def _filtered(self, parts: list[str], base: int, arcs_before: int) -> tuple[np.ndarray, ...]:
        """Filter all parts at once, place by place from their starts: ends of the places' pieces, and of each piece
        the cumulative probability, code and place before it. Numbers count on from ``base`` and ``arcs_before``."""
        chars = np.frombuffer("".join(parts).encode("utf-32-le"), dtype="<u4").astype(np.int64)
        length = np.array([len(p) for p in parts], dtype=np.int64)
        stop = np.cumsum(length)
        start = np.repeat(stop - length, length)
        first, last, codes, logs = self.pieces.spans(chars, np.repeat(stop, length))
        depth = np.arange(len(chars)) - start
        order = np.argsort(depth[last], kind="stable")
        bounds = np.searchsorted(depth[last][order], np.arange(int(length.max()) + 1))
        ways, chance = np.zeros(len(chars)), np.zeros(len(last))
        opens = first == start[last]
        for d in range(int(length.max())):
            arcs = order[bounds[d] : bounds[d + 1]]
            place = last[arcs]
            each = logs[arcs] + np.where(opens[arcs], 0.0, ways[np.maximum(first[arcs] - 1, 0)])
            new = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
            top = np.maximum.reduceat(each, new)
            size = np.diff(np.concatenate((new, [len(place)])))
            total = top + np.log(np.add.reduceat(np.exp(each - np.repeat(top, size)), new))
            ways[place[new]] = total
            chance[arcs] = np.exp(each - np.repeat(total, size))
        count = np.bincount(last, minlength=len(chars))
        ended = np.cumsum(count)
        running = chance
        # Summed inside each place alone, piece by piece, so that no other part has a share in the rounding.
        for k in range(1, int(count.max())):
            at = ended[count > k] - count[count > k] + k
            running[at] += running[at - 1]
        running[ended - 1] = 1.0
        self.ends.update(zip(parts, (base + stop - 1).tolist(), strict=True))
        return (
            (arcs_before + ended).astype(np.int32),
            running,
            codes,
            np.where(opens, -1, base + first - 1).astype(np.int32),
        )

    def _draw(self, place: np.ndarray, chance: np.ndarray) -> np.ndarray:
        """The piece drawn at each place: the first whose cumulative probability exceeds ``chance``."""
        arc, final = self.first_arc[place], self.first_arc[place + 1] - 1
        step = 1 << max(0, self.pieces.longest - 1).bit_length() >> 1
        while step:
            middle = np.minimum(arc + (step - 1), final)
            arc = np.where((arc + (step - 1) < final) & (self.cumulative[middle] <= chance), arc + step, arc)
            step >>= 1
        return arc

    def _draw_long(self, part: str, seed: int) -> list[int]:
        arcs, end, step, out = self.pieces.arcs(part), len(part), 0, []
        seeds = np.full(1, seed, dtype=np.uint64)
        while end:
            cumulative, codes, starts = arcs[end - 1]
            k = int(np.searchsorted(cumulative, _uniform(seeds, step)[0], side="right"))
            out.append(codes[k])
            end, step = starts[k], step + 1
        return out[::-1]

    def encode(self, texts: list[str], seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and their number for each text."""
        parts, per_text = [], []
        for text in texts:
            own = _PART.findall(" " + text) if text else []
            parts += own
            per_text.append(len(own))
        per_text = np.array(per_text, dtype=np.int64)
        if not parts:
            return np.zeros(0, dtype=np.int32), per_text
        missing = {p for p in set(parts).difference(self.ends) if len(p) < LONG_PART}
        if len(self.ends) + len(missing) > KEPT_PARTS and self.ends:
            self._forget()
            missing = {p for p in set(parts) if len(p) < LONG_PART}
        if missing:
            self._learn(sorted(missing))
        place = np.array([self.ends.get(p, -1) for p in parts], dtype=np.int64)
        first = np.repeat(np.cumsum(per_text) - per_text, per_text)
        with np.errstate(over="ignore"):
            seed = _mix(np.repeat(seeds, per_text) + (np.arange(len(parts)) - first).astype(np.uint64) * _MIX1)
        drawn, which, step = [], [], 0
        active = np.flatnonzero(place >= 0)
        at = place[active]
        while len(active):
            arc = self._draw(at, _uniform(seed[active], step))
            drawn.append(self.codes[arc])
            which.append(active)
            at = self.before[arc]
            go_on = at >= 0
            active, at, step = active[go_on], at[go_on], step + 1
        long = {int(i): self._draw_long(parts[i], int(seed[i])) for i in np.flatnonzero(place < 0)}
        counts = np.zeros(len(parts), dtype=np.int64)
        for w in which:
            counts[w] += 1
        for i, codes in long.items():
            counts[i] = len(codes)
        start = np.cumsum(counts) - counts
        out = np.zeros(int(counts.sum()), dtype=np.int32)
        # The first draw is the last piece of its part.
        for step, (w, codes) in enumerate(zip(which, drawn, strict=True)):
            out[start[w] + counts[w] - 1 - step] = codes
        for i, codes in long.items():
            out[start[i] : start[i] + len(codes)] = codes
        bounds = np.concatenate(([0], np.cumsum(per_text)))
        total = np.concatenate(([0], np.cumsum(counts)))
        n = total[bounds[1:]] - total[bounds[:-1]]
        return self._spell(out, n)

    def _spell(self, codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Replace codes of characters by the ids of their bytes."""
        odd = np.flatnonzero(codes >= self.pieces.size)
        if not len(odd):
            return codes, n
        spelled = [self.pieces.spelled[c] for c in codes[odd]]
        length = np.ones(len(codes), dtype=np.int64)
        length[odd] = [len(s) for s in spelled]
        owner = np.repeat(np.arange(len(n)), n)
        more = np.bincount(owner, weights=length, minlength=len(n)).astype(np.int64)
        out = np.repeat(codes, length)
        start = np.cumsum(length) - length
        for i, s in zip(start[odd].tolist(), spelled, strict=True):
            out[i : i + len(s)] = s
        return out, more


def _groups(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Texts in groups of bounded size with the place of the first; nulls as empty texts."""
    start, group, size = 0, [], 0
    for i, t in enumerate(texts):
        group.append(t.as_py() or "")
        size += len(group[-1])
        if size >= BATCH_CHARS:
            yield start, group
            start, group, size = i + 1, [], 0
    if group:
        yield start, group


def _encoder(model: str, alpha: float, seed: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = per_process(("sampler", model, alpha), lambda: Sampler(model, alpha))
        for batch in batches:
            with np.errstate(over="ignore"):
                seeds = _mix(batch["_seed"].to_numpy().view(np.uint64) + np.uint64(seed) * _STEP)
            for start, texts in _groups(batch["_text"]):
                ids, n = sampler.encode(texts, seeds[start : start + len(texts)])
                rows = batch.slice(start, len(texts))
                null = rows["_text"].is_null().to_numpy(zero_copy_only=False)
                ends = pa.array(np.concatenate(([0], np.cumsum(n))).astype(np.int32))
                lists = pa.ListArray.from_arrays(ends, pa.array(ids), mask=pa.array(null))
                out = {"_row": rows["_row"], "piece_ids": lists}
                yield pa.RecordBatch.from_pydict(out | ({"_text": rows["_text"]} if with_text else {}))

    return run


def encode(
    docs: DataFrame, model: str, alpha: float = 1.0, seed: int = 0, key: str = "doc_id", text: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of ``docs``: ``key``, the columns ``keep`` and ``piece_ids``, a segmentation drawn for its key.

    Whole texts are encoded inside their rows; nothing is shuffled. A null text has null ids, an empty one
    none. Rows of one key with one text are segmented alike; a null key is a key like others. Other columns are
    not read. The model must be a SentencePiece model with byte pieces whose other pieces hold spaces only in
    front.
    """
    columns = list(dict.fromkeys((key, *keep)))
    # The text crosses once, whether or not it is kept.
    rows = docs.select(
        F.struct(*[c for c in columns if c != text] or [F.lit(0).alias("_none")]).alias("_row"),
        F.xxhash64(key).alias("_seed"), F.col(text).alias("_text"),
    )
    held = rows.schema["_row"].dataType.simpleString() + ", piece_ids array<int>"
    out = rows.mapInArrow(_encoder(model, alpha, seed, text in columns), f"_row {held}" + ", _text string" * (text in columns))
    return out.select(*[F.col("_text").alias(c) if c == text else F.col("_row")[c].alias(c) for c in columns], "piece_ids")


def _decoder(model: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = per_process(("pieces", model), lambda: Pieces(model, 1.0))
        for batch in batches:
            n = batch["_ids"].value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            # Groups of texts with a bounded number of ids.
            group = np.cumsum(n) // BATCH_IDS
            cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
            for start, stop in zip(cuts, cuts[1:], strict=False):
                lists = batch["_ids"].slice(start, stop - start)
                raw, ends = pieces.spell(lists.flatten().to_numpy(zero_copy_only=False), n[start:stop])
                texts = [
                    raw[a:b].decode()[1:] if there else None
                    for a, b, there in zip(ends, ends[1:], lists.is_valid().to_pylist(), strict=False)
                ]
                yield pa.RecordBatch.from_pydict(
                    {"_row": batch["_row"].slice(start, stop - start), "_ids": lists, "decoded": pa.array(texts, pa.string())}
                )

    return run


def decode(encoded: DataFrame, model: str, ids: str = "piece_ids") -> DataFrame:
    """``encoded`` with the column ``decoded``: the text that was encoded, character by character; null ids give null."""
    rest = [c for c in encoded.columns if c != ids] or [F.lit(0).alias("_none")]
    rows = encoded.select(F.struct(*rest).alias("_row"), F.col(ids).alias("_ids"))
    held = rows.schema["_row"].dataType.simpleString()
    out = rows.mapInArrow(_decoder(model), f"_row {held}, _ids array<int>, decoded string")
    return out.select(*[F.col("_ids").alias(c) if c == ids else F.col("_row")[c].alias(c) for c in encoded.columns], "decoded")
