"""Token ids in binary files whose document boundaries are Elias-Fano encoded.

A file is a sequence of blocks, each followed by a line feed (Spark's text writer puts it there). A block holds
the concatenated ids of consecutive documents, and instead of 64-bit offsets and keys two Elias-Fano sequences,
which take about two bits per document more than the spread of the values needs. Select samples find the n-th
boundary without decoding the others.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.common import materialize, scratch_path
from quern.llm.process import per_process

BLOCK_BYTES = 4 << 20
BLOCK_DOCS = 1 << 16
# A file is one value in a reader's batch, so that few blocks keep batches and their copies small.
BLOCKS_PER_FILE = 2
# Pieces a worker process remembers between tasks, about 200 bytes each.
CACHED_PIECES = 1_000_000
JOINED_PIECES = 5_000
# Fixed value: how byte-level vocabularies write a space.
SPACE_SIGN = "\u0120"
SAMPLE_EVERY = 256

_BLOCK = "<4sIIIqQQQ"  # magic, id bytes, documents, null keys, first key, ids, bytes of keys, bytes of boundaries
_MAGIC = b"EFT1"
_SEQUENCE = "<QBxxxIQ"  # values, low bits, select samples, bytes of the high part
_ONES = np.array([bin(b).count("1") for b in range(256)], dtype=np.uint8)


class EliasFano:
    """A non-decreasing sequence of integers from 0 up: low bits packed, high bits in unary.

    ``seq[i]`` finds the i-th one in the unary part from the nearest sample; ``values()`` decodes all.
    """

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n, last = len(values), int(values[-1]) if len(values) else 0
        low_bits = max(0, (last // n).bit_length() - 1) if n else 0
        places = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((values[:, None] >> places) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n, dtype=np.int64)
        bits = np.zeros(int(ones[-1]) + 1 if n else 0, dtype=np.uint8)
        bits[ones] = 1
        return cls(n, low_bits, low, np.packbits(bits, bitorder="little"), ones[::SAMPLE_EVERY].astype("<u8"))

    def to_bytes(self) -> bytes:
        head = struct.pack(_SEQUENCE, self.n, self.low_bits, len(self.samples), len(self.high))
        return b"".join((head, self.samples.tobytes(), self.high.tobytes(), self.low.tobytes()))

    @classmethod
    def from_bytes(cls, data: memoryview) -> EliasFano:
        n, low_bits, n_samples, n_high = struct.unpack_from(_SEQUENCE, data)
        at = struct.calcsize(_SEQUENCE)
        samples = np.frombuffer(data, "<u8", n_samples, at)
        high = np.frombuffer(data, np.uint8, n_high, at + 8 * n_samples)
        low = np.frombuffer(data, np.uint8, -(-n * low_bits // 8), at + 8 * n_samples + n_high)
        return cls(n, low_bits, low, high, samples)

    def __len__(self) -> int:
        return self.n

    def _select(self, i: int) -> int:
        """Place of the i-th one in the unary part."""
        start, left = int(self.samples[i // SAMPLE_EVERY]), i % SAMPLE_EVERY
        at = start // 8
        byte = int(self.high[at]) & (0xFF << start % 8)
        while left >= _ONES[byte]:
            left -= int(_ONES[byte])
            at += 1
            byte = int(self.high[at])
        for _ in range(left):
            byte &= byte - 1
        return at * 8 + (byte & -byte).bit_length() - 1

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        first = i * self.low_bits
        bits = np.unpackbits(self.low[first // 8 : (first + self.low_bits + 7) // 8], bitorder="little")
        bits = bits[first % 8 : first % 8 + self.low_bits]
        low = sum(int(b) << k for k, b in enumerate(bits))
        return (self._select(i) - i) << self.low_bits | low

    def values(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        out = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            bits = np.unpackbits(self.low, count=self.n * self.low_bits, bitorder="little").reshape(self.n, -1)
            out |= (bits.astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        return out.astype(np.int64)


def pack_block(keys: list[int | None], ids: list[bytes], width: int) -> bytes:
    """One block: ``keys`` ascending with nulls first, and the ids of each document as little-endian bytes."""
    known = np.array([k for k in keys if k is not None], dtype=np.int64)
    first = int(known[0]) if len(known) else 0
    ends = np.cumsum([len(x) // width for x in ids], dtype=np.int64)
    coded_keys = EliasFano.encode((known - first).astype(np.uint64)).to_bytes()
    coded_ends = EliasFano.encode(ends).to_bytes()
    head = struct.pack(
        _BLOCK, _MAGIC, width, len(keys), len(keys) - len(known), first, int(ends[-1]) if len(ends) else 0, len(coded_keys), len(coded_ends)
    )
    return b"".join((head, coded_keys, coded_ends, *ids))


class Block:
    """A block read back: ``keys``, ``boundaries`` (Elias-Fano, ends of the documents) and ``ids``."""

    def __init__(self, data: memoryview):
        magic, width, n, nulls, first, n_ids, a, b = struct.unpack_from(_BLOCK, data)
        if magic != _MAGIC:
            raise ValueError("no token block starts here")
        at = struct.calcsize(_BLOCK)
        known = EliasFano.from_bytes(data[at : at + a]).values() + first
        self.keys: list[int | None] = [None] * nulls + known.tolist()
        self.boundaries = EliasFano.from_bytes(data[at + a : at + a + b])
        self.ids = np.frombuffer(data, f"<u{width}", n_ids, at + a + b)
        self.size = at + a + b + n_ids * width
        if len(self.keys) != n or len(self.boundaries) != n:
            raise ValueError("a token block is damaged")

    def document(self, i: int) -> np.ndarray:
        """Ids of the i-th document, found by select."""
        return self.ids[self.boundaries[i - 1] if i else 0 : self.boundaries[i]]


def blocks_of(content: bytes | pa.Buffer) -> Iterator[Block]:
    view, at = memoryview(content), 0
    while at < len(view):
        block = Block(view[at:])
        at += block.size + 1  # the line feed
        yield block


# The white space of the tokenizer's pattern (Unicode White_Space).
_WHITE = "\\t-\\r " + "".join(map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_ODD_SPACE = re.compile(f" (?:[{_WHITE}]|$)")
_CUT = re.compile(f" (?=[^{_WHITE}])")


class PieceEncoder:
    """Encodes whole texts with the tokenizers library, asking it once for each different piece.

    The tokenizer's pattern never joins characters across a space that is followed by something other than
    white space, so a text may be cut there and its pieces encoded on their own. Only use it with byte-level
    tokenizers of that pattern. The cache is bounded; when full, its later half is dropped. As the library does by
    default, a text is cut at the vocabulary's added tokens first, and each of them becomes its own id.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        added = self.tokenizer.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word for t in added.values()):
            raise ValueError("an added token of the vocabulary takes white space or word bounds into account")
        self.added = {t.content: np.array([i], dtype=f"<u{self.width}").tobytes() for i, t in added.items()}
        # The longest of several that start at one place is taken.
        self.cut_at_added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.opens = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        self.opens[[i for token, i in self.tokenizer.get_vocab().items() if token.startswith(SPACE_SIGN)]] = True
        self.first: dict[str, bytes] = {}
        self.rest: dict[str, bytes] = {}

    def _learn(self, cache: dict[str, bytes], pieces: set[str], lead: str) -> None:
        if not lead:
            self._learn_each(cache, list(pieces), lead)
            return
        self._learn_each(cache, [p for p in pieces if " " in p], lead)
        plain = [p for p in pieces if " " not in p]
        for at in range(0, len(plain), JOINED_PIECES):
            self._learn_joined(cache, plain[at : at + JOINED_PIECES], lead)

    def _learn_each(self, cache: dict[str, bytes], pieces: list[str], lead: str) -> None:
        coded = self.tokenizer.encode_batch_fast([lead + p for p in pieces], add_special_tokens=False)
        cache.update((p, np.array(e.ids, dtype=f"<u{self.width}").tobytes()) for p, e in zip(pieces, coded, strict=True))

    def _learn_joined(self, cache: dict[str, bytes], pieces: list[str], lead: str) -> None:
        """Encode pieces without inner spaces as one text; an id that begins with a space begins a piece."""
        text = lead + lead.join(pieces)
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=f"<u{self.width}")
        start = np.flatnonzero(self.opens[ids])
        if len(start) != len(pieces):
            self._learn_each(cache, pieces, lead)
            return
        raw, bounds = ids.tobytes(), (np.append(start, len(ids)) * self.width).tolist()
        cache.update((p, raw[x:y]) for p, x, y in zip(pieces, bounds, bounds[1:], strict=False))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian bytes of ``width`` per id."""
        # Between added tokens (odd places) a text is encoded as if it stood alone.
        stretches = [self.cut_at_added.split(t) if any(a in t for a in self.added) else [t] for t in texts]
        coded = iter(self._encode_plain([s for own in stretches for s in own[::2]]))
        return [
            next(coded) if len(own) == 1 else b"".join(self.added[s] if i % 2 else next(coded) for i, s in enumerate(own))
            for own in stretches
        ]

    def _encode_plain(self, texts: list[str]) -> list[bytes]:
        """``encode`` for texts without added tokens."""
        cut = [t.split(" ") if not _ODD_SPACE.search(t) else _CUT.split(t) for t in texts]
        for name, lead, used in (
            ("first", "", {c[0] for c in cut}),
            ("rest", " ", set().union(*(c[1:] for c in cut))),
        ):
            missing = used.difference(getattr(self, name))
            if len(getattr(self, name)) + len(missing) > CACHED_PIECES:
                # What was met first is what is frequent; the later half goes.
                setattr(self, name, dict(islice(getattr(self, name).items(), CACHED_PIECES // 2)))
                missing = used.difference(getattr(self, name))
            if missing:
                self._learn(getattr(self, name), missing, lead)
        first, rest = self.first, self.rest
        return [first[c[0]] + b"".join(map(rest.__getitem__, c[1:])) for c in cut]


def _slices(texts: pa.Array, most: int = 2 << 20) -> Iterator[tuple[int, list[str]]]:
    """The texts in groups of about ``most`` bytes with the place of the first; nulls as empty texts."""
    start, group, size = 0, [], 0
    for i, t in enumerate(texts):
        text = t.as_py() or ""
        group.append(text)
        size += len(text)
        if size >= most:
            yield start, group
            start, group, size = i + 1, [], 0
    if group:
        yield start, group


def _writer(path: str, end_id: int) -> Callable:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_process(("pieces", path), lambda: PieceEncoder(path))
        end = np.array([end_id], dtype=f"<u{encoder.width}").tobytes()
        keys: list[int | None] = []
        ids: list[bytes] = []
        size = 0
        for batch in batches:
            known = batch["key"].to_pylist()
            for start, texts in _slices(batch["text"]):
                for i, coded in enumerate(encoder.encode(texts), start):
                    keys.append(known[i])
                    ids.append(coded + end)
                    size += len(coded)
                    if size >= BLOCK_BYTES or len(keys) == BLOCK_DOCS:
                        yield pa.RecordBatch.from_pydict({"value": [pack_block(keys, ids, encoder.width)]})
                        keys, ids, size = [], [], 0
        if keys:
            yield pa.RecordBatch.from_pydict({"value": [pack_block(keys, ids, encoder.width)]})

    return write


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = 0
) -> None:
    """Write the ids of every whole text, each followed by ``end_id``, in ascending order of the integer ``key``.

    The order runs through the files in the order of their names. Null keys come first; repeated rows and
    keys are documents of their own, next to each other; a null or empty text is only its end id; other
    columns are not read; an empty table gives no blocks. Blocks hold about 4 MB of ids (one longer text
    is a block of its own) and files 2 blocks, so that a reader's memory is bounded.
    """
    d = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    ordered = d.repartitionByRange(F.col("key").asc_nulls_first()).sortWithinPartitions(F.col("key").asc_nulls_first(), "text")
    blocks = ordered.mapInArrow(_writer(tokenizer, end_id), "value binary")
    # The bytes pass through a string column unchanged.
    blocks = blocks.select(F.col("value").cast("string"))
    blocks.write.option("lineSep", "\n").option("maxRecordsPerFile", BLOCKS_PER_FILE).text(path)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"], strict=True):
            before, place = 0, 0
            # The batch's own memory, not a copy.
            for block in blocks_of(content.as_buffer()):
                ends = block.boundaries.values()
                starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
                wide = block.ids.astype("<u4")
                crcs = [zlib.crc32(wide[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                n = len(ends)
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": pa.array(block.keys, pa.int64()),
                        "path": pa.array([path.as_py()] * n, pa.string()),
                        "place": pa.array(np.arange(place, place + n)),
                        "start": pa.array(starts + before),
                        "n_tokens": pa.array(ends - starts),
                        "ids_crc32": pa.array(crcs, pa.int64()),
                    }
                )
                before, place = before + int(ends[-1]) if n else before, place + n


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row per document in the files below ``path``: ``key``, ``start`` (ids before it in all files), ``n_tokens``
    and ``ids_crc32`` (of the ids as little-endian unsigned 32-bit integers).

    The ids before a file are a running sum over one row per file, never over documents.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    schema = "key bigint, path string, place bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    rows = materialize(files.mapInArrow(_rows, schema), "token_rows")
    number = lambda mark: F.regexp_extract("path", mark, 1).cast("int")
    order = Window.orderBy(number(r"part-(\d+)-[^/]*$"), number(r"-c(\d+)[^/]*$"), "path")
    sums = rows.groupBy("path").agg(F.sum("n_tokens").alias("n"))
    sums = sums.select("path", (F.sum("n").over(order) - F.col("n")).alias("before"))
    found = rows.join(materialize(sums, "file_starts"), "path")
    return found.select("key", (F.col("before") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")


def tokenize_to_files(docs: DataFrame, tokenizer: str, path: str | None = None, **columns) -> DataFrame:
    """Write the token files below ``path`` (a scratch folder if none is given) and read them back."""
    path = path or scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer, **columns)
    return read_tokens(docs.sparkSession, path)
