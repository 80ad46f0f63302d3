"""WARC archives of captures, read back into a globally ordered capture index.

Archives are written by Spark's text writer, one record per line with the record separator as line end, and
read by its binary file reader, so any store that Spark reaches will do. Reading an archive gives a run of
captures that is sorted locally; runs are dealt out by ranges of (URL key, time) and each range is merged
by a loser tree, which makes the whole index globally ordered.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from urllib.parse import unquote_to_bytes

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.common import materialize, scratch_path

# Fixed values of the format.
VERSION = "WARC/1.1"
CRLF = "\r\n"
RECORD_END = CRLF + CRLF
HTTP_OK = "HTTP/1.1 200 OK"

REVISIT_BYTES = 1000
ARCHIVE_BYTES = 16 << 20
BATCH_ROWS = 2048
# Digests of repeated payloads up to this number (under 100 bytes each) are sent to the pages; beyond, pages are shuffled.
BROADCAST_ROWS = 500_000

_CAPTURE = (
    "page_id bigint, url string, url_key string, captured timestamp, record_type string, refers_to bigint, "
    "payload_bytes bigint, payload_digest string, archive string, record_offset bigint, record_bytes bigint"
)
# Order of the index. The archive and the offset make it unique.
_ORDER = ("url_key", "captured", "page_id", "archive", "record_offset")


def url_key(url: Column) -> Column:
    """Host labels in reverse order, then path and query, lower-cased: ``com,example)/path?q``.

    Scheme, leading ``www.``, port and fragment are left out; null for a null address.
    """
    host = F.regexp_replace(F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://)?([^/?#]*)", 1)), r"^www\d*\.|:\d+$", "")
    path = F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://)?[^/?#]*([^#]*)", 1))
    path = F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), path)


def _header_value(value: Column) -> Column:
    """Line breaks would end a header; they and the percent sign are percent-encoded."""
    for raw, safe in (("%", "%25"), ("\r", "%0D"), ("\n", "%0A")):
        value = F.replace(value, F.lit(raw), F.lit(safe))
    return value


def with_leaders(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """Add ``digest``, ``n_bytes`` and ``leader`` (largest id of the same payload, null below ``least`` bytes).

    The largest ids are combined before the shuffle and only digests that occur twice are joined back.
    """
    p = pages.withColumns({"digest": F.sha1("payload"), "n_bytes": F.octet_length("payload").cast("long")})
    groups = p.where(F.col("n_bytes") >= least).groupBy("digest", "n_bytes")
    shared = groups.agg(F.max("page_id").alias("leader"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    shared = materialize(shared, "leaders")
    shared = F.broadcast(shared) if shared.count() <= BROADCAST_ROWS else shared
    return p.join(shared, ["digest", "n_bytes"], "left")


def _records(p: DataFrame) -> Column:
    """The record of one capture, up to the record separator."""
    revisit = F.col("leader").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("leader"))
    http = F.concat(
        F.lit(HTTP_OK + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF + "Content-Length: "),
        F.col("n_bytes").cast("string"), F.lit(RECORD_END),
    )
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("n_bytes"))
    line = lambda name, value: F.when(value.isNull(), "").otherwise(F.concat(F.lit(name + ": "), value, F.lit(CRLF)))
    page = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    profile = F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    head = F.concat(
        F.lit(VERSION + CRLF),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", page(F.col("page_id"))),
        line("WARC-Date", F.date_format(F.to_utc_timestamp("captured", F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")),
        line("WARC-Target-URI", _header_value(F.col("url"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("WARC-Profile", profile),
        line("WARC-Refers-To", F.when(revisit, page(F.col("leader")))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", length.cast("string")),
        F.lit(CRLF),
        http,
    )
    # The bytes of the payload pass through a string column unchanged.
    return F.concat(head, F.when(revisit, "").otherwise(F.col("payload").cast("string")))


def write_archives(
    pages: DataFrame,
    path: str,
    key: str = "page_id",
    url: str = "url",
    body: str = "html",
    captured: str | None = None,
    archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """Write one record per row of ``pages`` into archives below ``path``, of about ``archive_bytes`` on average.

    Of rows with equal payloads of 1000 bytes or more the one with the largest ``key`` (an integer) is a response,
    and so is a repeated row of that key; the others are revisits that refer to it. A null body is an empty
    payload, a null address or time leaves its header out, a null key never leads. Within an archive captures
    are sorted by URL key and time. Without a ``captured`` column a capture's time is its key in seconds.
    Other columns are not read. An empty table gives archives without records.
    """
    payload = F.coalesce(F.col(body).cast("binary"), F.lit(b""))
    time = F.col(captured).cast("timestamp") if captured else F.timestamp_seconds(F.col(key))
    p = pages.select(
        F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), time.alias("captured"), payload.alias("payload")
    )
    size = p.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("payload") + 600).alias("bytes")).first()
    # Each partition writes its captures in order, into as many archives as their size asks for; pages are not shuffled.
    p = with_leaders(p).sortWithinPartitions(url_key(F.col("url")), "captured", "page_id")
    records = max(1, archive_bytes * size["n"] // size["bytes"]) if size["n"] else 1
    p.select(_records(p).alias("value")).write.option("lineSep", RECORD_END).option("maxRecordsPerFile", records).text(path)


_HEADERS = re.compile(rb"([^\r\n:]+): ?([^\r\n]*)\r\n")


def parse_archive(content: bytes) -> Iterator[dict]:
    """The records of one archive: headers by lower-cased name, offset, length, HTTP headers and payload."""
    view, at = memoryview(content), 0
    while at < len(content):
        head_end = content.index(b"\r\n\r\n", at) + 2
        if not content.startswith(VERSION.encode() + b"\r\n", at):
            raise ValueError(f"no record starts at byte {at}")
        headers = {k.lower().decode(): v for k, v in _HEADERS.findall(content, content.index(b"\r\n", at) + 2, head_end)}
        start = head_end + 2
        stop = start + int(headers["content-length"])
        http_end = content.index(b"\r\n\r\n", start, stop) + 2
        http = {k.lower().decode(): v for k, v in _HEADERS.findall(content, content.index(b"\r\n", start) + 2, http_end)}
        if content[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end at byte {stop}")
        yield {"headers": headers, "http": http, "payload": view[http_end + 2 : stop], "offset": at, "bytes": stop + 4 - at}
        at = stop + 4


def _page(value: bytes | None) -> int | None:
    number = (value or b"").removeprefix(b"<urn:page:").removesuffix(b">")
    return int(number) if number else None


def _capture(record: dict) -> dict:
    """What the index says of a record. Digest and length of a response are taken from its payload."""
    h, payload = record["headers"], record["payload"]
    kind = h["warc-type"].decode()
    digest = hashlib.sha1(payload).hexdigest()
    said = h["warc-payload-digest"].decode().removeprefix("sha1:")
    if kind == "response" and digest != said:
        raise ValueError(f"payload of the record at byte {record['offset']} does not match its digest")
    return {
        "page_id": _page(h["warc-record-id"]),
        "url": unquote_to_bytes(h["warc-target-uri"]).decode("utf-8", "replace") if "warc-target-uri" in h else None,
        "captured": h["warc-date"].decode() if "warc-date" in h else None,
        "record_type": kind,
        "refers_to": _page(h.get("warc-refers-to")),
        "payload_bytes": len(payload) if kind == "response" else int(record["http"]["content-length"]),
        "payload_digest": said,
        "record_offset": record["offset"],
        "record_bytes": record["bytes"],
    }


_READ = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("captured", pa.string()), ("record_type", pa.string()),
     ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
     ("record_offset", pa.int64()), ("record_bytes", pa.int64()), ("archive", pa.string())]
)


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"], strict=True):
            archive, rows = path.as_py().rsplit("/", 1)[-1], []
            for record in parse_archive(content.as_buffer().to_pybytes()):
                rows.append(_capture(record) | {"archive": archive})
                if len(rows) == BATCH_ROWS:
                    yield pa.RecordBatch.from_pylist(rows, _READ)
                    rows = []
            yield pa.RecordBatch.from_pylist(rows, _READ)


def read_archives(spark, path: str) -> DataFrame:
    """The captures of all archives below ``path``; the captures of one archive come in their order there."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    schema = (
        "page_id bigint, url string, captured string, record_type string, refers_to bigint, payload_bytes bigint, "
        "payload_digest string, record_offset bigint, record_bytes bigint, archive string"
    )
    read = files.mapInArrow(_read_batches, schema)
    read = read.withColumns({"captured": F.to_timestamp("captured"), "url_key": url_key(F.col("url"))})
    return read.select(*[c.split()[0] for c in _CAPTURE.split(", ")])


class LoserTree:
    """k-way merge of sorted runs. Each inner node keeps the loser of its match, so that the next row
    costs one comparison per level. Nulls sort first, as in Spark; equal keys keep the order of the runs."""

    def __init__(self, runs: Sequence[Iterator[tuple]]):
        self.runs = list(runs)
        self.heads = [next(r, None) for r in self.runs]
        self.tree = [0] * max(1, len(self.runs))
        if self.runs:
            self.tree[0] = self._play(1)

    def _less(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x[0], a) < (y[0], b)

    def _play(self, node: int) -> int:
        """Winner below ``node``; the losers stay in the nodes."""
        k = len(self.runs)
        if node >= k:
            return node - k
        a, b = self._play(2 * node), self._play(2 * node + 1)
        winner, self.tree[node] = (a, b) if self._less(a, b) else (b, a)
        return winner

    def __iter__(self) -> Iterator[tuple]:
        k = len(self.runs)
        while k and self.heads[self.tree[0]] is not None:
            winner = self.tree[0]
            yield self.heads[winner]
            self.heads[winner] = next(self.runs[winner], None)
            node = (winner + k) // 2
            while node:
                if self._less(self.tree[node], winner):
                    winner, self.tree[node] = self.tree[node], winner
                node //= 2
            self.tree[0] = winner


def _null_first(values: Sequence) -> tuple:
    return tuple((v is not None, v) if v is not None else (False,) for v in values)


def _merge_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the runs of one key range. A run whose rows arrived in several pieces is put in order first."""
    tables = [b for b in batches if b.num_rows]
    if not tables:
        return
    table = pa.Table.from_batches(tables)
    columns = [table[c].to_pylist() for c in _ORDER]
    runs: dict[str, list[tuple]] = {}
    for row, values in enumerate(zip(*columns, strict=True)):
        runs.setdefault(values[_ORDER.index("archive")], []).append((_null_first(values), row))
    for run in runs.values():
        if any(a > b for a, b in zip(run, run[1:], strict=False)):
            run.sort()
    merged = [row for _, row in LoserTree([iter(run) for _, run in sorted(runs.items())])]
    for at in range(0, len(merged), BATCH_ROWS):
        part = table.take(pa.array(merged[at : at + BATCH_ROWS]))
        yield from part.combine_chunks().to_batches()


def merge_index(captures: DataFrame, range_rows: int = 1_000_000) -> DataFrame:
    """All captures ordered by URL key, time, id, archive and offset over the partitions in turn.

    Ranges are cut inside a URL key too, so that one address with most captures is shared out; each task
    holds about ``range_rows`` index rows (no payloads).
    """
    run = materialize(captures, "runs")
    parts = max(1, -(-run.count() // range_rows))
    dealt = run.repartitionByRange(parts, *_ORDER)
    return dealt.mapInArrow(_merge_batches, dealt.schema)


def capture_index(pages: DataFrame, path: str | None = None, **columns) -> DataFrame:
    """Write ``pages`` as archives below ``path`` (a scratch folder if none is given), read them back and merge the runs."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(pages, path, **columns)
    return merge_index(read_archives(spark, path))
