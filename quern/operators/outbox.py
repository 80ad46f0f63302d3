"""Report messages up to an outbox table; nothing is sent."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.common import materialize, with_group_row_number
from quern.functions.scalars import file_ext, previous_month_name

# Media types of attachments and the type tag of a file attachment.
MEDIA_TYPES = {
    ".xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    ".csv": "text/csv",
    ".pdf": "application/pdf",
}
ATTACHMENT_TAG = "#microsoft.graph.fileAttachment"

# A neutral sample; senders bring their own.
NOTICE = "<p>{report}, {month}: the figures are in.</p>\n<p><a href=\"{link}\">Open</a></p>\n"


def allowed_senders(
    messages: DataFrame,
    groups: DataFrame,
    members: DataFrame,
    group: str,
    users: DataFrame | None = None,
    sender: str = "sender",
) -> DataFrame:
    """Add ``state``: ``ready`` for members of the named group, else ``rejected``.

    The first group of that display name counts, and a missing group raises. With a table of
    ``users``, senders it does not list are ``unknown``. The lists are stored with one row per person,
    so that Catalyst broadcasts them by their measured size and the messages stay where they are.
    """
    found = groups.filter(F.col("display_name") == group).agg(F.min("group_id")).scalar()
    missing = F.raise_error(F.lit(f"no group named {group!r}"))
    wanted = F.coalesce(found, missing.cast(groups.schema["group_id"].dataType))

    def people(rows: DataFrame, mark: str) -> DataFrame:
        return materialize(rows.select(F.col("user").alias(sender)).distinct(), mark).withColumn(mark, F.lit(True))

    out = messages.join(people(members.filter(F.col("group_id") == wanted), "_in"), sender, "left")
    state = F.when(F.col("_in"), "ready").otherwise("rejected")
    if users is not None:
        out = out.join(people(users, "_known"), sender, "left")
        state = F.when(F.col("_known").isNull(), "unknown").otherwise(state)
        return out.withColumn("state", state).drop("_in", "_known")
    return out.withColumn("state", state).drop("_in")


def _recipients(addresses: Column) -> Column:
    return F.transform(
        addresses, lambda a: F.struct(F.struct(a.alias("address")).alias("emailAddress"))
    )


def _if_any(items: Column) -> Column:
    return F.when(F.size(items) > 0, items)


def build_messages(
    df: DataFrame, attachments: str | None = None, name: str = "payload", on_bad_type: str = "raise"
) -> DataFrame:
    """JSON payload from ``subject, content_type, body`` and address arrays ``to_list, cc_list, bcc_list``.

    Empty copies and attachments are left out. A content type other than Text or HTML raises, or gives a null
    payload with ``on_bad_type="null"``.
    """
    known = F.col("content_type").isin("Text", "HTML")
    raised = F.raise_error(F.lit("content type must be Text or HTML")).cast("string")
    checked = F.when(known, F.col("content_type")).otherwise(raised if on_bad_type == "raise" else F.lit(None))
    parts = [
        F.col("subject").alias("subject"),
        F.struct(checked.alias("contentType"), F.col("body").alias("content")).alias("body"),
        _recipients(F.col("to_list")).alias("toRecipients"),
    ]
    for column, field in (("cc_list", "ccRecipients"), ("bcc_list", "bccRecipients")):
        if column in df.columns:
            parts.append(_if_any(_recipients(F.col(column))).alias(field))
    if attachments is not None:
        parts.append(_if_any(F.col(attachments)).alias("attachments"))
    message = F.struct(F.struct(*parts).alias("message"), F.lit(True).alias("saveToSentItems"))
    payload = F.to_json(message)
    return df.withColumn(name, payload if on_bad_type == "raise" else F.when(known, payload))


def _attachment(name: Column, suffix: str, content: Column) -> Column:
    return F.struct(
        F.lit(ATTACHMENT_TAG).alias("@odata.type"),
        name.alias("name"),
        F.lit(MEDIA_TYPES[suffix]).alias("contentType"),
        content.alias("contentBytes"),
    )


def _csv_line(cols: Sequence[Column]) -> Column:
    """One CSV line; text with separators, quotes or line breaks is quoted."""

    def cell(c: Column) -> Column:
        text = c.cast("string")
        quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
        return F.coalesce(F.when(text.rlike('[,"\r\n]'), quoted).otherwise(text), F.lit(""))

    return F.concat_ws(",", *[cell(c) for c in cols])


def table_attachment(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    name: str,
    rows_per_file: int = 100_000,
) -> DataFrame:
    """The rows of each key as CSV attachments: ``(key, part_no, n_rows, attachment)``.

    Files are built by the executors. A key with more than ``rows_per_file`` rows gets numbered
    parts, so that no task holds more than one file.
    """
    cols = [c for c in df.columns if c != key]
    placed = with_group_row_number(df, [key], list(order), "_place").withColumn(
        "part_no", F.floor(F.col("_place") / rows_per_file).cast("int")
    )
    part = F.when(F.col("part_no") > 0, F.concat(F.lit("_"), (F.col("part_no") + 1).cast("string")))
    title = F.concat(F.lit(name + "_"), F.col(key).cast("string"), F.coalesce(part, F.lit("")), F.lit(".csv"))
    lines = placed.select(key, "part_no", "_place", _csv_line([F.col(c) for c in cols]).alias("_line"))
    body = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("_place", "_line"))), lambda s: s["_line"]), "\n"
    )
    head = F.lit(",".join(cols) + "\n")
    files = lines.groupBy(key, "part_no").agg(
        F.count(F.lit(1)).alias("n_rows"), F.encode(F.concat(head, body, F.lit("\n")), "UTF-8").alias("_bytes")
    )
    return files.select(
        key, "part_no", "n_rows", _attachment(title, ".csv", F.base64("_bytes")).alias("attachment")
    )


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark finds anything at a path of any store, without reading it."""
    try:
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def file_attachments(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Workbook, CSV and PDF files as attachments; other suffixes and paths that do not exist are skipped."""
    found = [p for p in ([path] if isinstance(path, str) else path) if _exists(spark, p)]
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = reader.load(found) if found else spark.createDataFrame([], schema)
    suffix = file_ext("path")
    media = F.create_map(*[F.lit(v) for pair in MEDIA_TYPES.items() for v in pair])
    return (
        files.filter(suffix.isin(*MEDIA_TYPES))
        .withColumn("name", F.regexp_extract("path", "([^/]+)$", 1))
        .select(
            "path",
            F.struct(
                F.lit(ATTACHMENT_TAG).alias("@odata.type"),
                F.col("name"),
                F.element_at(media, suffix).alias("contentType"),
                F.base64("content").alias("contentBytes"),
            ).alias("attachment"),
        )
    )


def _escaped(value: Column) -> Column:
    """Text for HTML; null becomes empty."""
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        value = F.replace(value, F.lit(raw), F.lit(safe))
    return F.coalesce(value, F.lit(""))


def render_body(df: DataFrame, report: str, date: str, link: str, name: str = "body", template: str = NOTICE) -> DataFrame:
    """Fill the template with the report name, the month before ``date`` and a link, each escaped for HTML.

    The template is cut at its marks once, so a value that looks like a mark stays as it is.
    """
    values = {"{report}": F.col(report), "{month}": previous_month_name(date), "{link}": F.col(link)}
    parts = re.split("(" + "|".join(map(re.escape, values)) + ")", template)
    return df.withColumn(name, F.concat(*[_escaped(values[p]) if p in values else F.lit(p) for p in parts]))


def outbox(
    requests: DataFrame,
    groups: DataFrame,
    members: DataFrame,
    group: str,
    attachments: DataFrame | None = None,
    key: str = "message_id",
    files_per_message: int = 10,
    users: DataFrame | None = None,
    on_unknown: str = "raise",
) -> DataFrame:
    """Outbox rows ``(key, message_no, sender, state, payload)``; a message that is not ready keeps no payload.

    ``attachments`` holds ``key``, ``attachment`` and ``part_no``; several tables and files of one message are
    numbered on in the order of name and part. Without ``part_no`` each row is one file. A request with more
    than ``files_per_message`` files becomes several numbered messages, so that no payload grows without bound
    and no file is left out. With a table of ``users`` an unknown sender raises, or gets the state ``unknown``
    with ``on_unknown="mark"``. A content type other than Text or HTML is ``rejected``.
    """
    files = None
    if attachments is None:
        requests = requests.withColumn("message_no", F.lit(0))
    else:
        if "part_no" not in attachments.columns:
            attachments = attachments.withColumn("part_no", F.lit(0))
        order = [F.col("_file"), F.col("part_no"), F.xxhash64("attachment")]
        # Parts of one table share the name up to their number, so the media type and name order whole files.
        named = attachments.withColumn("_file", F.regexp_replace("attachment.name", r"(_\d+)?(\.[^.]+)$", "$2"))
        placed = with_group_row_number(named, [key], order, "_place")
        listed = placed.groupBy(key, F.floor(F.col("_place") / files_per_message).cast("int").alias("_no")).agg(
            F.transform(
                F.array_sort(F.collect_list(F.struct("_place", "attachment"))), lambda s: s["attachment"]
            ).alias("files")
        )
        requests = requests.join(listed, key, "left").withColumn("message_no", F.coalesce("_no", F.lit(0)))
        files = "files"
    built = build_messages(allowed_senders(requests, groups, members, group, users), files, on_bad_type="null")
    state = F.when((F.col("state") == "ready") & F.col("payload").isNull(), "rejected").otherwise(F.col("state"))
    if users is not None and on_unknown == "raise":
        raised = F.raise_error(F.concat(F.lit("unknown sender "), F.coalesce("sender", F.lit("null")))).cast("string")
        state = F.when(F.col("state") == "unknown", raised).otherwise(state)
    built = built.withColumn("state", state)
    payload = F.when(F.col("state") == "ready", F.col("payload")).alias("payload")
    return built.select(key, "message_no", "sender", "state", payload)
