"""Chat formatting checked by a grammar round trip.

Grammar of one turn: ``### role: text</turn>``, turns joined by a line feed. A backslash makes the next
character literal. Each turn is rendered plainly first and reparsed; only where the recovered role or text
differs from the source is its content escaped, more and more, until both are identical.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the template.
HEAD, MID, END, JOINT, ESCAPE = "### ", ": ", "</turn>", "\n", "\\"
_HEADER = r"(?s)^### ([^\\:]*+(?:\\.[^\\:]*+)*+): (.*)$"


def _replaced(text: Column, *pairs: tuple[str, str]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


# From plain to fully escaped, for texts and for roles. A header's role ends at its first bare colon, so the last level
# leaves none in a role.
_MARKS = ((ESCAPE, "\\\\"), (END, "<\\/turn>"))
_LEVELS = ((), _MARKS, (*_MARKS, ("###", "\\###"), (MID, "\\: ")))
_ROLE_LEVELS = ((), _MARKS, (*_MARKS, ("###", "\\###"), (":", "\\:")))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _render(role: Column, text: Column, level: int) -> Column:
    role, text = _replaced(role, *_ROLE_LEVELS[level]), _replaced(text, *_LEVELS[level])
    return F.concat(F.lit(HEAD), role, F.lit(MID), text, F.lit(END))


def _parse_piece(piece: Column) -> Column:
    """Role and text of what stands before an end mark; null if it is no turn, or holds a second header."""
    role = F.regexp_extract(piece, _HEADER, 1)
    text = F.regexp_extract(piece, _HEADER, 2)
    one = piece.rlike(_HEADER) & ~piece.rlike(r"\n### ") & ~text.startswith(HEAD)
    return F.when(one, F.struct(unescape(role).alias("role"), unescape(text).alias("text"), text.alias("raw")))


def _recovers(segment: Column, role: Column, text: Column) -> Column:
    pieces = F.split(segment, END)
    back = _parse_piece(pieces[0])
    return F.coalesce(
        (F.size(pieces) == 2) & (pieces[1] == "") & (back["role"] == role) & (back["text"] == text), F.lit(False)
    )


def format_chats(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    loss_role: str = "assistant",
) -> DataFrame:
    """One row per conversation: ``conv``, ``formatted`` and ``loss_mask``.

    ``loss_mask`` has one entry per turn: ``skip`` characters without loss, then ``take`` characters with
    loss (the rendered text of a ``loss_role`` turn, else 0); what follows the last entry carries no loss.
    Null roles and texts are rendered as empty; null turn numbers come first, ties go by role and text, and
    repeated rows stay turns of their own. A null conversation id is a conversation like others; other
    columns are not read; no rows give no conversations. Escaping and checking are done turn by turn before
    the turns of a conversation, which is one output row, are put together. A turn that does not come back
    identical at the last level either raises instead of being written.
    """
    one = turns.select(
        F.col(conv).alias("_conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    levels = range(len(_LEVELS))
    one = one.withColumns({f"_s{k}": _render(F.col("role"), F.col("text"), k) for k in levels})
    level = F.raise_error(F.concat(F.lit("a turn does not come back from its escaped form: "), "role")).cast("int")
    for k in reversed(levels):
        level = F.when(_recovers(F.col(f"_s{k}"), F.col("role"), F.col("text")), F.lit(k)).otherwise(level)
    one = one.withColumn("level", level)
    segment, taken = F.col(f"_s{levels[-1]}"), F.length(_replaced(F.col("text"), *_LEVELS[-1]))
    for k in reversed(levels[:-1]):
        segment = F.when(F.col("level") == k, F.col(f"_s{k}")).otherwise(segment)
        taken = F.when(F.col("level") == k, F.length(_replaced(F.col("text"), *_LEVELS[k]))).otherwise(taken)
    one = one.select(
        "_conv",
        F.struct(
            "turn", "role", "text", segment.alias("segment"),
            F.when(F.col("role") == loss_role, taken).otherwise(0).alias("take"),
        ).alias("t"),
    )
    whole = one.groupBy("_conv").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    # Whether the turn before is under the mask; null for the first turn.
    before = F.concat(F.array(F.lit(None).cast("boolean")), F.transform("ts", lambda t: t["role"] == loss_role))
    mask = F.zip_with(
        "ts",
        before,
        lambda t, b: F.struct(
            (
                F.length(t["segment"]) - t["take"]
                # The end mark after a text under the mask is skipped by the next entry.
                - F.when(t["role"] == loss_role, F.lit(len(END))).otherwise(0)
                + F.when(b.isNotNull(), len(JOINT)).otherwise(0)
                + F.when(b, len(END)).otherwise(0)
            ).alias("skip"),
            t["take"].alias("take"),
        ),
    )
    mask = F.slice(mask, 1, F.size("ts"))
    return whole.select(
        F.col("_conv").alias(conv), F.array_join("ts.segment", JOINT).alias("formatted"), mask.alias("loss_mask")
    )


def read_back(formatted: DataFrame, text: str = "formatted", mask: str = "loss_mask") -> DataFrame:
    """Add ``turns`` (role, text) and ``loss_texts`` (unescaped), both recovered from the formatted text alone.

    ``loss_texts`` are cut by the mask, not by role. A text that breaks the grammar gets a null turn.
    """
    df = formatted.withColumn("_pieces", F.split(text, END))
    df = df.withColumn(
        "_pieces",
        F.transform(
            F.slice("_pieces", 1, F.greatest(F.size("_pieces") - 1, F.lit(0))),
            lambda p, i: F.when(i > 0, F.regexp_replace(p, r"^\n", "")).otherwise(p),
        ),
    )
    # Mask entries run from the end of one take to the end of the next; a take ends where its piece ends.
    cut = F.zip_with(
        "_pieces",
        mask,
        lambda p, m: F.when(m["take"] > 0, unescape(F.substring(p, F.length(p) - m["take"] + 1, m["take"]))),
    )
    return df.withColumns(
        {"turns": F.transform("_pieces", _parse_piece), "loss_texts": F.array_compact(cut)}
    ).drop("_pieces")
