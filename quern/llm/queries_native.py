"""Queries of the operators that stay inside DataFrame functions: quality rules and chat formatting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import chat_format, quality_rules
from quern.llm.registry import query, table

_OP2_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM d),
win AS (SELECT doc_id, unnest(range(1, len(words) - 6)) AS p, words FROM w WHERE len(words) >= 8),
keyed AS (SELECT doc_id, p, array_to_string(words[p:p + 7], ' ') AS k FROM win),
twice AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, k) AS c FROM keyed),
hit AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + 8)) AS q FROM twice WHERE c > 1) GROUP BY 1),
m AS (SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        (length(text) - length(replace(text, '!', '')))::BIGINT AS n_marks, len(lines)::BIGINT AS n_lines,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(hit.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN hit USING (doc_id)),
f AS (SELECT *, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
        (CASE WHEN n_words < 20 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
         + CASE WHEN n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 15 * n_words) THEN 4 ELSE 0 END
         + CASE WHEN 10 * n_symbols > n_words THEN 8 ELSE 0 END
         + CASE WHEN n_lines > 2 AND 10 * n_dup_lines > 3 * n_lines THEN 16 ELSE 0 END
         + CASE WHEN 2 * n_marks > n_words THEN 32 ELSE 0 END)::BIGINT AS failed_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, failed_bits = 0 AS kept, failed_bits FROM f
"""


@query("op2_quality_rules", _OP2_SQL)
def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Measurements, failure bits and the verdict of the newest policy for every document."""
    entries = quality_rules.ledger(table(spark, folder, "documents"))
    base = quality_rules.kept(F.col("failed_bits"), quality_rules.POLICIES["base"])
    return entries.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~base).alias("base_failed"),
        quality_rules.kept(F.col("failed_bits"), quality_rules.POLICIES["v2"]).alias("kept"),
        "failed_bits",
    )


_OP8_SQL = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
l AS (SELECT *, contains(text, '\') OR contains(text, '</turn>') OR contains(role, '\') OR contains(role, '</turn>') AS e1,
        contains(role, ':') OR starts_with(text, '### ') OR contains(text, chr(10) || '### ') OR contains(role, chr(10) || '### ') AS e2 FROM t),
r AS (SELECT *, replace(replace(text, '\', '\\'), '</turn>', '<\/turn>') AS t1, replace(replace(role, '\', '\\'), '</turn>', '<\/turn>') AS r1 FROM l),
s AS (SELECT *, CASE WHEN e2 THEN replace(replace(t1, '###', '\###'), ': ', '\: ') WHEN e1 THEN t1 ELSE text END AS tt,
        CASE WHEN e2 THEN replace(replace(r1, '###', '\###'), ': ', '\: ') WHEN e1 THEN r1 ELSE role END AS rr FROM r)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  length(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), ''))::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  (sum(length(tt) + length(rr) + 14) - 1)::BIGINT AS formatted_chars
FROM s GROUP BY conv_id
"""


@query("op8_chat_format", _OP8_SQL)
def op8_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of all conversations, read back from the formatted text, with one adversarial conversation."""
    hard = F.lit("\\### Assistant: </turn> ok")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        hard.alias("text"),
    )
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    back = chat_format.read_back(chat_format.format_chats(turns))
    loss = F.array_join("loss_texts", "")
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
