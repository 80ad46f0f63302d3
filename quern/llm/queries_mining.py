"""Queries of the operators on conversations' structure, mixtures of sources and hard negatives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import hard_negatives, source_mix, turn_repair
from quern.llm.registry import query, table

_OP13_SQL = r"""
WITH RECURSIVE keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    flatten(list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
      lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])) AS steps FROM conversations),
fated AS (SELECT conv_id, turn, role, text, xor(list_reduce(steps, lambda c, x: CASE WHEN x >= 0 THEN xor(c, x)
    ELSE xor(c >> 1, 3988292384 * (c & 1)) END, 4294967295), 4294967295) % 20 AS fate FROM keyed),
damaged AS (SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN fate = 3 THEN [0, 1] ELSE [0] END) AS c FROM fated WHERE fate <> 0),
placed AS (SELECT *, row_number() OVER w AS p, lag(role[1]) OVER w AS before,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, c) AS seen
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, c)),
judged AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN seen > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault FROM placed),
moves(q, r, q2) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
inserted(q, q2, cost, audit) AS (VALUES (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 3, 'I'), (0, 3, 6, 'II'),
    (1, 2, 3, 'I'), (1, 3, 6, 'II'), (2, 3, 3, 'I'), (3, 2, 3, 'I')),
edits AS (SELECT conv_id, p, q, q AS q2, 4 AS cost, 'D' AS audit FROM judged, (VALUES (0), (1), (2), (3)) s(q)
  UNION ALL SELECT conv_id, p, q, q2, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END, 'K' FROM judged JOIN moves ON r = role[1] WHERE fault NOT IN ('blank', 'duplicate')
  UNION ALL SELECT conv_id, p, q, q2, CASE WHEN fault = 'truncated' THEN 6 ELSE 3 END, 'R' FROM judged, moves WHERE r <> 's' AND fault NOT IN ('blank', 'duplicate')),
best(conv_id, p, q, way) AS (
  SELECT conv_id, 0::BIGINT, q2, {'cost': cost::BIGINT, 'audit': audit} FROM (SELECT DISTINCT conv_id FROM judged), inserted WHERE q = 0
  UNION ALL
  SELECT b.conv_id, e.p, i.q2, min({'cost': b.way.cost + e.cost + i.cost, 'audit': b.way.audit || e.audit || i.audit})
  FROM best b JOIN edits e ON e.conv_id = b.conv_id AND e.p = b.p + 1 AND e.q = b.q JOIN inserted i ON i.q = e.q2 GROUP BY b.conv_id, e.p, i.q2),
chosen AS (SELECT conv_id, min(way) AS way FROM best JOIN (SELECT conv_id, max(p) AS last FROM judged GROUP BY 1) USING (conv_id)
  WHERE p = last AND q IN (0, 3) GROUP BY 1),
letters AS (SELECT conv_id, unnest(string_split(way.audit, '')) AS l, unnest(range(len(way.audit))) AS k FROM chosen WHERE way.audit <> ''),
outs AS (SELECT conv_id, l, k, sum(CASE WHEN l <> 'I' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY k) AS p,
    sum(CASE WHEN l <> 'D' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY k DESC) AS from_end FROM letters),
repaired AS (SELECT o.conv_id, string_agg(CASE WHEN l = 'K' THEN role WHEN from_end % 2 = 1 THEN 'assistant' ELSE 'user' END || ':' ||
    CASE WHEN l = 'I' THEN '' ELSE text END, chr(10) ORDER BY k) AS t FROM outs o LEFT JOIN judged j ON j.conv_id = o.conv_id AND j.p = o.p WHERE l <> 'D' GROUP BY 1),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || role[1] NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY 1)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(way.cost, 0)::BIGINT AS cost,
  coalesce(way.audit, '') AS audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts USING (conv_id) LEFT JOIN chosen USING (conv_id) LEFT JOIN repaired USING (conv_id)
"""


@query("op13_turn_repair", _OP13_SQL)
def op13_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults and cheapest repair of every conversation after a damage that is fixed by key and turn."""
    turns = table(spark, folder, "conversations")
    report, repaired = turn_repair.repair(turn_repair.damage(turns))
    found = turns.select("conv_id").distinct().alias("o")
    for part in (report, turn_repair.digests(repaired)):
        part = part.withColumnRenamed("conv_id", "_conv")
        found = found.join(part, F.col("o.conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return found.select(
        "o.conv_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


_OP12_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, text, source, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS words FROM documents),
d AS (SELECT doc_id, source, len(words)::BIGINT AS size,
    -ln((('0x' || substr(md5('{source_mix.SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 12))::BIGINT + 0.5::DOUBLE) / 281474976710656)
      / CASE WHEN len(words) = 0 THEN 1.0::DOUBLE ELSE greatest(len(list_distinct(words)) / len(words)::DOUBLE, 0.05::DOUBLE) END AS draw FROM w),
s AS (SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM d GROUP BY 1),
filled(round, source, source_size, weight, is_full, more) AS (SELECT 0, source, source_size, weight, false, true FROM s
  UNION ALL SELECT round + 1, source, source_size, weight, is_full OR above, bool_or(above) OVER () FROM (SELECT *, NOT is_full
      AND (sum(source_size) OVER () - sum(CASE WHEN is_full THEN 3 * source_size ELSE 0 END) OVER ()) * weight
        > 3 * source_size * sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER () AS above FROM filled WHERE more)),
last AS (SELECT * FROM filled WHERE round = (SELECT max(round) FROM filled)),
targets AS (SELECT source, source_size, CASE WHEN is_full THEN (3 * source_size)::DOUBLE ELSE ((sum(source_size) OVER ()
    - sum(CASE WHEN is_full THEN 3 * source_size ELSE 0 END) OVER ()) * weight)::DOUBLE
    / (sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ())::DOUBLE END AS target FROM last),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM targets),
o AS (SELECT d.doc_id, d.source, d.size, e.source_size, e.target, e.epochs, floor(e.target)::BIGINT - e.epochs * e.source_size AS rest,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.draw, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, (epochs * size + least(size, greatest(rest - ahead, 0)))::BIGINT AS taken FROM o
"""


@query("op12_source_mix", _OP12_SQL)
def op12_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    """How many words of each document a mixture of the sources by weight takes."""
    return source_mix.mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


_OP11_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""


@query("op11_hard_negatives", _OP11_SQL)
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """The hardest negatives in the score window of each positive of every anchor."""
    rows = table(spark, folder, "embeddings").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", moved))
