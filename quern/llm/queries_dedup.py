"""Queries of the operators that compare documents with each other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import jaccard_join, substring_dedup
from quern.llm.registry import query, table

_OP7_SQL = r"""
WITH RECURSIVE t AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 1), lambda p: array_to_string(w[p:p + 2], ' ')) END) AS g FROM t),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM c JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 90 * (p.n + q.n - k)),
deg AS (SELECT a, count(*) AS n_links FROM link GROUP BY 1),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT t.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(t.doc_id, coalesce(m.low, t.doc_id)) AS component_id, coalesce(n_links, 0)::BIGINT AS n_links
FROM t LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a, min(b) AS low FROM reach GROUP BY 1) m ON m.a = t.doc_id LEFT JOIN deg ON deg.a = t.doc_id
"""


@query("op7_jaccard_join", _OP7_SQL)
def op7_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components and numbers of links of documents whose sets of 3-word shingles are alike by 90 % or more."""
    return jaccard_join.near_duplicates(table(spark, folder, "documents"), links=True)


_OP5_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
win AS (SELECT doc_id, p, array_to_string(w[p:p + 34], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS p FROM d WHERE len(w) >= 35)),
twice AS (SELECT doc_id, p, count(*) OVER (PARTITION BY k) AS c FROM win),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 35)) AS q FROM twice WHERE c > 1),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS q FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY q) AS t FROM word ANTI JOIN gone USING (doc_id, q) GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


@query("op5_substring_dedup", _OP5_SQL)
def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document less those in repeated runs of 35 words."""
    left = substring_dedup.kept_words(table(spark, folder, "documents"))
    return left.select(
        "doc_id",
        "n_words",
        (F.col("n_words") - F.size("kept")).alias("n_removed"),
        F.sha2(F.array_join("kept", " "), 256).alias("kept_sha256"),
    )
