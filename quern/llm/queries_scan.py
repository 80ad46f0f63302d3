"""Queries of the operators that scan whole texts or pages: decontamination, archives, token files, toxicity, licences."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import decontaminate, license_scan, piece_sampling, token_files, toxicity, warc
from quern.llm.registry import query, table

_OP1_SQL = r"""
WITH lowered AS (SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
d AS (SELECT doc_id, coalesce(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM lowered),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bs AS (SELECT item_id, w, least(len(w), 10) AS n FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS k FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM bs)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS k FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, dw.n, p, item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.n = bw.n),
words_hit AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hits) GROUP BY 1),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY 1)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words_hit USING (doc_id) LEFT JOIN found USING (doc_id)
"""


@query("op1_decontaminate", _OP1_SQL)
def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Words and items hit in every document."""
    hits = decontaminate.find_hits(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return hits.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        decontaminate.words_hit(F.col("hits")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


_OP4_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS payload_digest FROM p),
r AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS leader FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> leader THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> leader THEN leader END AS refers_to
FROM r
"""


@query("op4_warc", _OP4_SQL)
def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All pages as archive records, read back through the merged capture index."""
    index = warc.capture_index(table(spark, folder, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op6_token_files")
def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Starts, lengths and checksums of all documents, read back from the token files."""
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    rows = token_files.tokenize_to_files(table(spark, folder, "documents"), tokenizer)
    return rows.withColumnRenamed("key", "doc_id")


# The tables label one toxicity category; low quality stands before it in the chain.
CATEGORIES = ("low_quality", "toxic")


def chain_labels(labels: DataFrame) -> DataFrame:
    return labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Probability of each category and the verdict for every document."""
    docs = table(spark, folder, "documents")
    chain = toxicity.fit_chain(docs, chain_labels(table(spark, folder, "labels")), CATEGORIES)
    return toxicity.score(docs, chain).withColumn("rejected", F.col("p_toxic") >= 0.5)


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_OP10_SQL = f"""
WITH known(s, i) AS (VALUES {", ".join(f"({_sql_text(s)}, {_sql_text(i)})" for s, i in license_scan.SENTENCES.items())}),
rules(name, pattern) AS (VALUES {", ".join(f"({_sql_text(n)}, {_sql_text(license_scan.rule_pattern(ids).removeprefix('(?s)'))})" for n, ids in license_scan.RULES)}),
cut AS (SELECT doc_id, string_split_regex(coalesce(text, ''), {_sql_text(license_scan.SENTENCE_END)}) AS parts, coalesce(text, '') AS text FROM documents),
each AS (SELECT doc_id, unnest(parts) AS s, unnest(range(len(parts))) AS p FROM cut),
ids AS (SELECT doc_id, string_agg(i, ',' ORDER BY p) AS line
        FROM (SELECT doc_id, p, trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g')) AS s FROM each) JOIN known USING (s) GROUP BY 1),
matched AS (SELECT DISTINCT doc_id, name FROM ids, rules WHERE regexp_matches(',' || line || ',', pattern)),
named AS (SELECT doc_id, string_agg(name, ',' ORDER BY name) AS licenses FROM matched GROUP BY 1)
SELECT doc_id, (CASE WHEN trim(text) = '' THEN 0 ELSE len(parts) END)::BIGINT AS n_sentences,
  coalesce(line, '') AS sentence_ids, coalesce(licenses, '') AS licenses
FROM cut LEFT JOIN ids USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query("op10_license_scan", _OP10_SQL)
def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Known licence sentences and recognised licences of every document, with sentences cut as in the SQL."""
    found = license_scan.scan_licenses(table(spark, folder, "documents"), sentences=license_scan.SENTENCES, lines=False)
    return found.withColumns({c: F.array_join(c, ",") for c in ("sentence_ids", "licenses")})


@query("op10_license_lines")
def op10_license_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The same with line ends as ends of sentences, which the SQL above does not know."""
    found = license_scan.scan_licenses(table(spark, folder, "documents"))
    return found.withColumns({c: F.array_join(c, ",") for c in ("sentence_ids", "licenses")})


@query("op3_piece_sampling")
def op3_piece_sampling(spark: SparkSession, folder: str) -> DataFrame:
    """A sampled segmentation of every document and whether it decodes to the text."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = piece_sampling.encode(table(spark, folder, "documents"), model, keep=("text",))
    return piece_sampling.decode(encoded, model).select(
        "doc_id",
        F.size("piece_ids").cast("long").alias("n_pieces"),
        "piece_ids",
        F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"),
    )
