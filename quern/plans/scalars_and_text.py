"""Queries over column functions, cleaned text, tokens, phrases and sentiment."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions import scalars
from quern.functions.words import CLOUD_EXTRA, ENGLISH, STOP_WORDS
from quern.operators import shape, text
from quern.plans.registry import Tables, query, sql_list

# ---- links and names

DECODED = """regexp_replace(h, '^["'']|["'']$', '', 'g')"""
for _reference, _character in scalars.REFERENCES:
    DECODED = f"replace({DECODED}, '{_reference}', '{_character.replace(chr(39), chr(39) * 2)}')"
LINKS = rf"""list_transform(regexp_extract_all(html, '(?is)<a\b[^>]*?\shref\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)', 1), lambda h: {DECODED})"""


def listed(expression: str, source: str, keep: str) -> str:
    """SQL that turns a list expression into rows with zero-based positions."""
    return f"""SELECT {keep}, i AS pos, l[i + 1] AS item FROM (SELECT *, {expression} AS l FROM {source}),
               unnest(range(len(l))) r(i)"""


@query("extract_links", f"SELECT page_id, pos, item AS href FROM ({listed(LINKS, 'pages', 'page_id')})")
def _extract_links(t: Tables):
    return scalars.extract_links(t.pages.select("page_id", "html"))


@query("match_links", "SELECT page_id, pos, item AS match FROM (" + listed("regexp_extract_all(html, 'href=\"(/[A-Za-z]+)\"', 1)", "pages", "page_id") + ")")
def _match_links(t: Tables):
    return scalars.match_links(t.pages.select("page_id", "html"), r'href="(/[A-Za-z]+)"', group=1)


@query(
    "match_links_first",
    "SELECT page_id, pos, item AS match FROM ("
    + listed("regexp_extract_all(html, 'href=\"(/[A-Za-z]+)\"', 1)", "pages", "page_id")
    + ") WHERE pos = 0",
)
def _match_links_first(t: Tables):
    return scalars.match_links(t.pages.select("page_id", "html"), r'href="(/[A-Za-z]+)"', group=1, first=True)


@query(
    "absolute_url",
    f"""SELECT page_id, pos, CASE
          WHEN item = '' THEN url
          WHEN regexp_matches(item, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN item
          WHEN item LIKE '//%' THEN regexp_extract(url, '^[a-z]+:') || item
          WHEN item LIKE '/%' THEN regexp_extract(url, '^[a-z]+://[^/?#]*') || item
          WHEN item LIKE '#%' THEN regexp_replace(url, '#.*$', '') || item
          WHEN item LIKE '?%' THEN regexp_replace(url, '[?#].*$', '') || item
          WHEN regexp_matches(regexp_replace(url, '[?#].*$', ''), '^[a-z]+://[^/]*$')
            THEN regexp_replace(url, '[?#].*$', '') || '/' || item
          ELSE regexp_extract(regexp_replace(url, '[?#].*$', ''), '^(.*/)', 1) || item END AS address
        FROM ({listed(LINKS, 'pages', 'page_id, url')})""",
)
def _absolute_url(t: Tables):
    rows = scalars.extract_links(t.pages)
    return rows.select("page_id", "pos", scalars.absolute_url("url", "href").alias("address"))


@query(
    "file_name",
    r"""SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS name,
               regexp_extract(lower(regexp_extract(url, '([^/]*)$', 1)), '[^.](\.[^.]+)$', 1) AS ext FROM pages""",
)
def _file_name(t: Tables):
    return t.pages.select("page_id", scalars.file_name("url").alias("name"), scalars.file_ext("url").alias("ext"))


@query("url_quote", "SELECT p_partkey, replace(url_encode(p_brand || '/' || p_name || '&*~'), '%2F', '/') AS quoted FROM part")
def _url_quote(t: Tables):
    path = F.concat("p_brand", F.lit("/"), "p_name", F.lit("&*~"))
    return t.part.select("p_partkey", scalars.url_quote(path).alias("quoted"))


# ---- dates, seasons and scores

MONTHS_ON = "(date_trunc('month', o_orderdate) + INTERVAL 5 MONTH)"


@query(
    "covers_to_dates",
    f"""SELECT o_orderkey,
          CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN NULL
               ELSE date_trunc('month', o_orderdate)::DATE END AS start_date,
          CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE last_day({MONTHS_ON})::DATE END AS end_date
        FROM orders""",
)
def _covers_to_dates(t: Tables):
    day, priority = F.col("o_orderdate"), F.col("o_orderpriority")
    first, second = F.date_format(day, "MMMM yyyy"), F.date_format(F.add_months(F.trunc(day, "month"), 5), "MMMM yyyy")
    covers = (
        F.when((priority == "1-URGENT") & (F.col("o_orderstatus") == "F"), F.lit("not published"))
        .when(priority == "1-URGENT", first)
        .when(priority == "2-HIGH", F.concat(first, F.lit("–"), second))
        .when(priority == "3-MEDIUM", F.concat(first, F.lit(" –\n"), F.replace(second, F.lit(" "), F.lit("\n"))))
        .otherwise(F.concat(first, F.lit(" – "), second))
    )
    dates = scalars.covers_to_dates(t.orders.select("o_orderkey", covers.alias("Covers")))
    return dates.select("o_orderkey", F.col("Start_date").alias("start_date"), F.col("End_Date").alias("end_date"))


@query(
    "format_season",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Sum ' || strftime(o_orderdate, '%y')
          WHEN 'P' THEN 'Q' || quarter(o_orderdate) || strftime(o_orderdate, '%y')
          ELSE CASE WHEN o_orderpriority = '5-LOW' THEN 'Gas Year ' || strftime(o_orderdate, '%Y')
               ELSE 'Win ' || strftime(o_orderdate, '%y') END END AS season FROM orders""",
)
def _format_season(t: Tables):
    year, status = F.date_format("o_orderdate", "yyyy"), F.col("o_orderstatus")
    after = F.date_format(F.add_months("o_orderdate", 12), "yy")
    season = (
        F.when(status == "F", F.concat(F.lit("Summer "), year))
        .when(status == "P", F.concat(F.lit("Q"), F.quarter("o_orderdate").cast("string"), F.lit(" "), year))
        .when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("Gas Year "), year))
        .otherwise(F.concat(F.lit("Winter "), year, F.lit("/"), after))
    )
    return t.orders.select("o_orderkey", scalars.format_season(season).alias("season"))


@query("previous_month_name", "SELECT o_orderkey, monthname(o_orderdate - INTERVAL 1 MONTH) AS month FROM orders")
def _previous_month_name(t: Tables):
    return t.orders.select("o_orderkey", scalars.previous_month_name("o_orderdate").alias("month"))


@query(
    "date_ordinal",
    "SELECT o_orderkey, (date_diff('day', DATE '0001-01-01', o_orderdate::DATE) + 1)::INTEGER AS day_no FROM orders",
)
def _date_ordinal(t: Tables):
    return t.orders.select("o_orderkey", scalars.date_ordinal("o_orderdate").alias("day_no"))


@query(
    "weight_midpoint_kg",
    "SELECT l_orderkey, l_linenumber, round((l_quantity + (l_quantity + 10)) / 2 * 0.453592, 6) AS kg FROM lineitem",
)
def _weight_midpoint_kg(t: Tables):
    kg = scalars.weight_midpoint_kg("l_quantity", F.col("l_quantity") + 10)
    return t.lineitem.select("l_orderkey", "l_linenumber", F.round(kg, 6).alias("kg"))


SOFTMAX = """SELECT vec_id, i AS pos, exp(v[i + 1] - list_max(v)) / list_sum(list_transform(v, lambda x: exp(x - list_max(v)))) AS p
             FROM (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE * 10) AS v FROM embeddings), unnest(range(64)) r(i)"""


@query("softmax", f"SELECT vec_id, pos, round(p, 8) AS p FROM ({SOFTMAX})")
def _softmax(t: Tables):
    scores = F.transform("embedding", lambda x: x.cast("double") * 10)
    rows = t.embeddings.select("vec_id", F.posexplode(scalars.softmax(scores)).alias("pos", "p"))
    return rows.withColumn("p", F.round("p", 8))


@query("to_base64", "SELECT p_partkey, base64(encode(p_name)) AS coded FROM part")
def _to_base64(t: Tables):
    return t.part.select("p_partkey", scalars.to_base64(F.encode("p_name", "UTF-8")).alias("coded"))


# ---- cleaned text

PLAIN = r"""lower(split_part(regexp_replace(text, '@[A-Za-z0-9]+', '', 'g'), 'https://', 1))"""


def _cleaned_sql(text_sql: str) -> str:
    steps = [
        (r"[^\p{L}\p{N}_+( )*$]", ""),
        (r"\s{2,}", " "),
        (r"@[\p{L}\p{N}_]+", ""),
        (r"[^\x00-\x7F]+", " "),
        (r"[^\p{L}\p{N}_\s]", ""),
    ]
    for pattern, value in steps:
        text_sql = f"regexp_replace({text_sql}, '{pattern}', '{value}', 'g')"
    kept = f"list_filter(string_split_regex({text_sql}, '\\s+'), lambda w: w <> '' AND w NOT IN ({sql_list(STOP_WORDS)}))"
    return f"regexp_replace(array_to_string({kept}, ' '), '[0-9]+', '', 'g')"


CLEANED = f"SELECT doc_id, lang, {_cleaned_sql(PLAIN)} AS text FROM documents"
APART = f"SELECT doc_id, {_cleaned_sql(f'''regexp_replace({PLAIN}, '[{chr(92)}t{chr(92)}n{chr(92)}r{chr(92)}f{chr(92)}v]', ' ', 'g')''')} AS text FROM documents"


@query("clean_text", CLEANED)
def _clean_text(t: Tables):
    return text.clean_text(t.texts("lang", "text"), "text")


@query("clean_text_lines_apart", APART)
def _clean_text_lines_apart(t: Tables):
    return text.clean_text(t.texts("text"), "text", glue_lines=False)


def _words_sql(source: str, words, keep: str) -> str:
    found = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"
    return f"""SELECT {keep} w AS word FROM (SELECT {keep} unnest({found}) AS w FROM {source})
               WHERE w NOT IN ({sql_list(words)})"""


@query(
    "top_words_by_language",
    f"""SELECT lang, word, n, rank FROM (SELECT lang, word, n,
          row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS rank
          FROM (SELECT lang, word, count(*) AS n FROM ({_words_sql(f'({CLEANED})', CLOUD_EXTRA, 'lang,')}) GROUP BY lang, word))
        WHERE rank <= 15""",
)
def _top_words_by_language(t: Tables):
    rows = text.clean_text(t.texts("lang", "text"), "text")
    counts = text.word_counts(rows, text.without_words(text.word_tokens("text"), CLOUD_EXTRA), ["lang"])
    return shape.top_n_per_group(counts, ["lang"], 15, "n", ["word"])


@query(
    "top_n_words",
    f"SELECT word, count(*) AS n FROM ({_words_sql('documents', ENGLISH, '')}) GROUP BY word ORDER BY n DESC, word LIMIT 15",
)
def _top_n_words(t: Tables):
    return text.top_n_words(t.texts("text"), "text")


@query(
    "word_frequencies",
    f"""SELECT lang, word, n, rank FROM (SELECT lang, word, n,
          row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS rank
          FROM (SELECT lang, word, count(*) AS n FROM ({_words_sql('documents', [*ENGLISH, *CLOUD_EXTRA], 'lang,')}) GROUP BY lang, word))
        WHERE rank <= 50""",
)
def _word_frequencies(t: Tables):
    return text.word_frequencies(t.texts("lang", "text"), "text", ["lang"], 50)


@query(
    "word_frequencies_overall",
    f"""SELECT word, count(*) AS n FROM ({_words_sql('documents', [*ENGLISH, *CLOUD_EXTRA], '')})
        GROUP BY word ORDER BY n DESC, word LIMIT 500""",
)
def _word_frequencies_overall(t: Tables):
    return text.word_frequencies(t.texts("text"), "text", n=500)


# ---- tokens and phrases

TOKENS = r"""list_filter(regexp_extract_all(strip_accents(lower(text)), '[\p{L}\p{Nl}\p{No}_]+'),
             lambda w: length(w) BETWEEN 2 AND 15 AND NOT starts_with(w, '_'))"""


@query("simple_tokens", f"SELECT doc_id, array_to_string({TOKENS}, ' ') AS tokens FROM documents")
def _simple_tokens(t: Tables):
    rows = text.simple_tokens(t.texts("text"), "text")
    return rows.select("doc_id", F.array_join("tokens", " ").alias("tokens"))


@query(
    "remove_stopwords",
    f"""SELECT doc_id, array_to_string(list_filter({TOKENS}, lambda w: w NOT IN ({sql_list(STOP_WORDS)})), ' ') AS tokens
        FROM documents""",
)
def _remove_stopwords(t: Tables):
    rows = text.simple_tokens(t.texts("text"), "text")
    return text.remove_stopwords(rows, "tokens").select("doc_id", F.array_join("tokens", " ").alias("tokens"))


# Words of the benchmark texts as a stop-word table.
@query(
    "remove_stopwords_by_table",
    f"""WITH d AS (SELECT doc_id, {TOKENS} AS l FROM documents),
             s AS (SELECT DISTINCT unnest({TOKENS}) AS w FROM benchmark),
             p AS (SELECT doc_id, i, l[i + 1] AS w FROM d, unnest(range(len(l))) r(i))
        SELECT doc_id, coalesce(k, '') AS tokens FROM d LEFT JOIN
          (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS k FROM p ANTI JOIN s USING (w) GROUP BY doc_id) USING (doc_id)""",
)
def _remove_stopwords_by_table(t: Tables):
    rows = text.simple_tokens(t.texts("text"), "text").select("doc_id", "tokens")
    listed_words = t.benchmark.select(F.explode(text.tokens_of("text")).alias("word"))
    kept = text.remove_stopwords(rows, "tokens", listed_words, "doc_id")
    return kept.select("doc_id", F.array_join("tokens", " ").alias("tokens"))


PHRASES = f"""WITH d AS (SELECT doc_id, {TOKENS} AS l FROM documents),
  p AS (SELECT doc_id, i, l[i + 1] AS a, l[i + 2] AS b FROM d, unnest(range(len(l))) r(i)),
  u AS (SELECT a AS w, count(*) AS n FROM p GROUP BY a),
  q AS (SELECT a, b, count(*) AS n FROM p WHERE b IS NOT NULL GROUP BY a, b),
  v AS (SELECT (SELECT count(*) FROM u) + (SELECT count(*) FROM q) AS size),
  f AS (SELECT q.a, q.b, q.n, x.n AS n_a, y.n AS n_b, (q.n - 1)::DOUBLE / x.n / y.n * size AS score
        FROM q JOIN u x ON x.w = q.a JOIN u y ON y.w = q.b, v WHERE (q.n - 1)::DOUBLE / x.n / y.n * size > 10)"""


@query("phrase_scores", f"{PHRASES} SELECT a, b, n, n_a, n_b, round(score, 5) AS score FROM f")
def _phrase_scores(t: Tables):
    rows = text.simple_tokens(t.texts("text"), "text")
    return text.phrase_scores(rows, "tokens").withColumn("score", F.round("score", 5))


MERGED = f"""{PHRASES},
  m AS (SELECT doc_id, i FROM p JOIN f USING (a, b)),
  g AS (SELECT doc_id, i, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS run FROM m),
  s AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, run ORDER BY i) AS k FROM g) WHERE k % 2 = 1),
  o AS (SELECT p.doc_id, p.i, CASE WHEN s.i IS NULL THEN p.a ELSE p.a || '_' || p.b END AS w
        FROM p LEFT JOIN s ON s.doc_id = p.doc_id AND s.i = p.i
        LEFT JOIN s before ON before.doc_id = p.doc_id AND before.i = p.i - 1 WHERE before.i IS NULL)
  SELECT doc_id, coalesce(string_agg(w, ' ' ORDER BY i), '') AS tokens FROM d LEFT JOIN o USING (doc_id) GROUP BY doc_id"""


def _merged(t: Tables, limit: int):
    rows = text.simple_tokens(t.texts("text"), "text").select("doc_id", "tokens")
    phrases = text.phrase_scores(rows, "tokens")
    merged = text.apply_phrases(rows, "tokens", phrases, "doc_id", limit)
    return merged.select("doc_id", F.array_join("tokens", " ").alias("tokens"))


@query("apply_phrases", MERGED)
def _apply_phrases(t: Tables):
    return _merged(t, 300_000)


@query("apply_phrases_joined", MERGED)
def _apply_phrases_joined(t: Tables):
    return _merged(t, 0)


# ---- lexicons, made from the words of the documents by their endings

TAGS = """CASE WHEN w LIKE '%tion' THEN 'NNS' WHEN w LIKE '%ent' THEN 'JJ' WHEN w LIKE '%ed' THEN 'VBD'
          WHEN w LIKE '%er' THEN 'NN' ELSE 'XX' END"""
LEMMA = "CASE WHEN w LIKE '%tion' THEN w[:-4] ELSE w END"


def _lexicon(t: Tables):
    w = F.col("word")
    tag = (
        F.when(w.endswith("tion"), "NNS").when(w.endswith("ent"), "JJ").when(w.endswith("ed"), "VBD")
        .when(w.endswith("er"), "NN").otherwise("XX")
    )
    words = t.texts("text").select(F.explode(text.tokens_of("text")).alias("word")).distinct()
    return words.select("word", F.regexp_replace(w, "tion$", "").alias("lemma"), tag.alias("tag"))


@query(
    "lexicon_filter",
    f"""WITH d AS (SELECT doc_id, {TOKENS} AS l FROM documents),
             p AS (SELECT doc_id, i, l[i + 1] AS w FROM d, unnest(range(len(l))) r(i))
        SELECT doc_id, coalesce(tokens, '') AS tokens FROM documents LEFT JOIN
          (SELECT doc_id, string_agg(regexp_replace(w, 'tion$', ''), ' ' ORDER BY i) AS tokens
           FROM p WHERE {TAGS} IN ('NN', 'NNS', 'JJ') GROUP BY doc_id) USING (doc_id)""",
)
def _lexicon_filter(t: Tables):
    rows = text.simple_tokens(t.texts("text"), "text")
    kept = text.lexicon_filter(rows, "doc_id", "tokens", _lexicon(t), ["NN", "JJ"])
    return kept.select("doc_id", F.array_join("tokens", " ").alias("tokens"))


VALENCE = """CASE WHEN w LIKE '%tion' THEN 1.5 WHEN w LIKE '%ent' THEN -1.25 WHEN w LIKE '%ed' THEN 0.5
             WHEN w LIKE '%er' THEN -0.75 END"""
SENTIMENT = f"""SELECT doc_id, round(s / sqrt(s * s + 15), 4) AS compound,
    CASE WHEN s > 0 THEN 'Positive' WHEN s < 0 THEN 'Negative' ELSE 'Neutral' END AS sentiment
  FROM (SELECT doc_id, coalesce(sum({VALENCE}), 0)::DOUBLE AS s
        FROM (SELECT doc_id, lang, unnest(CASE WHEN len({TOKENS}) = 0 THEN [''] ELSE {TOKENS} END) AS w FROM documents)
        GROUP BY doc_id)"""


def _scored(t: Tables):
    w = F.col("word")
    valence = (
        F.when(w.endswith("tion"), 1.5).when(w.endswith("ent"), -1.25).when(w.endswith("ed"), 0.5).when(w.endswith("er"), -0.75)
    )
    lexicon = _lexicon(t).select("word", valence.alias("valence")).filter(F.col("valence").isNotNull())
    return text.sentiment(t.texts("text"), "doc_id", text.tokens_of("text"), lexicon)


@query("sentiment", SENTIMENT)
def _sentiment(t: Tables):
    return _scored(t)


@query(
    "sentiment_profile",
    f"""SELECT sentiment, count(*) AS n, round(count(*) / (SELECT count(*) FROM documents), 6) AS share
        FROM ({SENTIMENT}) GROUP BY sentiment""",
)
def _sentiment_profile(t: Tables):
    return text.sentiment_profile(_scored(t)).withColumn("share", F.round("share", 6))
