"""Queries over bags of words, topic models, regression and classification."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.common import materialize
from quern.functions.scalars import date_ordinal, scored_confidence
from quern.operators import predict, shape, text, topic_blocks, topics
from quern.plans.registry import Tables, query, sql_list
from quern.plans.scalars_and_text import TOKENS

# ---- bags of words


def _tokens(t: Tables, *keep: str) -> DataFrame:
    return text.simple_tokens(t.texts(*keep, "text"), "text").select("doc_id", *keep, "tokens")


DOCS = f"WITH d AS (SELECT doc_id, lang, {TOKENS} AS l FROM documents)"
VOCAB = f"""{DOCS}, w AS (SELECT doc_id, lang, unnest(l) AS word FROM d),
  v AS (SELECT word, df, row_number() OVER (ORDER BY df DESC, word) - 1 AS word_id
        FROM (SELECT word, count(DISTINCT doc_id) AS df FROM w GROUP BY word))"""


@query("vocabulary", f"{VOCAB} SELECT word, df, word_id FROM v")
def _vocabulary(t: Tables):
    return topics.vocabulary(_tokens(t), "tokens", "doc_id")


@query(
    "bag_of_words",
    f"{VOCAB} SELECT doc_id, word_id, count(*) AS n FROM w JOIN v USING (word) GROUP BY doc_id, word_id",
)
def _bag_of_words(t: Tables):
    rows = _tokens(t)
    return topics.bag_of_words(rows, "tokens", "doc_id", topics.vocabulary(rows, "tokens", "doc_id"))


@query(
    "topic_top_words",
    f"""{VOCAB} SELECT topic, word, n, rank FROM (SELECT lang AS topic, word, count(*) AS n,
          row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, word) AS rank FROM w GROUP BY lang, word)
        WHERE rank <= 15""",
)
def _topic_top_words(t: Tables):
    bow = topics.bag_of_words(_tokens(t), "tokens", "doc_id")
    labelled = t.documents.select("doc_id", F.col("lang").alias("topic"))
    return topics.topic_top_words(bow, labelled, "doc_id")


# ---- quality of given topics: the commonest words of each language

TOPIC_LANGS = ("de", "en", "es", "fr")


def _language_topics(t: Tables, n: int) -> dict[int, list[str]]:
    counts = text.word_counts(_tokens(t, "lang"), F.col("tokens"), ["lang"])
    best = shape.top_n_per_group(counts, ["lang"], n, "n", ["word"]).orderBy("lang", "rank").collect()
    return {i: [r["word"] for r in best if r["lang"] == lang] for i, lang in enumerate(TOPIC_LANGS)}


def _pairs_sql(n: int, window: int | None) -> str:
    """Counts of words and word pairs per topic, by listing every window."""
    span = "len(l)" if window is None else f"least(len(l), {window})"
    return f"""{VOCAB},
      top AS (SELECT list_position([{sql_list(TOPIC_LANGS)}], lang) - 1 AS topic, word, rank FROM
              (SELECT lang, word, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, word) AS rank
               FROM w GROUP BY lang, word) WHERE rank <= {n}),
      size AS (SELECT doc_id, len(l) - {span} + 1 AS windows, {span} AS span FROM d WHERE len(l) > 0),
      pos AS (SELECT doc_id, i, l[i + 1] AS word FROM d, unnest(range(len(l))) r(i)),
      hit AS (SELECT DISTINCT p.doc_id, word, s AS start FROM pos p JOIN size USING (doc_id),
              unnest(range(greatest(i - span + 1, 0), least(i, windows - 1) + 1)) u(s)
              WHERE word IN (SELECT word FROM top)),
      single AS (SELECT word, count(*) AS n FROM hit GROUP BY word),
      both_in AS (SELECT x.word AS a, y.word AS b, count(*) AS n FROM hit x JOIN hit y USING (doc_id, start)
              GROUP BY x.word, y.word),
      pair AS (SELECT x.topic, x.word AS a, y.word AS b, x.rank AS i, y.rank AS j, coalesce(both_in.n, 0) AS n
               FROM top x JOIN top y ON x.topic = y.topic
               LEFT JOIN both_in ON both_in.a = x.word AND both_in.b = y.word),
      total AS (SELECT sum(windows)::BIGINT AS n FROM size)"""


@query(
    "cooccurrence_counts",
    f"""{_pairs_sql(5, 110)} SELECT topic, a, b, n FROM pair WHERE i <= j AND n > 0
        UNION ALL SELECT -1, NULL, NULL, n FROM total""",
)
def _cooccurrence_counts(t: Tables):
    return topics.cooccurrence_counts(_tokens(t), "tokens", _language_topics(t, 5), 110)


@query("cooccurrence_counts_20")
def _cooccurrence_counts_20(t: Tables):
    return topics.cooccurrence_counts(_tokens(t), "tokens", _language_topics(t, 20), 110)


CV = f"""{_pairs_sql(5, 110)},
  p AS (SELECT pair.topic, i, j, pair.n::DOUBLE / total.n AS ab, x.n::DOUBLE / total.n AS pa, y.n::DOUBLE / total.n AS pb
        FROM pair JOIN single x ON x.word = a JOIN single y ON y.word = b, total),
  npmi AS (SELECT topic, i, j, ln((ab + 1e-12) / (pa * pb)) / -ln(ab + 1e-12) AS v FROM p),
  whole AS (SELECT topic, j, sum(v) AS v FROM npmi GROUP BY topic, j),
  cosine AS (SELECT topic, i, sum(npmi.v * whole.v) / sqrt(sum(npmi.v * npmi.v)) / sqrt(sum(whole.v * whole.v)) AS c
             FROM npmi JOIN whole USING (topic, j) GROUP BY topic, i)"""


@query("coherence_cv", f"{CV} SELECT topic, round(avg(c), 6) AS coherence FROM cosine GROUP BY topic")
def _coherence_cv(t: Tables):
    found = topics.coherence_cv(_language_topics(t, 5), _tokens(t), "tokens", 110, 5)
    return found.withColumn("coherence", F.round("coherence", 6))


@query("coherence_cv_20")
def _coherence_cv_20(t: Tables):
    found = topics.coherence_cv(_language_topics(t, 20), _tokens(t), "tokens")
    return found.withColumn("coherence", F.round("coherence", 6))


@query(
    "coherence_umass",
    f"""{_pairs_sql(10, None)} SELECT topic, round(avg(ln((pair.n::DOUBLE / total.n + 1e-12) / (single.n::DOUBLE / total.n))), 6)
        AS coherence FROM pair JOIN single ON single.word = b, total WHERE j < i GROUP BY topic""",
)
def _coherence_umass(t: Tables):
    found = topics.coherence_umass(_language_topics(t, 10), _tokens(t), "tokens", 10)
    return found.withColumn("coherence", F.round("coherence", 6))


# ---- topic models


def _vectors(t: Tables):
    rows = materialize(_tokens(t, "lang"), "tokens")
    vectors, model = topics.count_vectors(rows, "tokens")
    return rows, materialize(vectors, "vectors"), model.vocabulary


def _block_topics(t: Tables, k: int = 4, **settings) -> topic_blocks.BlockTopics:
    return topic_blocks.fit_blocks(_tokens(t), "tokens", "doc_id", k, **settings)


@query("topic_terms")
def _topic_terms(t: Tables):
    return topic_blocks.block_terms(_block_topics(t), 10)


@query("doc_topics")
def _doc_topics(t: Tables):
    return topics.dominant_topic(topic_blocks.block_mixtures(_block_topics(t), "doc_id"))


@query("log_perplexity")
def _log_perplexity(t: Tables):
    bound = topics.log_perplexity(topics.block_lda_fit(_tokens(t), "tokens", "doc_id"))
    return t.spark.createDataFrame([(4, bound)], "k int, bound double")


@query("choose_k")
def _choose_k(t: Tables):
    return topics.choose_k(_tokens(t), "tokens", key="doc_id")


@query("lda_grid")
def _lda_grid(t: Tables):
    return topics.lda_grid(_tokens(t), "tokens", ks=(2, 4), alphas=("asymmetric",), betas=("symmetric", 0.5), fractions=(0.75, 1.0))


@query("lsi_fit")
def _lsi_fit(t: Tables):
    docs, _, _, _ = topics.lsi_fit(_tokens(t), "tokens", "doc_id", 20, 40_000)
    return docs.select("doc_id", F.posexplode("mixture").alias("component", "weight"))


@query("dominant_topic")
def _dominant_topic(t: Tables):
    docs, _, _, _ = topics.lsi_fit(_tokens(t), "tokens", "doc_id", 20, 40_000)
    return topics.dominant_topic(docs).groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


@query("auto_topics")
def _auto_topics(t: Tables):
    return topic_blocks.found_topics(_tokens(t), "tokens", "doc_id")


# ---- encoding, scaling and regression


@query(
    "grid_to_rows",
    """SELECT l_linenumber AS row_key, l_returnflag AS flag, max(l_quantity) AS top FROM lineitem
       WHERE l_discount >= 0.05 AND l_linenumber::VARCHAR || l_returnflag <> '1A' GROUP BY 1, 2""",
)
def _grid_to_rows(t: Tables):
    return _grid(t.lineitem.filter("l_discount >= 0.05"))


@query(
    "grid_to_rows_all",
    """SELECT l_linenumber AS row_key, l_returnflag AS flag, max(l_quantity) AS top FROM lineitem
       WHERE l_linenumber::VARCHAR || l_returnflag <> '1A' GROUP BY 1, 2""",
)
def _grid_to_rows_all(t: Tables):
    return _grid(t.lineitem)


def _grid(rows: DataFrame) -> DataFrame:
    cells = F.when(F.concat(F.col("l_linenumber").cast("string"), "l_returnflag") != "1A", F.col("l_quantity"))
    grid = rows.groupBy(F.col("l_linenumber").alias("row_key")).pivot("l_returnflag", ["A", "N", "R"]).agg(F.max(cells))
    return predict.grid_to_rows(grid, "row_key", ["A", "N", "R"], "flag", "top")


@query("label_encode", "SELECT p_partkey, dense_rank() OVER (ORDER BY p_brand) - 1 AS code FROM part")
def _label_encode(t: Tables):
    return predict.label_encode(t.part.select("p_partkey", "p_brand"), "p_brand").select("p_partkey", "code")


SIZE_SQL = "['XS', 'S', 'M', 'L', 'XL', '2XL', '3XL', '4XL', '5XL', '6XL'][1 + p_size % 10]"
CODE_SQL = "list_position(['2XL', '3XL', '4XL', '5XL', '6XL', 'L', 'M', 'S', 'XL', 'XS'], {}) - 1"


def _size_of(t: Tables) -> DataFrame:
    names = F.array(*[F.lit(s) for s in predict.SIZES])
    return t.part.select("p_partkey", F.get(names, F.col("p_size") % 10).alias("Size"))


@query("label_encode_classes", f"SELECT p_partkey, {CODE_SQL.format(SIZE_SQL)} AS code FROM part")
def _label_encode_classes(t: Tables):
    return predict.label_encode(_size_of(t), "Size", predict.SIZES).select("p_partkey", "code")


@query(
    "standardise",
    """SELECT l_orderkey, l_linenumber, round((l_quantity - mq) / sq, 6) AS quantity, round((l_extendedprice - mp) / sp, 6) AS price
       FROM lineitem, (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq, avg(l_extendedprice) AS mp,
                       stddev_pop(l_extendedprice) AS sp FROM lineitem)""",
)
def _standardise(t: Tables):
    rows = predict.standardise(t.lineitem, ["l_quantity", "l_extendedprice"])
    return rows.select(
        "l_orderkey", "l_linenumber", F.round("l_quantity_scaled", 6).alias("quantity"), F.round("l_extendedprice_scaled", 6).alias("price")
    )


DAY = "(date_diff('day', DATE '0001-01-01', ts::DATE) + 1)"
FIT = f"""SELECT event_type, regr_slope(value, {DAY} - 737000) AS slope,
  regr_intercept(value, {DAY} - 737000) - 737000 * regr_slope(value, {DAY} - 737000) AS intercept,
  regr_r2(value, {DAY} - 737000) AS r2, count(*) AS n FROM events GROUP BY event_type"""


def _fits(t: Tables):
    return predict.linear_fit(t.events, "event_type", date_ordinal("ts"), "value")


@query("linear_fit", f"SELECT event_type, round(slope, 6) AS slope, round(intercept, 2) AS intercept, round(r2, 8) AS r2, n FROM ({FIT})")
def _linear_fit(t: Tables):
    return _fits(t).withColumns({"slope": F.round("slope", 6), "intercept": F.round("intercept", 2), "r2": F.round("r2", 8)})


@query(
    "forecast",
    f"""SELECT event_type, (last + h::INTEGER)::DATE AS day,
               round(intercept + slope * (date_diff('day', DATE '0001-01-01', (last + h::INTEGER)::DATE) + 1), 4) AS predicted
        FROM ({FIT}) JOIN (SELECT event_type, max(ts)::DATE AS last FROM events GROUP BY event_type) USING (event_type),
        range(1, 61) r(h)""",
)
def _forecast(t: Tables):
    last = t.events.groupBy("event_type").agg(F.to_date(F.max("ts")).alias("last"))
    found = predict.forecast(_fits(t), last, "event_type", "last")
    return found.withColumn("predicted", F.round("predicted", 4))


@query(
    "split_train_test",
    """SELECT o_orderkey, CASE WHEN substr(md5('42:' || o_orderkey::VARCHAR), 1, 8) < '33333333' THEN 'test' ELSE 'train' END AS part
       FROM orders""",
)
def _split_train_test(t: Tables):
    return predict.split_train_test(t.orders.select("o_orderkey"), "o_orderkey")


@query(
    "regression_metrics",
    """SELECT l_returnflag, round(avg(abs(l_extendedprice - 1500 * l_quantity)), 3) AS mae,
              round(avg((l_extendedprice - 1500 * l_quantity) ** 2) / 1e6, 6) AS mse_millions,
              round(100 * (1 - avg((l_extendedprice - 1500 * l_quantity) ** 2) / var_pop(l_extendedprice)), 6) AS r2_percent
       FROM lineitem GROUP BY l_returnflag""",
)
def _regression_metrics(t: Tables):
    rows = t.lineitem.withColumn("predicted", F.col("l_quantity") * 1500)
    found = predict.regression_metrics(rows, "l_extendedprice", "predicted", ["l_returnflag"])
    return found.select(
        "l_returnflag", F.round("mae", 3).alias("mae"), F.round(F.col("mse") / 1e6, 6).alias("mse_millions"), F.round("r2_percent", 6).alias("r2_percent")
    )


# Hold-out quality of the per-site lines: fit on one part, score on the other.
@query(
    "holdout_quality",
    f"""WITH s AS (SELECT event_type, value, {DAY} AS x, substr(md5('42:' || event_id::VARCHAR), 1, 8) < '33333333' AS test FROM events),
         m AS (SELECT event_type, regr_slope(value, x - 737000) AS a, regr_intercept(value, x - 737000) AS b FROM s WHERE NOT test GROUP BY event_type),
         p AS (SELECT event_type, value, b + a * (x - 737000) AS fitted FROM s JOIN m USING (event_type) WHERE test)
       SELECT event_type, round(avg(abs(value - fitted)), 5) AS mae, round(avg((value - fitted) ** 2), 4) AS mse,
              round(100 * (1 - avg((value - fitted) ** 2) / var_pop(value)), 5) AS r2_percent FROM p GROUP BY event_type""",
)
def _holdout_quality(t: Tables):
    rows = predict.split_train_test(t.events, "event_id")
    model = predict.linear_fit(rows.filter("part = 'train'"), "event_type", date_ordinal("ts"), "value")
    scored = rows.filter("part = 'test'").join(model, "event_type").withColumn(
        "predicted", F.col("intercept") + F.col("slope") * date_ordinal("ts")
    )
    found = predict.regression_metrics(scored, "value", "predicted", ["event_type"])
    return found.withColumns({"mae": F.round("mae", 5), "mse": F.round("mse", 4), "r2_percent": F.round("r2_percent", 5)})


@query("boosted_regression")
def _boosted_regression(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_quantity", "l_discount", "l_tax", "l_extendedprice")
    rows = materialize(predict.split_train_test(rows, "l_orderkey"), "rows")
    cols = ["l_quantity", "l_discount", "l_tax"]
    model = predict.boosted_regression(rows.filter("part = 'train'"), cols, "l_extendedprice")
    scored = model.transform(predict.features(rows.filter("part = 'test'"), cols))
    return predict.regression_metrics(scored, "l_extendedprice", "prediction")


# ---- size classes: from the weight and height of parts


def _sizes(t: Tables) -> DataFrame:
    """Parts as people: a height, a weight and the size that both give."""
    height = 165.0 + F.col("p_size") * 0.6
    weight = 60.0 + F.pmod(F.col("p_retailprice"), F.lit(97.0))
    place = F.floor((height - 165.0) / 10 + (weight - 60.0) / 33).cast("int")
    size = F.get(F.array(*[F.lit(s) for s in ("S", "M", "L", "XL", "2XL", "3XL")]), place)
    rows = t.part.select("p_partkey", height.alias("Height_cm"), weight.alias("Weight_kg"), size.alias("Size"))
    rows = predict.label_encode(rows, "Size", ["S", "M", "L", "XL", "2XL", "3XL"], "Size_encoded")
    rows = predict.standardise(rows, ["Height_cm", "Weight_kg"])
    return materialize(rows.withColumn("label", F.col("Size_encoded").cast("double")), "sizes")


SCALED = ["Height_cm_scaled", "Weight_kg_scaled"]


@query("boosted_classifier")
def _boosted_classifier(t: Tables):
    rows = predict.split_train_test(_sizes(t), "p_partkey")
    model = predict.boosted_classifier(rows.filter("part = 'train'"), SCALED, "label")
    scored = model.transform(predict.features(rows.filter("part = 'test'"), SCALED))
    return scored.groupBy("Size").agg(
        F.count(F.lit(1)).alias("n"), F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy")
    )


@query("softmax_regression")
def _softmax_regression(t: Tables):
    rows = predict.split_train_test(_sizes(t), "p_partkey")
    model = predict.softmax_regression(rows.filter("part = 'train'"), SCALED, "label")
    scored = model.transform(predict.features(rows.filter("part = 'test'"), SCALED))
    return scored.groupBy("Size").agg(
        F.count(F.lit(1)).alias("n"), F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy")
    )


@query("class_probabilities")
def _class_probabilities(t: Tables):
    rows = _sizes(t)
    model = predict.boosted_classifier(rows, SCALED, "label")
    shares = predict.class_probabilities(model, rows, SCALED)
    return scored_confidence(shares, "probability").select("p_partkey", "class_index", "confidence")


# Shares of the order status of each customer.
@query(
    "scored_confidence",
    """WITH c AS (SELECT c_custkey, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'O') AS o,
                         count(*) FILTER (o_orderstatus = 'P') AS p FROM (SELECT o_custkey AS c_custkey, o_orderstatus FROM orders) GROUP BY c_custkey)
       SELECT c_custkey, CASE greatest(f, o, p) WHEN f THEN 0 WHEN o THEN 1 ELSE 2 END AS class_index,
              round(100.0 * greatest(f, o, p) / (f + o + p), 1) AS confidence FROM c""",
)
def _scored_confidence(t: Tables):
    counts = [F.count_if(F.col("o_orderstatus") == s) for s in ("F", "O", "P")]
    rows = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.array(*[c / F.count(F.lit(1)) for c in counts]).alias("probability")
    )
    return scored_confidence(rows, "probability").drop("probability")


@query(
    "stratified_folds",
    """WITH c AS (SELECT p_type, count(*) AS n, min(p_partkey) AS first FROM part GROUP BY p_type),
         s AS (SELECT p_type, n, coalesce(sum(n) OVER (ORDER BY first ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM c),
         a AS (SELECT p_type, f, count(*) AS rows_in FROM s, unnest(range(start, start + n)) u(p), range(10) r(f)
               WHERE p % 10 = f GROUP BY p_type, f),
         e AS (SELECT p_type, f, sum(rows_in) OVER (PARTITION BY p_type ORDER BY f) AS upto, rows_in FROM a),
         k AS (SELECT p_partkey, p_type, row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) - 1 AS place FROM part)
       SELECT p_partkey, f::INTEGER AS fold FROM k JOIN e ON k.p_type = e.p_type AND place < upto AND place >= upto - rows_in""",
)
def _stratified_folds(t: Tables):
    return predict.stratified_folds(t.part.select("p_partkey", "p_type"), "p_type", ["p_partkey"], 10).select("p_partkey", "fold")


@query("cross_validate")
def _cross_validate(t: Tables):
    rows = predict.stratified_folds(_sizes(t), "Size", ["p_partkey"], 10)
    return predict.cross_validate(
        rows,
        lambda train: predict.softmax_regression(train, SCALED, "label"),
        lambda model, test: model.transform(predict.features(test, SCALED)),
        "label",
        10,
    )


@query(
    "feedback_update",
    f"""WITH r AS (SELECT p_size + 150.0 AS Height_cm, p_retailprice / 20 AS Weight_kg, {SIZE_SQL} AS Size, false AS UserProvided FROM part
          UNION ALL SELECT c_nationkey + 160.0, c_acctbal / 100, CASE c_mktsegment WHEN 'BUILDING' THEN 'XL' WHEN 'MACHINERY' THEN 'M' END, true
          FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))
        SELECT round(Height_cm, 6) AS Height_cm, round(Weight_kg, 6) AS Weight_kg, Size, UserProvided, {CODE_SQL.format('Size')} AS Size_encoded FROM r""",
)
def _feedback_update(t: Tables):
    base = _size_of(t).join(t.part, "p_partkey").select(
        (F.col("p_size") + 150.0).alias("Height_cm"), (F.col("p_retailprice") / 20).alias("Weight_kg"), "Size"
    )
    said = F.when(F.col("c_mktsegment") == "BUILDING", " xl").when(F.col("c_mktsegment") == "MACHINERY", "m").otherwise("huge")
    users = t.customer.select(
        (F.col("c_nationkey") + 160.0).alias("Height_cm"), (F.col("c_acctbal") / 100).alias("Weight_kg"), said.alias("Size")
    )
    rows = predict.feedback_update(base, users)
    return rows.withColumns({c: F.round(c, 6) for c in ("Height_cm", "Weight_kg")})
