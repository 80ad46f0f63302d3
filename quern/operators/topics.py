"""Bags of words, topic models and their quality."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import LDA, LDAModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.common import materialize, with_row_number
from quern.operators.shape import argmax_index, top_n_per_group
from quern.operators.text import each_token, word_counts
from quern.operators.topic_blocks import BlockTopics, Setting, fit_side_by_side, heaviest_words
from quern.operators.topic_blocks import log_perplexity as block_log_perplexity

EPSILON = 1e-12
# Mini-batches of the automatic topics: texts of one, its least share of a large table, least steps of a run, and how
# slowly early batches are forgotten.
BATCH_TEXTS, MIN_BATCH_SHARE, LEAST_STEPS, BATCH_OFFSET = 256, 0.01, 40, 10.0
# Texts per task of such a run.
TASK_TEXTS = 500
# Texts whose words are counted at once.
COUNTED_TEXTS = 1000
# Words whose pairs are counted at once, words x windows of a text that are held at once (exact in single precision), and
# the rows of such a count.
PAIRED_WORDS, WINDOW_CELLS = 3000, 4_000_000
PAIRS = "topic int, a string, b string, n bigint"


def vocabulary(df: DataFrame, tokens: str, key: str) -> DataFrame:
    """``(word, df, word_id)``: ids by falling document count, then by word."""
    words = each_token(df, F.array_distinct(tokens))
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    return with_row_number(counts, [F.desc("df"), "word"], "word_id")


def _counted(df: DataFrame, tokens: str, key: str) -> DataFrame:
    """``(key, word, n)`` of each row by itself; a task holds the pairs of ``COUNTED_TEXTS`` texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, COUNTED_TEXTS):
                keys, texts = batch.slice(start, COUNTED_TEXTS).columns
                row = np.repeat(np.arange(len(texts)), pc.list_value_length(texts).fill_null(0).to_numpy())
                words = texts.flatten().dictionary_encode("encode")
                width = max(len(words.dictionary), 1)
                pairs, n = np.unique(row * width + words.indices.to_numpy(), return_counts=True)
                at, code = np.divmod(pairs, width)
                found = [keys.take(pa.array(at)), words.dictionary.take(pa.array(code)), pa.array(n)]
                yield pa.RecordBatch.from_arrays(found, [key, "word", "n"])

    kind = df.schema[key].dataType.simpleString()
    counts = df.select(key, tokens).mapInArrow(count, f"{key} {kind}, word string, n bigint")
    return counts.filter(F.col("word").isNotNull())


def bag_of_words(df: DataFrame, tokens: str, key: str, vocab: DataFrame | None = None) -> DataFrame:
    """``(key, word_id, n)``, or ``(key, word, n)`` without a vocabulary.

    All words of a text meet in its row and are counted there, so that no words are shuffled; only the texts of a
    key with several rows have their counts added up.
    """
    several = df.groupBy(F.col(key).alias("_key")).count().filter("count > 1").select("_key")
    several = materialize(several, "keys")
    if several.isEmpty():
        counts = _counted(df, tokens, key)
    else:
        again = F.col(key).eqNullSafe(F.col("_key"))
        added = _counted(df.join(several, again, "left_semi"), tokens, key).groupBy(key, "word").agg(F.sum("n").alias("n"))
        counts = _counted(df.join(several, again, "left_anti"), tokens, key).unionByName(added)
    if vocab is None:
        return counts
    return counts.join(vocab.select("word", "word_id"), "word").select(key, "word_id", "n")


class WordVectors(CountVectorizerModel):
    """A vectoriser that goes to the JVM as one string, and whose words are not fetched back from there."""

    words: Sequence[str] = ()

    @classmethod
    def of(cls, spark: SparkSession, words: Sequence[str], tokens: str, name: str) -> WordVectors:
        used = set().union(*words)
        mark = next(c for c in map(chr, range(0x10FFFF)) if c not in used)
        cut = spark._jvm.java.util.regex.Pattern.compile(mark, spark._jvm.java.util.regex.Pattern.LITERAL)
        model = cls._create_from_java_class("org.apache.spark.ml.feature.CountVectorizerModel", cut.split(mark.join(words), -1))
        model.words = list(words)
        return model.setInputCol(tokens).setOutputCol(name)

    @property
    def vocabulary(self) -> list[str]:
        return list(self.words)


def count_vectors(
    df: DataFrame, tokens: str, max_features: int | None = None, name: str = "features"
) -> tuple[DataFrame, CountVectorizerModel]:
    """Sparse count vectors over all words by falling count, ties broken by the word; null texts have none.

    ``max_features`` keeps only the commonest. The list of words is part of the model, which the driver and
    the executors hold, so a vocabulary beyond their memory needs that bound.
    """
    df = df.withColumn(tokens, F.coalesce(tokens, F.array().cast("array<string>")))
    ranked = word_counts(df, F.col(tokens)).orderBy(F.desc("n"), "word")
    best = (ranked if max_features is None else ranked.limit(max_features)).select("word").collect()
    words = [r["word"] for r in best]
    if words:
        model = WordVectors.of(df.sparkSession, words, tokens, name)
    else:
        model = CountVectorizerModel.from_vocabulary(words, inputCol=tokens, outputCol=name)
    return model.transform(df), model


def lda_fit(
    vectors: DataFrame,
    k: int = 4,
    seed: int = 42,
    max_iter: int = 10,
    alpha: float | list[float] | None = None,
    beta: float | None = None,
    sample: float = 1.0,
    offset: float | None = None,
) -> LDAModel:
    """Variational Bayes with a fixed symmetric prior: ``max_iter`` passes over all texts.

    ``sample`` below 1 makes each step read only about that share of the texts. Steps over all texts weigh in
    from the first one on; steps over a share start with a small weight, unless ``offset`` sets it (the less, the more).
    """
    fit = LDA(
        k=k, seed=seed, maxIter=max_iter, optimizer="online", subsamplingRate=sample,
        learningOffset=offset if offset is not None else 1.0 if sample >= 1 else 1024.0,
        docConcentration=alpha if isinstance(alpha, list) else [1.0 / k if alpha is None else alpha],
        topicConcentration=1.0 / k if beta is None else beta,
        optimizeDocConcentration=False,
    )
    return fit.fit(vectors)


def topic_terms(model: LDAModel, words: Sequence[str], n: int = 10) -> DataFrame:
    """``(topic, rank, word, weight)``, topics x ``n`` rows; the vocabulary is bounded by the vectoriser."""
    # The words of all topics are matched here, by place: a table of the whole vocabulary would be sent out for every model.
    table = model.describeTopics(n)
    rows = [
        (topic, rank, words[place], weight)
        for topic, places, weights in table.collect()
        for rank, (place, weight) in enumerate(zip(places, weights), 1)
    ]
    return table.sparkSession.createDataFrame(rows, "topic int, rank int, word string, weight double")


def doc_topics(model: LDAModel, vectors: DataFrame, key: str) -> DataFrame:
    """Topic mixture of each text as an array."""
    return model.transform(vectors).select(key, vector_to_array("topicDistribution").alias("mixture"))


def block_lda_fit(
    df: DataFrame, tokens: str, key: str, k: int = 4, seed: int = 42, max_iter: int = 10,
    alpha: float | list[float] | None = None, beta: float | None = None,
) -> BlockTopics:
    """As ``lda_fit`` over all words and texts, with the word weights in a partitioned table."""
    setting = Setting(k, 1.0 / k if alpha is None else alpha, 1.0 / k if beta is None else beta)
    return fit_side_by_side(df, tokens, key, [setting], max_iter, _salt(seed))[0]


def log_perplexity(model: LDAModel | BlockTopics, vectors: DataFrame | None = None) -> float:
    """Per-word likelihood bound; negative, nearer to zero is better. A model of blocks has its own texts."""
    if isinstance(model, BlockTopics):
        return block_log_perplexity(model)
    return -model.logPerplexity(vectors)


def _topic_lists(topics: Mapping[int, Sequence[str]] | DataFrame, n: int) -> dict[int, list[str]]:
    """Top words per topic: at most topics x ``n`` words, a parameter of the model."""
    if not isinstance(topics, DataFrame):
        return {t: list(w)[:n] for t, w in topics.items()}
    out: dict[int, list[str]] = {}
    for r in topics.filter(F.col("rank") <= n).orderBy("topic", "rank").collect():
        out.setdefault(r["topic"], []).append(r["word"])
    return out


def cooccurrence_counts(
    df: DataFrame, tokens: str, topics: Mapping[int, Sequence[str]], window: int | None
) -> DataFrame:
    """``(topic, a, b, n)``: windows that hold both words, where ``a = b`` counts the word alone.

    ``window`` words slide by one; a shorter text is one window, and ``None`` takes whole texts. The
    row with topic -1 counts all windows. Tokens stay in Arrow, and a text is looked at once for the topics of all
    models. A task adds up one table of pairs over all its texts and emits it once, so neither texts nor windows are
    shuffled; topics with more than ``PAIRED_WORDS`` words between them are counted in several turns.
    """
    turns: list[list[int]] = [[]]
    met: set[str] = set()
    for topic, ws in topics.items():
        if turns[-1] and len(met | set(ws)) > PAIRED_WORDS:
            turns.append([])
            met = set()
        turns[-1].append(topic)
        met |= set(ws)
    texts = df.select(F.col(tokens).alias("tokens"))
    partial = reduce(
        DataFrame.unionByName,
        [texts.mapInArrow(_pair_counter({t: topics[t] for t in some}, window, not i), PAIRS) for i, some in enumerate(turns)],
    )
    return partial.groupBy("topic", "a", "b").agg(F.sum("n").alias("n"))


def _pair_counter(topics: Mapping[int, Sequence[str]], window: int | None, with_total: bool):
    """For ``mapInArrow``: rows of ``PAIRS`` of all texts of a task."""
    words = sorted({w for ws in topics.values() for w in ws})
    width = len(words)
    members = {t: np.array([words.index(w) for w in ws], dtype=np.int64) for t, ws in topics.items()}

    def add(together: np.ndarray, codes: np.ndarray, windows: int, span: int) -> None:
        """Windows of one text that hold both words, for each pair of those it has; ``codes`` are -1 for other words."""
        at = np.flatnonzero(codes >= 0)
        if not len(at):
            return
        found, row = np.unique(codes[at], return_inverse=True)
        first, last = np.maximum(at - span + 1, 0), np.minimum(at + 1, windows)
        some = max(1, WINDOW_CELLS // len(found))
        pairs = 0.0
        for start in range(0, windows, some):
            wide = min(some, windows - start)
            # Each place opens its word at the first window that holds it and closes it behind the last one.
            edges = np.bincount(row * (wide + 1) + np.clip(first - start, 0, wide), minlength=len(found) * (wide + 1))
            edges -= np.bincount(row * (wide + 1) + np.clip(last - start, 0, wide), minlength=len(found) * (wide + 1))
            inside = (np.cumsum(edges.reshape(len(found), wide + 1), axis=1)[:, :-1] > 0).astype(np.float32)
            pairs = pairs + (inside @ inside.T).astype(np.float64)
        together[np.ix_(found, found)] += pairs

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        together, seen = np.zeros((width, width)), 0
        for batch in batches:
            texts = batch.column(0)
            flat = texts.flatten()
            codes = pc.index_in(flat, value_set=pa.array(words, flat.type)).fill_null(-1).to_numpy()
            sizes = pc.list_value_length(texts).fill_null(0).to_numpy()
            for size, end in zip(sizes.tolist(), np.cumsum(sizes).tolist()):
                if size < 1:
                    continue
                span = size if window is None else min(window, size)
                seen += size - span + 1
                add(together, codes[end - size : end], size - span + 1, span)
        rows = [(-1, None, None, seen)] if with_total else []
        for topic, names in topics.items():
            table = together[np.ix_(members[topic], members[topic])]
            rows += [(topic, names[i], names[j], int(table[i, j])) for i, j in zip(*np.nonzero(table)) if i <= j]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.string(), pa.string(), pa.int64()))], ["topic", "a", "b", "n"]
        )

    return count


def _tables(counts: DataFrame, lists: Mapping[int, Sequence[str]]) -> tuple[int, dict[int, np.ndarray]]:
    """Count matrices per topic, a few hundred numbers each."""
    total, out = 0, {t: np.zeros((len(w), len(w))) for t, w in lists.items()}
    for r in counts.collect():
        if r["topic"] == -1:
            total = r["n"]
            continue
        i, j = lists[r["topic"]].index(r["a"]), lists[r["topic"]].index(r["b"])
        out[r["topic"]][i, j] = out[r["topic"]][j, i] = r["n"]
    return total, out


def coherence_cv(
    topics: Mapping[int, Sequence[str]] | DataFrame, df: DataFrame, tokens: str, window: int = 110, n: int = 20
) -> DataFrame:
    """``(topic, coherence)`` by c_v: boolean sliding windows, NPMI vectors, cosine with their sum."""
    lists = _topic_lists(topics, n)
    total, tables = _tables(cooccurrence_counts(df, tokens, lists, window), lists)
    rows = []
    for topic, table in tables.items():
        joint = table / max(total, 1)
        alone = np.diag(joint)
        with np.errstate(divide="ignore", invalid="ignore"):
            npmi = np.log((joint + EPSILON) / np.outer(alone, alone)) / -np.log(joint + EPSILON)
        npmi[~np.isfinite(npmi)] = 0.0
        whole = npmi.sum(0)
        size = np.linalg.norm(npmi, axis=1) * np.linalg.norm(whole)
        cosine = np.divide(npmi @ whole, size, out=np.zeros(len(size)), where=size > 0)
        rows.append((int(topic), float(cosine.mean())))
    return df.sparkSession.createDataFrame(rows, "topic int, coherence double")


def coherence_umass(
    topics: Mapping[int, Sequence[str]] | DataFrame, df: DataFrame, tokens: str, n: int = 10
) -> DataFrame:
    """``(topic, coherence)`` by u_mass: mean log((D(w_i, w_j)/N + e) / (D(w_j)/N)) over j < i."""
    lists = _topic_lists(topics, n)
    total, tables = _tables(cooccurrence_counts(df, tokens, lists, None), lists)
    rows = []
    for topic, table in tables.items():
        terms = [
            np.log((table[i, j] / total + EPSILON) / (table[j, j] / total)) if table[j, j] else 0.0
            for i in range(1, len(table))
            for j in range(i)
        ]
        rows.append((int(topic), float(np.mean(terms)) if terms else 0.0))
    return df.sparkSession.createDataFrame(rows, "topic int, coherence double")


def _mean_coherence(lists: Sequence[Sequence[Sequence[str]]], df: DataFrame, tokens: str, window: int = 110, n: int = 20) -> list[float]:
    """Mean c_v of the topics of each model; windows are counted once for the topics of all models."""
    numbered = {(i, j): words for i, model in enumerate(lists) for j, words in enumerate(model)}
    scores = coherence_cv({t: words for t, words in enumerate(numbered.values())}, df, tokens, window, n)
    found = {r["topic"]: r["coherence"] for r in scores.collect()}
    by_model: list[list[float]] = [[] for _ in lists]
    for t, (i, _) in enumerate(numbered):
        by_model[i].append(found[t])
    return [float(np.mean(x)) for x in by_model]


def choose_k(
    df: DataFrame, tokens: str, ks: Sequence[int] = range(2, 23, 2), seed: int = 42, max_iter: int = 10,
    max_features: int | None = None, n: int = 20, sample: float = 1.0, key: str | None = None,
) -> DataFrame:
    """``(k, coherence)`` of one model per ``k``; the texts are written once and read by all fits.

    Word weights stay in a partitioned table (``topic_blocks``), in which texts are dealt out by ``key`` (or their
    place); with ``max_features`` or a ``sample``, Spark's own fit runs over vectors and holds topics x words on the driver.
    """
    stored = materialize(df.select(tokens, (F.col(key) if key else F.monotonically_increasing_id()).alias("_key")), "tokens")
    if max_features is None and sample >= 1:
        settings = [Setting(k, 1.0 / k, 1.0 / k) for k in ks]
        lists = heaviest_words(fit_side_by_side(stored, tokens, "_key", settings, max_iter, _salt(seed)), n)
    else:
        vectors, words = count_vectors(stored, tokens, max_features)
        vectors = materialize(vectors, "vectors")
        models = (lda_fit(vectors, k, seed, max_iter, sample=sample) for k in ks)
        lists = [list(_topic_lists(topic_terms(m, words.vocabulary, n), n).values()) for m in models]
    rows = list(zip(ks, _mean_coherence(lists, stored, tokens, n=n)))
    return df.sparkSession.createDataFrame(rows, "k int, coherence double")


def _salt(seed: int) -> str:
    """What the choice of the texts that topics start from is mixed with: nothing for the usual seed."""
    return "" if seed == 42 else str(seed)


def prior(value: float | str, k: int) -> float | list[float]:
    """A number as it is, ``symmetric`` as 1 / k, ``asymmetric`` as shares that fall like 1 / (i + sqrt(k))."""
    if value == "symmetric":
        return 1.0 / k
    if value == "asymmetric":
        raw = [1.0 / (i + k**0.5) for i in range(k)]
        return [x / sum(raw) for x in raw]
    return float(value)


def lda_grid(
    df: DataFrame, tokens: str, ks: Sequence[int], alphas: Sequence[float | str], betas: Sequence[float | str],
    fractions: Sequence[float] = (0.75, 1.0), key: str = "doc_id", seed: int = 42, max_iter: int = 10,
    sample: float = 1.0,
) -> DataFrame:
    """``(fraction, k, alpha, beta, coherence)``; a share of the corpus is chosen by a hash of the key.

    A prior is a number, ``symmetric`` (1 / k), or for ``alphas`` also ``asymmetric`` (falling with the
    topic's number). Named priors are listed as such, so ``alpha`` and ``beta`` are strings. The models of a
    share are fitted side by side on partitioned word weights; with a ``sample``, Spark's own fit runs for each.
    """
    rows = []
    grid = [(k, alpha, beta) for k in ks for alpha in alphas for beta in betas]
    for share in fractions:
        chosen = df.filter(F.pmod(F.xxhash64(key), F.lit(1_000_000)) < int(share * 1_000_000))
        stored = materialize(chosen.select(key, tokens), "tokens")
        if sample >= 1:
            settings = [Setting(k, prior(alpha, k), prior(beta, k)) for k, alpha, beta in grid]
            lists = heaviest_words(fit_side_by_side(stored, tokens, key, settings, max_iter, _salt(seed)), 20)
        else:
            vectors, words = count_vectors(stored, tokens)
            vectors = materialize(vectors, "vectors")
            models = (lda_fit(vectors, k, seed, max_iter, prior(alpha, k), prior(beta, k), sample) for k, alpha, beta in grid)
            lists = [list(_topic_lists(topic_terms(m, words.vocabulary, 20), 20).values()) for m in models]
        means = _mean_coherence(lists, stored, tokens)
        rows += [(float(share), k, str(alpha), str(beta), mean) for (k, alpha, beta), mean in zip(grid, means)]
    return df.sparkSession.createDataFrame(
        rows, "fraction double, k int, alpha string, beta string, coherence double"
    )


def lsi_fit(df: DataFrame, tokens: str, key: str, k: int = 20, max_features: int = 40_000):
    """Truncated SVD of the count matrix: ``(doc_topic, singular values, term matrix, words)``.

    The sign of a component makes its largest term weight positive. Only the term matrix
    (at most ``max_features`` x ``k``) comes to the driver; texts are projected where they lie.
    """
    vectors, model = count_vectors(df.select(key, tokens), tokens, max_features)
    stored = materialize(vectors.select(key, tokens, "features"), "vectors")
    old = MLUtils.convertVectorColumnsFromML(stored.select("features"), "features")
    words = model.vocabulary
    matrix = RowMatrix(old)
    # Each of the hundred or so steps of the decomposition reads all rows; those that fit stay in memory as vectors.
    rows = matrix._java_matrix_wrapper._java_model.rows().cache()
    svd = matrix.computeSVD(min(k, len(words)), computeU=False)
    rows.unpersist(False)
    terms = svd.V.toArray()
    largest = np.abs(terms).argmax(axis=0)
    terms = terms * np.where(terms[largest, np.arange(terms.shape[1])] < 0, -1.0, 1.0)
    held = df.sparkSession.sparkContext.broadcast((terms, words))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Tokens stay in Arrow: as Python strings, those of one batch alone take hundreds of MB."""
        matrix, names = held.value
        for batch in batches:
            flat = batch.column(1).flatten()
            places = pc.index_in(flat, value_set=pa.array(names, flat.type)).fill_null(-1).to_numpy()
            ends = np.cumsum(pc.list_value_length(batch.column(1)).fill_null(0).to_numpy())
            sums = [matrix[x[x >= 0]].sum(0) for x in np.split(places, ends[:-1])]
            mixtures = pa.array(sums, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), mixtures], [key, "mixture"])

    kind = df.schema[key].dataType.simpleString()
    docs = stored.select(key, tokens).mapInArrow(project, f"{key} {kind}, mixture array<double>")
    return docs, list(svd.s), terms, words


def dominant_topic(df: DataFrame, mixture: str = "mixture", name: str = "topic") -> DataFrame:
    return df.withColumn(name, argmax_index(mixture))


def topic_top_words(bow: DataFrame, doc_topic: DataFrame, key: str, n: int = 15) -> DataFrame:
    """The ``n`` commonest words over the texts of each topic; a topic without texts gives no rows."""
    totals = bow.join(doc_topic.select(key, "topic"), key).groupBy("topic", "word").agg(F.sum("n").alias("n"))
    return top_n_per_group(totals, ["topic"], n, "n", ["word"])


def auto_topics(
    vectors: DataFrame, words: Sequence[str], key: str, t_max: int = 150, min_share: float = 0.01, seed: int = 42,
    max_iter: int | None = None, sample: float | None = None, passes: int = 5,
) -> DataFrame:
    """Number of topics from the data: a sparse prior over many topics, keeping those with a share.

    ``(topic, share, rank, word, weight)`` of the topics that carry at least ``min_share`` of the texts. One run takes
    mini-batches of about ``BATCH_TEXTS`` texts, so that topics are set anew many times during one pass over
    the texts, ``passes`` passes in all; small tables, of which a batch would be the whole, get ``LEAST_STEPS`` steps.
    """
    n = max(vectors.count(), 1)
    share = min(1.0, max(BATCH_TEXTS / n, MIN_BATCH_SHARE)) if sample is None else sample
    steps = max(LEAST_STEPS, round(passes / share)) if max_iter is None else max_iter
    # Every task of a step returns a matrix of topics x words, so a step has no more tasks than its texts need.
    vectors = vectors.coalesce(max(1, -(-n // TASK_TEXTS)))
    model = lda_fit(vectors, t_max, seed, steps, alpha=1.0 / t_max, beta=0.01, sample=share, offset=BATCH_OFFSET if share < 1 else 1.0)
    mixtures = doc_topics(model, vectors, key)
    shares = (
        mixtures.select(F.posexplode("mixture").alias("topic", "p"))
        .groupBy("topic")
        .agg(F.avg("p").alias("share"))
        .filter(F.col("share") >= min_share)
    )
    return shares.join(topic_terms(model, words, 10), "topic")
