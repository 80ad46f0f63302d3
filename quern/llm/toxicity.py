"""Toxicity by a classifier chain.

Categories are predicted one after another by logistic models over how often the words and word beginnings of a text occur in it.
Each model also sees the probabilities of the categories before it; while it is trained those come from models that
did not see the row (out of fold), so that it learns from probabilities as they will be in use.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.common import materialize
from quern.llm.words import plain_words

# Documented bounds of the fit: labelled rows read, and features per category (words and beginnings in at least
# MIN_TEXTS labelled texts that tell its labels apart best).
SAMPLE_ROWS = 20_000
FEATURE_WORDS = 300
FOLDS = 3
MIN_TEXTS = 2
# Lengths of word beginnings that are features beside the words, as insults are inflected.
BEGINNINGS = (5, 6, 7)
# A feature's value is log(1 + occurrences per PER_WORDS words); shorter texts than LEAST_WORDS count as so long.
PER_WORDS, LEAST_WORDS = 300, 30
# Penalty of the logistic models: the more labelled texts, the less.
PENALTY_ROWS, MOST_PENALTY = 0.75, 3e-4


@dataclass(frozen=True)
class Chain:
    """Fitted chain: ``models[i]`` predicts ``categories[i]``, None for a category with a single label value."""

    categories: tuple[str, ...]
    words: CountVectorizerModel
    own: tuple[tuple[int, ...], ...]  # places of each category's features among all
    models: tuple[LogisticRegressionModel | None, ...]
    shares: tuple[float, ...]


def _beginnings(words: Column, n: int) -> Column:
    long = F.filter(words, lambda w: F.length(w) >= n)
    return F.transform(long, lambda w: F.concat(F.lit("^"), F.substring(w, 1, n)))


def features_of(words: Column) -> Column:
    """The words and, marked by a caret, the beginnings of those that are long enough."""
    return F.concat(words, *[_beginnings(words, n) for n in BEGINNINGS])


def _with_words(texts: DataFrame, text: str) -> DataFrame:
    """Replace the text by ``_plain``, its words, and ``_length``, the number of words that rates are taken of."""
    split = texts.withColumn("_plain", plain_words(F.col(text))).drop(text)
    return split.withColumn("_length", F.greatest(F.size("_plain"), F.lit(LEAST_WORDS)).cast("double"))


def _with_features(split: DataFrame) -> DataFrame:
    return split.withColumn("_features", features_of(F.col("_plain"))).drop("_plain")


def _with_rates(df: DataFrame, words: CountVectorizerModel) -> DataFrame:
    """Replace ``_features`` by ``_bag``, the values of the chosen ones."""
    counted = words.transform(df).drop("_features")
    rate = F.transform(vector_to_array("_bag"), lambda c: F.log1p(c * PER_WORDS / F.col("_length")))
    return counted.withColumn("_bag", array_to_vector(rate)).drop("_length")


def labelled_sample(
    docs: DataFrame, labels: DataFrame, categories: Sequence[str], key: str, text: str, rows: int
) -> DataFrame:
    """Up to ``rows`` labelled texts, chosen by a hash of the key, so that every run takes the same.

    Rows without a key or with a null label are left out; of repeated keys the largest label counts.
    """
    known = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key"))
    known = known.agg(*[F.max(F.col(c).cast("double")).alias(c) for c in categories]).na.drop()
    known = materialize(known.orderBy(F.xxhash64("_key"), "_key").limit(rows), "labels")
    texts = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    # The bounded side is sent; the texts stay where they are.
    found = texts.join(F.broadcast(known), "_key")
    return _with_words(found.select("_key", "_text", *categories), "_text")


def _partial_sums(categories: Sequence[str]):
    """Per batch and feature: texts, sum and sum of squares of its values, and the sum over the texts of each category."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = np.stack([batch[c].to_numpy(zero_copy_only=False) for c in categories], axis=1)
            sums: dict[str, np.ndarray] = {}
            for at, (length, told) in enumerate(zip(batch["_length"].to_pylist(), labels, strict=True)):
                for name, count in Counter(batch["_features"][at].as_py()).items():
                    value = np.log1p(count * PER_WORDS / length)
                    row = sums.setdefault(name, np.zeros(3 + len(categories)))
                    row[:3] += 1.0, value, value * value
                    row[3:] += value * told
            if sums:
                columns = np.stack(list(sums.values()), axis=1)
                names = ["n", "s", "q", *[f"s_{k}" for k in range(len(categories))]]
                yield pa.RecordBatch.from_pydict({"word": pa.array(list(sums)), **{c: pa.array(v) for c, v in zip(names, columns, strict=True)}})

    return run


def _chosen_words(sample: DataFrame, categories: Sequence[str], per_category: int, min_texts: int) -> list[list[str]]:
    """For each category the features whose values tell the labels of a category apart best, by the squared t statistic; ties by word."""
    totals = sample.agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in categories]).first()
    names = ["n", "s", "q", *[f"s_{k}" for k in range(len(categories))]]
    sums = _with_features(sample).mapInArrow(_partial_sums(categories), ", ".join(["word string", *[f"{c} double" for c in names]]))
    counts = sums.groupBy("word").agg(*[F.sum(c).alias(c) for c in names])
    counts = materialize(counts.where(F.col("n") >= min_texts), "word_sums")
    chosen: list[list[str]] = []
    for k, c in enumerate(categories):
        n, positive = float(totals["n"] or 0), float(totals[c] or 0)
        if not 0 < positive < n:
            chosen.append([])
            continue
        gap = F.col(f"s_{k}") / positive - (F.col("s") - F.col(f"s_{k}")) / (n - positive)
        spread = F.col("q") / n - F.pow(F.col("s") / n, 2)
        # Rounded, so that the order in which sums were added cannot change the choice.
        score = F.round(gap * gap / (spread + 1e-9) / (1 / positive + 1 / (n - positive)), 6)
        best = counts.select("word", score.alias("score")).orderBy(F.desc("score"), "word").limit(per_category)
        chosen.append([r["word"] for r in best.collect()])
    return chosen


def _probability(name: str) -> Column:
    return vector_to_array("_probability")[1].alias(name)


def _inputs(df: DataFrame, own: Sequence[int], before: Sequence[str]) -> DataFrame:
    """Add the features of one model: those of its category and the probabilities of the categories before."""
    sliced = VectorSlicer(inputCol="_bag", outputCol="_own", indices=list(own)).transform(df)
    return VectorAssembler(inputCols=["_own", *before], outputCol="_inputs").transform(sliced)


def _scored(
    df: DataFrame, own: Sequence[int], before: Sequence[str], model: LogisticRegressionModel | None, share: float, out: str
) -> DataFrame:
    """Add the probability of one category under ``p_<category>``."""
    if model is None:
        return df.withColumn(out, F.lit(share))
    return model.transform(_inputs(df, own, before)).select(*df.columns, _probability(out))


def _fit(df: DataFrame, own: Sequence[int], before: Sequence[str], label: str) -> tuple[LogisticRegressionModel | None, float]:
    told = df.agg(F.avg(label).alias("share"), F.min(label).alias("low"), F.max(label).alias("high"), F.count(label).alias("n")).first()
    if told["share"] is None or told["low"] == told["high"]:
        return None, float(told["share"] or 0.0)
    learner = LogisticRegression(
        featuresCol="_inputs", labelCol=label, probabilityCol="_probability", rawPredictionCol="_raw",
        predictionCol="_prediction", regParam=min(MOST_PENALTY, PENALTY_ROWS / told["n"]), standardization=False, maxIter=60, aggregationDepth=2,
    )
    return learner.fit(_inputs(df, own, before)), float(told["share"])


def fit_chain(
    docs: DataFrame,
    labels: DataFrame,
    categories: Sequence[str],
    key: str = "doc_id",
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    feature_words: int = FEATURE_WORDS,
    folds: int = FOLDS,
    min_texts: int = MIN_TEXTS,
) -> Chain:
    """Fit one model per category, in order, on at most ``sample_rows`` labelled texts.

    ``labels`` has one 0/1 column per category. A category whose labels are all alike (or missing, as in
    empty tables) gets no model and its share as a constant probability.
    """
    sample = labelled_sample(docs, labels, categories, key, text, sample_rows)
    sample = materialize(sample.withColumn("_fold", F.pmod(F.xxhash64("_key"), F.lit(folds))), "sample")
    chosen = _chosen_words(sample, categories, feature_words, min_texts)
    names = sorted({w for words in chosen for w in words}) or [""]
    place = {w: i for i, w in enumerate(names)}
    # A category that nothing tells apart still gets one feature.
    own = tuple(tuple(place[w] for w in words) or (0,) for words in chosen)
    bag = CountVectorizerModel.from_vocabulary(names, inputCol="_features", outputCol="_bag", minTF=1.0)
    train = materialize(_with_rates(_with_features(sample), bag), "bags")
    models, shares, before = [], [], []
    for at, category in enumerate(categories):
        model, share = _fit(train, own[at], before, category)
        models.append(model)
        shares.append(share)
        if at + 1 == len(categories):
            break
        parts = []
        for fold in range(folds):
            rest, left = train.where(F.col("_fold") != fold), train.where(F.col("_fold") == fold)
            parts.append(_scored(left, own[at], before, *_fit(rest, own[at], before, category), f"p_{category}"))
        out_of_fold = parts[0]
        for part in parts[1:]:
            out_of_fold = out_of_fold.unionByName(part)
        train = materialize(out_of_fold, "out_of_fold")
        before = [*before, f"p_{category}"]
    return Chain(tuple(categories), bag, own, tuple(models), tuple(shares))


def score(docs: DataFrame, chain: Chain, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``p_<category>`` of each category, one row per row of ``docs``; whole texts, no shuffle.

    A null or empty text is scored like one without known words. Repeated rows and null keys stay rows of
    their own; other columns are not read, so their names cannot clash.
    """
    d = _with_words(docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")), "_text")
    d = _with_rates(_with_features(d), chain.words)
    before: list[str] = []
    for category, own, model, share in zip(chain.categories, chain.own, chain.models, chain.shares, strict=True):
        d = _scored(d, own, before, model, share, f"p_{category}")
        before.append(f"p_{category}")
    return d.select(F.col("_key").alias(key), *before)


def reject_toxic(
    docs: DataFrame, chain: Chain, category: str = "toxic", threshold: float = 0.5, text: str = "text"
) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose probability of ``category`` is below ``threshold``."""
    d = docs.select(F.struct(*docs.columns).alias("_doc"), F.col(text).alias("_text"))
    d = score(d, chain, "_doc", "_text").where(F.col(f"p_{category}") < threshold)
    return d.select("_doc.*")
