"""Counts, chunks and vectors of texts: large vocabularies, repeated keys, and what a task holds at once."""

from collections import Counter

import numpy as np
import pytest
from pyspark.ml.feature import CountVectorizerModel
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.sql import SparkSession

from quern.operators import retrieve, topics

SCHEMA = "doc_id long, tokens array<string>"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_words_reach_the_jvm_as_one_string(spark, monkeypatch):
    """Odd words too; one call per word took half a minute for 260,000 words, and as long to read them back."""
    monkeypatch.setattr(CountVectorizerModel, "_new_java_array", None)
    odd = ["a", "a", "a", "", "", "\x00\n", "b\\n", "'é\U0001f600", None]
    vectors, model = topics.count_vectors(spark.createDataFrame([(1, odd), (2, None), (3, ["b\\n"])], SCHEMA), "tokens")
    monkeypatch.setattr(CountVectorizerModel, "vocabulary", None)
    words = model.vocabulary
    assert words[:1] == ["a"] and sorted(words) == sorted({w for w in odd if w is not None})
    got = {r["doc_id"]: r["features"].toArray() for r in vectors.collect()}
    assert {w: n for w, n in zip(words, got[1])} == Counter(w for w in odd if w is not None)
    assert not got[2].any() and got[3].sum() == 1 and got[3][words.index("b\\n")] == 1


def test_terms_of_a_model_send_out_no_vocabulary(spark, monkeypatch):
    rows = [(i, [f"w{i * 40 + j}" for j in range(40)]) for i in range(40)]
    vectors, model = topics.count_vectors(spark.createDataFrame(rows, SCHEMA), "tokens")
    fit = topics.lda_fit(vectors, 3, max_iter=1)
    sizes, create = [], SparkSession.createDataFrame

    def seen(self, data, *args, **kwargs):
        sizes.append(len(data))
        return create(self, data, *args, **kwargs)

    monkeypatch.setattr(SparkSession, "createDataFrame", seen)
    got = topics.topic_terms(fit, model.vocabulary, 5).collect()
    assert sizes == [15]
    matrix = fit.topicsMatrix().toArray()
    matrix = matrix / matrix.sum(0)
    for topic in range(3):
        found = sorted((r["rank"], r["weight"], r["word"]) for r in got if r["topic"] == topic)
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5]
        assert [w for _, w, _ in found] == pytest.approx(sorted(matrix[:, topic])[::-1][:5])
        assert all(matrix[model.vocabulary.index(word), topic] == pytest.approx(w) for _, w, word in found)


@pytest.mark.parametrize("at_once", [1000, 2])
def test_bags_shuffle_no_words_of_single_keys(spark, monkeypatch, at_once):
    monkeypatch.setattr(topics, "COUNTED_TEXTS", at_once)
    rows = [(1, ["b", "a", "b", None]), (2, []), (3, None), (4, ["", "a"]), (5, ["b"]), (6, ["c", "c", "c"])]
    bags = topics.bag_of_words(spark.createDataFrame(rows, SCHEMA).coalesce(1), "tokens", "doc_id")
    assert "Exchange" not in plan(bags)
    rows += [(4, ["a", "d"]), (None, ["a"]), (None, ["a", "b"])]
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    want = Counter((k, w) for k, ws in rows for w in ws or [] if w is not None)
    bags = topics.bag_of_words(df, "tokens", "doc_id")
    assert {(r["doc_id"], r["word"]): r["n"] for r in bags.collect()} == want and bags.count() == len(want)
    vocab = topics.vocabulary(df, "tokens", "doc_id")
    ids = {r["word"]: r["word_id"] for r in vocab.collect()}
    got = topics.bag_of_words(df, "tokens", "doc_id", vocab).collect()
    assert {(r["doc_id"], r["word_id"]): r["n"] for r in got} == {(k, ids[w]): n for (k, w), n in want.items()}


def test_chunks_leave_a_task_a_few_texts_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(retrieve, "CHUNKED_TEXTS", 3)
    rows = [(i, "x", None if i % 5 == 0 else " ".join(f"word{j}" for j in range(i * 9))) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string").coalesce(1)
    got = retrieve.chunk_overlap(df, "text", 60, 10)
    assert "Generate" not in plan(got)
    assert got.dtypes == [("doc_id", "bigint"), ("lang", "string"), ("chunk_no", "int"), ("chunk", "string")]
    want = [(i, "x", n, c) for i, _, t in rows if t for n, c in enumerate(retrieve.split_text(t, 60, 10))]
    assert [tuple(r) for r in got.orderBy("doc_id", "chunk_no").collect()] == want


def test_projection_reads_vectors_from_memory_and_tokens_in_arrow(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, [f"w{k}" for k in rng.zipf(1.5, 12) % 30]) for i in range(60)] + [(60, None), (61, []), (62, ["rare", None, "w1"])]
    held, compute = [], RowMatrix.computeSVD

    def seen(self, *args, **kwargs):
        held.append(spark.sparkContext._jsc.getPersistentRDDs().size())
        return compute(self, *args, **kwargs)

    monkeypatch.setattr(RowMatrix, "computeSVD", seen)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    docs, _, terms, words = topics.lsi_fit(spark.createDataFrame(rows, SCHEMA), "tokens", "doc_id", 3, 20)
    assert held == [before + 1] and "MapInPandas" not in plan(docs)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
    got = {r["doc_id"]: r["mixture"] for r in docs.collect()}
    place = {w: i for i, w in enumerate(words)}
    assert "rare" not in place and sorted(got) == list(range(63))
    for i, ws in rows:
        want = sum((terms[place[w]] for w in ws or [] if w in place), np.zeros(3))
        assert got[i] == pytest.approx(list(want))
