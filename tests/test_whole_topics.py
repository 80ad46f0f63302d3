"""Topic quality over 20 words per topic against brute force."""

import numpy as np
import pytest

from quern.operators import topics
from quern.plans import QUERIES
from quern.plans import topics_and_models as plans


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = np.random.default_rng(4)
    rows = [(i, plans.TOPIC_LANGS[i % 4], " ".join(f"w{chr(97 + k)}{chr(97 + k)}" for k in rng.zipf(1.4, 200) % 26)) for i in range(16)]
    path = tmp_path_factory.mktemp("topics")
    spark.createDataFrame(rows, "doc_id long, lang string, text string").coalesce(1).write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_twenty_words_against_brute_force(spark, folder):
    t = plans.Tables(spark, folder)
    texts = [r["tokens"] for r in plans._tokens(t).collect()]
    lists = plans._language_topics(t, 20)
    assert all(len(words) == 20 for words in lists.values())
    spans = [set(x[p : p + 110]) for x in texts for p in range(max(len(x) - 109, 1)) if x]
    want, scores = {(-1, None, None, len(spans))}, {}
    for topic, words in lists.items():
        n = np.array([[sum(a in s and b in s for s in spans) for b in words] for a in words])
        want |= {(topic, words[i], words[j], int(n[i, j])) for i in range(20) for j in range(i, 20) if n[i, j]}
        p = n / len(spans)
        v = np.log((p + topics.EPSILON) / np.outer(np.diag(p), np.diag(p))) / -np.log(p + topics.EPSILON)
        whole = v.sum(0)
        scores[topic] = float(np.mean(v @ whole / (np.linalg.norm(v, axis=1) * np.linalg.norm(whole))))
    assert {tuple(r) for r in QUERIES["cooccurrence_counts_20"](spark, folder).select("topic", "a", "b", "n").collect()} == want
    assert {r["topic"]: r["coherence"] for r in QUERIES["coherence_cv_20"](spark, folder).collect()} == pytest.approx(scores, abs=2e-6)


def test_automatic_topics_are_the_planted_ones(spark):
    """Short texts of one of three kinds, with common words among them; most found topics hold words of one kind."""
    rng = np.random.default_rng(6)
    rows = [(i, [f"t{i % 3}w{k}" if u < 0.6 else f"cw{k}" for k, u in zip(rng.integers(0, 12, 20), rng.random(20))]) for i in range(90)]
    vectors, model = topics.count_vectors(spark.createDataFrame(rows, "doc_id long, tokens array<string>").coalesce(1).cache(), "tokens")
    kinds, share = {}, {}
    for r in topics.auto_topics(vectors.cache(), model.vocabulary, "doc_id", 30).collect():
        kinds.setdefault(r["topic"], set()).update({r["word"][:2]} - {"cw"})
        share[r["topic"]] = r["share"]
    pure = [i for i, k in kinds.items() if len(k) == 1]
    assert set().union(*[kinds[i] for i in pure]) == {"t0", "t1", "t2"}
    assert sum(share[i] for i in pure) > 0.8
