"""Skewed data, the ways taken beyond a size limit, and the shape of plans."""

import json
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quern import common
from quern.operators import outbox, predict, profile, retrieve, shape, text, topics
from quern.plans.registry import Tables
from tests.conftest import DATA


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def test_row_numbers_with_a_hot_value(spark):
    rows = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("v"))
    got = common.with_row_number(rows.repartition(7), ["v", "id"], "n").toPandas().sort_values("n")
    want = rows.toPandas().sort_values(["v", "id"])
    assert got["n"].tolist() == list(range(5000)) and got["id"].tolist() == want["id"].tolist()


def test_row_numbers_of_no_rows(spark):
    assert common.with_row_number(spark.range(0), ["id"], "n").count() == 0


def test_group_row_numbers_with_null_and_hot_group(spark):
    group = F.when(F.col("id") % 3 > 0, F.when(F.col("id") % 3 == 1, "hot").otherwise(F.col("id").cast("string")))
    rows = spark.range(600).select("id", group.alias("g"))
    got = common.with_group_row_number(rows, ["g"], ["id"], "n").toPandas()
    for _, part in got.groupby("g", dropna=False):
        assert part.sort_values("id")["n"].tolist() == list(range(len(part)))


@pytest.mark.parametrize("limit", [1_000_000, 3])
def test_quantiles_with_hot_values(spark, limit):
    rng = np.random.default_rng(1)
    hot = np.where(rng.random(30_000) < 0.4, 5.0, rng.normal(size=30_000))
    frame = pd.DataFrame({"hot": hot, "spread": rng.lognormal(size=30_000), "few": rng.integers(0, 3, 30_000).astype(float)})
    rows = spark.createDataFrame(frame).repartition(6)
    probs = (0.0, 0.25, 0.5, 0.75, 0.999, 1.0)
    got = profile.exact_quantiles(rows, list(frame), probs, limit)
    for c in frame:
        for p in probs:
            assert got[c, p] == pytest.approx(float(np.quantile(frame[c], p)), abs=1e-12)


def test_quantiles_of_nothing(spark):
    rows = spark.createDataFrame([(None, float("nan")), (None, 2.0)], "a double, b double")
    got = profile.exact_quantiles(rows, ["a", "b"], (0.5,))
    assert got == {("a", 0.5): None, ("b", 0.5): 2.0}


def points(spark, n, width, seed, copies=0):
    rng = np.random.default_rng(seed)
    values = rng.normal(size=(n, width))
    values[:copies] = values[0]
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(values)], "vec_id bigint, embedding array<double>"), values


@pytest.mark.parametrize("way", ["broadcast", "blocks"])
def test_nearest_against_brute_force(spark, way, monkeypatch):
    store, s = points(spark, 300, 5, 1, copies=100)
    queries, q = points(spark, 70, 5, 2)
    monkeypatch.setattr(retrieve._by_blocks, "__defaults__", ((), 32))
    got = retrieve.nearest(store.repartition(5), queries, 4, query_id="vec_id", query_limit=4096 if way == "broadcast" else 0)
    found = {(r["query_id"], r["rank"]): (r["store_id"], r["distance"]) for r in got.collect()}
    distance = np.sqrt(((q[:, None] - s[None]) ** 2).sum(2))
    for i in range(len(q)):
        order = np.lexsort((np.arange(len(s)), distance[i]))[:4]
        for rank, j in enumerate(order, 1):
            assert found[i, rank][0] == j and found[i, rank][1] == pytest.approx(distance[i, j], abs=1e-9)


def test_nearest_approx_recall_and_hot_bucket(spark, monkeypatch):
    store, s = points(spark, 240, 6, 3, copies=80)
    monkeypatch.setattr(retrieve._by_blocks, "__defaults__", ((), 16))
    got = retrieve.nearest_approx(store, store, 3, query_id="vec_id", bucket_length=4.0).toPandas()
    exact = retrieve.nearest(store, store, 3, query_id="vec_id").toPandas()
    assert (got.groupby("query_id").size() <= 3).all() and (got["rank"] == 1).sum() == 240
    both = got.merge(exact, on=["query_id", "rank"], suffixes=("", "_exact"))
    close = np.isclose(both["distance"], both["distance_exact"])
    assert close.mean() > 0.8


def test_folds_with_a_hot_class(spark):
    labels = ["b"] * 37 + ["a"] * 5 + ["b"] * 20 + ["c"] * 11 + ["a"] * 4
    rows = spark.createDataFrame(list(enumerate(labels)), "id int, label string")
    got = predict.stratified_folds(rows, "label", ["id"], 5).toPandas().sort_values("id")["fold"].to_numpy()
    seen = list(dict.fromkeys(labels))
    codes = np.array([seen.index(x) for x in labels])
    share = np.array([np.bincount(np.sort(codes)[i::5], minlength=3) for i in range(5)])
    want = np.empty(len(codes), dtype=int)
    for k in range(3):
        want[codes == k] = np.arange(5).repeat(share[:, k])
    assert got.tolist() == want.tolist()


def brute_windows(docs, window):
    out = []
    for d in docs:
        if d:
            span = len(d) if window is None else min(window, len(d))
            out += [set(d[i : i + span]) for i in range(len(d) - span + 1)]
    return out


@pytest.mark.parametrize("window", [4, None])
def test_window_counts_against_brute_force(spark, window):
    rng = np.random.default_rng(5)
    docs = [[f"w{j}" for j in rng.integers(0, 9, n)] for n in (0, 1, 3, 4, 30, 60)]
    rows = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, t array<string>").repartition(3)
    lists = {0: ["w0", "w1", "w2"], 1: ["w2", "w7", "absent"]}
    got = {(r["topic"], r["a"], r["b"]): r["n"] for r in topics.cooccurrence_counts(rows, "t", lists, window).collect()}
    windows = brute_windows(docs, window)
    assert got.pop((-1, None, None)) == len(windows)
    want = {}
    for topic, ws in lists.items():
        for i, a in enumerate(ws):
            for b in ws[i:]:
                n = sum(a in w and b in w for w in windows)
                if n:
                    want[topic, a, b] = n
    assert got == want
    scores = topics.coherence_umass(lists, rows, "t") if window is None else topics.coherence_cv(lists, rows, "t", window)
    assert scores.count() == 2 and all(np.isfinite(r["coherence"]) for r in scores.collect())


def test_lsi_against_numpy(spark):
    rng = np.random.default_rng(2)
    docs = [[f"w{j}" for j in rng.integers(0, 12, 25)] for _ in range(40)]
    rows = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, t array<string>")
    mixtures, values, terms, words = topics.lsi_fit(rows, "t", "i", 3)
    counts = np.array([[d.count(w) for w in words] for d in docs], dtype=float)
    assert values == pytest.approx(np.linalg.svd(counts)[1][:3].tolist(), rel=1e-6)
    got = np.array([r["mixture"] for r in mixtures.orderBy("i").collect()])
    assert np.abs(got - counts @ terms).max() < 1e-9


def test_topic_model_shares(spark):
    docs = [["a", "b", "c"] * 5, ["x", "y", "z"] * 5] * 20
    rows = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, t array<string>")
    vectors, model = topics.count_vectors(rows, "t")
    lda = topics.lda_fit(vectors, 2, max_iter=30, sample=0.5)
    shares = topics.doc_topics(lda, vectors, "i").collect()
    assert all(abs(sum(r["mixture"]) - 1) < 1e-6 for r in shares)
    terms = topics.topic_terms(lda, model.vocabulary, 3)
    assert {frozenset(r["w"]) for r in terms.groupBy("topic").agg(F.collect_set("word").alias("w")).collect()} == {
        frozenset("abc"), frozenset("xyz"),
    }
    assert topics.log_perplexity(lda, vectors) < 0
    kept = topics.auto_topics(vectors, model.vocabulary, "i", t_max=6, min_share=0.2, max_iter=20, sample=0.5)
    assert 1 <= kept.select("topic").distinct().count() <= 5


def test_classifiers_beat_the_majority(spark):
    rng = np.random.default_rng(0)
    labels = rng.integers(0, 3, 300)
    rows = spark.createDataFrame([(float(k + rng.normal() / 5), float(-k + rng.normal() / 5), float(k)) for k in labels], "x double, y double, label double")
    for model in (predict.softmax_regression(rows, ["x", "y"], "label", 50), predict.boosted_classifier(rows, ["x", "y"], "label", 3, 0.3, 4)):
        scored = predict.class_probabilities(model, rows, ["x", "y"])
        assert scored.agg(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0] > 0.9
        assert scored.filter(F.abs(F.aggregate("probability", F.lit(0.0), lambda a, p: a + p) - 1) > 1e-6).count() == 0


def test_best_k_takes_the_first(spark):
    scores = spark.createDataFrame([(1, 0.5), (2, 0.75), (3, 0.75)], "k int, accuracy double")
    assert predict.best_k(scores) == 2


def test_slices_agree_near_and_far(spark):
    rows = spark.range(12_000).select((F.col("id") * 7919 % 12_000).alias("v"))
    near = [r["v"] for r in shape.slice_rows(rows, ["v"], 45, 50).orderBy("v").collect()]
    far = [r["v"] for r in shape.slice_rows(rows, ["v"], 11_000, 11_003).orderBy("v").collect()]
    assert near == [45, 46, 47, 48, 49] and far == [11_000, 11_001, 11_002]


def test_filters_and_columns_reach_the_scan(spark):
    t = Tables(spark, DATA)
    found = plan(profile.category_counts(t.lineitem.filter("l_discount > 0.05"), "l_returnflag"))
    assert "PushedFilters: [IsNotNull(l_discount), GreaterThan(l_discount,0.05)]" in found
    assert "ReadSchema: struct<l_discount:double,l_returnflag:string>" in found


def test_no_query_plans_a_cartesian_product(spark):
    t = Tables(spark, DATA)
    frames = [
        profile.zscore_outliers(t.events, "value"),
        profile.top_value_share(t.events, "user_id"),
        predict.standardise(t.lineitem, ["l_quantity"]),
        text.top_n_words(t.documents, "text"),
        predict.linear_fit(t.events, "event_type", F.dayofyear("ts"), "value"),
    ]
    for df in frames:
        assert "CartesianProduct" not in plan(df) and "NestedLoop" not in plan(df)


def test_top_n_is_limited_before_the_shuffle(spark):
    df = shape.top_n_per_group(Tables(spark, DATA).customer, ["c_mktsegment"], 3, "c_acctbal", ["c_custkey"])
    assert plan(df).count("WindowGroupLimit") >= 2


def test_a_large_side_is_not_broadcast(spark):
    assert common.fits(spark.range(10), 10) and not common.fits(spark.range(11), 10)
    assert "broadcast" not in plan(common.broadcast_if_small(spark.range(11), 10)).lower()


def test_the_cluster_folder_is_used():
    def session(master, named):
        context = SimpleNamespace(master=master, applicationId="app")
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: named))

    assert common.shared_dir(session("yarn", "hdfs://name/shared/")) == "hdfs://name/shared"
    with pytest.raises(ValueError):
        common.shared_dir(session("yarn", None))


def test_tokens_are_computed_once(spark):
    rows = text.simple_tokens(Tables(spark, DATA).documents.select("doc_id", "text"), "text")
    for df in (topics.bag_of_words(rows, "tokens", "doc_id"), text.word_counts(rows, F.col("tokens"))):
        physical = df._jdf.queryExecution().executedPlan().toString()
        assert "Filter isnotnull(word" in physical and "size(" not in physical


def test_a_hot_message_becomes_numbered_messages(spark):
    rows = spark.range(95).select((F.col("id") % 2 * 0 + 1).alias("message_id"), "id").union(spark.createDataFrame([(2, 0)]))
    files = outbox.table_attachment(rows, "message_id", ["id"], "t", rows_per_file=10)
    requests = spark.createDataFrame(
        [(i, "ann", "s", "Text", "b", ["x@example.com"]) for i in (1, 2, 3)],
        "message_id bigint, sender string, subject string, content_type string, body string, to_list array<string>",
    )
    groups = spark.createDataFrame([(1, "G")], "group_id int, display_name string")
    members = spark.createDataFrame([(1, "ann")], "group_id int, user string")
    sent = outbox.outbox(requests, groups, members, "G", files, files_per_message=4).collect()
    names = {}
    for r in sent:
        found = json.loads(r["payload"])["message"].get("attachments", [])
        names[r["message_id"], r["message_no"]] = [a["name"] for a in found]
    assert {k: len(v) for k, v in names.items()} == {(1, 0): 4, (1, 1): 4, (1, 2): 2, (2, 0): 1, (3, 0): 0}
    assert names[1, 0][:2] == ["t_1.csv", "t_1_2.csv"] and len({n for v in names.values() for n in v}) == 11


def test_the_edge_of_the_nearest_keeps_enough():
    """At least ``k`` columns lie below it, equal, infinite and missing numbers included; a few more may."""
    rng = np.random.default_rng(8)
    rough = rng.random((50, 1000))
    rough[1], rough[2, 5:], rough[3, 100:] = 0.5, np.inf, np.nan
    for k in (1, 3, 20):
        edge = retrieve._edges(rough, k)
        assert not np.isnan(edge).any()
        for row, e in zip(rough, edge):
            assert np.sort(row)[k - 1] <= e or np.isnan(np.sort(row)[k - 1])
        assert (rough[4:] <= edge[4:, None]).sum(1).max() <= 8 * k
    few = rough[4:, :100]
    assert retrieve._edges(few, 3).tolist() == np.sort(few, axis=1)[:, 2].tolist()


def test_closest_in_wide_blocks_against_brute_force():
    rng = np.random.default_rng(9)
    s = rng.normal(size=(900, 4))
    s[300:340] = s[7]
    ids, folds = rng.permutation(900), rng.integers(0, 3, 900)
    left, right, dist = retrieve._closest(ids, s, ids, s, 4, folds, folds)
    for i in range(900):
        d = np.where(folds == folds[i], np.inf, np.sqrt(((s - s[i]) ** 2).sum(1)))
        order = np.lexsort((ids, d))[:4]
        mine = left == ids[i]
        assert right[mine].tolist() == ids[order].tolist() and dist[mine] == pytest.approx(d[order])


@pytest.mark.parametrize("most", [1 << 29, 64])
def test_pairs_that_are_no_phrases_stay_out_of_the_join(spark, monkeypatch, most):
    """Every phrase passes, however small the table of bits; other pairs mostly do not."""
    monkeypatch.setattr(text, "MOST_BITS", most)
    phrases = spark.createDataFrame([(f"a{i}", f"b{i}") for i in range(500)], "a string, b string")
    pairs = spark.createDataFrame([(f"a{i}", f"b{j}") for i in range(500) for j in (i, i + 1)], "a string, b string")
    kept = {tuple(r) for r in pairs.filter(text._maybe(phrases, ["a", "b"])).collect()}
    assert kept >= {(f"a{i}", f"b{i}") for i in range(500)}
    assert most == 64 or len(kept) < 600
    rows = spark.createDataFrame([(i, [f"a{i}", f"b{i}", f"a{i}", f"b{i + 1}", None]) for i in range(500)], "k int, t array<string>")
    got = {r["k"]: r["t"] for r in text.apply_phrases(rows, "t", phrases, "k", 0).collect()}
    assert got == {i: [f"a{i}_b{i}", f"a{i}", f"b{i + 1}", None] for i in range(500)}
