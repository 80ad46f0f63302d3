"""Rows that must not get lost, and settings that must not cut the work."""

import json
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quern.operators import outbox, retrieve, text, topics
from quern.sinks import tables
from quern.sources import files
from quern.streaming import feeds

AB = "a int, b string"


@pytest.mark.parametrize(
    ("content", "want"),
    [
        ('{"a": 1},\n{"a": 2},\n{"a": 3}', [1, 2, 3]),
        ('{"a": 1}, {"a": 2}', [1, 2]),
        ('\n\t{"a": 1,\n "b": "x"}\n', [1]),
        ('\r\n [{"a": 1},\n {"a": 2}]', [1, 2]),
        ('{"data": [{"a": 4}]}', [4]),
        ('{"a": 1}\n\n{"a": 2}\n', [1, 2]),
        ('{"a": 1} {"a": 2}', None),
        ('{"a":\n1}\n{"a":\n2}', None),
        ('{"a": 1}\n[{"a": 2}]', None),
        ('{"data": [{"a": 4}]},\n{"data": [{"a": 5}]}', None),
    ],
)
def test_json_gives_every_record_or_raises(spark, tmp_path, content, want):
    (tmp_path / "f.json").write_text(content)
    read = lambda: sorted(r["a"] for r in files.read_json_any(spark, str(tmp_path), AB).collect())
    if want is None:
        with pytest.raises(Exception):
            read()
    else:
        assert read() == want


def test_csv_columns_follow_the_header(spark, tmp_path):
    (tmp_path / "x.csv").write_text("b,extra,a\none,9,1\n")
    assert [tuple(r) for r in files.read_csv(spark, str(tmp_path), AB).collect()] == [(1, "one")]
    assert [tuple(r) for r in files.read_csv(spark, str(tmp_path), "a int, c double").collect()] == [(1, None)]
    (tmp_path / "y.csv").write_text("a,b,extra\n2,two,9\n")
    with pytest.raises(Exception):
        files.read_csv(spark, str(tmp_path), AB).collect()


@pytest.mark.parametrize("limit", [10, 0])
def test_vectors_that_are_not_finite_take_no_part(spark, limit):
    nan, inf = float("nan"), float("inf")
    store = spark.createDataFrame([(1, [0.0, 0.0]), (2, [nan, 0.0]), (3, [inf, 1.0]), (4, None), (5, [3.0, 4.0]), (6, [None, 1.0])], "vec_id long, embedding array<double>")
    queries = spark.createDataFrame([(7, [0.0, 1.0]), (8, [nan, nan])], "query_id long, embedding array<double>")
    got = retrieve.nearest(store, queries, 2, query_limit=limit).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["store_id"]) for r in got] == [(7, 1), (7, 5)]


def test_texts_without_kept_words_and_null_texts_stay(spark):
    rows = spark.createDataFrame([(1, ["good", "x"]), (2, ["x"]), (3, []), (4, None)], "k int, t array<string>")
    lexicon = spark.createDataFrame([("good", "good", "JJ")], "word string, lemma string, tag string")
    got = {r["k"]: r["t"] for r in text.lexicon_filter(rows, "k", "t", lexicon, ["JJ"]).collect()}
    assert got == {1: ["good"], 2: [], 3: [], 4: []}
    phrases = spark.createDataFrame([("good", "x")], "a string, b string")
    for limit in (10, 0):
        got = {r["k"]: r["t"] for r in text.apply_phrases(rows, "t", phrases, "k", limit).collect()}
        assert got == {1: ["good_x"], 2: ["x"], 3: [], 4: []}


def test_every_word_and_text_reaches_the_models(spark):
    rows = spark.createDataFrame([(i, [f"w{i}_{j}" for j in range(300)]) for i in range(150)] + [(999, None)], "doc_id int, tokens array<string>")
    vectors, model = topics.count_vectors(rows, "tokens")
    assert len(model.vocabulary) == 45_000 and vectors.count() == 151
    fit = topics.lda_fit(vectors.limit(40), 2, max_iter=1)
    assert fit.vocabSize() == 45_000
    assert topics.LDA().getSubsamplingRate() < 1.0  # the default of the library, which is not taken
    assert len(topics.prior("asymmetric", 4)) == 4 and topics.prior("symmetric", 4) == 0.25 and topics.prior(0.3, 4) == 0.3
    projected, _, _, words = topics.lsi_fit(rows.limit(20).union(rows.where("tokens IS NULL")), "tokens", "doc_id", 3)
    assert projected.count() == 21 and len(words) == 6000


def test_newer_rows_stay_whatever_the_order_of_the_files(spark, tmp_path):
    for name, day, value in (("1", 5, "new"), ("2", 2, "old"), ("3", 6, "newest")):
        spark.createDataFrame([(1, date(2024, 1, day), value)], "k int, d date, v string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        out = feeds.landing_stream(
            spark, str(tmp_path / "in"), "quern_losses", f"t{tmp_path.name.replace('-', '_')}", str(tmp_path / "progress"),
            "k int, d date, v string", ["k"], lambda b: b, version="d", files_per_batch=1,
        )
        assert [r["v"] for r in out.collect()] == ["newest" if name == "3" else "new"]


def test_old_versions_free_their_files(spark):
    rows = spark.range(5).withColumn("v", F.lit("x"))
    tables.load_table(rows, "quern_losses", "kept")
    for i in range(5):
        tables.upsert_table(spark.range(i, i + 1).withColumn("v", F.lit("y")), "quern_losses", "kept", ["id"])
    place = spark.sql("DESCRIBE DATABASE quern_losses").where("info_name = 'Location'").first()[1].removeprefix("file:")
    found = [p for p in Path(place).iterdir() if p.name.startswith("kept__v")]
    assert len(found) == 2
    assert sorted(r["v"] for r in spark.table("quern_losses.kept").collect()) == ["y"] * 5


def test_values_are_filled_in_once_and_escaped(spark):
    df = spark.createDataFrame([("<b> {month}", date(2024, 3, 5), "u?a=1&b"), (None, date(2024, 1, 5), None)], "r string, d date, l string")
    got = [r["body"] for r in outbox.render_body(df, "r", "d", "l", template="{report}|{month}|{link}").collect()]
    assert got == ["&lt;b&gt; {month}|February|u?a=1&amp;b", "|December|"]


def test_missing_files_are_skipped(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x\n1\n")
    got = outbox.file_attachments(spark, [str(tmp_path / "a.csv"), str(tmp_path / "missing.pdf")]).collect()
    assert [r["attachment"]["name"] for r in got] == ["a.csv"]
    assert outbox.file_attachments(spark, str(tmp_path / "nothing")).count() == 0


def test_messages_take_several_tables_and_files(spark, tmp_path):
    requests = spark.createDataFrame(
        [(1, "ann", "s", "HTML", "b", ["x"]), (2, "ann", "s", "Markdown", "b", ["x"]), (3, "bob", "s", "Text", "b", ["x"])],
        "message_id int, sender string, subject string, content_type string, body string, to_list array<string>",
    )
    groups = spark.createDataFrame([(7, "G")], "group_id int, display_name string")
    members = spark.createDataFrame([(7, "ann")], "group_id int, user string")
    rows = spark.createDataFrame([(1, 5), (1, 6)], "message_id int, v int")
    both = outbox.table_attachment(rows, "message_id", ["v"], "first").unionByName(outbox.table_attachment(rows, "message_id", ["v"], "second"))
    (tmp_path / "z.pdf").write_bytes(b"%PDF")
    filed = outbox.file_attachments(spark, str(tmp_path)).select(F.lit(1).alias("message_id"), F.lit(0).alias("part_no"), "attachment")
    parts = both.select("message_id", "part_no", "attachment").unionByName(filed)
    users = spark.createDataFrame([("ann",)], "user string")
    sent = {r["message_id"]: r for r in outbox.outbox(requests, groups, members, "G", parts, users=users, on_unknown="mark").collect()}
    assert {k: r["state"] for k, r in sent.items()} == {1: "ready", 2: "rejected", 3: "unknown"}
    named = [a["name"] for a in json.loads(sent[1]["payload"])["message"]["attachments"]]
    assert named == ["first_1.csv", "second_1.csv", "z.pdf"]
    with pytest.raises(Exception, match="unknown sender bob"):
        outbox.outbox(requests, groups, members, "G", users=users).collect()
