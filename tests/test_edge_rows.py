"""Hand-built rows for the cases that full tables may not hold."""

import datetime
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions import scalars
from quern.functions.words import EXTRA, STOP_WORDS
from quern.operators import lineage, outbox, predict, profile, retrieve, shape, text
from quern.sources import tables


def column(df):
    return [r[0] for r in df.collect()]


def test_nan_to_null(spark):
    rows = spark.createDataFrame([("abc", 1.0), ("NaN", float("nan")), ("nan", None), ("1.5", 2.0), (None, 0.0)], "s string, x double")
    assert [tuple(r) for r in shape.nan_to_null(rows).collect()] == [
        ("abc", 1.0), (None, None), (None, None), ("1.5", 2.0), (None, 0.0),
    ]


def test_coerce_truncates_and_keeps_going(spark):
    rows = spark.createDataFrame([("12.9", "2020-01-31"), ("x", "soon"), (None, None)], "n string, d string")
    got = shape.coerce(rows, {"n": "int", "d": "date"}).collect()
    assert [tuple(r) for r in got] == [(12, datetime.date(2020, 1, 31)), (None, None), (None, None)]


def test_exclude_rows_literal_and_intended(spark):
    rows = spark.createDataFrame(
        [("BU List", "A", "x"), ("0", "A", "x"), (None, "A", "x"), ("U", None, "x"), ("U", "ZQ900", "x"), ("U", "A", None), ("U", "A", "SaaS"), ("U", "A", "x")],
        "unit string, name string, owner string",
    )
    rules = {"name": ["ZQ900"], "owner": ["SaaS"]}
    assert column(shape.exclude_rows(rows, ["unit"], rules)) == ["BU List", "0", "U"]
    assert column(shape.exclude_rows(rows, ["unit"], {**rules, "unit": ["BU List", "0"]})) == ["U"]


def test_repeated_header_keeps_nulls(spark):
    rows = spark.createDataFrame([("Cost Type",), (None,), ("Rent",)], "c string")
    assert column(shape.drop_repeated_header(rows, "c", "Cost Type")) == [None, "Rent"]


def test_factorize_by_first_appearance(spark):
    rows = spark.createDataFrame([(0, "b"), (1, "a"), (2, None), (3, "b")], "i int, s string")
    assert [r["code"] for r in shape.factorize(rows, "s", "i").orderBy("i").collect()] == [0, 1, -1, 0]


def test_covers_to_dates(spark):
    rows = spark.createDataFrame(
        [("April 2023 – September 2023",), ("April 2023–September 2023",), ("April 2023 – September\n2023",), ("April 2023",), (None,)],
        "Covers string",
    )
    start, end = datetime.date(2023, 4, 1), datetime.date(2023, 9, 30)
    got = [(r["Start_date"], r["End_Date"]) for r in scalars.covers_to_dates(rows).collect()]
    assert got == [(start, end), (start, end), (start, end), (start, None), (None, None)]


def test_format_season(spark):
    rows = spark.createDataFrame([("Summer 2023",), ("Q1 2023",), ("Winter 2023/24",), ("Gas Year",)], "s string")
    assert column(rows.select(scalars.format_season("s"))) == ["Sum 23", "Q123", "Win 23", "Gas Year"]


def test_previous_month_is_clamped(spark):
    rows = spark.createDataFrame([(datetime.date(2024, 3, 31),), (datetime.date(2024, 1, 5),)], "d date")
    assert column(rows.select(scalars.previous_month_name("d"))) == ["February", "December"]


def test_date_ordinal(spark):
    rows = spark.createDataFrame([(datetime.date(2019, 5, 23),), (datetime.date(1, 1, 1),)], "d date")
    assert column(rows.select(scalars.date_ordinal("d"))) == [737202, 1]


def test_absolute_url(spark):
    base = "https://a.example.com/x/y/z.html?q=1#f"
    hrefs = ["http://b.org/p", "//c.org/p", "/media/f.pdf", "g.pdf", "?n=2", "#top", "mailto:team@example.com", ""]
    rows = spark.createDataFrame([(base, h) for h in hrefs], "b string, h string")
    assert column(rows.select(scalars.absolute_url("b", "h"))) == [
        "http://b.org/p", "https://c.org/p", "https://a.example.com/media/f.pdf", "https://a.example.com/x/y/g.pdf",
        "https://a.example.com/x/y/z.html?n=2", "https://a.example.com/x/y/z.html?q=1#top", "mailto:team@example.com", base,
    ]
    dots = ["../g.pdf", "./g.pdf", "../../../g", "a/./b/../c?x=../y", "..", "/m/../n/.", "http://b.org/a/../c#d"]
    rows = spark.createDataFrame([(base, h) for h in dots], "b string, h string")
    from urllib.parse import urljoin

    assert column(rows.select(scalars.absolute_url("b", "h"))) == [urljoin(base, h) for h in dots[:-1]] + ["http://b.org/c#d"]
    bare = spark.createDataFrame([("https://a.example.com", "g.pdf")], "b string, h string")
    assert column(bare.select(scalars.absolute_url("b", "h"))) == ["https://a.example.com/g.pdf"]


def test_links_of_all_quote_forms(spark):
    page = """<a href="/a?x=1&amp;y=2">1</a><A class='c' HREF = '/b'>2</A><a href=/c>3</a><a\nhref="">4</a><p href="/no">"""
    rows = spark.createDataFrame([(page,)], "html string")
    assert [r["href"] for r in scalars.extract_links(rows).collect()] == ["/a?x=1&y=2", "/b", "/c", ""]


def test_file_ext(spark):
    rows = spark.createDataFrame([("/a/b.tar.GZ",), ("/a.b/c",), (".hidden",)], "p string")
    assert column(rows.select(scalars.file_ext("p"))) == [".gz", "", ""]


def test_url_quote(spark):
    rows = spark.createDataFrame([("Shared Docs/a&b (1)~é*.xlsx",)], "p string")
    from urllib.parse import quote

    assert column(rows.select(scalars.url_quote("p"))) == [quote("Shared Docs/a&b (1)~é*.xlsx")]


def test_rows_to_frame_pads_and_cuts(spark):
    rows = spark.createDataFrame([(["a"],), (["a", "b", "c"],)], "cells array<string>")
    assert [tuple(r) for r in tables.rows_to_frame(rows, ["x", "y"]).collect()] == [("a", None, 1), ("a", "b", 3)]


def test_apply_schema_needs_matching_width(spark):
    with pytest.raises(ValueError):
        tables.apply_schema(spark.range(1), T.StructType.fromDDL("a int, b int"))


def test_word_lists():
    assert len(set(EXTRA)) == 77 and "the" in STOP_WORDS


def test_clean_text_order_of_steps(spark):
    texts = [
        "@Bob Great NEWS!! https://t.co/x and more\nnext line",
        "line one\nline two",
        "5g network 2020",
        "café + naïf",
        "a_b (c) d$",
        "see http://x.org/y",
    ]
    rows = spark.createDataFrame(enumerate(texts), "i int, t string")
    got = {r["i"]: r["t"] for r in text.clean_text(rows, "t").collect()}
    assert got == {0: "great news", 1: "line oneline", 2: "g network ", 3: "caf na f", 4: "a_b c", 5: "see httpxorgy"}
    apart = {r["i"]: r["t"] for r in text.clean_text(rows, "t", glue_lines=False).collect()}
    assert apart[1] == "line line"


def test_tokens(spark):
    rows = spark.createDataFrame([("Éléphants_2 a _x bb9cc ÀÉ ² " + "z" * 16,), ("plain TEXT a1b2 _no yes_",), (None,)], "t string")
    got = column(text.simple_tokens(rows, "t").select("tokens"))
    assert got == [["elephants_", "bb", "cc", "ae"], ["plain", "text", "yes_"], None]


def test_phrase_merge_is_greedy(spark):
    rows = spark.createDataFrame([(0, ["a", "b", "c", "d"]), (1, []), (2, ["a", "a", "a"])], "k int, t array<string>")
    phrases = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("a", "a")], "a string, b string")
    for limit in (10, 0):
        got = {r["k"]: r["t"] for r in text.apply_phrases(rows, "t", phrases, "k", limit).collect()}
        assert got == {0: ["a_b", "c_d"], 1: [], 2: ["a_a", "a"]}


def test_sentiment_of_texts_without_hits(spark):
    rows = spark.createDataFrame([(0, ["good"]), (1, ["bad", "bad"]), (2, []), (3, ["dull"])], "k int, t array<string>")
    lexicon = spark.createDataFrame([("good", 1.9), ("bad", -2.5)], "word string, valence double")
    got = {r["k"]: (r["compound"], r["sentiment"]) for r in text.sentiment(rows, "k", F.col("t"), lexicon).collect()}
    assert got == {0: (0.4404, "Positive"), 1: (-0.7906, "Negative"), 2: (0.0, "Neutral"), 3: (0.0, "Neutral")}


def test_chunk_fixed_edges(spark):
    rows = spark.createDataFrame([(0, ""), (1, "ab" * 300), (2, "x\n" * 301), (3, "😀" * 301)], "k int, t string")
    got = retrieve.chunk_fixed(rows, "t").groupBy("k").agg(F.collect_list("chunk").alias("c")).collect()
    sizes = {r["k"]: [len(c) for c in r["c"]] for r in got}
    assert sizes == {1: [300, 300], 2: [300, 300, 2], 3: [300, 1]}


def test_chunk_overlap_rules():
    body = "\n\n".join(" ".join(f"word{i}{j}" for j in range(30)) for i in range(12))
    chunks = retrieve.split_text(body, 500, 50)
    assert all(0 < len(c) <= 500 for c in chunks)
    assert retrieve.split_text("x" * 1200, 500, 50)[0] == "x" * 500
    assert retrieve.split_text("x" * 1200, 500, 50)[1] == "x" * 500
    words = set(body.split())
    assert words == {w for c in chunks for w in c.split()}
    assert retrieve.split_text("", 500, 50) == [] and retrieve.split_text(" \n ", 500, 50) == []
    assert retrieve.split_text("one two three four", 9, 4) == ["one two", "two three"[4:], "four"]


def test_knn_exact_hit_and_ties(spark):
    train = spark.createDataFrame([(0, [0.0, 0.0], 7), (1, [1.0, 0.0], 3), (2, [-1.0, 0.0], 2), (3, [0.0, 1.0], 3)], "vec_id bigint, embedding array<double>, label int")
    queries = spark.createDataFrame([(10, [0.0, 0.0]), (11, [0.0, -50.0])], "query_id bigint, embedding array<double>")
    got = {r["query_id"]: r["label"] for r in predict.knn_classify(train, queries, 3).collect()}
    assert got[10] == 7
    tied = spark.createDataFrame([(12, [0.0, 0.0])], "query_id bigint, embedding array<double>")
    others = train.filter("vec_id in (1, 2)")
    assert predict.knn_classify(others, tied, 2).first()["label"] == 2


def test_label_encode_rejects_unseen(spark):
    rows = spark.createDataFrame([("XS",), ("2XL",), (None,)], "s string")
    assert [r["code"] for r in predict.label_encode(rows, "s", predict.SIZES).collect()] == [9, 0, None]
    with pytest.raises(PySparkException):
        predict.label_encode(spark.createDataFrame([("7XL",)], "s string"), "s", predict.SIZES).collect()


def test_feedback_ignores_unknown_sizes(spark):
    base = spark.createDataFrame([(170.0, 70.0, "S")], "Height_cm double, Weight_kg double, Size string")
    new = spark.createDataFrame([(180.0, 80.0, " xl "), (1.0, 1.0, "huge"), (2.0, 2.0, None)], base.schema)
    rows = predict.feedback_update(base, new).orderBy("Height_cm").collect()
    assert [(r["Size"], r["UserProvided"], r["Size_encoded"]) for r in rows] == [("S", False, 7), ("XL", True, 8)]


def test_edges_and_labels(spark):
    rows = spark.createDataFrame([("R", ["T (a)", "T", "T (b)", "T (a)", "U", "u"]), ("E", [])], "report string, entries array<string>")
    edges = lineage.relationship_edges(rows)
    assert {(r["dst"], r["column"]) for r in edges.collect()} == {("T", "a"), ("T", ""), ("T", "b"), ("U", ""), ("u", "")}
    assert set(column(lineage.graph_nodes(rows, edges))) == {"R", "E", "T", "U", "u"}
    last = {r["dst"]: r["label"] for r in lineage.edge_labels(edges).collect()}
    every = {r["dst"]: r["label"] for r in lineage.edge_labels(edges, "all").collect()}
    assert last == {"T": "a", "U": "", "u": ""} and every == {"T": "a, b", "U": "", "u": ""}


def test_messages(spark):
    schema = "message_id int, sender string, subject string, content_type string, body string, to_list array<string>, cc_list array<string>"
    good = spark.createDataFrame([(1, "a", 'say "hi"', "HTML", "<b>x</b>", ["t@example.com"], None)], schema)
    payload = json.loads(outbox.build_messages(good).first()["payload"])
    assert payload == {
        "message": {"subject": 'say "hi"', "body": {"contentType": "HTML", "content": "<b>x</b>"}, "toRecipients": [{"emailAddress": {"address": "t@example.com"}}]},
        "saveToSentItems": True,
    }
    with pytest.raises(PySparkException):
        outbox.build_messages(good.withColumn("content_type", F.lit("Markdown"))).collect()


def test_senders(spark):
    groups = spark.createDataFrame([(2, "Mailers"), (1, "Mailers"), (3, "Others")], "group_id int, display_name string")
    members = spark.createDataFrame([(1, "ann"), (1, "ann"), (2, "bob"), (3, "cy")], "group_id int, user string")
    users = spark.createDataFrame([("ann",), ("bob",)], "user string")
    messages = spark.createDataFrame([(i, s) for i, s in enumerate(["ann", "ann", "bob", "cy"])], "i int, sender string")
    got = outbox.allowed_senders(messages, groups, members, "Mailers", users).orderBy("i").collect()
    assert [r["state"] for r in got] == ["ready", "ready", "rejected", "unknown"]
    with pytest.raises(PySparkException):
        outbox.allowed_senders(messages, groups, members, "Nobody").collect()


def test_range_outliers_and_empty_profiles(spark):
    rows = spark.createDataFrame([(60.0,), (-11.0,), (50.0,), (-10.0,), (None,)], "v double")
    assert {(r["v"], r["side"]) for r in profile.range_outliers(rows, "v").collect()} == {(60.0, "high"), (-11.0, "low")}
    empty = spark.createDataFrame([(None, None)], "a int, b string")
    top = {r["column_name"]: r["most_frequent"] for r in profile.most_frequent_values(empty).collect()}
    assert top == {"a": None, "b": None}
    assert [tuple(r)[1:] for r in profile.unique_values(empty).collect()] == [(0, 0), (0, 0)]


def test_standardise_constant_column(spark):
    rows = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert [tuple(r)[2:] for r in predict.standardise(rows, ["a", "b"]).orderBy("a").collect()] == [(-1.0, 0.0), (1.0, 0.0)]
