"""Files written by the tests, tables rewritten in place, and streams that stop and go on."""

import json
import struct
import zlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quern.operators import outbox
from quern.sinks import tables as sinks
from quern.sources import files, images, workbooks
from quern.streaming import feeds

SCHEMA = "a bigint, b string"


def test_csv_with_byte_order_mark_and_quoted_breaks(spark, tmp_path):
    (tmp_path / "t.csv").write_bytes("﻿a,b\n1,\"x\ny\"\n2,\"say \"\"hi\"\"\"\n".encode())
    rows = files.read_csv(spark, str(tmp_path), SCHEMA, multiline=True).orderBy("a").collect()
    assert [tuple(r) for r in rows] == [(1, "x\ny"), (2, 'say "hi"')]
    assert files.read_csv(spark, str(tmp_path), multiline=True).columns == ["a", "b"]


JSON_SHAPES = {
    "wrapped": ('{"data":[{"a":1,"b":"x"},{"a":2,"b":"y"}]}', 2),
    "wrapped_and_count": ('{"count":2,"results":[{"a":1,"b":"x"},{"a":2,"b":"y"}]}', 2),
    "ragged_one_line": ('{"items":[{"a":1,"b":"x"}],"tags":[1,2,3]}', 1),
    "ragged_pretty": ('{\n "tags": [1, 2, 3],\n "items": [\n  {"a": 1, "b": "x"}\n ]\n}', 1),
    "scalars_one_line": ('{"a":1,"b":"x"}', 1),
    "scalars_pretty": ('{\n "a": 1,\n "b": "x"\n}', 1),
    "lines": ('{"a":1,"b":"x"}\n{"a":2,"b":"y"}\n\n{"a":3,"b":"z"}\n', 3),
    "list": ('[{"a":1,"b":"x"},\n{"a":2,"b":"y"}]', 2),
}


@pytest.mark.parametrize("shape", sorted(JSON_SHAPES))
def test_json_shapes(spark, tmp_path, shape):
    body, n = JSON_SHAPES[shape]
    (tmp_path / "d.json").write_text(body)
    rows = files.read_json_any(spark, str(tmp_path), SCHEMA).orderBy("a").collect()
    assert [r["a"] for r in rows] == list(range(1, n + 1)) and rows[0]["b"] == "x"


def test_json_folder_of_all_shapes_and_broken_text(spark, tmp_path):
    for name, (body, _) in JSON_SHAPES.items():
        (tmp_path / f"{name}.json").write_text(body)
    assert files.read_json_any(spark, str(tmp_path), SCHEMA).count() == sum(n for _, n in JSON_SHAPES.values())
    assert files.read_json_any(spark, str(tmp_path / "lines.json"), SCHEMA, shape="lines").count() == 3
    assert files.read_json_any(spark, str(tmp_path / "list.json"), SCHEMA, shape="documents").count() == 2
    (tmp_path / "broken.json").write_text("not json at all")
    with pytest.raises(PySparkException):
        files.read_json_any(spark, str(tmp_path), SCHEMA).collect()


def png(width, height):
    def chunk(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    head = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    pixels = zlib.compress((b"\0" + b"\x10\x20\x30" * width) * height)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", pixels) + chunk(b"IEND", b"")


def bmp(width, height):
    line = b"\1\2\3" * width + b"\0" * (-3 * width % 4)
    head = b"BM" + struct.pack("<IHHI", 54 + height * len(line), 0, 0, 54)
    return head + struct.pack("<IiiHHIIiiII", 40, width, height, 1, 24, 0, 0, 0, 0, 0, 0) + line * height


def test_images_are_decoded(spark, tmp_path):
    for name, make in (("a.png", png), ("b.bmp", bmp), ("c.PNG", png)):
        (tmp_path / name).write_bytes(make(30, 20))
    (tmp_path / "notes.txt").write_text("no picture")
    rows = images.read_images(spark, str(tmp_path)).collect()
    assert {r["file_name"]: (r["format"], r["width"], r["height"]) for r in rows} == {"a.png": ("png", 30, 20), "b.bmp": ("bmp", 30, 20), "c.PNG": ("png", 30, 20)}
    assert all(r["size_bytes"] == len(r["bytes"]) for r in rows)
    (tmp_path / "g.png").write_bytes(png(30, 20)[:24])
    with pytest.raises(PySparkException):
        images.read_images(spark, str(tmp_path)).collect()


def test_class_folders(spark, tmp_path):
    for label in ("pear", "apple"):
        (tmp_path / label).mkdir()
        for i in range(3):
            (tmp_path / label / f"{i}.png").write_bytes(png(2, 2))
    rows = images.read_class_folders(spark, str(tmp_path)).collect()
    assert sorted((r["label"], r["label_index"]) for r in rows) == [("apple", 0)] * 3 + [("pear", 1)] * 3


def test_mixed_folder(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "t.CSV").write_text("a,b\n1,x\n")
    (tmp_path / "sub" / "d.json").write_text('{"a": 2, "b": "y"}')
    (tmp_path / "sub" / "p.png").write_bytes(png(4, 3))
    found = files.read_folder(spark, str(tmp_path), SCHEMA, SCHEMA)
    assert {k: v.count() for k, v in found.items()} == {"csv": 1, "json": 1, "image": 1}
    (tmp_path / "notes.txt").write_text("x")
    with pytest.raises(ValueError):
        files.read_folder(spark, str(tmp_path), SCHEMA, SCHEMA)
    assert set(files.read_folder(spark, str(tmp_path), SCHEMA, SCHEMA, "skip")) == {"csv", "json", "image"}


def test_staged_sheets(spark, tmp_path):
    rows = [
        {"path": "w", "sheet": "First", "sheet_no": 0, "row_no": 0, "cells": ["only sheet"]},
        {"path": "w", "sheet": "Second", "sheet_no": 1, "row_no": 0, "cells": ["Org", "two runs"]},
        {"path": "w", "sheet": "Second", "sheet_no": 1, "row_no": 1, "cells": []},
        {"path": "w", "sheet": "Second", "sheet_no": 1, "row_no": 2, "cells": ["2019-05-23", None, None, "True", "1.5"]},
    ]
    (tmp_path / "w.json").write_text("\n".join(json.dumps(r) for r in rows))
    staged = spark.read.schema(workbooks.STAGED).json(str(tmp_path))
    part = workbooks.sheet_rows(staged, "Second", "B:D", nrows=1).orderBy("row_no").collect()
    assert [r["cells"] for r in part] == [["two runs"], []]
    assert workbooks.sheet_rows(staged).first()["cells"] == ["only sheet"]
    named = workbooks.read_workbooks(spark, str(tmp_path), ["x", "y"], "Second", "D:E").filter("x is not null")
    assert [tuple(r) for r in named.collect()] == [("True", "1.5")]
    assert workbooks.sheet_rows(staged, "Missing").count() == 0


def test_column_names():
    assert [workbooks.column_index(c) for c in ("A", "R", "Z", "AA", "XFD")] == [0, 17, 25, 26, 16383]


def test_file_attachments(spark, tmp_path):
    for name in ("a.xlsx", "b.csv", "c.pdf", "d.txt", "e.xls"):
        (tmp_path / name).write_bytes(b"12345")
    rows = [r["attachment"] for r in outbox.file_attachments(spark, str(tmp_path)).collect()]
    assert {r["name"] for r in rows} == {"a.xlsx", "b.csv", "c.pdf"} and {r["contentBytes"] for r in rows} == {"MTIzNDU="}


def test_upsert_null_keys_duplicates_and_versions(spark):
    first = spark.createDataFrame([(1, None, "old"), (2, "k", "old")], "a int, b string, v string")
    sinks.upsert_table(first, "upsert_test", "t", ["a", "b"])
    change = spark.createDataFrame([(1, None, "new"), (3, "k", "new")], first.schema)
    for _ in range(3):
        got = sinks.upsert_table(change, "upsert_test", "t", ["a", "b"])

    assert {(r["a"], r["v"]) for r in got.collect()} == {(1, "new"), (2, "old"), (3, "new")}
    assert len(sinks._versions(spark, "upsert_test", "t")) == 2
    with pytest.raises(ValueError):
        sinks.upsert_table(change.union(change), "upsert_test", "t", ["a", "b"])


def test_per_key_folders(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_per_key(spark.range(6).withColumn("site", F.col("id") % 3), "site", path)
    assert spark.read.parquet(f"{path}/site=1").count() == 2


def test_feedback_stream_takes_each_file_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    base = spark.createDataFrame([(170.0, 70.0, "S")], "Height_cm double, Weight_kg double, Size string")
    seen = []

    def run():
        return feeds.feedback_stream(
            spark, str(landing), str(tmp_path / "store"), str(tmp_path / "progress"), base,
            "Height_cm double, Weight_kg double, Size string", refit=lambda rows: seen.append(rows.count()) or "model",
        )

    (landing / "1.csv").write_text("Height_cm,Weight_kg,Size\n180,80,xl\n181,81,none\n")
    rows, model = run()
    assert rows.count() == 2 and model == "model"
    (landing / "2.csv").write_text("Height_cm,Weight_kg,Size\n190,90,2XL\n")
    assert run()[0].count() == 3 and run()[0].count() == 3
    assert seen == [2, 3]


def test_landing_stream_goes_on_where_it_stopped(spark, tmp_path):
    schema = "k int, day int, v string"

    def land(rows, name):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "files" / name))

    def run():
        return feeds.landing_stream(
            spark, str(tmp_path / "files" / "*"), "landing_test", "t", str(tmp_path / "progress"), schema, ["k"],
            lambda batch: batch.filter("v is not null"), version="day",
        )

    land([(1, 1, "a"), (1, 2, "b"), (2, 1, None)], "one")
    assert {tuple(r) for r in run().select("k", "v").collect()} == {(1, "b")}
    land([(1, 3, "c"), (2, 2, "d")], "two")
    assert {tuple(r) for r in run().select("k", "v").collect()} == {(1, "c"), (2, "d")}
