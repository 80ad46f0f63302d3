"""Delimited text, JSON and mixed folders."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.sources.images import IMAGE_SUFFIXES, read_images

BYTE_ORDER_MARK = "﻿"


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    multiline: bool = False,
) -> DataFrame:
    """CSV with a header row, UTF-8 with or without a byte order mark.

    With a schema columns are matched by their header, in any order: one the file lacks is null, one the
    schema lacks is left out. A file whose header differs from the others raises. Without a schema the types
    are inferred, which costs a second pass and is meant for profiling. ``multiline`` allows line
    breaks inside quotes, at the price of one task per file.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multiline)
    if schema is not None:
        return _read_by_header(spark, reader, path, schema)
    df = reader.option("inferSchema", True).csv(path)
    return df.toDF(*[c.lstrip(BYTE_ORDER_MARK) for c in df.columns])


def _read_by_header(spark: SparkSession, reader, path: str | list[str], schema: T.StructType | str) -> DataFrame:
    """Read with the schema put in the order of the header, which Spark then checks in every file."""
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    known = {f.name.lower(): f for f in wanted.fields}
    header = reader.csv(path).columns
    if not header:
        return reader.schema(wanted).csv(path)
    plain = [c.lstrip(BYTE_ORDER_MARK) for c in header]
    fields = [T.StructField(c, known[p.lower()].dataType if p.lower() in known else T.StringType()) for c, p in zip(header, plain)]
    df = reader.option("enforceSchema", False).schema(T.StructType(fields)).csv(path)
    place = {p.lower(): c for c, p in zip(header, plain)}
    return df.select(
        *[
            (F.col(f"`{place[f.name.lower()]}`") if f.name.lower() in place else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in wanted.fields
        ]
    )


def _starts_with(column: Column, bracket: str) -> Column:
    return column.rlike(r"^\s*\%s" % bracket)


def _as_text(schema: T.StructType | str) -> str:
    return schema if isinstance(schema, str) else schema.toDDL()


def json_documents(
    docs: DataFrame,
    schema: T.StructType | str,
    text: str = "value",
    wrap_keys: Sequence[str] = ("data", "results", "items"),
) -> DataFrame:
    """Rows of whole JSON documents held in a text column.

    A list gives its elements, an object with a list under one of ``wrap_keys`` (first match in
    that order) gives the elements of that list, and any other object gives one row. Several values with
    commas between them give the rows of all, except after a wrapped list; whatever else stands behind a value
    raises, as does text that is neither list nor object. Columns other than ``text`` are kept in front.
    """
    fields = _as_text(schema)
    doc = F.col(text)
    strict = {"mode": "FAILFAST"}
    # Inside one more list nothing behind the first value can go unread.
    all_of = F.concat(F.lit("["), doc, F.lit("]"))
    alone = F.size(F.from_json(all_of, "array<map<string,string>>", strict)) == 1
    more = F.raise_error(F.lit("a JSON document goes on behind its wrapped list"))
    rows = F.when(_starts_with(doc, "["), F.flatten(F.from_json(all_of, f"array<array<struct<{fields}>>>", strict)))
    for key in wrap_keys:
        inner = F.get_json_object(doc, f"$.{key}")
        rows = rows.when(
            _starts_with(doc, "{") & _starts_with(inner, "["),
            F.when(alone, F.from_json(inner, f"array<struct<{fields}>>", strict)).otherwise(more.cast(f"array<struct<{fields}>>")),
        )
    rows = rows.when(_starts_with(doc, "{"), F.from_json(all_of, f"array<struct<{fields}>>", strict))
    rows = rows.otherwise(F.raise_error(F.lit("unable to parse JSON document")))
    kept = [c for c in docs.columns if c != text]
    return docs.select(*kept, F.explode(rows).alias("_row")).select(*kept, "_row.*")


def _files_by_shape(spark: SparkSession, path: str | list[str]) -> tuple[list[str], list[str]]:
    """Files with one object per line, and files that are one document.

    In a valid document over several lines not every line both opens and closes with a brace, so no
    JSON has to be parsed to tell them apart. One row per file comes back, as in the driver's own listing.
    """
    line = F.regexp_replace("value", r"^\s+|\s+$", "")
    whole_line = line.startswith("{") & line.endswith("}")
    kinds = (
        spark.read.text(path)
        .select(F.col("_metadata.file_path").alias("file"), whole_line.alias("whole"), line.alias("line"))
        .filter(F.col("line") != "")
        .groupBy("file")
        .agg(F.count(F.lit(1)).alias("n"), F.min("whole").alias("whole"))
        .collect()
    )
    by_line = [r["file"] for r in kinds if r["whole"] and r["n"] > 1]
    return by_line, [r["file"] for r in kinds if not (r["whole"] and r["n"] > 1)]


def read_json_any(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str,
    wrap_keys: Sequence[str] = ("data", "results", "items"),
    shape: str | None = None,
) -> DataFrame:
    """JSON files holding record lists, one record per line, wrapped lists or a single object.

    Files with an object on every line go to the splittable line reader, the others are parsed as
    documents. ``shape="lines"`` or ``"documents"`` says what all files hold and saves the pass that
    looks.
    """
    if shape is None:
        by_line, whole = _files_by_shape(spark, path)
    else:
        paths = [path] if isinstance(path, str) else path
        by_line, whole = (paths, []) if shape == "lines" else ([], paths)
    parts = []
    if by_line:
        parts.append(spark.read.schema(_as_text(schema)).option("mode", "FAILFAST").json(by_line))
    if whole:
        parts.append(json_documents(spark.read.text(whole, wholetext=True), schema, "value", wrap_keys))
    if not parts:
        raise ValueError(f"unable to parse JSON: {path}")
    return reduce(lambda a, b: a.unionByName(b), parts)


def _any_case(suffix: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in suffix)


def read_folder(
    spark: SparkSession,
    path: str,
    csv_schema: T.StructType | str | None = None,
    json_schema: T.StructType | str | None = None,
    on_unknown: str = "raise",
) -> dict[str, DataFrame]:
    """All files below ``path`` by kind: ``csv``, ``json`` and ``image``.

    Other suffixes raise, or are left out with ``on_unknown="skip"``. Listing reads no contents.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select(F.regexp_extract(F.lower("path"), r"(\.[^./]+)$", 1).alias("suffix"))
    )
    suffixes = {r["suffix"] for r in listing.distinct().collect()}
    known = {".csv", ".json", *IMAGE_SUFFIXES}
    if on_unknown == "raise" and suffixes - known:
        raise ValueError(f"unsupported file types: {sorted(suffixes - known)}")
    out: dict[str, DataFrame] = {}
    if ".csv" in suffixes:
        reader = (
            spark.read.option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*" + _any_case(".csv"))
            .option("header", True)
            .option("escape", '"')
        )
        if csv_schema is not None:
            out["csv"] = _read_by_header(spark, reader, path, csv_schema)
        else:
            out["csv"] = reader.option("inferSchema", True).csv(path)
    if ".json" in suffixes:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*" + _any_case(".json"))
            .load(path)
            .select("path")
        )
        if json_schema is None:
            raise ValueError("a schema is needed to read JSON files")
        out["json"] = read_json_any(spark, [r["path"] for r in files.collect()], json_schema)
    if suffixes & set(IMAGE_SUFFIXES):
        out["image"] = read_images(spark, path)
    return out
