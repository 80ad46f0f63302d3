"""Image files as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.common import with_row_number

# Suffixes accepted as images.
IMAGE_SUFFIXES = (".png", ".jpg", ".jpeg", ".bmp", ".tiff", ".webp")


def _image_files(spark: SparkSession, path: str, suffixes: Sequence[str] | None = IMAGE_SUFFIXES) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    files = files.select("*", F.col("_metadata.file_path").alias("uri"))
    if suffixes is None:
        return files
    return files.filter(F.lower("path").rlike(r"\.(" + "|".join(s[1:] for s in suffixes) + ")$"))


def _plain(path: str) -> Column:
    """One spelling of an address: Spark's readers differ in the slashes behind the scheme."""
    return F.regexp_replace(path, "^([A-Za-z]+:)/+", "$1/")


def image_format(content: str = "content") -> Column:
    """Format from the first bytes; null for anything else."""
    start = F.hex(F.substring(content, 1, 4))
    marks = (("89504E47", "png"), ("424D", "bmp"), ("FFD8", "jpeg"), ("49492A00", "tiff"), ("4D4D002A", "tiff"))
    return F.coalesce(*[F.when(start.startswith(mark), name) for mark, name in marks])


def read_images(spark: SparkSession, path: str, suffixes: Sequence[str] | None = IMAGE_SUFFIXES) -> DataFrame:
    """One row per image below ``path``: name, path, bytes, format, width, height and size.

    Spark's image source decodes the pictures, so a picture that it cannot read raises. ``suffixes=None`` takes
    all files for images. Only paths and sizes are matched between the two readers.
    """
    files = _image_files(spark, path, suffixes)
    decoded = spark.read.format("image").option("recursiveFileLookup", True).load(path)
    sizes = decoded.select(_plain("image.origin").alias("_at"), "image.width", "image.height")
    broken = F.raise_error(F.concat(F.lit("invalid image "), "path")).cast("int")
    width = F.when(F.col("width") > 0, F.col("width")).otherwise(broken)
    return files.join(sizes, _plain("uri") == F.col("_at")).select(
        F.regexp_extract("path", "([^/]+)$", 1).alias("file_name"),
        "path",
        F.col("content").alias("bytes"),
        image_format().alias("format"),
        width.alias("width"),
        "height",
        F.col("length").alias("size_bytes"),
    )


def class_folders(files: DataFrame, path_col: str = "path") -> DataFrame:
    """Add ``label`` (parent folder) and ``label_index`` (place among the sorted labels).

    Only the paths are read to list the classes.
    """
    labelled = files.withColumn("label", F.regexp_extract(path_col, "([^/]+)/[^/]+$", 1))
    classes = with_row_number(labelled.select("label").distinct(), ["label"], "label_index")
    return labelled.join(classes.withColumn("label_index", F.col("label_index").cast("int")), "label")


def read_class_folders(spark: SparkSession, path: str) -> DataFrame:
    """Images below ``path`` with the label taken from their folder."""
    return class_folders(_image_files(spark, path).drop("uri"))
