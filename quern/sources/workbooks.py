"""Sheets of workbooks, staged as rows of cells.

Whoever drops workbooks into the landing folder stages each sheet as JSON lines with ``path``, ``sheet``,
``sheet_no``, ``row_no`` and ``cells``; Spark splits and reads those in parallel, which it cannot do with the
archives themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.sources.tables import rows_to_frame

STAGED = "path string, sheet string, sheet_no int, row_no int, cells array<string>"


def column_index(letters: str) -> int:
    """Zero-based place of a column name: A is 0, AA is 26."""
    n = 0
    for c in letters.upper():
        n = n * 26 + ord(c) - 64
    return n - 1


def sheet_rows(staged: DataFrame, sheet: str | None = None, columns: str | None = None, nrows: int | None = None) -> DataFrame:
    """``(path, row_no, cells)`` of one sheet per workbook; row 0 is the header.

    ``sheet=None`` takes the first sheet, ``columns`` a range such as ``A:R``, and ``nrows`` the number of data
    rows. A workbook without the named sheet gives no rows.
    """
    rows = staged.filter((F.col("sheet_no") == 0) if sheet is None else (F.col("sheet") == sheet))
    if nrows is not None:
        rows = rows.filter(F.col("row_no") <= nrows)
    cells = F.col("cells")
    if columns:
        first, last = (column_index(c) for c in columns.split(":"))
        cells = F.slice(cells, first + 1, last - first + 1)
    return rows.select("path", "row_no", cells.alias("cells"))


def read_workbooks(
    spark: SparkSession,
    path: str,
    names: Sequence[str],
    sheet: str | None = None,
    columns: str | None = None,
    nrows: int | None = None,
) -> DataFrame:
    """Data rows of all staged workbooks below ``path`` under positional names, all text."""
    staged = spark.read.schema(STAGED).option("mode", "FAILFAST").option("recursiveFileLookup", True).json(path)
    rows = sheet_rows(staged, sheet, columns, nrows).filter("row_no > 0")
    return rows_to_frame(rows, names).drop("n_cells")
