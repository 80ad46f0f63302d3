"""Words of a text and hashes of word windows as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters between words.
SPACE = r"[\x20\x09-\x0D]+"
NOT_ALPHANUMERIC = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _parts(text: Column, separator: str) -> Column:
    """Non-empty parts between separators; a null text has none."""
    return F.coalesce(F.array_remove(F.split(text, separator), ""), F.array().cast("array<string>"))


def space_words(text: Column) -> Column:
    """Runs of characters other than ASCII white space, unchanged."""
    return _parts(text, SPACE)


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only, whatever the locale."""
    return F.translate(text, UPPER, LOWER)


def plain_words(text: Column) -> Column:
    """Runs of digits, ASCII letters (lower-cased) and characters beyond ASCII."""
    return _parts(lower_ascii(text), NOT_ALPHANUMERIC)


def _shifted(items: str, by: int) -> Column:
    return F.slice(items, by + 1, F.greatest(F.size(items) - by, F.lit(0)))


def with_window_hashes(df: DataFrame, words: str, sizes: dict[str, int]) -> DataFrame:
    """Add one column per entry of ``sizes`` (name: window size) with the hash of each window of that
    many consecutive words, in order; empty if the text has fewer words.

    Windows of 2, 4, 8 ... words are hashed from two halves, others from the powers of two in their size, largest
    first, so that the cost per word grows with the logarithm of the size and the hash of a window depends on its
    words alone, never on the other sizes asked for. The columns are added one after another, because an
    expression used twice inside another would be evaluated twice.
    """
    out = df.withColumn("_h1", F.transform(words, lambda w: F.xxhash64(w)))
    made = {1: "_h1"}

    def make(size: int) -> None:
        nonlocal out
        if size in made:
            return
        # The smallest power of two in the size goes last; a power of two falls into halves.
        b = size & -size if size & (size - 1) else size // 2
        a = size - b
        make(a)
        make(b)
        both = F.zip_with(made[a], _shifted(made[b], a), lambda x, y: F.xxhash64(x, y))
        out = out.withColumn(f"_h{size}", F.slice(both, 1, F.greatest(F.size(words) - (size - 1), F.lit(0))))
        made[size] = f"_h{size}"

    for size in sorted(set(sizes.values())):
        make(size)
    return out.withColumns({name: F.col(made[size]) for name, size in sizes.items()}).drop(*made.values())
