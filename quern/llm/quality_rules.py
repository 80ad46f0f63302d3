"""Quality rules kept as a ledger of failure bits and measurements.

Every rule is evaluated once per text. Policies, their versions and ablations work on the stored bits and
never read a text again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.words import SPACE, space_words, with_window_hashes

WINDOW = 8
SYMBOLS = r"[#*$%&|<>]"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_marks", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """A rule owns one bit of the ledger for good; ``failed`` sees the measurement columns."""

    bit: int
    name: str
    failed: str


RULES = (
    Rule(0, "few_words", "n_words < 20"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule(2, "odd_word_length", "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 15 * n_words)"),
    Rule(3, "symbols", "10 * n_symbols > n_words"),
    Rule(4, "duplicate_lines", "n_lines > 2 AND 10 * n_dup_lines > 3 * n_lines"),
    Rule(5, "exclamation_marks", "2 * n_marks > n_words"),
)
# Versions are never edited, only added.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "odd_word_length", "symbols", "duplicate_lines"),
    "v2": ("few_words", "repeated_windows", "odd_word_length", "symbols", "duplicate_lines", "exclamation_marks"),
}


def mask_of(names: Sequence[str], rules: Sequence[Rule] = RULES) -> int:
    bits = {r.name: 1 << r.bit for r in rules}
    return sum(bits[n] for n in set(names))


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``key`` and the measurements, all of the whole text.

    ``n_repeat_words`` counts words inside windows of 8 words that occur at least twice in the text. A null
    text measures like an empty one; repeated rows and null keys stay rows of their own; other columns are
    not read, so their names cannot clash. Nothing is shuffled.
    """
    d = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    d = d.withColumn("_words", space_words(F.col("_text")))
    d = with_window_hashes(d, "_words", {"_windows": WINDOW})
    d = d.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")))
    d = d.select(
        "_key",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("_text", SPACE, "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.regexp_replace("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.length("_text") - F.length(F.replace("_text", F.lit("!"), F.lit("")))).cast("long").alias("n_marks"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        # Only texts with a repeated window go through the sort below; for the others it is empty.
        F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), F.col("_windows"))
        .otherwise(F.array().cast("array<bigint>"))
        .alias("_windows"),
    )
    return _repeats(d).withColumnRenamed("_key", key)


def _repeats(d: DataFrame) -> DataFrame:
    """Words covered by the windows whose hash occurs twice or more in the array."""
    tail = lambda c: F.slice(c, 2, F.greatest(F.size(c) - 1, F.lit(0)))
    d = d.withColumn("_sorted", F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("p")))))
    d = d.withColumn(
        "_twins", F.zip_with("_sorted", tail("_sorted"), lambda a, b: F.when(a["h"] == b["h"], F.array(a["p"], b["p"])))
    )
    d = d.withColumn("_starts", F.array_sort(F.array_distinct(F.flatten(F.array_compact("_twins")))))
    covered = F.zip_with(
        "_starts", tail("_starts"), lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))).cast("long")
    )
    d = d.withColumn("n_repeat_words", F.aggregate(covered, F.lit(0).cast("long"), lambda s, x: s + x))
    return d.drop("_windows", "_sorted", "_twins", "_starts")


def ledger(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """``key``, the measurements and ``failed_bits`` (bit of each failed rule set), one row per row of ``docs``."""
    bits = F.lit(0).cast("long")
    for r in rules:
        bits = bits.bitwiseOR(F.when(F.expr(r.failed), F.lit(1 << r.bit).cast("long")).otherwise(F.lit(0).cast("long")))
    return measure(docs, key, text).withColumn("failed_bits", bits)


def kept(bits: Column, policy: Sequence[str], rules: Sequence[Rule] = RULES) -> Column:
    return bits.bitwiseAND(F.lit(mask_of(policy, rules))) == 0


def apply_policies(
    entries: DataFrame, policies: Mapping[str, Sequence[str]] = POLICIES, rules: Sequence[Rule] = RULES
) -> DataFrame:
    """The ledger with one boolean ``kept_<version>`` per policy; no rule is evaluated again."""
    return entries.withColumns({f"kept_{v}": kept(F.col("failed_bits"), names, rules) for v, names in policies.items()})


def ablations(entries: DataFrame, policy: Sequence[str], rules: Sequence[Rule] = RULES) -> DataFrame:
    """What each rule of a policy does: rows it fails, rows only it fails (kept without it), rows kept by it alone.

    Rows are combined to one per distinct bit pattern before anything else; an empty ledger gives zero counts.
    """
    mask = mask_of(policy, rules)
    masked = F.col("failed_bits").bitwiseAND(F.lit(mask))
    patterns = entries.groupBy(masked.alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    chosen = [r for r in rules if r.name in set(policy)]
    count = lambda test: F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0)).cast("long")
    sums = []
    for r in chosen:
        one = F.lit(1 << r.bit).cast("long")
        sums.append(
            F.struct(
                F.lit(r.name).alias("rule"),
                count(F.col("bits").bitwiseAND(one) != 0).alias("n_failed"),
                count(F.col("bits") == one).alias("n_only"),
                count(F.col("bits").bitwiseAND(F.lit(mask & ~(1 << r.bit))) == 0).alias("n_kept_without"),
                count(F.col("bits") == 0).alias("n_kept"),
            )
        )
    return patterns.agg(F.array(*sums).alias("_rows")).select(F.inline("_rows"))


def bits_by_group(entries: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Rows, the bits that some row fails and the bits that all rows fail, per group."""
    return entries.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.bit_or("failed_bits").alias("any_failed"),
        F.bit_and("failed_bits").alias("all_failed"),
    )
