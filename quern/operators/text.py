"""Text cleaning, tokens, phrases, sentiment and word frequencies."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.common import materialize
from quern.functions.words import CLOUD_EXTRA, ENGLISH, STOP_WORDS, accent_table
from quern.operators.profile import class_share
from quern.operators.shape import top_n_per_group

# Size of the table of bits that tells most other pairs from phrases: 64 MB at most.
BITS_PER_ROW, MOST_BITS = 16, 1 << 29


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def each_token(df: DataFrame, tokens: str | Column, keep: Sequence[str] = (), pos: bool = False) -> DataFrame:
    """One row per token in column ``word``, with its place in ``pos`` if wanted.

    The outer form, with the empty rows dropped afterwards: for the inner one Catalyst puts a filter on
    the size of the array below, and computes the tokens a second time for it.
    """
    token = F.posexplode_outer(tokens).alias("pos", "word") if pos else F.explode_outer(tokens).alias("word")
    return df.select(*keep, token).filter(F.col("word").isNotNull())


def without_words(tokens: Column, words: Sequence[str]) -> Column:
    """Tokens not in the list, in order; the list becomes a hash set inside the expression."""
    return F.filter(tokens, lambda t: ~t.isin(*words))


def cleaned(
    text: str | Column, words: Sequence[str] = tuple(STOP_WORDS), glue_lines: bool = True
) -> Column:
    """Cleaned text as one chain of JVM expressions.

    Mentions go first, then everything from the first ``https://`` on, then case, then all
    characters but letters, digits, underscores and spaces. What is not ASCII becomes a space, stop
    words are left out and digits are deleted last, so that spare spaces may remain. Line breaks and
    tabs are deleted, which joins the words around them; ``glue_lines=False`` keeps them apart.
    """
    t = F.regexp_replace(_col(text), "@[A-Za-z0-9]+", "")
    t = F.lower(F.substring_index(t, "https://", 1))
    if not glue_lines:
        t = F.regexp_replace(t, r"\s", " ")
    letters = F.regexp_replace(F.regexp_replace(t, r"[^\p{L}\p{N}_ ]+", ""), r"[^\x00-\x7F]+", " ")
    t = _if_ascii(_col(text), F.regexp_replace(t, "[^a-z0-9_ ]+", ""), letters)
    tokens = without_words(F.split(t, " "), ["", *words])
    return F.regexp_replace(F.array_join(tokens, " "), "[0-9]+", "")


def clean_text(
    df: DataFrame,
    col: str,
    words: Sequence[str] = tuple(STOP_WORDS),
    glue_lines: bool = True,
    name: str | None = None,
) -> DataFrame:
    return df.withColumn(name or col, cleaned(col, words, glue_lines))


def remove_stopwords(
    df: DataFrame, tokens: str, words: Sequence[str] | DataFrame = tuple(STOP_WORDS), key: str | None = None
) -> DataFrame:
    """Leave listed tokens out of an array column, keeping the order.

    A Python list is compiled into the expression. A table of words (one column) may be of any
    size: the tokens are matched by an anti join and put back together by ``key``.
    """
    if not isinstance(words, DataFrame):
        return df.withColumn(tokens, without_words(F.col(tokens), words))
    listed = materialize(words.select(F.col(words.columns[0]).alias("word")).distinct(), "words")
    kept = (
        each_token(df, tokens, [key], pos=True)
        .join(listed, "word", "left_anti")
        .groupBy(key)
        .agg(F.array_sort(F.collect_list(F.struct("pos", "word"))).alias("_kept"))
    )
    return (
        df.drop(tokens)
        .join(kept, key, "left")
        .withColumn(
            tokens,
            F.coalesce(F.transform("_kept", lambda s: s["word"]), F.array().cast("array<string>")),
        )
        .drop("_kept")
    )


def _if_ascii(text: Column, plain: Column, other: Column) -> Column:
    """Cheaper expressions for texts whose bytes and characters are equal in number."""
    return F.when(F.octet_length(text) == F.char_length(text), plain).otherwise(other)


def tokens_of(text: str | Column, min_len: int = 2, max_len: int = 15) -> Column:
    """Lower-cased alphabetic runs without accents, of the given lengths.

    Digits end a run, and runs that start with an underscore are left out.
    """
    accented, base = accent_table()
    t = F.lower(_col(text))
    bare = F.regexp_replace(F.translate(t, accented, base), r"\p{Mn}+", "")

    def runs(of: Column, letters: str) -> Column:
        # A whole run: not part of a longer one, and the underscore only after the first letter.
        pattern = f"(?<![{letters}_])[{letters}][{letters}_]{{{min_len - 1},{max_len - 1}}}+(?![{letters}_])"
        return F.regexp_extract_all(of, F.lit(pattern), F.lit(0))

    return _if_ascii(_col(text), runs(t, "a-z"), runs(bare, r"\p{L}\p{Nl}\p{No}"))


def simple_tokens(
    df: DataFrame, col: str, min_len: int = 2, max_len: int = 15, name: str = "tokens"
) -> DataFrame:
    return df.withColumn(name, tokens_of(col, min_len, max_len))


def word_tokens(text: str | Column) -> Column:
    """Lower-cased runs of two or more word characters, accents kept."""
    t = F.lower(_col(text))
    return _if_ascii(
        _col(text),
        F.regexp_extract_all(t, F.lit("[a-z0-9_]{2,}"), F.lit(0)),
        F.regexp_extract_all(t, F.lit(r"[\p{L}\p{N}_]{2,}"), F.lit(0)),
    )


def word_counts(df: DataFrame, tokens: Column, group: Sequence[str] = ()) -> DataFrame:
    """Counts by group and word, combined in each task before the shuffle."""
    return (
        each_token(df, tokens, group)
        .groupBy(*group, "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def top_n_words(
    df: DataFrame, text: str, n: int = 15, words: Sequence[str] = tuple(ENGLISH)
) -> DataFrame:
    """The ``n`` commonest words of the whole column with their counts."""
    counts = word_counts(df, without_words(word_tokens(text), words))
    return counts.orderBy(F.desc("n"), "word").limit(n)


def word_frequencies(
    df: DataFrame,
    text: str,
    group: Sequence[str] = (),
    n: int = 50,
    words: Sequence[str] = tuple([*ENGLISH, *CLOUD_EXTRA]),
) -> DataFrame:
    """The ``n`` commonest words, overall or for each group."""
    counts = word_counts(df, without_words(word_tokens(text), words), group)
    if not group:
        return counts.orderBy(F.desc("n"), "word").limit(n)
    return top_n_per_group(counts, list(group), n, "n", ["word"])


def pair_counts(df: DataFrame, tokens: str) -> DataFrame:
    """``(a, b, n)`` for every word and its right neighbour; the last word has none.

    One row per token, combined in each task before the only shuffle.
    """
    t = F.col(tokens)
    beside = F.arrays_zip(t.alias("a"), F.slice(t, 2, F.greatest(F.size(t), F.lit(1))).alias("b"))
    return (
        df.select(F.explode(beside).alias("_p"))
        .select("_p.a", "_p.b")
        .groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def phrase_scores(
    df: DataFrame, tokens: str, min_count: int = 1, threshold: float = 10.0
) -> DataFrame:
    """Adjacent pairs that occur together more often than their words suggest.

    score = (n_ab - min_count) / n_a / n_b * vocabulary size, where the vocabulary holds words and
    pairs; kept above the threshold. The texts are read once: the pair counts are written, the word
    counts are their sums, and all joins run over these two tables.
    """
    counts = materialize(pair_counts(df, tokens), "pairs")
    words = materialize(counts.groupBy("a").agg(F.sum("n").alias("n")), "words")
    pairs = counts.filter(F.col("b").isNotNull())
    vocabulary = pairs.count() + words.count()
    scored = (
        # A pair seen no more than min_count times scores zero at best.
        pairs.filter((F.col("n") > min_count) if threshold >= 0 else (F.col("n") >= min_count))
        .join(words.select("a", F.col("n").alias("n_a")), "a")
        .join(words.select(F.col("a").alias("b"), F.col("n").alias("n_b")), "b")
        .withColumn(
            "score", (F.col("n") - min_count) / F.col("n_a") / F.col("n_b") * F.lit(vocabulary)
        )
    )
    return scored.filter(F.col("score") > threshold).select("a", "b", "n", "n_a", "n_b", "score")


def _merge(tokens: Sequence[str], joins) -> list[str]:
    """Join marked neighbours from left to right; a joined word is not joined again."""
    out, at, last = [], 0, len(tokens) - 1
    while at <= last:
        if at < last and joins(at):
            out.append(f"{tokens[at]}_{tokens[at + 1]}")
            at += 2
        else:
            out.append(tokens[at])
            at += 1
    return out


def _maybe(listed: DataFrame, cols: Sequence[str]) -> Column:
    """False only for rows whose columns are surely not among those of ``listed``.

    Each listed row sets one bit of a table of at least ``BITS_PER_ROW`` bits a row, up to ``MOST_BITS``; beyond that size
    more rows pass. Nulls count as nothing.
    """
    n = listed.count()
    log = min(max((BITS_PER_ROW * n).bit_length(), 6), MOST_BITS.bit_length() - 1)
    # The words of the table as one array of numbers, read by place.
    place = F.shiftrightunsigned(F.xxhash64(*cols), 64 - log)
    word, bit = F.shiftright(place, 6), F.pmod(place, F.lit(64)).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    held = np.zeros(1 << (log - 6), dtype=np.int64)
    found = listed.groupBy(word.alias("word")).agg(F.bit_or(one).alias("bits")).toArrow()
    held[found["word"].to_numpy()] = found["bits"].to_numpy()
    known = listed.sparkSession.sparkContext.broadcast(held)

    @F.pandas_udf("boolean")
    def met(word: pd.Series, bit: pd.Series) -> pd.Series:
        return pd.Series((known.value[word.to_numpy()] >> bit.to_numpy()) & 1 == 1)

    return met(word, bit)


def apply_phrases(
    df: DataFrame, tokens: str, phrases: DataFrame, key: str, limit: int = 300_000
) -> DataFrame:
    """Replace phrase pairs by ``a_b`` in an array column; a null array becomes an empty one.

    Up to ``limit`` phrases travel to the executors as a set, after a count. Beyond that the
    pairs are matched by a join, and only the places that matched are sent back to their texts. Places
    whose pair surely is no phrase, by a table of bits, are left out before that join.
    """
    df = df.withColumn(tokens, F.coalesce(tokens, F.array().cast("array<string>")))
    phrases = materialize(phrases.select("a", "b"), "phrases")
    few = phrases.limit(limit + 1).collect()
    if len(few) <= limit:
        pairs = df.sparkSession.sparkContext.broadcast({(r["a"], r["b"]) for r in few})

        @F.pandas_udf("array<string>")
        def merged(col: pd.Series) -> pd.Series:
            known = pairs.value
            return col.map(lambda t: _merge(t, lambda i: (t[i], t[i + 1]) in known))

        return df.withColumn(tokens, merged(tokens))

    t = F.col(tokens)
    neighbours = F.arrays_zip(
        F.slice(t, 1, F.greatest(F.size(t) - 1, F.lit(0))).alias("a"),
        F.slice(t, 2, F.greatest(F.size(t) - 1, F.lit(0))).alias("b"),
    )
    places = (
        df.select(key, F.posexplode(neighbours).alias("_pos", "_p"))
        .select(key, "_pos", "_p.a", "_p.b")
        .filter(_maybe(phrases, ["a", "b"]))
        .join(phrases, ["a", "b"], "left_semi")
        .groupBy(key)
        .agg(F.collect_list("_pos").alias("_places"))
    )

    @F.pandas_udf("array<string>")
    def merged_at(col: pd.Series, places: pd.Series) -> pd.Series:
        out = []
        for words, marks in zip(col, places):
            known = set() if marks is None else set(marks)
            out.append(_merge(words, known.__contains__))
        return pd.Series(out, index=col.index)

    return df.join(places, key, "left").withColumn(tokens, merged_at(tokens, "_places")).drop("_places")


def lexicon_filter(
    df: DataFrame, key: str, tokens: str, lexicon: DataFrame, tags: Sequence[str]
) -> DataFrame:
    """Words whose tag is allowed, replaced by their lemma, in text order; a text without such words stays, empty.

    ``lexicon(word, lemma, tag)`` joins on the word. Its allowed part is stored first, so that
    Catalyst broadcasts it by its measured size, or splits frequent words in a sort-merge join.
    Tags match by their beginning, so ``NN`` also allows ``NNS``.
    """
    allowed = F.lit(False)
    for tag in tags:
        allowed = allowed | F.col("tag").startswith(tag)
    kept = lexicon.filter(allowed).groupBy("word").agg(F.min("lemma").alias("lemma"))
    kept = materialize(kept, "lexicon")
    # The outer form keeps a row for an empty text, and the left join one for a text whose words all go.
    words = df.select(key, F.posexplode_outer(tokens).alias("pos", "word"))
    found = F.when(F.col("lemma").isNotNull(), F.struct("pos", "lemma"))
    return (
        words.join(kept, "word", "left")
        .groupBy(key)
        .agg(F.array_sort(F.collect_list(found)).alias("_w"))
        .select(key, F.transform("_w", lambda s: s["lemma"]).alias(tokens))
    )


def sentiment(
    df: DataFrame, key: str, tokens: Column, lexicon: DataFrame, valence: str = "valence"
) -> DataFrame:
    """``(key, compound, sentiment)`` from word valences.

    compound = s / sqrt(s^2 + 15) with s the sum of valences; above 0 is Positive, below Negative.
    Each task sums its texts before the shuffle, and texts without a listed word stay Neutral.
    """
    words = df.select(key, F.explode_outer(tokens).alias("word"))
    listed = materialize(lexicon.select("word", F.col(valence).alias("_v")), "lexicon")
    s = F.col("_s")
    label = F.when(s > 0, "Positive").when(s < 0, "Negative").otherwise("Neutral")
    return (
        words.join(listed, "word", "left")
        .groupBy(key)
        .agg(F.coalesce(F.sum("_v"), F.lit(0.0)).alias("_s"))
        .select(key, F.round(s / F.sqrt(s * s + 15), 4).alias("compound"), label.alias("sentiment"))
    )


def sentiment_profile(scored: DataFrame) -> DataFrame:
    """Counts and shares of the sentiment classes."""
    return class_share(scored, "sentiment")
