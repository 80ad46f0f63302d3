"""Mixing of sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions only.

Each document gets an exponential key: minus the logarithm of a uniform number drawn from its own hash, divided by its
quality weight. A source whose target is n times its size and some more gives n complete epochs, and then its
documents in order of their keys until the rest of the target is reached.

The order is taken in two levels. Keys are mapped, in their order, to ``BUCKETS`` buckets, sizes are added up per source
and bucket before they are shuffled, and a running sum over a source's buckets finds the one in which its budget
ends. Buckets before it are taken whole, those behind it not at all, and only the documents of that one bucket are
sorted. So no source is gathered or sorted as a whole, however many of all documents it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.common import materialize, with_row_number
from quern.llm.words import space_words

# Documented parameters: weights of the sources in order of their names, most epochs of one source, and the seed.
WEIGHTS = (1, 2, 3)
MOST_EPOCHS = 3
SEED = "mix-1"
# Buckets of keys per source, which bounds the rows of one source in the running sum.
BUCKETS = 65_536
LEAST_QUALITY = 0.05


def uniform(key: Column, text: Column, seed: str = SEED) -> Column:
    """A number in (0, 1) from a digest of seed, key and text; the same in every run and on every machine."""
    told = F.concat_ws(":", F.lit(seed), F.coalesce(key.cast("string"), F.lit("")), F.coalesce(text, F.lit("")))
    return (F.conv(F.substring(F.md5(told.cast("binary")), 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def exponential_key(uniform_number: Column, weight: Column) -> Column:
    """The key by which a smaller value is drawn earlier."""
    return -F.log(uniform_number) / weight


def distinct_share(words: Column) -> Column:
    """Default quality weight: the share of distinct words, at least ``LEAST_QUALITY``; 1 without words."""
    share = F.size(F.array_distinct(words)) / F.greatest(F.size(words), F.lit(1))
    return F.when(F.size(words) == 0, 1.0).otherwise(F.greatest(share, F.lit(LEAST_QUALITY)))


def sized(docs: DataFrame, key: str, text: str, source: str, quality: str | None, seed: str) -> DataFrame:
    """The light side of the documents: ``key``, ``source``, ``size``, exponential key ``draw`` and its ``bucket``."""
    told = F.lit(None).cast("double") if quality is None else F.col(quality).cast("double")
    rows = docs.select(
        F.col(key).alias("key"), F.col(source).alias("source"), told.alias("weight"),
        space_words(F.col(text)).alias("words"), uniform(F.col(key), F.col(text), seed).alias("u"),
    )
    given = F.when(F.col("weight") > 0, F.col("weight")).otherwise(F.lit(LEAST_QUALITY))
    weight = distinct_share(F.col("words")) if quality is None else given
    rows = rows.select("key", "source", F.size("words").cast("long").alias("size"), exponential_key(F.col("u"), weight).alias("draw"))
    # Rises with the key and fills the buckets evenly if weights are alike.
    bucket = F.least(F.floor((1 - F.exp(-F.col("draw"))) * BUCKETS), F.lit(BUCKETS - 1)).cast("int")
    return rows.withColumn("bucket", bucket)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """``source``, ``source_size`` and ``target`` from one row per source.

    Sources in order of their names (by code point, null last) weigh ``weights`` in turn and share the sum of
    all sizes. A target stops at ``most_epochs`` times its source's size; what is over is shared again among the
    others by weight until none is above. Only sums come to the driver, whatever the number of sources; each round
    sets at least one more source to its bound.
    """
    ranked = with_row_number(sizes, [F.asc_nulls_last("source")], "place")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int")).cast("long")
    state = materialize(ranked.select("source", "source_size", weight.alias("weight"), F.lit(False).alias("full")), "sources")
    while True:
        told = state.agg(
            F.sum("source_size").alias("all"),
            F.coalesce(F.sum(F.when(F.col("full"), most_epochs * F.col("source_size"))), F.lit(0)).alias("gone"),
            F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))), F.lit(0)).alias("open"),
        ).first()
        rest, shared = (told["all"] or 0) - told["gone"], max(told["open"], 1)
        part = F.lit(rest).cast("long") * F.col("weight")
        above = ~F.col("full") & (part > most_epochs * F.col("source_size") * F.lit(shared))
        if state.where(above).isEmpty():
            break
        state = materialize(state.withColumn("full", F.col("full") | above), "sources")
    target = F.when(F.col("full"), (most_epochs * F.col("source_size")).cast("double")).otherwise(part.cast("double") / F.lit(float(shared)))
    return state.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    quality: str | None = None,
    weights: tuple[int, ...] = WEIGHTS,
    most_epochs: int = MOST_EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``source``, ``size``, ``source_size``, ``target`` and ``taken``.

    ``size`` counts runs of characters other than ASCII white space; a null or empty text has none and gives
    nothing. ``taken`` counts the words that the mix takes of the document, repeats included: its size once per complete
    epoch, and once more if it is drawn for the rest; of the document at which the rest ends only as many (first) words
    are taken as are left, so that a source gives its target to the word, rounded down. ``quality`` names a column of
    weights (null or not positive: ``LEAST_QUALITY``); without it the share of distinct words counts. Null
    sources are one source. Equal keys go by document key, size and text digest; fully equal rows may swap places, which
    changes no value of the result. Other columns are not read; an empty table gives no rows.
    """
    light = materialize(sized(docs, key, text, source, quality, seed), "sized")
    sums = materialize(light.groupBy("source", "bucket").agg(F.sum("size").alias("size")), "bucket_sums")
    targets = materialize(source_targets(sums.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most_epochs), "targets")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    targets = targets.withColumn("epochs", epochs)
    targets = targets.withColumn("rest", F.floor(F.col("target")).cast("long") - F.col("epochs") * F.col("source_size"))

    # The bucket in which the rest ends: the first one whose running sum reaches it.
    upto = F.sum("size").over(Window.partitionBy("source").orderBy("bucket"))
    sums = sums.withColumn("upto", upto)
    joined = sums.alias("s").join(targets.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source")))
    ends = joined.where((F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("s.size") < F.col("rest")))
    ends = ends.groupBy("t.source").agg(F.min(F.struct("bucket", (F.col("upto") - F.col("s.size")).alias("before"))).alias("cut"))
    plan = targets.alias("t").join(ends.alias("e"), F.col("t.source").eqNullSafe(F.col("e.source")), "left").select(
        "t.*",
        # Without a rest no bucket is taken.
        F.coalesce("cut.bucket", F.lit(-1)).alias("cut"), F.coalesce("cut.before", F.lit(0)).alias("before"),
    )
    plan = materialize(plan, "mix_plan")

    placed = light.alias("d").join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")))
    placed = placed.select("d.key", "d.source", "d.size", "d.draw", "d.bucket", "source_size", "target", "epochs", "rest", "cut", "before")
    whole = placed.where("bucket <> cut").withColumn("more", F.when(F.col("bucket") < F.col("cut"), F.col("size")).otherwise(F.lit(0)))
    in_order = Window.partitionBy("source").orderBy("draw", "key", "size").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.col("before") + F.coalesce(F.sum("size").over(in_order), F.lit(0))
    cut = placed.where("bucket = cut").withColumn("more", F.least("size", F.greatest(F.col("rest") - ahead, F.lit(0))))
    taken = (F.col("epochs") * F.col("size") + F.col("more")).cast("long")
    return whole.unionByName(cut).select(F.col("key").alias(key), F.col("source").alias(source), "size", "source_size", "target", taken.alias("taken"))
