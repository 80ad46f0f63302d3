"""Encoding, scaling, regression, classification and nearest neighbours."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, OneVsRest
from pyspark.ml.feature import Bucketizer, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.common import materialize, with_group_row_number, with_row_number
from quern.functions.scalars import date_ordinal, softmax
from quern.operators.retrieve import nearest
from quern.operators.shape import add_default_column, append_rows

# The size classes, in their natural order.
SIZES = ["XS", "S", "M", "L", "XL", "2XL", "3XL", "4XL", "5XL", "6XL"]


def grid_to_rows(
    df: DataFrame, row_key: str, columns: Sequence[str], column_name: str, value_name: str
) -> DataFrame:
    """A chart with one column per class range to rows, blank cells left out."""
    return df.unpivot(row_key, list(columns), column_name, value_name).filter(
        F.col(value_name).isNotNull()
    )


def label_encode(
    df: DataFrame, col: str, classes: Sequence[str] | None = None, name: str = "code"
) -> DataFrame:
    """Alphabetical code of each label.

    Known ``classes`` are compiled into the plan and any other label raises. Otherwise the distinct
    labels are ranked, and the join back is broadcast only if their stored list is small.
    """
    if classes is not None:
        known = sorted(set(classes))
        place = F.array_position(F.array(*[F.lit(c) for c in known]), F.col(col)).cast("int") - 1
        unseen = F.raise_error(F.concat(F.lit("unseen label: "), F.col(col).cast("string")))
        return df.withColumn(name, F.when(place >= 0, place).when(place < 0, unseen.cast("int")))
    codes = with_row_number(df.select(col).filter(F.col(col).isNotNull()).distinct(), [col], name)
    return df.join(codes, col, "left")


def standardise(df: DataFrame, cols: Sequence[str], suffix: str = "_scaled") -> DataFrame:
    """(x - mean) / population deviation; a constant column becomes 0."""
    stats = df.agg(
        F.struct(
            *[F.avg(c).alias(f"mean_{c}") for c in cols],
            *[F.stddev_pop(c).alias(f"sd_{c}") for c in cols],
        ).alias("s")
    ).scalar()

    def scaled(c: str) -> Column:
        sd = stats[f"sd_{c}"]
        return (F.col(c) - stats[f"mean_{c}"]) / F.when(sd == 0, F.lit(1.0)).otherwise(sd)

    return df.withColumns({c + suffix: scaled(c) for c in cols})


def linear_fit(df: DataFrame, key: str, x: str | Column, y: str) -> DataFrame:
    """Least squares of ``y`` on ``x`` for every key in one aggregation.

    Only running sums leave a task, so a site with most of the rows costs nothing extra.
    """
    x = F.col(x) if isinstance(x, str) else x
    # Both sides must be set, as in a pairwise fit; a day number is moved near zero first.
    shift = F.lit(737_000)
    rows = df.select(key, (x - shift).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    slope = F.regr_slope("_y", "_x")
    return (
        rows.groupBy(key)
        .agg(
            slope.alias("slope"),
            F.regr_intercept("_y", "_x").alias("_b"),
            F.regr_r2("_y", "_x").alias("r2"),
            F.regr_count("_y", "_x").alias("n"),
        )
        .select(key, "slope", (F.col("_b") - F.col("slope") * shift).alias("intercept"), "r2", "n")
    )


def forecast(
    model: DataFrame, last_dates: DataFrame, key: str, date: str, horizon: int = 60
) -> DataFrame:
    """The next ``horizon`` days of each key from its fitted line; one small row per key comes in."""
    days = F.sequence(F.date_add(F.col(date), 1), F.date_add(F.col(date), horizon))
    return (
        last_dates.select(key, F.explode(days).alias("day"))
        .join(model, key)
        .select(
            key,
            "day",
            (F.col("intercept") + F.col("slope") * date_ordinal("day")).alias("predicted"),
        )
    )


def split_train_test(df: DataFrame, key: str, share: float = 0.2, seed: int = 42) -> DataFrame:
    """Column ``part`` with ``test`` for about ``share`` of the rows, decided by a hash of the key.

    The same rows fall into the same part on every run, retry and cluster size.
    """
    edge = f"{int(share * 2**32):08x}"
    head = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), 1, 8)
    return df.withColumn("part", F.when(head < edge, "test").otherwise("train"))


def regression_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """R2 in percent, mean absolute and mean squared error."""
    a, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    return (
        df.filter(a.isNotNull() & p.isNotNull())
        .groupBy(*by)
        .agg(
            F.avg(F.abs(a - p)).alias("mae"),
            F.avg((a - p) * (a - p)).alias("mse"),
            F.var_pop(a).alias("_var"),
        )
        .withColumn("r2_percent", (1 - F.try_divide(F.col("mse"), F.col("_var"))) * 100)
        .drop("_var")
    )


# Rows that one task of a boosting round looks at, and fits that run side by side.
ROWS_PER_FIT_TASK, MOST_FITS = 100_000, 8
# Bins of a number in boosted trees, values of a column up to which each is told apart before the trees choose those bins,
# and rows that stand for those of equal bins and label when trees draw rows.
BINS, KNOWN_VALUES, CELL_PARTS = 32, 64, 16


def features(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol="features", handleInvalid="error").transform(df)


def _thresholds(df: DataFrame, cols: Sequence[str]) -> list[list[float]]:
    """Bounds per column: one bin for each of up to ``KNOWN_VALUES`` values, else ``BINS`` of equal frequency."""
    about = df.agg(*[F.approx_count_distinct(c, 0.01) for c in cols]).first()
    many = [c for c, n in zip(cols, about) if n > 2 * KNOWN_VALUES]
    bounds: dict[str, list[float]] = {}
    for c in [c for c in cols if c not in many]:
        values = sorted(r[0] for r in df.select(c).distinct().collect())
        if len(values) > KNOWN_VALUES:
            many.append(c)
        else:
            bounds[c] = [(x + y) / 2 for x, y in zip(values, values[1:])]
    if many:
        ranks = [i / BINS for i in range(1, BINS)]
        bounds.update(zip(many, df.approxQuantile(many, ranks, 1 / (32 * BINS))))
    return [[float("-inf"), *sorted({x for x in bounds[c] if abs(x) < float("inf")}), float("inf")] for c in cols]


HELPERS = ("value", "bin", "at")


def _helpers(kind: str, cols: Sequence[str]) -> list[str]:
    return [f"_{kind}_{i}" for i in range(len(cols))]


def _binned(df: DataFrame, cols: Sequence[str]) -> tuple[list, DataFrame]:
    """Stages that add the bins of ``cols`` as the vector ``_bins``, and the rows of ``df`` with ``_at_<i>``, the bins."""
    values, bins, places = (_helpers(kind, cols) for kind in HELPERS)
    casts = ", ".join(f"CAST(`{c}` AS DOUBLE) AS {v}" for c, v in zip(cols, values))
    cast = SQLTransformer(statement=f"SELECT *, {casts} FROM __THIS__")
    # The assembler stops at a missing number.
    rows = cast.transform(features(df, cols).filter("features IS NOT NULL"))
    cut = Bucketizer(splitsArray=_thresholds(rows, values), inputCols=values, outputCols=bins)
    # A sum is a plain number; what leaves the bucketizer is marked as a category, whose order trees would not heed.
    plain = SQLTransformer(statement=f"SELECT *, {', '.join(f'{b} + 0D AS {p}' for b, p in zip(bins, places))} FROM __THIS__")
    return [cast, cut, plain, VectorAssembler(inputCols=places, outputCol="_bins")], plain.transform(cut.transform(rows))


def _without_helpers(stages: list, model, cols: Sequence[str]) -> PipelineModel:
    """The fitted model behind its bins; it takes rows with ``cols`` and adds what the model adds."""
    helpers = ", ".join(["_bins", *[name for kind in HELPERS for name in _helpers(kind, cols)]])
    return PipelineModel([*stages, model, SQLTransformer(statement=f"SELECT * EXCEPT ({helpers}) FROM __THIS__")])


def _stored_cells(stages: list, cells: DataFrame, order: Sequence[str]) -> DataFrame:
    """Cells in a fixed order, so that a fit can be repeated, in as many partitions as their number needs."""
    cells = materialize(stages[-1].transform(cells).orderBy(*order), "boosting")
    return cells.coalesce(max(1, -(-cells.count() // ROWS_PER_FIT_TASK)))


def boosted_regression(
    df: DataFrame, cols: Sequence[str], y: str, depth: int = 6, step: float = 0.3, rounds: int = 100, seed: int = 42
):
    """Gradient-boosted trees on numeric columns.

    Trees see a number by its bin alone. Rows of equal bins are therefore counted once, before the rounds, and stand as one
    row with their mean and number: squared errors inside such a cell are the same for every tree.
    """
    stages, rows = _binned(df, cols)
    bins = _helpers("at", cols)
    # A missing target becomes NaN, at which the fit stops.
    target = F.coalesce(F.col(y).cast("double"), F.lit(float("nan")))
    cells = _stored_cells(stages, rows.groupBy(*bins).agg(F.avg(target).alias(y), F.count(F.lit(1)).cast("double").alias("_weight")), bins)
    trees = GBTRegressor(
        featuresCol="_bins", labelCol=y, weightCol="_weight", maxDepth=depth, stepSize=step, maxIter=rounds, maxBins=BINS, seed=seed
    )
    return _without_helpers(stages, trees.fit(cells), cols)


def boosted_classifier(
    df: DataFrame,
    cols: Sequence[str],
    label: str,
    depth: int = 6,
    step: float = 0.05,
    rounds: int = 200,
    subsample: float = 0.8,
    seed: int = 42,
):
    """One boosted model per class against the others; every tree sees 0.8 of the rows.

    Trees see a number by its bin alone. Rows of equal bins and label are therefore counted once, before the rounds, and
    stand as up to ``CELL_PARTS`` rows that share their number; each tree draws from those. A cell of no more rows than
    that is drawn row by row. The models of all classes are fitted side by side: a fit is thousands of short jobs, whose
    cost on a small table is that of starting their tasks.
    """
    stages, rows = _binned(df, cols)
    bins = _helpers("at", cols)
    cells = rows.groupBy(*bins, F.col(label).cast("double").alias(label)).agg(F.count(F.lit(1)).alias("_n"))
    parts = F.least("_n", F.lit(CELL_PARTS))
    cells = cells.select("*", parts.alias("_parts"), F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)).alias("_part"))
    share = F.floor(F.col("_n") / F.col("_parts")) + (F.col("_part") < F.col("_n") % F.col("_parts")).cast("int")
    cells = cells.select(*bins, label, "_part", share.cast("double").alias("_weight"))
    cells = _stored_cells(stages, cells, [*bins, label, "_part"])
    last = cells.agg(F.max(label)).first()[0]
    trees = GBTClassifier(
        maxDepth=depth, stepSize=step, maxIter=rounds, maxBins=BINS, subsamplingRate=subsample,
        featureSubsetStrategy=str(0.8), seed=seed,
    )
    side_by_side = min(int(last or 0) + 1, MOST_FITS)
    each = OneVsRest(classifier=trees, featuresCol="_bins", labelCol=label, weightCol="_weight", parallelism=side_by_side)
    return _without_helpers(stages, each.fit(cells), cols)


def class_probabilities(model, df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Probability array per row: the model's own, or the softmax of its class margins."""
    scored = model.transform(features(df, cols))
    if "probability" in scored.columns:
        return scored.withColumn("probability", vector_to_array("probability"))
    return scored.withColumn("probability", softmax(vector_to_array("rawPrediction")))


def softmax_regression(df: DataFrame, cols: Sequence[str], label: str, max_iter: int = 1000):
    """Multinomial regression without penalty, on standardised features."""
    fit = LogisticRegression(
        family="multinomial", regParam=0.0, maxIter=max_iter, featuresCol="features", labelCol=label
    )
    return fit.fit(features(df, cols))


def stratified_folds(
    df: DataFrame, label: str, order: Sequence[str], folds: int, name: str = "fold"
) -> DataFrame:
    """Consecutive folds inside each class, in row order, without shuffling.

    With all rows sorted by class, place ``i`` counts for fold ``i mod folds``; a class gives each fold
    as many of its rows as it has such places, in runs. Classes are taken in order of appearance.
    Places come from the distributed ranking, so one large class is no bottleneck.
    """
    placed = with_group_row_number(df, [label], list(order), "_place")
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(*order)).alias("_first"))
    # One row per class.
    before = Window.orderBy("_first").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(label, "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_s"))
    # Rows of a class that fall to folds 0..f: places p with p mod folds <= f in [start, start + n).
    places = F.sequence(F.lit(0), F.lit(folds - 1))

    def upto(end: Column, f: Column) -> Column:
        return F.floor(end / folds) * (f + 1) + F.least(end % folds, f + 1)

    edges = F.transform(
        places, lambda f: upto(F.col("_s") + F.col("_n"), f) - upto(F.col("_s"), f)
    )
    joined = placed.join(starts.select(label, edges.alias("_edges")), label)
    fold = F.size(F.filter("_edges", lambda e: e <= F.col("_place")))
    return joined.withColumn(name, fold).drop("_edges", "_place")


def cross_validate(
    df: DataFrame, fit: Callable[[DataFrame], object], score: Callable[[object, DataFrame], DataFrame],
    label: str, folds: int, fold: str = "fold",
) -> DataFrame:
    """Accuracy of every fold. ``score(model, rows)`` must add a ``prediction`` column.

    The rows with their folds are written once and read by all fits, which run side by side as jobs of their
    own; only the model and one accuracy per fold come back.
    """
    rows = materialize(df, "folds")
    n = rows.count()
    rows = rows.coalesce(max(1, -(-n // ROWS_PER_FIT_TASK)))

    def accuracy(f: int) -> tuple[int, float | None]:
        model = fit(rows.filter(F.col(fold) != f))
        right = F.avg((F.col("prediction") == F.col(label)).cast("double"))
        return f, score(model, rows.filter(F.col(fold) == f)).agg(right.alias("a")).first()["a"]

    with ThreadPoolExecutor(MOST_FITS) as pool:
        results = list(pool.map(inheritable_thread_target(accuracy), range(folds)))
    return df.sparkSession.createDataFrame(results, "fold int, accuracy double")


def _weights(kind: str) -> Column:
    """Vote of a neighbour. An exact hit silences all others by an infinite weight."""
    if kind == "uniform":
        return F.lit(1.0)
    return F.when(F.col("_exact"), (F.col("distance") == 0).cast("double")).otherwise(
        1 / F.when(F.col("distance") == 0, F.lit(1.0)).otherwise(F.col("distance"))
    )


def knn_classify(
    train: DataFrame,
    queries: DataFrame,
    k: int,
    label: str = "label",
    weights: str = "distance",
    train_id: str = "vec_id",
    query_id: str = "query_id",
    vec: str = "embedding",
) -> DataFrame:
    """Label of each query by the votes of its ``k`` nearest rows; ties go to the smallest label."""
    hits = nearest(train, queries, k, train_id, query_id, vec)
    own = Window.partitionBy("query_id")
    voted = hits.withColumn("_exact", F.min("distance").over(own) == 0)
    labels = train.select(F.col(train_id).alias("store_id"), F.col(label).alias("label"))
    votes = voted.join(labels, "store_id").groupBy("query_id", "label").agg(F.sum(_weights(weights)).alias("w"))
    best = F.min(F.struct((-F.col("w")).alias("neg"), "label"))
    return votes.groupBy("query_id").agg(best.alias("b")).select("query_id", F.col("b.label").alias("label"))


def knn_choose_k(
    train: DataFrame,
    ks: Sequence[int] = range(1, 21),
    label: str = "label",
    train_id: str = "vec_id",
    vec: str = "embedding",
    folds: int = 10,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Mean fold accuracy for every ``k`` with uniform weights.

    One distance job finds the neighbours outside the own fold up to the largest ``k``; all ``k`` are
    scored from the same ranks.
    """
    folded = materialize(stratified_folds(train, label, order or [train_id], folds), "folds")
    hits = nearest(folded, folded, max(ks), train_id, train_id, vec, fold="fold")
    truth = folded.select(F.col(train_id).alias("query_id"), F.col(label).alias("truth"), "fold")
    labels = folded.select(F.col(train_id).alias("store_id"), F.col(label).alias("label"))
    each_k = F.explode(F.array(*[F.lit(k) for k in ks])).alias("k")
    votes = (
        hits.join(labels, "store_id")
        .select("query_id", "label", "rank", each_k)
        .filter(F.col("rank") <= F.col("k"))
        .groupBy("query_id", "k", "label")
        .agg(F.count(F.lit(1)).alias("w"))
    )
    chosen = votes.groupBy("query_id", "k").agg(
        F.min(F.struct((-F.col("w")).alias("neg"), "label"))["label"].alias("label")
    )
    per_fold = (
        chosen.join(truth, "query_id")
        .groupBy("k", "fold")
        .agg(F.avg((F.col("label") == F.col("truth")).cast("double")).alias("accuracy"))
    )
    return per_fold.groupBy("k").agg(F.avg("accuracy").alias("accuracy"))


def best_k(scores: DataFrame) -> int:
    """The first ``k`` with the highest accuracy."""
    return scores.agg(F.min(F.struct((-F.col("accuracy")).alias("neg"), "k"))["k"].alias("k")).first()["k"]


def feedback_update(
    base: DataFrame, new: DataFrame, size: str = "Size", classes: Sequence[str] = tuple(SIZES)
) -> DataFrame:
    """Add user records with a known size to the training table, marked ``UserProvided``."""
    base = add_default_column(base, "UserProvided", False)
    sizes = F.upper(F.trim(F.col(size)))
    users = new.withColumn(size, sizes).filter(F.col(size).isin(*classes))
    users = users.withColumn("UserProvided", F.lit(True))
    return label_encode(append_rows(base, users), size, classes, "Size_encoded")
