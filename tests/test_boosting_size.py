"""Boosted trees are fitted on counted cells, whose number the rows do not raise."""

import pytest
from pyspark.sql import functions as F

from quern.operators import predict


def rows_of(spark, copies):
    rows = spark.range(400).select((F.col("id") % 20).cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("y"))
    rows = rows.withColumns({"z": 3 * F.col("x") - F.col("y"), "label": (F.col("x") > 9).cast("double")})
    return rows.crossJoin(spark.range(copies).select(F.col("id").alias("copy")))


def fitted_on(monkeypatch, rows, fit):
    """What the fit stores, and its model."""
    stored = []
    real = predict.materialize
    monkeypatch.setattr(predict, "materialize", lambda df, label: stored.append(real(df, label)) or stored[-1])
    model = fit(rows)
    return stored[-1], model


@pytest.mark.parametrize("kind", ["classes", "numbers"])
def test_more_rows_of_the_same_values_give_no_more_cells(spark, monkeypatch, kind):
    def fit(rows):
        if kind == "classes":
            return predict.boosted_classifier(rows, ["x", "y"], "label", 3, 0.3, 2)
        return predict.boosted_regression(rows, ["x", "y"], "z", 5, 0.3, 5)

    few, _ = fitted_on(monkeypatch, rows_of(spark, 10), fit)
    many, _ = fitted_on(monkeypatch, rows_of(spark, 60), fit)
    assert (few.agg(F.sum("_weight")).first()[0], many.agg(F.sum("_weight")).first()[0]) == (4000, 24_000)
    assert many.count() <= 140 * (predict.CELL_PARTS if kind == "classes" else 1)
    assert kind == "numbers" or few.filter("_weight < 1").count() == 0


def test_regression_over_cells_is_that_over_rows(spark):
    from pyspark.ml.regression import GBTRegressor

    # Uneven numbers, so that no two splits of the first rounds are equally good.
    uneven = F.pmod(F.xxhash64("x", "y"), F.lit(1009)) / 100
    rows = rows_of(spark, 3).withColumn("z", F.col("z") + uneven + F.col("copy") * F.col("y"))
    plain = GBTRegressor(featuresCol="features", labelCol="z", maxDepth=4, stepSize=0.3, maxIter=3, seed=42)
    whole = predict.features(rows, ["x", "y"])
    want = {(r["x"], r["y"]): r["prediction"] for r in plain.fit(whole).transform(whole).collect()}
    found = predict.boosted_regression(rows, ["x", "y"], "z", 4, 0.3, 3).transform(whole)
    assert set(found.columns) == {*whole.columns, "prediction"}
    for r in found.collect():
        assert r["prediction"] == pytest.approx(want[r["x"], r["y"]], abs=1e-6)


def test_missing_numbers_still_stop_the_fit(spark):
    rows = spark.createDataFrame([(1.0, 2.0), (2.0, None), (3.0, 1.0)], "x double, z double")
    with pytest.raises(Exception):
        predict.boosted_regression(rows, ["x"], "z", 2, 0.3, 2)
    with pytest.raises(Exception):
        predict.boosted_regression(rows, ["z"], "x", 2, 0.3, 2)


def test_columns_of_many_values_are_cut_into_bins_of_equal_frequency(spark):
    rows = spark.range(20_000).select((F.col("id") * F.col("id")).cast("double").alias("x"), (F.col("id") % 2 == 0).alias("b"))
    bounds = predict._thresholds(rows.withColumn("b", F.col("b").cast("double")), ["x", "b"])
    assert len(bounds[0]) == predict.BINS + 1 and bounds[1] == [float("-inf"), 0.5, float("inf")]
