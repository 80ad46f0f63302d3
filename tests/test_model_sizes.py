"""The model queries run the fits at the operators' own size."""

import pytest

import __spark_entry__ as contract
from quern.operators import predict
from tests.conftest import DATA


class Seen(Exception):
    pass


def run(spark, monkeypatch, name, learner):
    """Parameters of the first fit of a query, which is then left."""
    seen = []

    def stop(**settings):
        seen.append(settings)
        raise Seen

    monkeypatch.setattr(predict, learner, stop)
    with pytest.raises(Exception):
        contract.queries()[name](spark, DATA).collect()
    return seen[0]


def test_regression_runs_100_rounds(spark, monkeypatch):
    got = run(spark, monkeypatch, "boosted_regression", "GBTRegressor")
    assert (got["maxIter"], got["maxDepth"], got["stepSize"]) == (100, 6, 0.3)


@pytest.mark.parametrize("name", ["boosted_classifier", "boosted_classifier_bounds", "class_probabilities", "feedback_stream"])
def test_classifiers_run_200_rounds(spark, monkeypatch, name):
    got = run(spark, monkeypatch, name, "GBTClassifier")
    assert (got["maxIter"], got["maxDepth"], got["stepSize"]) == (200, 6, 0.05)


def test_cross_validation_runs_ten_folds(spark, monkeypatch):
    folds = []
    monkeypatch.setattr(predict, "cross_validate", lambda rows, fit, score, label, n: folds.append(n) or fit(rows))
    assert run(spark, monkeypatch, "cross_validate", "LogisticRegression")["maxIter"] == 1000
    assert folds == [10]
