"""MLlib classifiers with this library's defaults; keyword arguments override any parameter."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier

from classweave.operators.balance import WEIGHT
from classweave.operators.features import FEATURES, LABEL

# The hyperparameters that results are to be compared under.
RANKING_FOREST = {"numTrees": 20, "maxDepth": 5, "maxBins": 64, "seed": 42}
LOGISTIC = {"maxIter": 50, "regParam": 0.01, "elasticNetParam": 0.0}
FOREST = {"numTrees": 50, "maxDepth": 10, "maxBins": 64, "seed": 42}
BOOSTED = {"maxIter": 50, "maxDepth": 5, "stepSize": 0.1, "seed": 42}


def _make(classifier, defaults: dict, weight: str | None, params: dict):
    columns = {"featuresCol": FEATURES, "labelCol": LABEL}
    if weight is not None:
        columns["weightCol"] = weight
    return classifier(**{**columns, **defaults, **params})


def ranking_forest(weight: str | None = WEIGHT, **params) -> RandomForestClassifier:
    """A small forest whose importances rank the features."""
    return _make(RandomForestClassifier, RANKING_FOREST, weight, params)


def logistic(weight: str | None = WEIGHT, **params) -> LogisticRegression:
    """Ridge logistic regression; category indices enter as plain numbers."""
    return _make(LogisticRegression, LOGISTIC, weight, params)


def forest(weight: str | None = WEIGHT, **params) -> RandomForestClassifier:
    return _make(RandomForestClassifier, FOREST, weight, params)


def boosted(weight: str | None = WEIGHT, max_bins: int = 32, **params) -> GBTClassifier:
    """Gradient-boosted trees. Raise `max_bins` for strings with more than 31 values."""
    return _make(GBTClassifier, BOOSTED, weight, {"maxBins": max_bins, **params})
