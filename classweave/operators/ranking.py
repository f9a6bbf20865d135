"""Feature selection by the importances of a weighted forest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from classweave.functions import quoted, require_columns
from classweave.operators.balance import TARGET, WEIGHT
from classweave.operators.estimators import ranking_forest
from classweave.operators.features import build_pipeline, column_roles


def stable_layout(df: DataFrame, key: str | Sequence[str], partitions: int | None = None) -> DataFrame:
    """Spread the rows by a unique key and sort each partition by it, at the price of one shuffle.

    Seeded forests draw per partition, so a table read from other files gives
    another forest. With a fixed number of `partitions` the layout, and so the
    forest, depends on the rows alone. Without it Spark picks the number, which
    still spreads a table that sits in too few files to keep the cores busy.
    """
    keys = [F.col(quoted(k)) for k in ([key] if isinstance(key, str) else key)]
    spread = df.repartition(*keys) if partitions is None else df.repartition(partitions, *keys)
    return spread.sortWithinPartitions(*keys)


def rank_features(
    df: DataFrame,
    target: str = TARGET,
    weight: str | None = WEIGHT,
    exclude: Sequence[str] = (),
    estimator: Estimator | None = None,
    invalid: str = "skip",
    wide: Sequence[str] = (),
) -> DataFrame:
    """(rank, feature, score), best first; equal scores keep the vector's order.

    Scores sum to 1. Rows with a NULL category are left out of the fit. The
    importances have one number per feature, and are paired with the source
    columns by slot, not by name. The ranking has seen every row of `df`, which
    a later cross-validation over the same rows cannot undo.
    """
    roles = column_roles(df, target, weight, exclude)
    estimator = estimator or ranking_forest(weight)
    model = build_pipeline(df, estimator, target, weight, exclude, invalid, wide=wide).fit(df)
    importances = model.stages[-1].featureImportances.toArray()
    ranked = sorted(zip(roles.features, importances.tolist()), key=lambda pair: -pair[1])
    rows = [(rank, feature, score) for rank, (feature, score) in enumerate(ranked, start=1)]
    return df.sparkSession.createDataFrame(rows, "rank int, feature string, score double")


def top_features(ranking: DataFrame, k: int = 15) -> DataFrame:
    """The k best rows of a ranking."""
    return ranking.filter(F.col("rank") <= k)


def top_names(ranking: DataFrame, k: int = 15) -> list[str]:
    """Names of the k best features in rank order."""
    return [row.feature for row in top_features(ranking, k).orderBy("rank").collect()]


def project_top(
    df: DataFrame,
    features: Sequence[str],
    target: str = TARGET,
    weight: str | None = WEIGHT,
    keep_cols: Sequence[str] = (),
) -> DataFrame:
    """Keys, target, weight, then the features in rank order, which becomes the next slot order."""
    names = [*keep_cols, target, *([weight] if weight else []), *features]
    require_columns(df, *names)
    return df.select(*[F.col(quoted(n)) for n in names])
