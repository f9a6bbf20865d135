"""Batch scoring with a fitted pipeline, and readable result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from classweave.functions import class_probability, quoted, require_columns
from classweave.operators.contract import check_features, contract_from
from classweave.operators.features import label_stage
from classweave.sources import load_model


def batch_score(df: DataFrame, model: PipelineModel | str, keep_cols: Sequence[str] = ()) -> DataFrame:
    """(keep_cols..., prediction, probability) for every row; `model` may be a path.

    Without `keep_cols` the result has no key. The target is not needed: it is
    dropped unless kept, and its values are never checked. Features must have
    the names and kinds of type that the model was trained on.
    """
    require_columns(df, *keep_cols)
    if isinstance(model, str):
        model = load_model(model)
    check_features(df, contract_from(model))
    target = label_stage(model).getInputCol()
    features = df if target in keep_cols else df.drop(target)
    return model.transform(features).select(*[F.col(quoted(c)) for c in keep_cols], "prediction", "probability")


def prediction_view(
    df: DataFrame,
    positive_index: int = 1,
    probability_name: str = "Heart_Attack_Probability",
    class_name: str = "Predicted_Class",
    keep_cols: Sequence[str] = (),
) -> DataFrame:
    """Scored rows as P(positive) with four places and the class as an integer.

    `positive_index` is the place of the positive class in the probability
    vector; `features.positive_index` looks it up in a model.
    """
    require_columns(df, "prediction", "probability", *keep_cols)
    return df.select(
        *[F.col(quoted(c)) for c in keep_cols],
        class_probability("probability", positive_index).alias(probability_name),
        F.col("prediction").cast("int").alias(class_name),
    )


def prediction_sample(df: DataFrame, order_by: Sequence[str] = (), n: int = 20) -> DataFrame:
    """n rows of a view, the first by `order_by` where given, else any."""
    require_columns(df, *order_by)
    return (df.orderBy(*[F.col(quoted(c)) for c in order_by]) if order_by else df).limit(n)


def prediction_distribution(df: DataFrame, class_name: str = "Predicted_Class") -> DataFrame:
    """(class, count): rows per predicted class."""
    require_columns(df, class_name)
    return df.groupBy(F.col(quoted(class_name)).alias(class_name)).agg(F.count(F.lit(1)).alias("count"))
