"""One function per stage. Stages hand over through tables and saved models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from classweave.operators import estimators, scoring
from classweave.operators.balance import TARGET, WEIGHT, with_class_weight
from classweave.operators.features import fit_pipeline, positive_index
from classweave.operators.profile import balance_of, class_counts, column_profile, imbalance_of
from classweave.operators.ranking import project_top, rank_features, top_names
from classweave.operators.validation import cross_validate, cv_summary
from classweave.sources import load_model, read_parquet, save_model, write_parquet
from classweave.sources.staging import fresh_path

ESTIMATORS = {"lr": estimators.logistic, "rf": estimators.forest, "gbt": estimators.boosted}


def audit(df: DataFrame, target: str = TARGET, threshold: float = 15.0) -> dict[str, DataFrame]:
    """The reports on a raw table.

    The table is scanned twice, once for its columns and once for its classes.
    What comes back is one row per column and per class, and the reports are
    taken from those.
    """
    spark = df.sparkSession
    by_column = column_profile(df)
    columns = spark.createDataFrame(by_column.collect(), by_column.schema)
    # A column mistaken for the target may have very many values, so these stay in a table.
    path = fresh_path(spark, "classes")
    class_counts(df, target).write.parquet(path)
    classes = read_parquet(spark, path)
    return {
        "shape": columns.agg(F.max("n_rows").alias("n_rows"), F.count(F.lit(1)).cast("int").alias("n_columns")),
        "schema": columns.select("position", "column", "type", "nullable", "n_values"),
        "missing": columns.filter("n_missing > 0").select("column", "n_missing"),
        "balance": balance_of(classes),
        "imbalance": imbalance_of(classes, threshold),
    }


def weigh_table(df: DataFrame, output: str, target: str = TARGET, positive: str = "Yes", negative: str = "No") -> None:
    """Write the table with its class weights."""
    write_parquet(with_class_weight(df, target, positive, negative), output)


def select_features(
    df: DataFrame,
    output: str,
    target: str = TARGET,
    k: int = 15,
    keep_cols: Sequence[str] = (),
    weight: str | None = WEIGHT,
    exclude: Sequence[str] = (),
    **options,
) -> DataFrame:
    """Rank the features of a weighted table, write target, weight and the best k; return the ranking.

    `options` are those of `rank_features`: invalid, wide, estimator.
    """
    ranking = rank_features(df, target, weight, [*exclude, *keep_cols], **options)
    write_parquet(project_top(df, top_names(ranking, k), target, weight, keep_cols), output)
    return ranking


def train_model(
    df: DataFrame,
    kind: str,
    model_path: str,
    target: str = TARGET,
    key: Sequence[str] = (),
    k: int = 10,
    seed: int = 42,
    parallelism: int = 1,
    auc_bins: int | None = None,
    weight: str | None = WEIGHT,
    exclude: Sequence[str] = (),
    invalid: str = "keep",
    wide: Sequence[str] = (),
    max_categories: int | None = None,
    **params,
) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """Cross-validate, refit on all rows, save; return (model, fold metrics, their summary).

    `kind` is lr, rf or gbt; `params` override the classifier's parameters.
    """
    estimator = ESTIMATORS[kind](**params)
    features = {"weight": weight, "invalid": invalid, "wide": wide, "max_categories": max_categories}
    metrics = cross_validate(
        df,
        estimator,
        kind,
        target,
        key=list(key) or None,
        k=k,
        seed=seed,
        parallelism=parallelism,
        auc_bins=auc_bins,
        exclude=exclude,
        **features,
    )
    model = fit_pipeline(df, estimator, target=target, exclude=[*exclude, *key], **features)
    save_model(model, model_path)
    return model, metrics, cv_summary(metrics)


def score_table(df: DataFrame, model_path: str, output: str, keep_cols: Sequence[str] = ()) -> None:
    """Write prediction and probability for every row."""
    write_parquet(scoring.batch_score(df, model_path, keep_cols), output)


def view_predictions(
    spark: SparkSession,
    scored_path: str,
    model_path: str | None = None,
    positive: str = "Yes",
    keep_cols: Sequence[str] = (),
) -> dict[str, DataFrame]:
    """The readable table, a sample of it, and the rows per predicted class.

    With `model_path` the place of the positive class is looked up in the
    model; otherwise it is taken to be 1, as for the rarer class.
    """
    index = positive_index(load_model(model_path), positive) if model_path else 1
    view = scoring.prediction_view(read_parquet(spark, scored_path), index, keep_cols=keep_cols)
    return {
        "view": view,
        "sample": scoring.prediction_sample(view, keep_cols),
        "distribution": scoring.prediction_distribution(view),
    }
