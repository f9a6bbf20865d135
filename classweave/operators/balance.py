"""Class weights for an imbalanced binary target."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from classweave.functions import quoted, require_columns

TARGET = "HadHeartAttack"
WEIGHT = "classWeight"


def _counts(df: DataFrame, target: str, positive, negative) -> DataFrame:
    require_columns(df, target)
    value = F.col(quoted(target))
    return df.agg(
        F.count_if(value == F.lit(positive)).alias("n_positive"),
        F.count_if(value == F.lit(negative)).alias("n_negative"),
    )


def class_ratio(df: DataFrame, target: str = TARGET, positive="Yes", negative="No") -> DataFrame:
    """(n_positive, n_negative, ratio): negatives per positive, from one scan.

    A table without positives has no ratio; evaluating it raises.
    """
    undefined = F.raise_error(F.lit(f"no row has {target} = {positive}: the class ratio is undefined"))
    ratio = F.col("n_negative").cast("double") / F.col("n_positive")
    return _counts(df, target, positive, negative).withColumn(
        "ratio", F.when(F.col("n_positive") == 0, undefined.cast("double")).otherwise(ratio)
    )


def with_class_weight(
    df: DataFrame,
    target: str = TARGET,
    positive="Yes",
    negative="No",
    weight: str = WEIGHT,
    lazy: bool = False,
) -> DataFrame:
    """Add the weight column: the class ratio for positives, 1.0 for all else, NULL included.

    The ratio is taken over all rows of `df`, also those that later become test
    folds. By default it is computed at once and becomes a literal; with `lazy`
    it stays a scalar subquery in one plan.
    """
    if lazy:
        ratio = class_ratio(df, target, positive, negative).select("ratio").scalar()
    else:
        n_positive, n_negative = _counts(df, target, positive, negative).first()
        if n_positive == 0:
            raise ValueError(f"no row has {target} = {positive}: the class ratio is undefined")
        ratio = F.lit(n_negative / n_positive)
    is_positive = F.col(quoted(target)) == F.lit(positive)
    return df.withColumn(weight, F.when(is_positive, ratio).otherwise(F.lit(1.0)))


def weight_totals(df: DataFrame, target: str = TARGET, weight: str = WEIGHT) -> DataFrame:
    """(target, n_rows, total_weight): after weighting, both classes weigh the same."""
    require_columns(df, target, weight)
    return df.groupBy(F.col(quoted(target)).alias(target)).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col(quoted(weight))).alias("total_weight")
    )
