"""Quality of binary predictions, for a whole table or for every group of it.

All figures come from one chain of aggregates over the predictions: rows are
counted per distinct score before anything is sorted, so a score shared by a
third of all rows is a single row from there on.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from classweave.functions import quoted, require_columns
from classweave.sources.staging import fresh_path, staged

METRICS = ("accuracy", "precision", "recall", "f1", "auc")
_CELLS = ("tp", "fp", "tn", "fn")


def confusion_matrix(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """(by..., label, prediction, n): rows per combination."""
    require_columns(df, label, prediction, *by)
    keys = [F.col(quoted(b)).alias(b) for b in by]
    return df.groupBy(
        *keys, F.col(quoted(label)).alias("label"), F.col(quoted(prediction)).alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))


def _cells_by_score(df: DataFrame, label: str, prediction: str | None, score: str, by: Sequence[str]) -> DataFrame:
    """(by..., score, n, tp, fp, tn, fn) per distinct score; without a prediction tp and fn are lumped in tp."""
    is_one = F.col(quoted(label)) == 1
    is_zero = F.col(quoted(label)) == 0
    if prediction is None:
        says_one = F.lit(True)
        says_zero = F.lit(False)
    else:
        says_one = F.col(quoted(prediction)) == 1
        says_zero = F.col(quoted(prediction)) == 0
    keys = [F.col(quoted(b)).alias(b) for b in by]
    return df.groupBy(*keys, F.col(quoted(score)).alias("score")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(is_one & says_one).alias("tp"),
        F.count_if(is_zero & says_one).alias("fp"),
        F.count_if(is_zero & says_zero).alias("tn"),
        F.count_if(is_one & says_zero).alias("fn"),
    )


def _ranked_cells(cells: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by..., n, tp, fp, tn, fn, wins): wins counts the pairs in which a positive outscores a negative.

    A tie is half a win. Distinct scores are range-partitioned; every partition
    counts its own wins with a running sum, and its positives also beat all
    negatives of the partitions before it. Per group one row per partition is
    left for that last step.
    """
    positives = F.col("tp") + F.col("fn")
    negatives = F.col("fp") + F.col("tn")
    ranged = cells.repartitionByRange(*by, "score").withColumn("part", F.spark_partition_id())
    within = Window.partitionBy(*by, "part").orderBy("score").rowsBetween(Window.unboundedPreceding, 0)
    beaten = F.sum(negatives).over(within).cast("double") - negatives / 2.0
    parts = (
        ranged.withColumn("wins", positives * beaten)
        .groupBy(*by, "part")
        .agg(*[F.sum(c).alias(c) for c in ("n", *_CELLS, "wins")])
    )
    before = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    lower = F.coalesce(F.sum(negatives).over(before), F.lit(0)).cast("double")
    return (
        parts.withColumn("wins", F.col("wins") + positives * lower)
        .groupBy(*by)
        .agg(*[F.sum(c).alias(c) for c in ("n", *_CELLS, "wins")])
    )


_ID_BITS = 33


def _binned_cells(cells: DataFrame, by: Sequence[str], num_bins: int) -> DataFrame:
    """Cells of chunks of neighbouring scores in place of the scores: about `num_bins` for each group.

    A group with m distinct scores has chunks of m div `num_bins`, from the
    highest score down, the last may be smaller; with less than two per chunk
    it stays as it is. The order is a range-partitioned sort, and a score's
    place in it is its place in the partition plus the sizes of the partitions
    before, so no group passes through one task.
    """
    spark = cells.sparkSession
    path = fresh_path(spark, "chunks")
    in_order = cells.orderBy(*by, F.desc("score")).withColumn("id", F.monotonically_increasing_id())
    with staged(in_order) as kept:
        part = F.shiftright("id", _ID_BITS)
        numbered = kept.withColumn("part", part).withColumn("at", F.col("id") - F.shiftleft(part, _ID_BITS))
        # One row per partition of the sort and group.
        sizes = numbered.groupBy(*by, "part").agg(F.count(F.lit(1)).alias("size"), F.min("at").alias("first"))
        earlier = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        group = [f"_group{i}" for i in range(len(by))]
        starts = sizes.select(
            *[F.col(quoted(b)).alias(g) for b, g in zip(by, group)],
            F.col("part").alias("_part"),
            (F.coalesce(F.sum("size").over(earlier), F.lit(0)) - F.col("first")).alias("start"),
            F.floor(F.sum("size").over(Window.partitionBy(*by)) / num_bins).alias("grouping"),
        )
        # Groups may be NULL, and NULL joins only by this comparison.
        same = [F.col(quoted(b)).eqNullSafe(F.col(g)) for b, g in zip(by, group)] + [F.col("part") == F.col("_part")]
        chunk = -F.floor((F.col("start") + F.col("at")) / F.greatest(F.col("grouping"), F.lit(1)))
        joined = numbered.join(F.broadcast(starts), reduce(and_, same))
        placed = joined.select(*by, chunk.cast("double").alias("score"), "n", *_CELLS)
        placed.groupBy(*by, "score").agg(*[F.sum(c).alias(c) for c in ("n", *_CELLS)]).write.parquet(path)
    return spark.read.parquet(path)


def _ratio(above: Column, below: Column) -> Column:
    """above / below, 0 when nothing is below: a class never predicted has precision 0."""
    return F.coalesce(F.try_divide(above.cast("double"), below.cast("double")), F.lit(0.0))


def _auc() -> Column:
    pairs = (F.col("tp") + F.col("fn")).cast("double") * (F.col("fp") + F.col("tn")).cast("double")
    return F.try_divide(F.col("wins"), pairs)


def _checked(totals: DataFrame) -> DataFrame:
    counted = F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")
    bad = F.raise_error(F.lit("labels and predictions must be 0 or 1, and not NULL"))
    return totals.withColumn("n", F.when(counted != F.col("n"), bad.cast("bigint")).otherwise(F.col("n")))


def metrics_table(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    score: str = "score",
    by: Sequence[str] = (),
    num_bins: int | None = None,
) -> DataFrame:
    """(by..., n_rows, accuracy, precision, recall, f1, auc), unweighted by class weight.

    Precision, recall and F1 are the averages of both classes weighted by their
    support, so recall equals accuracy. AUC is exact, ties included, and NULL
    for a group with one class only; with `num_bins` it is the binned one of
    `roc_auc`. For figures of the positive class see `positive_class_metrics`.
    """
    require_columns(df, label, prediction, score, *by)
    cells = _cells_by_score(df, label, prediction, score, by)
    if num_bins is not None:
        cells = _binned_cells(cells, by, num_bins)
    return weighted_metrics(_checked(_ranked_cells(cells, by)), by)


def weighted_metrics(totals: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The metrics of rows of (by..., n, tp, fp, tn, fn, wins)."""
    tp, fp, tn, fn, n = (F.col(c) for c in (*_CELLS, "n"))
    ones, zeros = tp + fn, tn + fp
    precision_one, precision_zero = _ratio(tp, tp + fp), _ratio(tn, tn + fn)
    # 2pr / (p + r) in counts.
    f1_one, f1_zero = _ratio(2 * tp, 2 * tp + fp + fn), _ratio(2 * tn, 2 * tn + fp + fn)
    return totals.select(
        *by,
        n.alias("n_rows"),
        F.try_divide(tp + tn, n).alias("accuracy"),
        F.try_divide(ones * precision_one + zeros * precision_zero, n).alias("precision"),
        F.try_divide(tp + tn, n).alias("recall"),
        F.try_divide(ones * f1_one + zeros * f1_zero, n).alias("f1"),
        _auc().alias("auc"),
    )


def positive_class_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """(by..., positive_precision, positive_recall, positive_f1), which the weighted averages hide."""
    matrix = confusion_matrix(df, label, prediction, by)
    one, says_one = F.col("label") == 1, F.col("prediction") == 1

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    tp, fp, fn = total(one & says_one), total(~one & says_one), total(one & ~says_one)
    return matrix.groupBy(*by).agg(
        _ratio(tp, tp + fp).alias("positive_precision"),
        _ratio(tp, tp + fn).alias("positive_recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("positive_f1"),
    )


def long_metrics(table: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., n_rows, metric, value): one row per metric, NULL values kept."""
    return table.unpivot([*by, "n_rows"], list(METRICS), "metric", "value")


def roc_auc(
    df: DataFrame,
    label: str = "label",
    score: str = "score",
    by: Sequence[str] = (),
    num_bins: int | None = None,
) -> DataFrame:
    """(by..., auc): exact by default, as the share of positive-negative pairs in the right order.

    With `num_bins` the curve has about that many points, as MLlib's evaluator
    draws it (its own default is 1000): chunks of neighbouring distinct scores
    count as ties. That differs from the exact area by a little. The evaluator
    begins its chunks anew in every partition; here they depend on the scores
    alone, and agree with it where it has a single partition.
    """
    require_columns(df, label, score, *by)
    cells = _cells_by_score(df, label, None, score, by)
    if num_bins is not None:
        cells = _binned_cells(cells, by, num_bins)
    return _checked(_ranked_cells(cells, by)).select(*by, _auc().alias("auc"))
