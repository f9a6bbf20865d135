"""Cross-validation folds as a column: disjoint and complete by construction."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from classweave.functions import hash_fold, quoted, require_columns

FOLD = "fold"


def hash_folds(df: DataFrame, key: str | Sequence[str], k: int = 10, seed: int = 42, fold: str = FOLD) -> DataFrame:
    """Add a fold number that depends on the key alone. See `functions.hash_fold`."""
    require_columns(df, *([key] if isinstance(key, str) else key))
    return df.withColumn(fold, hash_fold(key, k, seed))


def _sortable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.ArrayType):
        return _sortable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(_sortable(f.dataType) for f in data_type.fields)
    return not isinstance(data_type, (T.MapType, T.VariantType))


def random_folds(df: DataFrame, k: int = 10, seed: int = 42, fold: str = FOLD) -> DataFrame:
    """Add a random fold number: the rows of table i of an even `randomSplit` get i.

    `randomSplit` yields k tables, each of which scans and sorts the input
    again. Here one draw per row decides, after the same sort inside each
    partition. Like `randomSplit`, the folds depend on the partitioning of
    `df`, are not stratified, and are only about equal in size.
    """
    order = [F.col(quoted(f.name)) for f in df.schema.fields if _sortable(f.dataType)]
    drawn = df.sortWithinPartitions(*order).withColumn("_draw", F.rand(seed))
    number = F.lit(k - 1)
    for i, bound in reversed(list(enumerate(accumulate([1 / k] * (k - 1))))):
        number = F.when(F.col("_draw") < bound, i).otherwise(number)
    return drawn.withColumn(fold, number.cast("int")).drop("_draw")


def fold_assembly(df: DataFrame, i: int, fold: str = FOLD, checked: bool = False) -> tuple[DataFrame, DataFrame]:
    """(train, test): all rows outside fold i, and the rows inside it.

    A row whose fold is NULL belongs to neither, so reading the training rows
    raises on it. Say `checked` where no fold is NULL: the filter then reaches
    the scan.
    """
    number = F.col(quoted(fold))
    outside = number != i
    if not checked:
        missing = F.raise_error(F.lit(f"{fold} is NULL in some rows")).cast("boolean")
        outside = F.when(number.isNull(), missing).otherwise(outside)
    return df.filter(outside), df.filter(number == i)


def fold_sizes(df: DataFrame, fold: str = FOLD) -> DataFrame:
    """(fold, train_rows, test_rows): what every fold trains on and is tested on."""
    require_columns(df, fold)
    sizes = df.groupBy(F.col(quoted(fold)).alias("fold")).agg(F.count(F.lit(1)).alias("test_rows"))
    total = sizes.agg(F.sum("test_rows")).scalar()
    return sizes.select("fold", (total - F.col("test_rows")).alias("train_rows"), "test_rows")
