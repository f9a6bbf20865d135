"""String columns with very many values as a pipeline stage: indices by joining with a category table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession

from classweave.operators.categories import index_by_table, write_category_table, write_ranked_counts, write_share_table
from classweave.operators.features import Roles, category_shares
from classweave.sources.staging import fresh_path


class CategoryIndexer(Transformer, MLWritable, MLReadable):
    """Adds the index of each input column by joining with the category table at a path.

    A saved indexer holds a copy of its table and reads that when it is loaded.
    """

    inputCols = Param(Params._dummy(), "inputCols", "string columns", TypeConverters.toListString)
    outputCols = Param(Params._dummy(), "outputCols", "their indices", TypeConverters.toListString)
    handleInvalid = Param(Params._dummy(), "handleInvalid", "keep, skip or error", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols: list[str] = (), outputCols: list[str] = (), handleInvalid: str = "keep") -> None:
        super().__init__()
        self._set(inputCols=list(inputCols), outputCols=list(outputCols), handleInvalid=handleInvalid)
        self.table_path: str | None = None

    def _table(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.table_path)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        table = self._table(dataset.sparkSession)
        names, outputs = self.getOrDefault("inputCols"), self.getOrDefault("outputCols")
        return index_by_table(dataset, table, names, outputs, self.getOrDefault("handleInvalid"))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, instance: CategoryIndexer) -> None:
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance._table(self.sparkSession).write.parquet(f"{path}/table")


class _Reader(MLReader):
    def __init__(self, cls: type[CategoryIndexer]) -> None:
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> CategoryIndexer:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        indexer = self.cls()
        indexer._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(indexer, metadata)
        indexer.table_path = f"{path}/table"
        return indexer


def _indexer(roles: Roles, wide: Sequence[str], invalid: str, path: str) -> CategoryIndexer:
    outputs = [roles.indexed[roles.strings.index(name)] for name in wide]
    indexer = CategoryIndexer(inputCols=list(wide), outputCols=outputs, handleInvalid=invalid)
    indexer.table_path = path
    return indexer


def fit_category_indexer(
    df: DataFrame, roles: Roles, wide: Sequence[str], invalid: str, positive: str | None = None, weight: str | None = None
) -> CategoryIndexer:
    """The stage for the wide columns of `df`; its table lies in the shared folder until the model is saved.

    With `positive` the categories are ordered by that class's share of their weight.
    """
    if positive is not None:
        return indexer_of_shares(category_shares(df, wide, roles.target, positive, weight), roles, wide, invalid)
    path = fresh_path(df.sparkSession, "categories")
    write_category_table(df, wide, path)
    return _indexer(roles, wide, invalid, path)


def indexer_of_shares(shares: DataFrame, roles: Roles, wide: Sequence[str], invalid: str) -> CategoryIndexer:
    """The stage for categories whose shares are known: (column, value, n, positive, total)."""
    path = fresh_path(shares.sparkSession, "categories")
    write_share_table(shares, path)
    return _indexer(roles, wide, invalid, path)


def only(indexer: CategoryIndexer | None, columns: Sequence[str]) -> CategoryIndexer | None:
    """The same stage for those of its columns that are among `columns`; None if none is."""
    if indexer is None:
        return None
    pairs = [p for p in zip(indexer.getOrDefault("inputCols"), indexer.getOrDefault("outputCols")) if p[0] in columns]
    if not pairs:
        return None
    inputs, outputs = zip(*pairs)
    fewer = CategoryIndexer(inputCols=list(inputs), outputCols=list(outputs), handleInvalid=indexer.getOrDefault("handleInvalid"))
    fewer.table_path = indexer.table_path
    return fewer


def indexer_of_counts(counts: DataFrame, roles: Roles, wide: Sequence[str], invalid: str) -> CategoryIndexer:
    """The same from counts (column, value, n)."""
    path = fresh_path(counts.sparkSession, "categories")
    write_ranked_counts(counts, path)
    return _indexer(roles, wide, invalid, path)
