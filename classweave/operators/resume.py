"""Cross-validation that survives its driver: every finished fit and every measured fold is kept in a shared folder."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping
from uuid import uuid4

from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from classweave.functions import quoted
from classweave.sources.files import child_names, delete_path, read_text, write_text
from classweave.sources.models import load_model, save_model


def table_fingerprint(df: DataFrame) -> str:
    """A digest of the rows, whatever their order: the same rows have the same one, from one scan.

    Rows are hashed to 64 bits, their sum, their exclusive or and their number
    are taken, so a row more, less or changed shows. Columns of types that
    cannot be hashed raise.
    """
    columns = [F.col(quoted(name)) for name in df.columns]
    # The hash passes over NULL, so which columns hold one is hashed too.
    row = F.xxhash64(*columns, *[c.isNull() for c in columns])
    total = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(row.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).cast("string").alias("sum"),
        F.coalesce(F.bit_xor(row), F.lit(0).cast("bigint")).alias("xor"),
    ).first()
    return _digest({"rows": total.asDict(), "types": df.dtypes})


def estimator_settings(estimator: Estimator) -> dict:
    """What a fit depends on besides its rows: the class and all its parameters."""
    values = {param.name: value for param, value in estimator.extractParamMap().items()}
    return {"class": type(estimator).__name__, "params": {name: str(values[name]) for name in sorted(values)}}


def _digest(value: Mapping) -> str:
    return hashlib.sha256(json.dumps(value, sort_keys=True, default=str).encode()).hexdigest()


class FitLog:
    """Finished fits in a folder, found by a digest of their data, their settings and their fold.

    A fit counts as finished once its entry, a small file of its own, is whole; the entry names the saved pipeline.
    Nothing is overwritten: of two drivers that fit the same, both leave an entry, and either serves.
    """

    def __init__(self, spark: SparkSession, folder: str, data: str, settings: Mapping) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self.common = {"data": data, "settings": settings, "spark": spark.version}

    def key(self, estimator: Estimator, fold: int, **more) -> str:
        return _digest({**self.common, "estimator": estimator_settings(estimator), "fold": fold, **more})

    def _entry(self, key: str) -> dict | None:
        for name in child_names(self.spark, f"{self.folder}/{key}"):
            if name.startswith("entry-"):
                try:
                    return json.loads(read_text(self.spark, f"{self.folder}/{key}/{name}"))
                except ValueError:  # its writer died half-way
                    continue
        return None

    def _note(self, key: str, entry: Mapping) -> None:
        write_text(self.spark, f"{self.folder}/{key}/entry-{uuid4().hex}", json.dumps(entry))

    def fitted(self, key: str) -> PipelineModel | None:
        """The pipeline of an earlier run, if it was finished."""
        entry = self._entry(key)
        return load_model(entry["model"]) if entry else None

    def keep_fit(self, key: str, model: str, fold: int, fitted: PipelineModel) -> None:
        """Save a pipeline that was just fitted, and then its entry."""
        path = f"{self.folder}/{key}/model-{uuid4().hex}"
        try:
            save_model(fitted, path)
        except BaseException:
            delete_path(self.spark, path)
            raise
        self._note(key, {"name": model, "fold": fold, "model": path})

    def measured(self, key: str) -> dict | None:
        """The metrics of an earlier run."""
        entry = self._entry(key)
        return entry["metrics"] if entry else None

    def keep_metrics(self, key: str, model: str, fold: int, metrics: Mapping) -> None:
        self._note(key, {"name": model, "fold": fold, "metrics": dict(metrics)})
