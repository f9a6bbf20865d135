"""Fitted pipelines on disk."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from classweave.sources.files import delete_path, path_exists, read_text, recover, sibling, swap_in, write_text

#: The file beside a model that says which columns it reads; readers of the folder pass over it.
CONTRACT = "_contract.json"


def _session() -> SparkSession:
    """The session, also in a thread that fits one fold of several."""
    return SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()


def save_model(model: PipelineModel, path: str) -> None:
    """Write the fitted pipeline, replacing what is at `path`, and beside it the columns that it expects.

    Like a table, it is written elsewhere first, so a failure leaves the old model as it was.
    """
    from classweave.operators.contract import contract_from, to_text

    spark = _session()
    recover(spark, path)
    fresh = sibling(spark, path, "new")
    try:
        model.write().save(fresh)
        if contract_from(model):
            write_text(spark, f"{fresh}/{CONTRACT}", to_text(contract_from(model)))
        swap_in(spark, fresh, path)
    finally:
        delete_path(spark, fresh)


def load_model(path: str) -> PipelineModel:
    """The saved pipeline, with its contract if it has one."""
    from classweave.operators.contract import attach, from_text

    spark = _session()
    model = PipelineModel.load(path)
    beside = f"{path}/{CONTRACT}"
    return attach(model, from_text(read_text(spark, beside))) if path_exists(spark, beside) else model
