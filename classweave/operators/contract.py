"""What a model expects of a table: the names, types and roles of its columns, kept beside it and checked before scoring."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from classweave.operators.features import Roles


@dataclass(frozen=True)
class Expected:
    """One column: its name, its type at training, what it is (feature or target) and the slot it fills."""

    column: str
    type: str
    role: str
    slot: int | None


def _kind(data_type: T.DataType) -> str:
    """What may stand for what: any number for another, for a vector holds doubles; but no text, truth value or date."""
    if isinstance(data_type, T.BooleanType):
        return "boolean"
    if isinstance(data_type, T.NumericType):
        return "number"
    if isinstance(data_type, T.StringType):
        return "string"
    return data_type.simpleString()


def contract_of(df: DataFrame, roles: Roles) -> list[Expected]:
    """The columns that a pipeline with these roles reads from tables like `df`."""
    found = [Expected(name, df.schema[name].dataType.simpleString(), "feature", i) for i, name in enumerate(roles.features)]
    return [*found, Expected(roles.target, df.schema[roles.target].dataType.simpleString(), "target", None)]


def attach(model: PipelineModel, contract: Sequence[Expected]) -> PipelineModel:
    """`model`, which from here on knows its contract."""
    model.contract = list(contract)
    return model


def contract_from(model: PipelineModel) -> list[Expected]:
    """The contract of a model; empty for one that was fitted or saved without."""
    return getattr(model, "contract", [])


def to_text(contract: Sequence[Expected]) -> str:
    return json.dumps([asdict(x) for x in contract])


def from_text(text: str) -> list[Expected]:
    return [Expected(**x) for x in json.loads(text)]


def check_features(df: DataFrame, contract: Sequence[Expected]) -> None:
    """Raise unless `df` has every feature under its very name and with its kind of type. The target is not needed."""
    fields = {f.name: f for f in df.schema.fields}
    for wanted in (x for x in contract if x.role == "feature"):
        if wanted.column not in fields:
            alike = [name for name in fields if name.lower() == wanted.column.lower()]
            hint = f"; it has {alike[0]!r}, which is spelt otherwise" if alike else ""
            raise ValueError(f"the model needs feature {wanted.column!r} ({wanted.type}), which the table lacks{hint}")
        own = fields[wanted.column].dataType
        kind = _kind(T._parse_datatype_string(wanted.type))
        if _kind(own) != kind:
            raise ValueError(f"feature {wanted.column!r} is {own.simpleString()}, the model was trained on {wanted.type}")


def feature_contract(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """(column, type, role, slot): what the model reads, features in the order of their slots."""
    rows = [(x.column, x.type, x.role, x.slot) for x in contract_from(model)]
    return spark.createDataFrame(rows, "column string, type string, role string, slot int")
