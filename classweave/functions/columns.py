"""Column expressions: everything here stays inside Catalyst and codegen."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> str:
    """Column name as one identifier, also when it holds dots or backticks."""
    return "`" + name.replace("`", "``") + "`"


def require_columns(df: DataFrame, *names: str) -> None:
    """Raise ValueError for the first name that is not a column of `df`."""
    for name in names:
        if name not in df.columns:
            raise ValueError(f"column {name!r} not found; the table has {', '.join(df.columns)}")


def is_missing(field: T.StructField) -> Column:
    """True where the field is NULL, NaN, or text that reads as NaN.

    `isnan` only applies to numbers. Text goes through `try_cast`, so that
    ANSI mode does not raise on ordinary words; as a failed cast is slow, only
    text that contains "nan" is cast. All other types can only be NULL.
    """
    value = F.col(quoted(field.name))
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return F.isnan(value) | value.isNull()
    if isinstance(field.dataType, T.StringType):
        reads_as_nan = F.lower(value).contains("nan") & F.coalesce(F.isnan(value.try_cast("double")), F.lit(False))
        return value.isNull() | reads_as_nan
    return value.isNull()


def class_score(vector: str | Column, index: int = 1) -> Column:
    """Element `index` of an ML vector, NULL when the vector is shorter.

    A forest trained on a single class yields one-element vectors, for which
    plain indexing would raise under ANSI mode.
    """
    return F.get(vector_to_array(vector), F.lit(index))


def class_probability(vector: str | Column, index: int = 1, places: int = 4) -> Column:
    """P(class `index`), rounded half up."""
    return F.round(class_score(vector, index), places)


def hash_fold(keys: str | Iterable[str], k: int, seed: int = 42) -> Column:
    """Fold number from the key alone: md5('seed:key') mod k.

    The result does not depend on partitioning, row order or retries, and rows
    that share a key share a fold. Use a key that is unique and not NULL.
    """
    names = [keys] if isinstance(keys, str) else list(keys)
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(quoted(n)).cast("string") for n in names])
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % k).cast("int")
