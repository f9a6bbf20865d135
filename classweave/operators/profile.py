"""Dataset audit: shape, schema, missing values and class balance.

Each report is a lazy DataFrame that costs one scan of the columns it needs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from classweave.functions import is_missing, quoted, require_columns
from classweave.operators.balance import TARGET


def _per_column(df: DataFrame, fixed: dict[str, list], counts: dict[str, list[Column]]) -> DataFrame:
    """One row per column, or per name asked for: literals and aggregates by result name, all from one aggregate."""
    n_columns = len(next(iter(fixed.values())))
    totals = df.agg(*[c.alias(f"{name}{i}") for name, columns in counts.items() for i, c in enumerate(columns)])
    rows = [
        F.struct(
            *[F.lit(values[i]).alias(name) for name, values in fixed.items()],
            *[F.col(f"{name}{i}").alias(name) for name in counts],
        )
        for i in range(n_columns)
    ]
    return totals.select(F.inline(F.array(*rows)))


def _schema(df: DataFrame) -> dict[str, list]:
    fields = df.schema.fields
    return {
        "position": list(range(len(fields))),
        "column": [f.name for f in fields],
        "type": [f.dataType.simpleString() for f in fields],
        "nullable": [f.nullable for f in fields],
    }


def _n_values(df: DataFrame) -> list[Column]:
    return [F.count(F.col(quoted(name))) for name in df.columns]


def _n_missing(df: DataFrame) -> list[Column]:
    return [F.count_if(is_missing(f)) for f in df.schema.fields]


def dataset_shape(df: DataFrame) -> DataFrame:
    """(n_rows, n_columns) in one row."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def schema_report(df: DataFrame, count_values: bool = False) -> DataFrame:
    """(position, column, type, nullable), from the metadata alone.

    `count_values` adds n_values, the non-NULL rows of each column, which takes a scan.
    """
    if count_values:
        return _per_column(df, _schema(df), {"n_values": _n_values(df)})
    rows = list(zip(*_schema(df).values()))
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string, nullable boolean")


def columns_present(df: DataFrame, names: Sequence[str], count_values: bool = False) -> DataFrame:
    """(column, present) for every name: whether the table has that column.

    `count_values` adds n_values, the non-NULL rows of the column, NULL where there is none: a column may be there and
    empty. That takes a scan of the columns that are there.
    """
    present = [name in df.columns for name in names]
    if not count_values:
        return df.sparkSession.createDataFrame(list(zip(names, present)), "column string, present boolean")
    values = [F.count(F.col(quoted(n))) if here else F.max(F.lit(None).cast("bigint")) for n, here in zip(names, present)]
    return _per_column(df, {"column": list(names), "present": present}, {"n_values": values})


def missing_counts(df: DataFrame) -> DataFrame:
    """(column, n_missing) for every column, from a single aggregate."""
    return _per_column(df, {"column": df.columns}, {"n_missing": _n_missing(df)})


def column_profile(df: DataFrame) -> DataFrame:
    """(position, column, type, nullable, n_rows, n_values, n_missing): all column reports in one scan."""
    counts = {
        "n_rows": [F.count(F.lit(1)) for _ in df.columns],
        "n_values": _n_values(df),
        "n_missing": _n_missing(df),
    }
    return _per_column(df, _schema(df), counts)


def missing_columns(df: DataFrame) -> DataFrame:
    """Only the columns that miss something; empty when the table is complete."""
    return missing_counts(df).filter("n_missing > 0")


def class_counts(df: DataFrame, target: str = TARGET) -> DataFrame:
    """(target, count): rows per class, NULL is a class."""
    require_columns(df, target)
    return df.groupBy(F.col(quoted(target)).alias(target)).agg(F.count(F.lit(1)).alias("count"))


def class_balance(df: DataFrame, target: str = TARGET) -> DataFrame:
    """(target, count, percent) by rising count; percent is of all rows, NULL is a class."""
    return balance_of(class_counts(df, target))


def balance_of(counts: DataFrame) -> DataFrame:
    """`class_balance` of a table of class counts.

    The total is a scalar subquery over the same counts, so the table is
    grouped once and no group passes through a single task.
    """
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("percent", F.col("count") * 100.0 / total).orderBy("count", quoted(counts.columns[0]))


def imbalance_flag(df: DataFrame, target: str = TARGET, threshold: float = 15.0) -> DataFrame:
    """(minority_percent, severe): severe when the rarest class is below the threshold."""
    return imbalance_of(class_counts(df, target), threshold)


def imbalance_of(counts: DataFrame, threshold: float = 15.0) -> DataFrame:
    """`imbalance_flag` of a table of class counts."""
    smallest = F.min("count") * 100.0 / F.sum("count")
    return counts.agg(smallest.alias("minority_percent")).withColumn(
        "severe", F.col("minority_percent") < threshold
    )
