"""Small helpers that the operators share: free column names, plain batches, tables in the shared folder."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from classweave.functions import quoted
from classweave.sources.staging import fresh_path


def free_name(taken: Iterable[str], name: str) -> str:
    """`name`, with underscores appended until no column has it in any case."""
    lowered = {x.lower() for x in taken}
    while name.lower() in lowered:
        name += "_"
    return name


def columns(names: Iterable[str]) -> list[Column]:
    """The columns of these names, whatever signs a name holds."""
    return [F.col(quoted(name)) for name in names]


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """Write `df` once to the shared folder and read it back: this cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of the batches that go to and from Python.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bound the batches of Python functions by bytes, unless the session has a bound of its own.

    Batches are counted in rows otherwise, and so many long texts in a row would not fit into memory.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(BATCH_BYTES))


def release_memory() -> None:
    """Give back what a Python worker has freed: it waits for its next task beside the executor's own memory."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


#: What a worker keeps from task to task, by name, and how it lets go of it.
_KEPT: dict[str, Callable[[], None]] = {}


def keeps(name: str, clear: Callable[[], None]) -> None:
    """Say that this worker will keep something until `clear` is called."""
    _KEPT[name] = clear


def begin_task(*names: str) -> None:
    """Let go of what tasks of other operators have left in this worker; what is named stays."""
    for name, clear in _KEPT.items():
        if name not in names:
            clear()


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict[str, pa.Array]], fields: list[T.StructField], keep: list[str] | None = None) -> DataFrame:
    """Columns of `df` (all, or those in `keep`) and behind them the columns that `fn` makes from each Arrow batch.

    `fn` returns one array per field, or None in place of the dictionary for a batch without rows of interest; under the
    name "rows" it may return the indices of the input rows that its arrays belong to.
    """
    bound_batches(df.sparkSession)
    kept = df.columns if keep is None else keep
    schema = T.StructType([df.schema[name] for name in kept] + fields)
    names = [f.name for f in fields]
    positions = [df.columns.index(name) for name in kept]
    out_names = [*kept, *names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task()
        for batch in batches:
            made = fn(batch)
            if made is None:
                continue
            columns = [batch.column(i) for i in positions]
            if "rows" in made:
                columns = [c.take(made["rows"]) for c in columns]
            yield pa.RecordBatch.from_arrays([*columns, *(made[n] for n in names)], names=out_names)
        release_memory()

    return df.mapInArrow(run, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def runs_of_groups(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Cut a stream of batches that is sorted by its first `keys` columns into one table per group."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, dtype=bool)
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        for values in columns:
            change[1:] |= values[1:] != values[:-1]
        first = tuple(values[0] for values in columns)
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for k, (start, end) in enumerate(zip(cuts, cuts[1:])):
            if held and (k or first != last):
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
        last = tuple(values[-1] for values in columns)
    if held:
        yield pa.Table.from_batches(held)
