"""Category indices for columns with more values than a driver should hold.

The result equals `features.string_index`. The category table is written to a
path that the caller owns, as it is also needed to index later tables.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from classweave.functions import quoted
from classweave.operators.features import category_counts
from classweave.sources.staging import staged

# At most this many values per column are frequent enough to be joined by
# broadcast: each holds more than 1/HEAVY_SHARE of its column.
HEAVY_SHARE = 1_000
_OFFSET_BITS = 33


def write_category_table(df: DataFrame, columns: Sequence[str], path: str) -> DataFrame:
    """Write and return (column, value, n, total, index), index by falling n, ties by value.

    The order is a range-partitioned sort. Row numbers inside each partition
    plus the sizes of the partitions before it give the global position, so no
    task sees more than its own partition.
    """
    return write_ranked_counts(category_counts(df, columns), path)


def write_share_table(shares: DataFrame, path: str) -> DataFrame:
    """Write and return (column, value, n, total, index, unseen), index by rising share of the positive class, ties by value.

    `shares` are those of `category_shares`. `unseen` is where a value with the share of all its column's rows would
    stand: between those with a lower share and the others.
    """
    # Sums of the same weights in another order differ in the last digits; equal shares must not.
    share = F.round(F.try_divide("positive", "total"), 12)
    placed = shares.select("column", "value", "n", "positive", "total", F.coalesce(share, F.lit(0.0)).alias("share"))
    with staged(placed) as kept, staged_ranks(kept.select("column", "value", "n", "share"), [F.col("share")]) as ranked:
        # One row per column.
        overall = kept.groupBy("column").agg(F.round(F.try_divide(F.sum("positive"), F.sum("total")), 12).alias("overall"))
        lower = kept.join(F.broadcast(overall), "column").groupBy("column")
        unseen = lower.agg((F.count_if(F.col("share") < F.col("overall")) - 0.5).alias("unseen"))
        ranked.drop("share").join(F.broadcast(unseen), "column").write.mode("overwrite").parquet(path)
    return shares.sparkSession.read.parquet(path)


def write_ranked_counts(counts: DataFrame, path: str) -> DataFrame:
    """`write_category_table` for categories that are counted already: (column, value, n)."""
    with staged_ranks(counts, [F.desc("n")]) as ranked:
        ranked.write.mode("overwrite").parquet(path)
    return counts.sparkSession.read.parquet(path)


@contextmanager
def staged_ranks(counts: DataFrame, order: Sequence[Column]) -> Iterator[DataFrame]:
    """`counts` with total (rows of the column) and index (0.0 for the first by `order`, ties by value), for the block."""
    in_order = counts.orderBy("column", *order, "value")
    with staged(in_order.withColumn("id", F.monotonically_increasing_id())) as numbered:
        part = F.shiftright("id", _OFFSET_BITS)
        placed = numbered.withColumn("part", part).withColumn(
            "position", F.col("id") - F.shiftleft(part, _OFFSET_BITS)
        )
        # One row per partition of the sort and column.
        sizes = placed.groupBy("part", "column").agg(
            F.count(F.lit(1)).alias("size"), F.min("position").alias("first"), F.sum("n").alias("rows")
        )
        earlier = Window.partitionBy("column").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        starts = sizes.select(
            "part",
            "column",
            (F.coalesce(F.sum("size").over(earlier), F.lit(0)) - F.col("first")).alias("start"),
            F.sum("rows").over(Window.partitionBy("column")).alias("total"),
        )
        index = (F.col("start") + F.col("position")).cast("double")
        joined = placed.join(F.broadcast(starts), ["part", "column"])
        yield joined.select(*counts.columns, "total", index.alias("index"))


def index_by_table(
    df: DataFrame,
    table: DataFrame,
    columns: Sequence[str],
    outputs: Sequence[str] | None = None,
    invalid: str = "keep",
) -> DataFrame:
    """Add index columns by joining with a category table, of either order.

    Frequent values are settled by broadcast. Rows that hold only those, or
    NULL, are never shuffled, so a value that fills a third of the table does
    not meet in one task. The other rows are shuffled once per column by their
    rare value; where a column is settled already, by a hash over all indexed
    columns, of which at least one is rare. Should a value that the table lacks
    be frequent, adaptive execution splits its partition.
    """
    if invalid not in ("keep", "skip", "error"):
        raise ValueError(f"invalid must be keep, skip or error, not {invalid!r}")
    outputs = list(outputs or [f"{c}_idx" for c in columns])
    values = [F.col(quoted(c)).cast("string") for c in columns]
    tables = [table.filter(F.col("column") == c) for c in columns]

    marked = df
    for i, (value, mine) in enumerate(zip(values, tables)):
        heavy = _lookup(mine.filter(_is_heavy()), i)
        marked = marked.join(F.broadcast(heavy), value == F.col(f"_value{i}"), "left").drop(f"_value{i}")
    pending = [value.isNotNull() & F.col(f"_index{i}").isNull() for i, value in enumerate(values)]
    any_pending = reduce(or_, pending)

    rare_rows = marked.filter(any_pending)
    spread = 1 + F.pmod(F.xxhash64(*values), F.lit(2**30)).cast("int")
    for i, (value, mine) in enumerate(zip(values, tables)):
        rare = _lookup(mine.filter(~_is_heavy()), i, "_found").withColumn(f"_zero{i}", F.lit(0))
        key = F.when(pending[i], value).otherwise("")
        salt = F.when(pending[i], 0).otherwise(spread)
        rare_rows = rare_rows.join(rare, (key == F.col(f"_value{i}")) & (salt == F.col(f"_zero{i}")), "left").drop(
            f"_value{i}", f"_zero{i}"
        )

    def indices(found: bool) -> list[Column]:
        result = []
        for i, (column, mine, output) in enumerate(zip(columns, tables, outputs)):
            index = F.coalesce(f"_index{i}", f"_found{i}") if found else F.col(f"_index{i}")
            if invalid == "keep":
                beyond = F.max("unseen") if "unseen" in table.columns else F.count(F.lit(1)).cast("double")
                index = F.coalesce(index, mine.agg(beyond).scalar())
            elif invalid == "error":
                unseen = F.raise_error(F.lit(f"{column} holds NULL or an unseen value"))
                index = F.coalesce(index, unseen.cast("double"))
            result.append(index.alias(output))
        return result

    names = [F.col(quoted(c)) for c in df.columns]
    settled = marked.filter(~any_pending).select(*names, *indices(False))
    result = settled.unionAll(rare_rows.select(*names, *indices(True)))
    if invalid == "skip":
        result = result.dropna(subset=[quoted(o) for o in outputs])
    return result


def _is_heavy() -> Column:
    """True for the rows of a category table that are joined by broadcast."""
    return F.col("n") * HEAVY_SHARE > F.col("total")


def _lookup(rows: DataFrame, i: int, index: str = "_index") -> DataFrame:
    # Plain doubles: unlike a fitted indexer, a join adds no category metadata.
    return rows.select(F.col("value").alias(f"_value{i}"), F.col("index").alias(f"{index}{i}"))
