"""Feature preparation: column roles, category indices, vectors, pipelines."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from classweave.functions import quoted, require_columns
from classweave.operators.balance import TARGET, WEIGHT

LABEL = "label"
FEATURES = "features"

#: Labels of all columns together that may come to the driver unless a call says otherwise.
MAX_CATEGORIES = 1_000_000

# Names that a pipeline adds; a source column may not have them.
ADDED = (LABEL, FEATURES, "rawPrediction", "probability", "prediction")


@dataclass(frozen=True)
class Roles:
    """Which column plays which part; slots follow the vector's order."""

    numeric: tuple[str, ...]
    strings: tuple[str, ...]
    target: str
    indexed: tuple[str, ...]

    @property
    def features(self) -> tuple[str, ...]:
        """Source column of each vector slot."""
        return self.numeric + self.strings

    @property
    def slots(self) -> tuple[str, ...]:
        """Assembler input of each vector slot."""
        return self.numeric + self.indexed


def _index_name(name: str, taken: Iterable[str]) -> str:
    candidate = f"{name}_idx"
    while candidate in taken:
        candidate += "_"
    return candidate


def column_roles(
    df: DataFrame,
    target: str = TARGET,
    weight: str | None = WEIGHT,
    exclude: Sequence[str] = (),
) -> Roles:
    """Split the features into strings and numbers, both in schema order.

    Target, weight and `exclude` (keys, fold numbers) are no features. Columns
    that a vector cannot hold, such as dates, raise instead of failing later.
    """
    require_columns(df, target, *exclude)
    aside = {target, weight, *exclude}
    numeric, strings = [], []
    for field in df.schema.fields:
        if field.name in aside:
            continue
        if "." in field.name or "`" in field.name:
            raise ValueError(f"rename feature {field.name!r}: ML columns may not contain dots or backticks")
        if isinstance(field.dataType, T.StringType):
            strings.append(field.name)
        elif isinstance(field.dataType, (T.NumericType, T.BooleanType)):
            numeric.append(field.name)
        else:
            raise ValueError(
                f"feature {field.name!r} has type {field.dataType.simpleString()}; "
                "convert it to a number or a string, or exclude it"
            )
    indexed = tuple(_index_name(s, df.columns) for s in strings)
    return Roles(tuple(numeric), tuple(strings), target, indexed)


def _long_values(df: DataFrame, columns: Sequence[str], kept: Sequence[Column] = ()) -> DataFrame:
    """(kept..., column, value): one row per non-NULL cell of the given columns."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(quoted(c)).cast("string").alias("value")) for c in columns]
    )
    return df.select(*kept, F.inline(pairs)).filter(F.col("value").isNotNull())


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) over all given columns in one scan; NULL is no category.

    Counts are combined before the shuffle, so a value that fills a third of
    the table costs one row per task.
    """
    require_columns(df, *columns)
    return _long_values(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def category_shares(
    df: DataFrame, columns: Sequence[str], target: str, positive: str, weight: str | None = None, fold: str | None = None, k: int = 0
) -> DataFrame:
    """(column, value, n, positive, total): the rows of every value, and their weight with the positive class and in all.

    With `fold` also n0, positive0, total0 and so on: the same over the rows outside each fold. Those are summed up from
    the rows they cover, not taken as differences, so that equal shares stay equal but for the last digits.
    """
    given = F.lit(1.0) if weight is None else F.col(quoted(weight)).cast("double")
    kept = [given.alias("w"), (F.col(quoted(target)).cast("string") == positive).alias("is_positive")]
    values = _long_values(df, columns, [*kept, *([F.col(quoted(fold)).alias("fold")] if fold else [])])

    def sums(rows: Column, suffix: str) -> list[Column]:
        return [
            F.count_if(rows).alias(f"n{suffix}"),
            F.coalesce(F.sum(F.when(rows & F.col("is_positive"), F.col("w"))), F.lit(0.0)).alias(f"positive{suffix}"),
            F.coalesce(F.sum(F.when(rows, F.col("w"))), F.lit(0.0)).alias(f"total{suffix}"),
        ]

    outside = [column for i in range(k) for column in sums(F.col("fold") != i, str(i))]
    return values.groupBy("column", "value").agg(*sums(F.lit(True), ""), *outside)


def fold_category_counts(df: DataFrame, columns: Sequence[str], fold: str, k: int) -> DataFrame:
    """(column, value, n, n0 .. n{k-1}): the counts of all rows and of every fold in one scan."""
    values = _long_values(df, columns, [F.col(quoted(fold)).alias("fold")])
    return values.groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("fold") == i).alias(f"n{i}") for i in range(k)]
    )


def column_report(
    df: DataFrame,
    target: str = TARGET,
    weight: str | None = WEIGHT,
    exclude: Sequence[str] = (),
) -> DataFrame:
    """(column, role, slot, n_categories): the roles, with the categories of each string.

    Trees need more bins than categories, so this shows beforehand which
    columns they can take.
    """
    roles = column_roles(df, target, weight, exclude)
    strings = [*roles.strings, target]
    sizes = category_counts(df, strings).groupBy("column").agg(F.count(F.lit(1)).alias("n_categories"))
    named = [(n, "numeric", i) for i, n in enumerate(roles.numeric)]
    named += [(s, "string", len(named) + i) for i, s in enumerate(roles.strings)]
    named.append((target, "target", None))
    if weight in df.columns:
        named.append((weight, "weight", None))
    known = df.sparkSession.createDataFrame(named, "column string, role string, slot int")
    # Both sides have one row per column of the table.
    return known.join(F.broadcast(sizes), "column", "left")


def string_cardinality(
    df: DataFrame,
    target: str = TARGET,
    weight: str | None = WEIGHT,
    exclude: Sequence[str] = (),
    bound: int = MAX_CATEGORIES,
    error: float = 0.02,
) -> DataFrame:
    """(column, n_rows, n_values, n_categories, share, wide): how many values each string feature has, from one scan.

    Sketches count the categories with a standard deviation of `error`, in a
    fixed space per task however many there are. `share` is the categories per
    value: near 1 the column is a key rather than a category. `wide` names what
    to pass in `wide=`: all the categories are more than `bound`, and these
    columns, widest first, are those without which the others fit.
    """
    strings = list(column_roles(df, target, weight, exclude).strings)
    if not strings:
        raise ValueError("the table has no string feature")
    each = [
        F.struct(
            F.lit(name).alias("column"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count(F.col(quoted(name))).alias("n_values"),
            F.approx_count_distinct(F.col(quoted(name)), error).alias("n_categories"),
        )
        for name in strings
    ]
    sizes = df.agg(F.array(*each).alias("sizes")).select(F.inline("sizes"))
    # One row per column of the table.
    not_wider = Window.orderBy("n_categories", "column").rowsBetween(Window.unboundedPreceding, 0)
    share = F.try_divide(F.col("n_categories").cast("double"), F.col("n_values"))
    return sizes.select("*", share.alias("share"), (F.sum("n_categories").over(not_wider) > bound).alias("wide"))


def wide_columns(df: DataFrame, *args, **options) -> list[str]:
    """The columns that `string_cardinality` calls wide, for `wide=`."""
    return sorted(row.column for row in string_cardinality(df, *args, **options).filter("wide").collect())


def collect_bounded(counts: DataFrame, bound: int | None) -> list[Row]:
    """All rows of a category table, or ValueError when there are more than `bound`, by default MAX_CATEGORIES.

    The rows are counted on the executors first, so beyond the bound no label
    reaches the driver.
    """
    bound = MAX_CATEGORIES if bound is None else bound
    # Kept on disk between both jobs; should an executor go, its part is counted again.
    kept = counts.persist(StorageLevel.DISK_ONLY)
    try:
        sizes = sorted(((row["count"], row["column"]) for row in kept.groupBy("column").count().collect()), reverse=True)
        if sum(n for n, _ in sizes) > bound:
            widest = ", ".join(f"{column!r} ({n})" for n, column in sizes[:3])
            raise ValueError(f"more than {bound} categories: name the widest columns in `wide`, or raise max_categories; {widest}")
        return kept.collect()
    finally:
        kept.unpersist()


def ordered_labels(rows: Iterable[tuple[str, str, int]], columns: Sequence[str]) -> dict[str, list[str]]:
    """Labels per column, index = position, from (column, value, n); values with n = 0 are unseen."""
    found: dict[str, list[tuple[str, int]]] = {c: [] for c in columns}
    for column, value, n in rows:
        if n > 0:
            found[column].append((value, n))
    for pairs in found.values():
        pairs.sort(key=lambda pair: (-pair[1], pair[0]))
    return {column: [value for value, _ in pairs] for column, pairs in found.items()}


def category_labels(
    df: DataFrame, columns: Sequence[str], max_categories: int | None = None
) -> dict[str, list[str]]:
    """Labels of the given columns in index order, from one scan for all of them.

    They come to the driver, as those of any fitted indexer do; `max_categories` bounds how many may, by default
    MAX_CATEGORIES, and more raise before any of them comes.
    """
    rows = collect_bounded(category_counts(df, columns).select("column", "value", "n"), max_categories)
    return ordered_labels(rows, columns)


def string_index(
    df: DataFrame,
    columns: Sequence[str],
    outputs: Sequence[str] | None = None,
    invalid: str = "keep",
    labels: Mapping[str, list[str]] | None = None,
    max_categories: int | None = None,
) -> DataFrame:
    """Add `<column>_idx`: 0.0 for the most frequent value, ties by value.

    What happens to NULL and unseen values: "keep" gives them the index after
    the last, "skip" drops the row, "error" raises. `labels` applies the
    categories of another table.
    """
    columns = list(columns)
    outputs = list(outputs or [_index_name(c, df.columns) for c in columns])
    labels = labels or category_labels(df, columns, max_categories)
    for column, output in zip(columns, outputs):
        df = _indexer(column, output, labels[column], invalid).transform(df)
    return df


def label_index(df: DataFrame, target: str = TARGET, label: str = LABEL) -> DataFrame:
    """Add the label: 0.0 for the most frequent class; NULL and unseen values raise."""
    return string_index(df, [target], [label], invalid="error")


def _indexer(column: str, output: str, labels: list[str], invalid: str) -> StringIndexerModel:
    # One model per column: the constructor for many columns pads shorter label
    # lists with NULL, which moves the index of unseen values.
    return StringIndexerModel.from_labels(labels, inputCol=column, outputCol=output, handleInvalid=invalid)


def feature_stages(
    roles: Roles, labels: Mapping[str, list[str]], invalid: str = "keep", wide: Transformer | None = None
) -> list:
    """Category indices, label index and vector assembly, ready to transform.

    The label stage raises on NULL; a table to be scored needs no target.
    `wide` indexes the strings that have no labels.
    """
    stages: list = [_indexer(s, i, labels[s], invalid) for s, i in zip(roles.strings, roles.indexed) if s in labels]
    if wide is not None:
        stages.insert(0, wide)
    stages.append(_indexer(roles.target, LABEL, labels[roles.target], "error"))
    stages.append(VectorAssembler(inputCols=list(roles.slots), outputCol=FEATURES))
    return stages


def assemble(
    df: DataFrame,
    target: str = TARGET,
    weight: str | None = WEIGHT,
    exclude: Sequence[str] = (),
    invalid: str = "keep",
    wide: Sequence[str] = (),
    max_categories: int | None = None,
) -> DataFrame:
    """Add indices, label and `features`: numbers first, then indexed strings, in schema order."""
    for stage in _prepared(df, target, weight, exclude, invalid, wide, max_categories)[2]:
        df = stage.transform(df)
    return df


def _prepared(
    df: DataFrame,
    target: str,
    weight: str | None,
    exclude: Sequence[str],
    invalid: str,
    wide: Sequence[str],
    max_categories: int | None,
    order: str = "frequency",
) -> tuple[Roles, dict[str, list[str]], list]:
    """Roles, labels, and the fitted feature stages of a table."""
    # The indices by table build on this module's counts.
    from classweave.operators.wide import fit_category_indexer

    roles = column_roles(df, target, weight, exclude)
    check_names(df.columns, roles, wide)
    labels = category_labels(df, [*(s for s in roles.strings if s not in wide), target], max_categories)
    by_table = None
    if wide:
        by_table = fit_category_indexer(df, roles, wide, invalid, ranked_class(labels[target], order), weight)
    return roles, labels, feature_stages(roles, labels, invalid, by_table)


def ranked_class(classes: Sequence[str], order: str) -> str | None:
    """The class by whose share wide categories are ordered, label 1; None where they are ordered by frequency."""
    if order not in ("frequency", "target"):
        raise ValueError(f"order must be frequency or target, not {order!r}")
    return classes[1] if order == "target" and len(classes) > 1 else None


def check_names(columns: Sequence[str], roles: Roles, wide: Sequence[str]) -> None:
    """Raise early on names that would fail deep inside a pipeline."""
    for name in ADDED:
        if name in columns:
            raise ValueError(f"rename column {name!r}: a pipeline adds one of that name")
    for name in wide:
        if name not in roles.strings:
            raise ValueError(f"wide column {name!r} is not among the string features {list(roles.strings)}")


def check_trainable(estimator: Estimator, roles: Roles, labels: Mapping[str, list[str]], invalid: str) -> None:
    """Raise early on what would fail deep inside the training."""
    if not roles.features:
        raise ValueError("no feature column is left")
    if len(labels[roles.target]) > 2:
        raise ValueError(f"target {roles.target!r} has {len(labels[roles.target])} classes; two are supported")
    if estimator.hasParam("maxBins"):
        bins = estimator.getOrDefault("maxBins")
        for name in (s for s in roles.strings if s in labels):
            arity = len(labels[name]) + (invalid == "keep")
            if arity > bins:
                raise ValueError(
                    f"feature {name!r} needs {arity} bins, the trees have maxBins = {bins}; raise max_bins"
                )


def build_pipeline(
    df: DataFrame,
    estimator: Estimator,
    target: str = TARGET,
    weight: str | None = WEIGHT,
    exclude: Sequence[str] = (),
    invalid: str = "keep",
    max_categories: int | None = None,
    wide: Sequence[str] = (),
    order: str = "frequency",
) -> Pipeline:
    """Indices, label, vector and estimator as one pipeline, to be fitted on `df`.

    The categories of all strings and of the target are read here in a single
    scan, instead of one job per column inside `fit`. Those of the columns
    named in `wide` never come to the driver: they are written as a table,
    which the pipeline joins with, and which is saved with the model. Trees
    take such an index as a number, not as a category. With `order="target"`
    the categories in `wide` are numbered by rising share of the rarer class
    among their rows, by weight: one threshold on the number is then the best
    split of all the categories into two sets, as far as the tree's bins tell
    them apart. NULL and unseen values get the place that a value with the
    share of the whole table would have.
    """
    return _build(df, estimator, target, weight, exclude, invalid, max_categories, wide, order)[0]


def _build(df, estimator, target, weight, exclude, invalid, max_categories, wide, order) -> tuple[Pipeline, Roles]:
    roles, labels, stages = _prepared(df, target, weight, exclude, invalid, wide, max_categories, order)
    check_trainable(estimator, roles, labels, invalid)
    return Pipeline(stages=[*stages, estimator]), roles


def fit_pipeline(
    df: DataFrame,
    estimator: Estimator,
    target: str = TARGET,
    weight: str | None = WEIGHT,
    exclude: Sequence[str] = (),
    invalid: str = "keep",
    max_categories: int | None = None,
    wide: Sequence[str] = (),
    order: str = "frequency",
) -> PipelineModel:
    """Build the pipeline for `df`, fit it on all rows, and let the model know which columns it reads."""
    from classweave.operators.contract import attach, contract_of

    pipeline, roles = _build(df, estimator, target, weight, exclude, invalid, max_categories, wide, order)
    return attach(pipeline.fit(df), contract_of(df, roles))


def label_stage(model: PipelineModel) -> StringIndexerModel:
    """The fitted stage that turns the target into the label."""
    for stage in model.stages:
        if isinstance(stage, StringIndexerModel) and stage.getOutputCol() == LABEL:
            return stage
    raise ValueError("the model has no label stage")


def positive_index(model: PipelineModel, positive="Yes") -> int:
    """Position of the positive class in the probability vector.

    Index 0 is the most frequent class, so this is 1 only while positives are
    the rarer class.
    """
    labels = list(label_stage(model).labels)
    if str(positive) not in labels:
        raise ValueError(f"class {positive!r} is unknown to the model, which has {labels}")
    return labels.index(str(positive))
