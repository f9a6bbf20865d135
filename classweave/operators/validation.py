"""k-fold cross-validation with five metrics, and the comparison of models."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from classweave.functions import class_score, quoted
from classweave.operators.balance import TARGET, WEIGHT
from classweave.operators.estimators import ranking_forest
from classweave.operators.features import (
    LABEL,
    Roles,
    category_shares,
    check_names,
    check_trainable,
    collect_bounded,
    column_roles,
    feature_stages,
    fold_category_counts,
    ordered_labels,
    ranked_class,
)
from classweave.operators.folds import FOLD, fold_assembly, hash_folds, random_folds
from classweave.operators.metrics import METRICS, metrics_table
from classweave.operators.ranking import stable_layout
from classweave.operators.resume import FitLog, estimator_settings, table_fingerprint
from classweave.operators.wide import CategoryIndexer, indexer_of_counts, indexer_of_shares, only
from classweave.sources.staging import staged

CV_FOLD = "cv_fold"


def cross_validate(
    df: DataFrame, estimator: Estimator, model: str, target: str = TARGET, **options
) -> DataFrame:
    """`compare_models` for one estimator, called `model` in the result."""
    return compare_models(df, {model: estimator}, target, **options)


def compare_models(
    df: DataFrame,
    estimators: Mapping[str, Estimator],
    target: str = TARGET,
    weight: str | None = WEIGHT,
    key: str | Sequence[str] | None = None,
    fold: str | None = None,
    k: int = 10,
    seed: int = 42,
    exclude: Sequence[str] = (),
    invalid: str = "keep",
    parallelism: int = 1,
    auc_bins: int | None = None,
    max_categories: int | None = None,
    wide: Sequence[str] = (),
    partitions: int | None = None,
    order: str = "frequency",
    weights: str = "table",
    positive: str | None = None,
    top_k: int | None = None,
    ranker: Estimator | None = None,
    resume: str | None = None,
) -> DataFrame:
    """(model, fold, n_rows, metric, value): k-fold cross-validation of every estimator on the same folds.

    Folds come from `key` (by hash), from an existing column `fold` with
    numbers 0 to k-1, or else at random. Every fold is scored by a pipeline
    whose category indices and classifier saw only the other folds. The class
    weights are those of `df`, so by default they were taken over all rows.

    With `weights="fold"` nothing of a test fold reaches its model: the column
    `weight`, which `df` then need not have, is the class ratio of the training
    rows for `positive` (by default the rarer class of all rows) and 1 for all
    else. With `top_k` each fold also ranks the features by `ranker` (by default
    the ranking forest) on its training rows, and trains on the best; see
    `fold_rankings`. `order="target"` numbers the categories in `wide` as in
    `build_pipeline`, by the training rows.

    With `resume` every fit is saved to that folder as it ends, and so are the
    metrics. A later call with the same rows, folds and settings takes from
    there what is finished, after a driver was lost or with more models. Random
    folds must then come from a column, for another run may draw others. The
    folder is the caller's to delete.

    The features are written once, sorted by fold within each task and without
    a shuffle, so that the rows of one fold are read without the others. One
    scan counts the categories of all folds, of the columns in `wide` too,
    which are indexed by joining with one table per fold; all folds of a model
    are scored and measured in one further job. `parallelism` fits that many
    folds at a time, each of which holds its own training data in memory and
    on disk.

    Seeded forests draw per partition. With `partitions` and a unique `key` the
    rows are laid out by key into that many, so that the result does not depend
    on how `df` is laid out.

    `n_rows` counts the rows that were scored, which "skip" lessens by those
    with a NULL or unseen category. A fold without rows has NULL metrics, one
    with a single class has NULL AUC. With `auc_bins` the AUC is MLlib's
    binned one.
    """
    keys = [] if key is None else [key] if isinstance(key, str) else list(key)
    given = [] if fold is None else [fold]
    if weights not in ("table", "fold"):
        raise ValueError(f"weights must be table or fold, not {weights!r}")
    if weights == "fold" and weight is None:
        raise ValueError("weights per fold need the name of the weight column")
    if resume is not None and key is None and fold is None:
        raise ValueError("a run that can be resumed needs a key or a column with the folds")
    roles = column_roles(df, target, weight, [*exclude, *keys, *given])
    check_names([*roles.features, target], roles, wide)
    needed = [*roles.features, target, *([weight] if weight and weights == "table" else [])]
    number = CV_FOLD
    while number in df.columns or number == weight:
        number += "_"
    if partitions is not None:
        if key is None:
            raise ValueError("a fixed layout needs a key")
        df = stable_layout(df, keys, partitions)
    if fold is not None:
        with_folds = df.withColumn(number, F.col(quoted(fold)).cast("int"))
    elif key is not None:
        with_folds = hash_folds(df, key, k, seed, number)
    else:
        # The draw sorts by every column, so the others go first.
        with_folds = random_folds(df.select(*[F.col(quoted(c)) for c in needed]), k, seed, number)
    spark = df.sparkSession
    nothing = {"n_rows": 0, **dict.fromkeys(METRICS)}
    rows = []
    # Ties within a fold keep the order of the key, which the sort may not change.
    ordered = [number, *(keys if partitions is not None else [])]
    kept = [F.col(quoted(c)) for c in dict.fromkeys([*needed, number, *ordered[1:]])]
    with staged(with_folds.select(*kept), [quoted(c) for c in ordered]) as table:
        table = table.select(*[F.col(quoted(c)) for c in needed], number)
        weighing = (weight, weights, positive)
        folds = _read_folds(table, number, roles, k, max_categories, wide, invalid, order, weighing)
        for estimator in estimators.values():
            for each in folds:
                check_trainable(estimator, roles, each.labels, invalid)
        log = None
        if resume is not None:
            settings = {"features": roles.features, "target": target, "invalid": invalid, "wide": sorted(wide), "order": order,
                        "weight": weighing, "top_k": top_k, "k": k, "ranker": ranker and estimator_settings(ranker)}
            log = FitLog(spark, resume, table_fingerprint(table), settings)
        for model, estimator in estimators.items():

            def fit(each: _Fold, model: str = model, estimator: Estimator = estimator) -> PipelineModel:
                key_of_fit = log and log.key(estimator, each.number)
                known = log and log.fitted(key_of_fit)
                if known:
                    return known
                train = _training_rows(table, each, number, roles, weight)
                chosen, by_table = roles, each.by_table
                if top_k is not None:
                    scores = _fold_ranking(train, each, roles, ranker or ranking_forest(weight), "skip")
                    chosen = _best_roles(roles, [name for name, _ in scores[:top_k]])
                    by_table = only(by_table, chosen.strings)
                fitted = Pipeline(stages=[*_stages(chosen, each, invalid, by_table), estimator.copy()]).fit(train)
                if log:
                    log.keep_fit(key_of_fit, model, each.number, fitted)
                return fitted

            measured = {}
            if log:
                found = ((e.number, log.measured(log.key(estimator, e.number, bins=auc_bins))) for e in folds)
                measured = {i: metrics for i, metrics in found if metrics is not None}
            open_folds = [each for each in folds if each.number not in measured]
            models = _run_parallel(spark, fit, open_folds, parallelism)
            for i, metrics in _measure(table, number, open_folds, models, auc_bins).items():
                measured[i] = metrics
                if log:
                    log.keep_metrics(log.key(estimator, i, bins=auc_bins), model, i, metrics)
            for i in range(k):
                found = measured.get(i, nothing)
                rows += [(model, i, found["n_rows"], metric, found[metric]) for metric in METRICS]
    return spark.createDataFrame(rows, "model string, fold int, n_rows bigint, metric string, value double")


def fold_rankings(
    df: DataFrame,
    target: str = TARGET,
    weight: str | None = WEIGHT,
    fold: str = FOLD,
    k: int = 10,
    exclude: Sequence[str] = (),
    ranker: Estimator | None = None,
    weights: str = "table",
    positive: str | None = None,
    invalid: str = "skip",
    wide: Sequence[str] = (),
    max_categories: int | None = None,
) -> DataFrame:
    """(fold, rank, feature, score): the ranking of `rank_features` on the rows outside each fold that has any.

    Categories, and with `weights="fold"` the class ratio too, come from those rows, all of them from one scan.
    """
    roles = column_roles(df, target, weight, [*exclude, fold])
    check_names([*roles.features, target], roles, wide)
    needed = [*roles.features, target, *([weight] if weight and weights == "table" else [])]
    rows = []
    with staged(df.select(*[F.col(quoted(c)) for c in [*needed, fold]]), [quoted(fold)]) as table:
        folds = _read_folds(table, fold, roles, k, max_categories, wide, invalid, "frequency", (weight, weights, positive))
        for each in folds:
            train = _training_rows(table, each, fold, roles, weight)
            scores = _fold_ranking(train, each, roles, ranker or ranking_forest(weight), invalid)
            rows += [(each.number, rank, name, score) for rank, (name, score) in enumerate(scores, start=1)]
    return df.sparkSession.createDataFrame(rows, "fold int, rank int, feature string, score double")


def _training_rows(table: DataFrame, each: _Fold, number: str, roles: Roles, weight: str | None) -> DataFrame:
    """The rows outside a fold, weighted by its own class ratio if it has one."""
    train, _ = fold_assembly(table, each.number, number, checked=True)
    train = train.drop(number)
    if each.ratio is None:
        return train
    value, ratio = each.ratio
    is_positive = F.col(quoted(roles.target)).cast("string") == value
    return train.withColumn(weight, F.when(is_positive, F.lit(ratio)).otherwise(F.lit(1.0)))


def _stages(roles: Roles, each: _Fold, invalid: str, by_table: CategoryIndexer | None) -> list:
    labels = {name: each.labels[name] for name in (*roles.strings, roles.target) if name in each.labels}
    return feature_stages(roles, labels, invalid, by_table)


def _fold_ranking(train: DataFrame, each: _Fold, roles: Roles, ranker: Estimator, invalid: str) -> list[tuple[str, float]]:
    """(feature, score), best first; equal scores keep the vector's order."""
    fitted = Pipeline(stages=[*_stages(roles, each, invalid, each.by_table), ranker.copy()]).fit(train)
    return sorted(zip(roles.features, fitted.stages[-1].featureImportances.toArray().tolist()), key=lambda pair: -pair[1])


def _best_roles(roles: Roles, best: Sequence[str]) -> Roles:
    """The roles with these features only, in their order: numbers, then strings."""
    index = dict(zip(roles.strings, roles.indexed))
    strings = tuple(name for name in best if name in index)
    return Roles(tuple(name for name in best if name not in index), strings, roles.target, tuple(index[s] for s in strings))


@dataclass(frozen=True)
class _Fold:
    """A fold with rows: its number, and of the rows outside it the categories, as labels or by table, and the class ratio."""

    number: int
    labels: dict[str, list[str]]
    by_table: CategoryIndexer | None
    ratio: tuple[str, float] | None


def _read_folds(
    table: DataFrame,
    number: str,
    roles: Roles,
    k: int,
    max_categories: int | None,
    wide: Sequence[str],
    invalid: str,
    order: str,
    weighing: tuple[str | None, str, str | None],
) -> list[_Fold]:
    """The folds that have rows.

    A fold's training counts are all counts minus its own, so the categories
    and class ratios of k training sets take one scan instead of k.
    """
    weight, weights, positive = weighing
    columns = [*(s for s in roles.strings if s not in wide), roles.target]
    counts = collect_bounded(fold_category_counts(table, columns, number, k), max_categories)
    classes = [row for row in counts if row.column == roles.target]
    sizes = [sum(row[f"n{i}"] for row in classes) for i in range(k)]
    if sum(sizes) != sum(row.n for row in classes):
        raise ValueError(f"fold numbers must be 0 to {k - 1}, and not NULL")
    overall = ordered_labels([(row.column, row.value, row.n) for row in classes], [roles.target])[roles.target]
    rarer = positive if positive is not None else overall[-1] if overall else None
    folds = []
    for i in range(k):
        if not sizes[i]:
            continue
        train_counts = [(row.column, row.value, row.n - row[f"n{i}"]) for row in counts]
        labels = ordered_labels(train_counts, columns)
        unseen = {row.value for row in classes if row[f"n{i}"]} - set(labels[roles.target])
        if unseen:
            raise ValueError(f"class {unseen.pop()!r} occurs in fold {i} only: no other fold can teach it")
        ratio = None
        if weights == "fold":
            ones = sum(row.n - row[f"n{i}"] for row in classes if row.value == rarer)
            others = sum(row.n - row[f"n{i}"] for row in classes if row.value != rarer)
            if not ones:
                raise ValueError(f"no row outside fold {i} has {roles.target} = {rarer}: the class ratio is undefined")
            ratio = (rarer, others / ones)
        folds.append(_Fold(i, labels, None, ratio))
    if not wide:
        return folds
    by_share = ranked_class(overall, order)
    if by_share is not None:
        # A ratio that is the same for a whole class does not change the order of the shares.
        own_weight = weight if weights == "table" else None
        with staged(category_shares(table, wide, roles.target, by_share, own_weight, number, k)) as shares:

            def by_shares(i: int) -> CategoryIndexer:
                names = [F.col(f"{c}{i}").alias(c) for c in ("n", "positive", "total")]
                return indexer_of_shares(shares.select("column", "value", *names).filter("n > 0"), roles, wide, invalid)

            return [replace(each, by_table=by_shares(each.number)) for each in folds]
    with staged(fold_category_counts(table, wide, number, k)) as by_fold:

        def indexer(i: int) -> CategoryIndexer:
            seen = by_fold.select("column", "value", (F.col("n") - F.col(f"n{i}")).alias("n")).filter("n > 0")
            return indexer_of_counts(seen, roles, wide, invalid)

        return [replace(each, by_table=indexer(each.number)) for each in folds]


def _run_parallel(
    spark: SparkSession, fit: Callable[[_Fold], PipelineModel], folds: list[_Fold], parallelism: int
) -> list[PipelineModel]:
    """Fit the folds from `parallelism` driver threads; Spark schedules their jobs."""
    if parallelism == 1 or len(folds) < 2:
        return [fit(each) for each in folds]
    with ThreadPool(min(parallelism, len(folds))) as pool:
        return pool.map(inheritable_thread_target(spark)(fit), folds)


def _measure(
    table: DataFrame, number: str, folds: list[_Fold], models: list[PipelineModel], auc_bins: int | None
) -> dict[int, dict]:
    """Metrics per fold number; the folds are scored side by side, each once and by its own model."""
    parts = []
    for each, model in zip(folds, models):
        _, test = fold_assembly(table, each.number, number)
        predictions = model.transform(test.drop(number))
        score = class_score("rawPrediction").alias("score")
        parts.append(predictions.select(F.lit(each.number).alias(FOLD), LABEL, "prediction", score))
    if not parts:
        return {}
    scored = reduce(DataFrame.unionAll, parts)
    measured = metrics_table(scored, by=[FOLD], num_bins=auc_bins).collect()
    return {row[FOLD]: {name: row[name] for name in ("n_rows", *METRICS)} for row in measured}


def cv_summary(metrics: DataFrame) -> DataFrame:
    """(model, metric, mean, pct, n_folds): means over the folds that have the metric.

    `pct` is the mean in percent with two places.
    """
    return (
        metrics.groupBy("model", "metric")
        .agg(F.avg("value").alias("mean"), F.count("value").alias("n_folds"))
        .select("model", "metric", "mean", F.round(F.col("mean") * 100, 2).alias("pct"), "n_folds")
    )


def leaderboard(summaries: DataFrame | Sequence[DataFrame], metric: str = "auc") -> DataFrame:
    """(rank, model, accuracy, precision, recall, f1, auc): models by falling mean, ties by name."""
    if isinstance(summaries, DataFrame):
        summaries = [summaries]
    rows = summaries[0]
    for other in summaries[1:]:
        rows = rows.unionByName(other)
    # One row per model, and models are written down by hand.
    wide = rows.groupBy("model").pivot("metric", list(METRICS)).agg(F.first("mean"))
    best_first = Window.orderBy(F.desc_nulls_last(metric), "model")
    return wide.withColumn("rank", F.row_number().over(best_first)).select("rank", "model", *METRICS)
