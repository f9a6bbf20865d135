from pathlib import Path

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import functions as F

import classweave as cw
from classweave.sources.staging import fresh_path
from workload import tables

KEY, TARGET = "o_orderkey", "target"
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def planted(spark):
    return cw.with_class_weight(tables.planted(spark, SMALL), TARGET).cache()


def _wide(metrics):
    result = {}
    for r in metrics.collect():
        result.setdefault(r.fold, {"n_rows": r.n_rows})[r.metric] = r.value
    return result


def one_by_one(df, estimator, k):
    """Fold by fold with plain stages and one evaluator per metric."""
    roles = cw.column_roles(df, TARGET, exclude=[KEY, "fold"])
    names = zip(roles.strings, roles.indexed)
    stages = [StringIndexer(inputCol=s, outputCol=i, handleInvalid="keep") for s, i in names]
    stages += [
        StringIndexer(inputCol=TARGET, outputCol="label"),
        VectorAssembler(inputCols=list(roles.slots), outputCol="features"),
        estimator,
    ]
    evaluators = {
        "auc": BinaryClassificationEvaluator(numBins=0),
        "accuracy": MulticlassClassificationEvaluator(metricName="accuracy"),
        "precision": MulticlassClassificationEvaluator(metricName="weightedPrecision"),
        "recall": MulticlassClassificationEvaluator(metricName="weightedRecall"),
        "f1": MulticlassClassificationEvaluator(metricName="f1"),
    }
    result = {}
    for i in range(k):
        train, test = cw.fold_assembly(df, i)
        predictions = Pipeline(stages=stages).fit(train).transform(test).cache()
        result[i] = {m: e.evaluate(predictions) for m, e in evaluators.items()}
        result[i]["n_rows"] = predictions.count()
        predictions.unpersist()
    return result


@pytest.mark.parametrize(
    "name, estimator",
    [("lr", lambda: cw.logistic()), ("gbt", lambda: cw.boosted(maxIter=3, maxDepth=3))],
)
def test_equals_fold_by_fold_evaluation(planted, name, estimator):
    folded = cw.hash_folds(planted, KEY, 3)
    expected = one_by_one(folded, estimator(), 3)
    found = _wide(cw.cross_validate(planted, estimator(), name, TARGET, key=KEY, k=3, parallelism=3))
    for i in range(3):
        for metric, value in expected[i].items():
            assert found[i][metric] == pytest.approx(value, abs=1e-6), (i, metric)


def test_fold_column_random_folds_and_threads_agree_on_the_shape(planted):
    folded = cw.random_folds(planted, 3).withColumnRenamed("fold", "part")
    options = {"target": TARGET, "exclude": [KEY], "k": 3}
    given = _wide(cw.cross_validate(folded, cw.logistic(maxIter=5), "lr", fold="part", **options))
    drawn = _wide(cw.cross_validate(planted, cw.logistic(maxIter=5), "lr", **options))
    threads = _wide(cw.cross_validate(folded, cw.logistic(maxIter=5), "lr", fold="part", parallelism=3, **options))
    for result in (given, drawn, threads):
        assert sum(fold["n_rows"] for fold in result.values()) == 1_500
    for i in range(3):
        assert threads[i] == pytest.approx(given[i])


def test_binned_auc_is_close(planted):
    options = {"target": TARGET, "key": KEY, "k": 2}
    exact = _wide(cw.cross_validate(planted, cw.logistic(), "lr", **options))
    binned = _wide(cw.cross_validate(planted, cw.logistic(), "lr", auc_bins=50, **options))
    for i in range(2):
        assert binned[i]["auc"] != exact[i]["auc"]
        assert binned[i]["auc"] == pytest.approx(exact[i]["auc"], abs=0.05)
        assert binned[i]["f1"] == exact[i]["f1"]


@pytest.fixture(scope="module")
def uneven(spark):
    """Fold 0 has both classes, fold 1 negatives only, fold 2 no rows."""
    rows = [(0, float(i), "Yes" if i % 3 == 0 else "No", 1.0) for i in range(30)]
    rows += [(1, float(i), "No", 1.0) for i in range(20)]
    rows += [(3, float(i), "Yes" if i % 2 else "No", 1.0) for i in range(20)]
    return spark.createDataFrame(rows, "fold int, x double, target string, classWeight double")


def test_folds_that_cannot_be_measured_are_null_and_not_averaged(uneven):
    metrics = cw.cross_validate(uneven, cw.logistic(), "lr", TARGET, fold="fold", k=4)
    found = _wide(metrics)
    assert found[2] == {"n_rows": 0, "accuracy": None, "precision": None, "recall": None, "f1": None, "auc": None}
    assert found[1]["auc"] is None and found[1]["accuracy"] is not None
    summary = {r.metric: r for r in cw.cv_summary(metrics).collect()}
    assert summary["auc"].n_folds == 2 and summary["accuracy"].n_folds == 3
    assert summary["auc"].mean == pytest.approx((found[0]["auc"] + found[3]["auc"]) / 2)
    assert summary["auc"].pct == pytest.approx(round(100 * summary["auc"].mean, 2), abs=0.0051)


def test_class_that_only_one_fold_has_is_an_error(uneven):
    only = uneven.filter("target = 'No' OR fold = 0")
    with pytest.raises(ValueError, match="'Yes' occurs in fold 0 only"):
        cw.cross_validate(only, cw.logistic(), "lr", TARGET, fold="fold", k=4)


def test_fold_numbers_out_of_range_are_refused(uneven):
    for fold in (F.col("fold") + 1, F.nullif("fold", F.lit(1))):
        with pytest.raises(ValueError, match="0 to 3"):
            cw.cross_validate(uneven.withColumn("fold", fold), cw.logistic(), "lr", TARGET, fold="fold", k=4)


def test_a_feature_may_be_called_fold(uneven):
    plain = uneven.withColumnRenamed("fold", "f")
    named = plain.withColumn("fold", F.col("x") * 2)
    found = _wide(cw.cross_validate(named.drop("x"), cw.logistic(), "lr", TARGET, fold="f", k=4))
    assert found == _wide(cw.cross_validate(plain, cw.logistic(), "lr", TARGET, fold="f", k=4))


def test_null_labels_raise(uneven):
    nulls = uneven.withColumn("target", F.when(F.col("x") > 1, F.col("target")))
    with pytest.raises(Exception):
        cw.cross_validate(nulls, cw.logistic(), "lr", TARGET, fold="fold", k=4)


def test_values_seen_in_one_fold_only_are_scored(spark):
    rows = [(i % 2, f"only{i % 2}", float(i % 7), "Yes" if i % 7 > 4 else "No", 1.0) for i in range(140)]
    df = spark.createDataFrame(rows, "fold int, s string, x double, target string, classWeight double")
    found = _wide(cw.cross_validate(df, cw.forest(numTrees=3, maxDepth=3), "rf", TARGET, fold="fold", k=2))
    assert all(found[i]["auc"] > 0.99 for i in range(2))


def test_skipped_rows_are_not_counted(spark):
    rows = [(i % 2, "a" if i % 3 else None, float(i % 7), "Yes" if i % 7 > 4 else "No", 1.0) for i in range(120)]
    df = spark.createDataFrame(rows, "fold int, s string, x double, target string, classWeight double")
    options = {"target": TARGET, "fold": "fold", "k": 2}
    skipped = _wide(cw.cross_validate(df, cw.logistic(), "lr", invalid="skip", auc_bins=1000, **options))
    kept = _wide(cw.cross_validate(df, cw.logistic(), "lr", **options))
    assert [skipped[i]["n_rows"] for i in range(2)] == [40, 40]
    assert [kept[i]["n_rows"] for i in range(2)] == [60, 60]


def test_staged_tables_are_removed(spark, planted):
    folder = Path(fresh_path(spark)).parent
    before = set(folder.glob("table-*"))
    cw.cross_validate(planted, cw.logistic(maxIter=2), "lr", TARGET, key=KEY, k=2)
    assert set(folder.glob("table-*")) == before


def test_folds_are_filtered_in_the_scan_and_staged_without_a_shuffle(planted):
    folded = cw.hash_folds(planted, KEY, 4)
    with cw.staged(folded, ["fold"]) as table:
        train, test = cw.fold_assembly(table, 1, checked=True)
        for side in (train, test):
            assert "PushedFilters: [IsNotNull(fold)" in side._jdf.queryExecution().executedPlan().toString()
        assert train.count() + test.count() == 1_500
        for path in table.inputFiles():
            folds = [r.fold for r in table.sparkSession.read.parquet(path).collect()]
            assert folds == sorted(folds)


@pytest.mark.parametrize("files", [1, 3, 8])
def test_a_fixed_layout_makes_forests_repeatable(spark, planted, tmp_path, files):
    forest = cw.forest(numTrees=4, maxDepth=3)
    options = {"key": KEY, "k": 3, "partitions": 4}
    planted.repartition(files, F.rand(files)).write.parquet(str(tmp_path / "rows"))
    found = _wide(cw.cross_validate(spark.read.parquet(str(tmp_path / "rows")), forest, "rf", TARGET, **options))
    assert found == _wide(cw.cross_validate(planted, forest, "rf", TARGET, **options))
    with pytest.raises(ValueError, match="key"):
        cw.cross_validate(planted, forest, "rf", TARGET, partitions=4)


def test_names_that_would_clash(planted):
    renamed = planted.withColumnRenamed("c_mktsegment", "cv_fold")
    assert cw.cross_validate(renamed, cw.logistic(maxIter=2), "lr", TARGET, key=KEY, k=2).count() == 10
    with pytest.raises(ValueError, match="'label'"):
        cw.cross_validate(planted.withColumnRenamed("c_mktsegment", "label"), cw.logistic(), "lr", TARGET, key=KEY, k=2)


def test_binned_areas_score_each_fold_once(planted):
    options = {"key": KEY, "k": 2}
    exact = _wide(cw.cross_validate(planted, cw.logistic(), "lr", TARGET, **options))
    binned = _wide(cw.cross_validate(planted, cw.logistic(), "lr", TARGET, auc_bins=100, **options))
    for i in exact:
        assert binned[i]["auc"] == pytest.approx(exact[i]["auc"], abs=0.02)
        assert binned[i]["f1"] == exact[i]["f1"]


def test_models_are_compared_on_the_same_folds(planted):
    estimators = {"lr": cw.logistic(), "gbt": cw.boosted(maxIter=2, maxDepth=2)}
    options = {"key": KEY, "k": 3, "parallelism": 3}
    together = cw.compare_models(planted, estimators, TARGET, **options)
    for name, estimator in estimators.items():
        alone = _wide(cw.cross_validate(planted, estimator, name, TARGET, **options))
        found = _wide(together.filter(F.col("model") == name))
        assert found.keys() == alone.keys()
        assert all(found[i] == pytest.approx(alone[i], abs=1e-9) for i in alone)
    board = cw.leaderboard(cw.cv_summary(together)).orderBy("rank").collect()
    assert [r.model for r in board] == ["gbt", "lr"]


def test_a_bad_estimator_is_found_before_any_training(planted):
    bad = {"lr": cw.logistic(), "gbt": cw.boosted(max_bins=3)}
    with pytest.raises(ValueError, match="bins"):
        cw.compare_models(planted, bad, TARGET, key=KEY, k=2)


def test_leaderboard_ranks_by_mean(spark):
    rows = [
        (m, i, 10, metric, base + i / 100)
        for m, base in (("b", 0.7), ("a", 0.7), ("c", 0.9))
        for i in range(3)
        for metric in ("accuracy", "precision", "recall", "f1", "auc")
    ]
    metrics = spark.createDataFrame(rows, "model string, fold int, n_rows bigint, metric string, value double")
    parts = [cw.cv_summary(metrics.filter(F.col("model") == m)) for m in "abc"]
    for board in (cw.leaderboard(parts), cw.leaderboard(cw.cv_summary(metrics))):
        assert [(r["rank"], r.model) for r in board.orderBy("rank").collect()] == [(1, "c"), (2, "a"), (3, "b")]


@pytest.mark.parametrize(
    "name, estimator, least",
    [
        ("lr", lambda: cw.logistic(), 0.9),
        ("rf", lambda: cw.forest(numTrees=5, maxDepth=3), 0.99),
        ("gbt", lambda: cw.boosted(maxIter=5, maxDepth=3), 0.99),
    ],
)
def test_planted_signal_is_found(spark, sf_dir, name, estimator, least):
    rows = cw.with_class_weight(tables.planted(spark, sf_dir), TARGET)
    metrics = cw.cross_validate(rows, estimator(), name, TARGET, key=KEY, k=3, parallelism=3)
    for fold in _wide(metrics).values():
        assert fold["auc"] > least
        assert fold["recall"] == fold["accuracy"]
