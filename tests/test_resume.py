"""Cross-validation that is stopped and started again, weights and rankings per fold."""

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

import classweave as cw
from classweave.operators import resume
from classweave.operators.estimators import LOGISTIC
from workload import tables

KEY, TARGET = "o_orderkey", "target"
SMALL = "/root/testdata/sf0.001"


class Stopped(BaseException):
    """As if the driver was lost."""


class Counting(LogisticRegression):
    """Counts its fits, and stops the run after so many."""

    fits, most = 0, None

    def _fit(self, dataset):
        if Counting.most is not None and Counting.fits >= Counting.most:
            raise Stopped
        Counting.fits += 1
        return super()._fit(dataset)


@pytest.fixture(scope="module")
def planted(spark):
    with cw.staged(cw.with_class_weight(tables.planted(spark, SMALL), TARGET)) as table:
        yield table


def counting(**params):
    return Counting(featuresCol="features", labelCol="label", weightCol="classWeight", **{**LOGISTIC, "maxIter": 5, **params})


def rows_of(metrics):
    return {(r.model, r.fold, r.metric): (r.n_rows, r.value) for r in metrics.collect()}


def test_a_stopped_run_goes_on_where_it_was(spark, planted, tmp_path):
    folder, options = str(tmp_path / "log"), {"key": KEY, "k": 4, "wide": ["o_orderpriority"]}

    def run(**more):
        Counting.fits = 0
        return rows_of(cw.cross_validate(planted, counting(**more.pop("params", {})), "lr", TARGET, **{**options, **more}))

    Counting.most = None
    plain = run()
    assert Counting.fits == 4
    Counting.most = 2
    with pytest.raises(Stopped):
        run(resume=folder)
    Counting.most = None
    again = run(resume=folder)
    assert Counting.fits == 2
    assert again.keys() == plain.keys()
    assert all(again[k] == pytest.approx(plain[k], abs=1e-9) for k in plain)
    assert run(resume=folder) == again and Counting.fits == 0
    # Other parameters, rows or bins are other fits or measures.
    run(resume=folder, params={"regParam": 0.5})
    assert Counting.fits == 4
    run(resume=folder, auc_bins=10)
    assert Counting.fits == 0
    Counting.fits = 0
    changed = planted.withColumn("o_totalprice", F.when(F.col(KEY) == 1, -1.0).otherwise(F.col("o_totalprice")))
    cw.cross_validate(changed, counting(), "lr", TARGET, resume=folder, **options).collect()
    assert Counting.fits == 4
    with pytest.raises(ValueError, match="resumed"):
        cw.cross_validate(planted, counting(), "lr", TARGET, k=4, resume=folder)


def test_an_entry_that_was_cut_short_does_not_count(spark, tmp_path):
    log = resume.FitLog(spark, str(tmp_path / "log"), "data", {})
    key = log.key(counting(), 0)
    log.keep_metrics(key, "lr", 0, {"n_rows": 3, "auc": 0.1 + 0.2, "f1": None})
    assert log.measured(key) == {"n_rows": 3, "auc": 0.1 + 0.2, "f1": None}
    entry = next((tmp_path / "log" / key).glob("entry-*"))
    text = entry.read_text()
    for crc in (tmp_path / "log" / key).glob(".*.crc"):
        crc.unlink()
    entry.write_text(text[:20])
    assert log.measured(key) is None
    log.keep_metrics(key, "lr", 0, {"n_rows": 4})
    assert log.measured(key) == {"n_rows": 4}


def test_fingerprints_see_every_change_but_order(spark):
    rows = [(1, "a", None), (2, None, "a"), (2, None, "a"), (3, "x", "y")]
    schema = "k int, s string, t string"
    own = resume.table_fingerprint(spark.createDataFrame(rows, schema))
    assert own == resume.table_fingerprint(spark.createDataFrame(rows[::-1], schema).repartition(3))
    others = [rows[:3], [*rows, rows[0]], [(1, None, "a"), *rows[1:]], [(1, "a", ""), *rows[1:]], []]
    assert own not in {resume.table_fingerprint(spark.createDataFrame(x, schema)) for x in others}
    assert own != resume.table_fingerprint(spark.createDataFrame(rows, "k long, s string, t string"))


def test_weights_of_a_fold_come_from_the_other_folds(planted):
    folded = cw.hash_folds(planted.drop("classWeight"), KEY, 3)
    options = {"target": TARGET, "fold": "fold", "k": 3, "exclude": [KEY]}
    found = rows_of(cw.cross_validate(folded, cw.logistic(), "lr", weights="fold", positive="Yes", **options))
    for i in range(3):
        train, test = cw.fold_assembly(folded, i)
        model = cw.fit_pipeline(cw.with_class_weight(train, TARGET), cw.logistic(), target=TARGET, exclude=[KEY, "fold"])
        scored = model.transform(test).select("label", "prediction", cw.class_score("rawPrediction").alias("score"))
        for name, value in cw.metrics_table(scored).first().asDict().items():
            if name != "n_rows":
                assert found["lr", i, name][1] == pytest.approx(value, abs=1e-6)
    assert found == rows_of(cw.cross_validate(folded, cw.logistic(), "lr", weights="fold", **options))  # positives are rarer
    one = folded.filter("target = 'No' OR fold = 1")
    with pytest.raises(ValueError, match="fold"):
        cw.cross_validate(one, cw.logistic(), "lr", weights="fold", positive="Yes", **options)


def test_rankings_of_a_fold_come_from_the_other_folds(planted):
    folded = cw.hash_folds(planted, KEY, 3)
    ranker = cw.ranking_forest(numTrees=1, bootstrap=False, maxDepth=3)
    ranked = cw.fold_rankings(folded, TARGET, k=3, exclude=[KEY], ranker=ranker)
    found = {i: [(r.feature, r.score) for r in ranked.filter(F.col("fold") == i).orderBy("rank").collect()] for i in range(3)}
    for i in range(3):
        train, _ = cw.fold_assembly(folded, i)
        alone = cw.rank_features(train.drop("fold"), TARGET, exclude=[KEY], estimator=ranker).orderBy("rank").collect()
        assert [(r.feature, pytest.approx(r.score)) for r in alone] == found[i]
    options = {"target": TARGET, "fold": "fold", "k": 3, "exclude": [KEY]}
    best = rows_of(cw.cross_validate(folded, cw.forest(numTrees=1, maxDepth=2, bootstrap=False), "rf", top_k=2, ranker=ranker, **options))
    for i in range(3):
        kept = cw.project_top(folded, [name for name, _ in found[i][:2]], TARGET, keep_cols=["fold"])
        train, test = cw.fold_assembly(kept, i)
        model = cw.fit_pipeline(train.drop("fold"), cw.forest(numTrees=1, maxDepth=2, bootstrap=False), target=TARGET)
        scored = model.transform(test).select("label", "prediction", cw.class_score("rawPrediction").alias("score"))
        assert best["rf", i, "auc"][1] == pytest.approx(cw.metrics_table(scored).first()["auc"], abs=1e-9)
