import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

import classweave as cw
from workload import queries, tables

KEY, TARGET = "o_orderkey", "target"
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def planted(spark):
    return cw.with_class_weight(tables.planted(spark, SMALL), TARGET).cache()


def _fit(rows, estimator, **options):
    return cw.fit_pipeline(rows, estimator, target=TARGET, exclude=[KEY], **options)


def test_default_parameters(spark):
    def values(estimator, *names):
        return {n: estimator.getOrDefault(n) for n in names}

    trees = ("numTrees", "maxDepth", "maxBins", "seed", "weightCol")
    assert values(cw.ranking_forest(), *trees) == dict(zip(trees, (20, 5, 64, 42, "classWeight")))
    assert values(cw.forest(), *trees) == dict(zip(trees, (50, 10, 64, 42, "classWeight")))
    names = ("maxIter", "maxDepth", "stepSize", "maxBins", "seed", "weightCol")
    assert values(cw.boosted(), *names) == dict(zip(names, (50, 5, 0.1, 32, 42, "classWeight")))
    names = ("maxIter", "regParam", "elasticNetParam", "weightCol")
    assert values(cw.logistic(), *names) == dict(zip(names, (50, 0.01, 0.0, "classWeight")))
    assert not cw.forest(weight=None, numTrees=3).isSet("weightCol")


def test_ridge_gradient_vanishes(planted):
    model = _fit(planted, cw.logistic(tol=1e-12, maxIter=500))
    rows = model.transform(planted).select(vector_to_array("features").alias("x"), "label", "classWeight").toPandas()
    x, y, w = np.stack(rows.x), rows.label.to_numpy(), rows.classWeight.to_numpy()
    beta, intercept = model.stages[-1].coefficients.toArray(), model.stages[-1].intercept
    p = 1 / (1 + np.exp(-(x @ beta + intercept)))
    mean = (w @ x) / w.sum()
    sigma = np.sqrt(w @ (x - mean) ** 2 / (w.sum() - (w @ w) / w.sum()))
    gradient = (w * (p - y)) @ x / w.sum() / sigma + 0.01 * beta * sigma
    assert np.abs(gradient).max() < 1e-6
    assert abs((w * (p - y)).sum() / w.sum()) < 1e-6


def test_ranking_finds_the_planted_features_and_sums_to_one(planted):
    ranking = cw.rank_features(planted, TARGET, exclude=[KEY])
    rows = ranking.orderBy("rank").collect()
    assert {rows[0].feature, rows[1].feature} == {"o_totalprice", "c_mktsegment"}
    assert sum(r.score for r in rows) == pytest.approx(1)
    assert [r.score for r in rows] == sorted((r.score for r in rows), reverse=True)
    assert cw.top_features(ranking).count() == 6 and cw.top_features(ranking, 2).count() == 2
    assert cw.top_names(ranking, 2) == [rows[0].feature, rows[1].feature]


def test_ties_keep_the_slot_order(spark):
    rows = [(1.0, 2.0, float(i % 2), "Yes" if i % 2 else "No") for i in range(40)]
    df = spark.createDataFrame(rows, "b double, a double, x double, t string")
    ranking = cw.rank_features(df, "t", None, estimator=cw.ranking_forest(weight=None, numTrees=1, bootstrap=False))
    assert cw.top_names(ranking) == ["x", "b", "a"]


def test_stable_layout_makes_forests_repeatable(planted):
    scores = set()
    for n in (1, 3, 8):
        rows = cw.stable_layout(planted.repartition(n), KEY, 2)
        ranking = cw.rank_features(rows, TARGET, exclude=[KEY])
        scores.add(tuple(tuple(r) for r in ranking.orderBy("rank").collect()))
    assert len(scores) == 1


def test_projection_keeps_rank_order(planted):
    assert cw.project_top(planted, ["o_totalprice", "c_acctbal"], TARGET).columns == [
        TARGET, "classWeight", "o_totalprice", "c_acctbal",
    ]
    with pytest.raises(ValueError, match="nothing"):
        cw.project_top(planted, ["nothing"], TARGET)


def test_skip_drops_only_rows_without_a_category_from_the_fit(spark):
    rows = [("a" if i % 2 else "b", "Yes" if i % 2 else "No") for i in range(40)] + [(None, "No")] * 5
    df = spark.createDataFrame(rows, "s string, t string")
    options = {"target": "t", "weight": None}
    small = {"weight": None, "numTrees": 1, "maxDepth": 1, "bootstrap": False}
    skipped = cw.fit_pipeline(df, cw.forest(**small), invalid="skip", **options)
    assert skipped.transform(df).count() == 40
    assert cw.fit_pipeline(df, cw.forest(**small), invalid="keep", **options).transform(df).count() == 45


@pytest.mark.parametrize("estimator", [cw.logistic, lambda: cw.forest(numTrees=3), lambda: cw.boosted(maxIter=2)])
def test_saved_model_scores_the_same(planted, tmp_path, estimator):
    model, path = _fit(planted, estimator()), str(tmp_path / "model")
    cw.save_model(model, path)
    cw.save_model(model, path)

    def scores(m):
        rows = cw.batch_score(planted, m, [KEY]).collect()
        return {r[KEY]: (r.prediction, tuple(r.probability)) for r in rows}

    found = scores(path)
    assert found == scores(model)
    assert all(sum(p) == pytest.approx(1) for _, p in found.values())


def test_scoring_needs_no_target_and_ignores_its_values(planted):
    model = _fit(planted, cw.logistic())
    expected = cw.batch_score(planted, model).collect()
    assert cw.batch_score(planted.drop(TARGET), model).collect() == expected
    strange = planted.withColumn(TARGET, F.lit("Perhaps"))
    assert cw.batch_score(strange, model).collect() == expected
    kept = cw.batch_score(strange, model, [TARGET, KEY])
    assert kept.columns == [TARGET, KEY, "prediction", "probability"] and kept.count() == 1_500
    assert cw.batch_score(planted, model).columns == ["prediction", "probability"]


def test_positive_class_is_looked_up(planted):
    rare = _fit(planted, cw.logistic())
    assert cw.positive_index(rare, "Yes") == 1 and cw.positive_index(rare, "No") == 0
    swapped = F.when(F.col(TARGET) == "Yes", "No").otherwise("Yes")
    common = _fit(planted.withColumn(TARGET, swapped), cw.logistic())
    assert cw.positive_index(common, "Yes") == 0
    with pytest.raises(ValueError, match="Maybe"):
        cw.positive_index(rare, "Maybe")
    view = cw.prediction_view(cw.batch_score(planted, rare), cw.positive_index(rare, "No"))
    complement = cw.prediction_view(cw.batch_score(planted, rare))
    sums = [a[0] + b[0] for a, b in zip(view.collect(), complement.collect())]
    assert sums == pytest.approx([1.0] * 1_500, abs=2e-4)


def test_forest_of_one_class_has_no_second_probability(spark):
    df = spark.createDataFrame([("No", float(i)) for i in range(10)], "t string, x double")
    model = cw.fit_pipeline(df, cw.forest(weight=None, numTrees=1), target="t", weight=None)
    view = cw.prediction_view(cw.batch_score(df, model)).distinct().collect()
    assert [tuple(r) for r in view] == [(None, 0)]


def test_view_rounds_half_up_and_names_are_arguments(spark):
    from pyspark.ml.linalg import Vectors

    rows = [(Vectors.dense([0.87655, 0.12345]), 0.0), (Vectors.sparse(2, {1: 1.0}), 1.0)]
    df = spark.createDataFrame(rows, ["probability", "prediction"])
    assert [tuple(r) for r in cw.prediction_view(df).collect()] == [(0.1235, 0), (1.0, 1)]
    named = cw.prediction_view(df, probability_name="p", class_name="c")
    assert named.columns == ["p", "c"]
    assert {tuple(r) for r in cw.prediction_distribution(named, "c").collect()} == {(0, 1), (1, 1)}
    assert cw.prediction_sample(named, ["p"], 1).collect()[0].p == 0.1235
    assert cw.prediction_sample(named).count() == 2


def test_train_lr_wide_trains_on_a_name_per_customer(spark, monkeypatch):
    """All names of customers with orders are indexed and scored by, and none of them comes to the driver."""
    collected = []
    plain = type(spark.range(1)).collect
    monkeypatch.setattr(type(spark.range(1)), "collect", lambda self: collected.append(plain(self)) or collected[-1])
    found = queries.train_lr_wide(spark, SMALL)
    assert max(map(len, collected), default=0) <= 3
    rows = plain(found)
    orders = spark.read.parquet(f"{SMALL}/orders.parquet")
    names = orders.join(spark.read.parquet(f"{SMALL}/customer.parquet"), F.col("o_custkey") == F.col("c_custkey"))
    counts = {r.c_name: r["count"] for r in plain(names.groupBy("c_name").count())}
    place = {n: float(i) for i, n in enumerate(sorted(counts, key=lambda n: (-counts[n], n)))}
    assert len(place) > 50
    assert {r[KEY]: r.name_index for r in rows} == {r[KEY]: place[r.c_name] for r in plain(names)}
    assert len(rows) == orders.count() and all(r.same_score for r in rows)
    # Two bands alone would give two scores.
    assert len({r.probability for r in rows}) > 10
