"""String columns with very many values: indices by joining with a table, in pipelines, folds and saved models."""

import pytest
from pyspark.sql import functions as F

import classweave as cw


@pytest.fixture(scope="module")
def many(spark):
    """300,000 values, each once, the first half of them mostly positive."""
    rows = spark.range(300_000).select(
        "id",
        F.format_string("v%06d", "id").alias("name"),
        (F.col("id") % 7).cast("double").alias("x"),
        F.when((F.col("id") < 150_000) == (F.col("id") % 10 != 0), "Yes").otherwise("No").alias("target"),
    )
    with cw.staged(rows) as table:
        yield table


def test_a_model_over_300_000_values_is_saved_and_loaded(spark, many, tmp_path):
    options = {"target": "target", "weight": None, "exclude": ["id"], "wide": ["name"]}
    model = cw.fit_pipeline(many, cw.logistic(weight=None), **options)
    cw.save_model(model, str(tmp_path / "model"))
    loaded = cw.load_model(str(tmp_path / "model"))
    known = many.filter("id % 1000 = 1").unionByName(many.limit(1).withColumns({"name": F.lit("unseen"), "id": F.lit(-1)}))
    found = {r.id: r for r in loaded.transform(known).select("id", "name_idx", "prediction", "label").collect()}
    assert found[-1].name_idx == 300_000 and found[5_001].name_idx == 5_001
    right = [r.prediction == r.label for r in found.values()]
    assert sum(right) > 0.8 * len(right)
    assert cw.positive_index(loaded, "Yes") in (0, 1)


def test_five_million_labels_raise_before_any_reaches_the_driver(spark, monkeypatch):
    rows = spark.range(5_000_000).select(F.col("id").cast("string").alias("key"), F.lit("b").alias("c"), F.when(F.col("id") % 3 == 0, "Yes").otherwise("No").alias("target"))
    report = {r.column: r for r in cw.string_cardinality(rows, "target", None).collect()}
    assert abs(report["key"].n_categories - 5_000_000) < 500_000 and report["key"].share > 0.9
    assert report["key"].wide and not report["c"].wide and report["c"].n_categories == 1
    assert cw.wide_columns(rows, "target", None) == ["key"] and cw.wide_columns(rows, "target", None, bound=10**8) == []
    collected = []
    plain = type(rows).collect
    monkeypatch.setattr(type(rows), "collect", lambda self: collected.append(plain(self)) or collected[-1])
    with pytest.raises(ValueError, match="wide"):
        cw.fit_pipeline(rows, cw.logistic(weight=None), target="target", weight=None)
    assert max(map(len, collected)) <= 3


def test_the_bound_on_labels(many):
    model = cw.fit_pipeline(many, cw.logistic(weight=None, maxIter=3), target="target", weight=None, exclude=["id"])
    assert len(model.stages[0].labels) == 300_000
    with pytest.raises(ValueError, match="wide"):
        cw.fit_pipeline(many, cw.logistic(weight=None), target="target", weight=None, exclude=["id"], max_categories=10)


def test_folds_index_by_their_own_tables(spark, many):
    few = many.filter("id % 500 < 3").select("id", F.substring("name", 1, 5).alias("name"), "target")
    options = {"target": "target", "weight": None, "key": "id", "k": 3}
    for invalid in ("keep", "skip"):
        by_table = cw.cross_validate(few, cw.logistic(weight=None), "lr", wide=["name"], invalid=invalid, **options)
        by_label = cw.cross_validate(few, cw.logistic(weight=None), "lr", invalid=invalid, **options)
        pairs = by_table.alias("a").join(by_label.alias("b"), ["fold", "metric"]).select("a.n_rows", F.col("b.n_rows").alias("m"), "a.value", F.col("b.value").alias("other")).collect()
        assert len(pairs) == 15
        for r in pairs:
            assert r.n_rows == r.m and r.value == pytest.approx(r.other, abs=1e-6)


def test_ranking_takes_wide_columns(many):
    few = many.filter("id % 500 < 3")
    ranking = cw.rank_features(few, "target", None, ["id"], cw.ranking_forest(weight=None), wide=["name"])
    assert cw.top_names(ranking, 1) == ["name"]


def test_wide_columns_must_be_string_features(many):
    for name in ("x", "id", "nothing"):
        with pytest.raises(ValueError, match="wide column"):
            cw.fit_pipeline(many, cw.logistic(weight=None), target="target", weight=None, exclude=["id"], wide=[name])


def test_shares_order_categories_for_trees(spark, tmp_path):
    """One split over 2,000 names must find the best of all subsets, which frequencies hide."""
    rows = spark.range(20_000).select(
        "id",
        F.concat(F.lit("n"), F.col("id") % 2000).alias("name"),
        (1 + F.col("id") % 3).cast("double").alias("classWeight"),
        F.when(F.col("id") % 2000 % 7 < 2, "Yes").otherwise("No").alias("target"),
    )
    stump = cw.forest(numTrees=1, maxDepth=1, bootstrap=False, maxBins=4096)
    options = {"target": "target", "exclude": ["id"], "wide": ["name"]}
    with cw.staged(rows) as table:
        model = cw.fit_pipeline(table, stump, order="target", **options)
        cw.save_model(model, str(tmp_path / "model"))
        blind = cw.fit_pipeline(table, stump, **options)
        scored = cw.load_model(str(tmp_path / "model")).transform(table)
        assert scored.filter("prediction <> label").count() == 0
        assert blind.transform(table).filter("prediction <> label").count() > 1000
        with pytest.raises(ValueError, match="order"):
            cw.fit_pipeline(table, stump, order="share", **options)
    new = spark.createDataFrame([("new",), (None,)], "name string")
    found = cw.load_model(str(tmp_path / "model")).transform(new).select("name_idx", "prediction").collect()
    # 572 of the 2,000 names are positive: the others have a share of 0 and stand below the table's.
    assert [tuple(r) for r in found] == [(1427.5, 0.0)] * 2 or [r.name_idx for r in found] == [1427.5] * 2


def test_shares_of_a_fold_come_from_the_other_folds(spark):
    """A name whose rows lie in one fold only is unseen there, whatever its own share."""
    rows = spark.range(6000).select(
        "id", (F.col("id") % 3).cast("int").alias("fold"),
        F.when(F.col("id") % 10 == 0, F.concat(F.lit("only"), F.col("id") % 3)).otherwise(F.concat(F.lit("n"), F.col("id") % 50)).alias("name"),
        F.when(F.col("id") % 50 < 20, "Yes").otherwise("No").alias("target"),
    )
    shares = {r.value: r for r in cw.category_shares(rows, ["name"], "target", "Yes", fold="fold", k=3).collect()}
    assert shares["only1"].n1 == 0 and shares["only1"].total1 == 0.0 and shares["only1"].n0 == shares["only1"].n
    for value in ("n7", "only2"):
        for i in range(3):
            own = rows.filter((F.col("name") == value) & (F.col("fold") != i))
            assert (shares[value][f"n{i}"], shares[value][f"positive{i}"]) == (own.count(), own.filter("target = 'Yes'").count())
    options = {"target": "target", "weight": None, "fold": "fold", "exclude": ["id"], "k": 3, "wide": ["name"], "invalid": "skip"}
    metrics = cw.cross_validate(rows, cw.forest(weight=None, numTrees=1, maxDepth=1, bootstrap=False), "rf", order="target", **options)
    skipped = rows.filter("name LIKE 'only%'").groupBy("fold").count().collect()
    sizes = {r.fold: r.n_rows for r in metrics.collect()}
    assert all(sizes[r.fold] == 2000 - r["count"] for r in skipped)
