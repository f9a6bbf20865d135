import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array

import classweave as cw
from classweave.operators.features import collect_bounded


@pytest.fixture(scope="module")
def mixed(spark):
    rows = [
        (1, "a", 1.0, "x", True, "No", 1.0),
        (2, "b", 2.0, None, False, "No", 1.0),
        (3, "b", 3.0, "y", True, "Yes", 2.0),
        (4, None, 4.0, "y", True, "No", 1.0),
    ]
    return spark.createDataFrame(
        rows, "id int, s string, x double, s_idx string, flag boolean, HadHeartAttack string, classWeight double"
    )


def test_roles_follow_schema_order_and_leave_out_target_weight_and_keys(mixed):
    roles = cw.column_roles(mixed, exclude=["id"])
    assert roles.numeric == ("x", "flag") and roles.strings == ("s", "s_idx")
    assert roles.features == ("x", "flag", "s", "s_idx")


def test_index_columns_never_collide_with_source_columns(mixed):
    roles = cw.column_roles(mixed, exclude=["id"])
    assert roles.indexed == ("s_idx_", "s_idx_idx")
    assert cw.assemble(mixed, exclude=["id"]).count() == 4


@pytest.mark.parametrize("column", ["day date", "seen timestamp", "tags array<string>", "`a.b` int"])
def test_features_that_no_vector_can_hold_are_refused(spark, column):
    df = spark.createDataFrame([], f"{column}, HadHeartAttack string")
    with pytest.raises(ValueError, match="feature"):
        cw.column_roles(df)
    name = column.split()[0].strip("`")
    assert cw.column_roles(df, exclude=[name]).features == ()


def test_assembled_slots_are_numbers_then_indices(mixed):
    rows = cw.assemble(mixed, exclude=["id"]).select("id", "label", vector_to_array("features").alias("v"))
    found = {r.id: (r.label, r.v) for r in rows.collect()}
    assert found[1] == (0.0, [1.0, 1.0, 1.0, 1.0])
    assert found[2] == (0.0, [2.0, 0.0, 0.0, 2.0])
    assert found[3] == (1.0, [3.0, 1.0, 0.0, 0.0])
    assert found[4] == (0.0, [4.0, 1.0, 2.0, 0.0])


@pytest.fixture(scope="module")
def words(spark):
    draw = random.Random(7)
    # Ties, empty text, and characters beyond the basic plane.
    pool = ["", "b", "a", "B", "ﬁ", "\U0001f600", "z", "ä", "aa", None]
    rows = [(i, draw.choice(pool), draw.choice(pool[:4])) for i in range(300)]
    rows += [(300 + i, w, "a") for i, w in enumerate(["t1", "t3", "t2", "￮", "\U0001f601"])]
    return spark.createDataFrame(rows, "id int, p string, q string")


@pytest.mark.parametrize("invalid", ["keep", "skip"])
def test_indices_equal_the_indexer_of_the_engine(words, invalid):
    expected = StringIndexer(
        inputCols=["p", "q"], outputCols=["p_idx", "q_idx"], handleInvalid=invalid
    ).fit(words).transform(words)
    found = cw.string_index(words, ["p", "q"], invalid=invalid)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
    assert [f.metadata for f in found.schema] == [f.metadata for f in expected.schema]


def test_labels_of_another_table_leave_values_unseen(words):
    labels = cw.category_labels(words.filter("q <> 'a'"), ["q"])
    assert "a" not in labels["q"]
    kept = cw.string_index(words, ["q"], labels=labels)
    assert {r.q_idx for r in kept.filter("q = 'a'").collect()} == {float(len(labels["q"]))}
    skipped = cw.string_index(words, ["q"], labels=labels, invalid="skip")
    assert skipped.count() == words.filter("q <> 'a'").count()
    with pytest.raises(Exception):
        cw.string_index(words, ["q"], labels=labels, invalid="error").collect()


def test_labels_beyond_the_bound_are_refused_not_cut(words):
    assert len(cw.category_labels(words, ["p"], max_categories=14)["p"]) == 14
    with pytest.raises(ValueError, match="more than 13 categories"):
        cw.category_labels(words, ["p"], max_categories=13)
    assert len(collect_bounded(cw.category_counts(words, ["q"]), 4)) == 4


def test_null_label_raises(spark):
    df = spark.createDataFrame([("Yes",), ("No",), ("No",), (None,)], "HadHeartAttack string")
    with pytest.raises(Exception):
        cw.label_index(df).collect()


def test_null_number_raises(mixed):
    with pytest.raises(Exception):
        cw.assemble(mixed.selectExpr("nullif(x, 2.0) AS x", "HadHeartAttack"), weight=None).collect()


def test_three_classes_and_no_features_are_refused(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0)], "t string, x double")
    with pytest.raises(ValueError, match="3 classes"):
        cw.build_pipeline(df, cw.logistic(weight=None), "t", None)
    with pytest.raises(ValueError, match="no feature"):
        cw.build_pipeline(df.drop("x"), cw.logistic(weight=None), "t", None)


@pytest.mark.parametrize("values, invalid, fits", [(31, "keep", True), (32, "keep", False), (32, "skip", True)])
def test_trees_need_a_bin_per_category(spark, values, invalid, fits):
    rows = [(f"v{i % values}", "Yes" if i % 3 else "No") for i in range(200)]
    df = spark.createDataFrame(rows, "s string, t string")
    options = {"target": "t", "weight": None, "invalid": invalid}
    small = {"weight": None, "maxIter": 1, "maxDepth": 1}
    if fits:
        cw.fit_pipeline(df, cw.boosted(**small), **options)
    else:
        with pytest.raises(ValueError, match="'s' needs 33 bins"):
            cw.fit_pipeline(df, cw.boosted(**small), **options)
        cw.fit_pipeline(df, cw.boosted(max_bins=64, **small), **options)


def test_pipeline_equals_one_of_plain_stages(mixed):
    roles = cw.column_roles(mixed, exclude=["id"])
    stages = [
        StringIndexer(inputCols=list(roles.strings), outputCols=list(roles.indexed), handleInvalid="keep"),
        StringIndexer(inputCol="HadHeartAttack", outputCol="label"),
        VectorAssembler(inputCols=list(roles.slots), outputCol="features"),
        cw.logistic(),
    ]
    expected = Pipeline(stages=stages).fit(mixed).transform(mixed).select("id", "probability")
    found = cw.fit_pipeline(mixed, cw.logistic(), exclude=["id"]).transform(mixed).select("id", "probability")
    for a, b in zip(sorted(found.collect()), sorted(expected.collect())):
        assert a.id == b.id and a.probability.toArray() == pytest.approx(b.probability.toArray(), abs=1e-9)


@pytest.mark.parametrize("estimator", [cw.logistic, cw.forest, cw.boosted])
def test_column_without_any_value_does_no_harm(spark, estimator):
    rows = [(None, float(i), "Yes" if i > 20 else "No") for i in range(40)]
    df = spark.createDataFrame(rows, "s string, x double, t string")
    small = {"maxIter": 2} if estimator is not cw.forest else {"numTrees": 2}
    model = cw.fit_pipeline(df, estimator(weight=None, **small), target="t", weight=None)
    assert model.transform(df).filter("s_idx = 0").count() == 40
    assert cw.string_index(df, ["s"], invalid="skip").count() == 0


def test_column_report_counts_categories(mixed):
    report = {r.column: (r.role, r.slot, r.n_categories) for r in cw.column_report(mixed, exclude=["id"]).collect()}
    assert report["s"] == ("string", 2, 2) and report["flag"] == ("numeric", 1, None)
    assert report["HadHeartAttack"] == ("target", None, 2)
