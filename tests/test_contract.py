"""Models know their columns, and a table that does not fit them is refused."""

import pytest
from pyspark.sql import functions as F

import classweave as cw
from classweave.operators.contract import contract_from


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(60).select(
        "id",
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("c"),
        (F.col("id") / 7).alias("x"),
        (F.col("id") % 2 == 0).alias("flag"),
        F.when(F.col("id") % 4 == 0, "Yes").otherwise("No").alias("target"),
    )


@pytest.fixture(scope="module")
def path(rows, tmp_path_factory):
    model = cw.fit_pipeline(rows, cw.logistic(weight=None, maxIter=3), target="target", weight=None, exclude=["id"])
    folder = str(tmp_path_factory.mktemp("models") / "model")
    cw.save_model(model, folder)
    cw.save_model(model, folder)
    return folder


def test_the_contract_is_saved_with_the_model(spark, path):
    found = [tuple(r) for r in cw.feature_contract(spark, cw.load_model(path)).collect()]
    assert found == [("x", "double", "feature", 0), ("flag", "boolean", "feature", 1), ("c", "string", "feature", 2), ("target", "string", "target", None)]


def test_a_table_that_fits_is_scored(rows, path):
    assert cw.batch_score(rows.drop("target"), path, ["id"]).count() == 60
    # Any number serves as a number, and further columns or another order do no harm.
    other = rows.select(F.lit("d").alias("more"), "c", "flag", F.col("x").cast("float").alias("x"), "id")
    assert cw.batch_score(other, path, ["id"]).count() == 60


@pytest.mark.parametrize(
    "change, message",
    [
        (lambda df: df.drop("x"), "'x'"),
        (lambda df: df.withColumnRenamed("c", "C"), "'C'"),
        (lambda df: df.withColumn("c", F.lit(1)), "'c' is int"),
        (lambda df: df.withColumn("x", F.col("x") > 3), "'x' is boolean"),
        (lambda df: df.withColumn("x", F.col("x").cast("string")), "'x' is string"),
        (lambda df: df.withColumn("flag", F.lit(1.0)), "'flag' is double"),
        (lambda df: df.withColumn("x", F.current_date()), "'x' is date"),
    ],
)
def test_other_tables_are_refused_by_name(rows, path, change, message):
    with pytest.raises(ValueError, match=message):
        cw.batch_score(change(rows), path)


def test_a_model_without_a_contract_scores_as_before(rows, path):
    from pyspark.ml import PipelineModel

    plain = PipelineModel.load(path)
    assert contract_from(plain) == [] and cw.batch_score(rows, plain).count() == 60
