import hashlib

import pytest
from pyspark.sql import functions as F

import classweave as cw


@pytest.fixture(scope="module")
def numbers(spark):
    return spark.range(0, 5_000, numPartitions=4).select("id", (F.col("id") % 13).alias("x"), F.rand(1).alias("r"))


def test_random_folds_are_those_of_random_split(numbers):
    found = {r.id: r.fold for r in cw.random_folds(numbers, 10, seed=42).collect()}
    for i, part in enumerate(numbers.randomSplit([0.1] * 10, seed=42)):
        assert {found[r.id] for r in part.select("id").collect()} == {i}
    assert len(found) == 5_000 and set(found.values()) == set(range(10))


def test_random_folds_tolerate_columns_that_cannot_be_sorted(spark):
    df = spark.range(100).select("id", F.create_map(F.lit("k"), "id").alias("m"))
    assert {r.fold for r in cw.random_folds(df, 3).collect()} == {0, 1, 2}


def test_hash_folds_ignore_the_layout(numbers):
    def folds(df):
        return {r.id: r.fold for r in cw.hash_folds(df, "id", 7).collect()}

    assert folds(numbers) == folds(numbers.repartition(9, "r")) == folds(numbers.coalesce(1).orderBy("r"))


def test_hash_folds_are_the_digest_of_seed_and_key(numbers):
    for row in cw.hash_folds(numbers.limit(200), "id", 7, seed=5).collect():
        assert row.fold == int(hashlib.md5(f"5:{row.id}".encode()).hexdigest()[:8], 16) % 7


def test_hash_folds_depend_on_seed_and_on_every_key(numbers):
    base = cw.hash_folds(numbers, "id", 10)
    other = cw.hash_folds(numbers, "id", 10, seed=7).withColumnRenamed("fold", "other")
    assert base.join(other, "id").filter("fold <> other").count() > 4_000
    two = cw.hash_folds(numbers, ["x", "id"], 10)
    assert {r.fold for r in two.select("fold").distinct().collect()} == set(range(10))
    shared = cw.hash_folds(numbers, "x", 10).groupBy("x").agg(F.count_distinct("fold").alias("n"))
    assert shared.filter("n <> 1").count() == 0


def test_train_and_test_are_disjoint_and_complete(numbers):
    folded = cw.hash_folds(numbers, "id", 5)
    sizes = {r.fold: (r.train_rows, r.test_rows) for r in cw.fold_sizes(folded).collect()}
    for i in range(5):
        train, test = cw.fold_assembly(folded, i)
        assert (train.count(), test.count()) == sizes[i]
        assert train.join(test, "id").count() == 0
        assert sum(sizes[i]) == 5_000


def test_rows_without_a_fold_are_refused(numbers):
    folded = cw.hash_folds(numbers, "id", 5).withColumn("fold", F.when(F.col("id") != 7, F.col("fold")))
    train, test = cw.fold_assembly(folded, 0)
    with pytest.raises(Exception, match="fold is NULL"):
        train.collect()


def test_absent_key_is_an_error(numbers):
    with pytest.raises(ValueError, match="nokey"):
        cw.hash_folds(numbers, "nokey")
