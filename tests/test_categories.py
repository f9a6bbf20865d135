import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

import classweave as cw


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of all rows hold one value, a tenth NULL, the rest are nearly unique."""
    i = F.col("id")
    return spark.range(0, 20_000, numPartitions=6).select(
        "id",
        F.when(i % 2 == 0, "hot").when(i % 10 == 1, F.lit(None)).otherwise(F.concat(F.lit("v"), i % 7001)).alias("w"),
        F.when(i % 3 == 0, "one").otherwise("two").alias("c"),
    )


@pytest.fixture(scope="module")
def table(skewed, tmp_path_factory):
    return cw.write_category_table(skewed, ["w", "c"], str(tmp_path_factory.mktemp("categories") / "table"))


def test_table_lists_every_value_once_in_the_engine_s_order(skewed, table):
    for column in ("w", "c"):
        labels = StringIndexer(inputCol=column, outputCol="i").fit(skewed).labels
        rows = table.filter(F.col("column") == column).orderBy("index").collect()
        assert [r.value for r in rows] == list(labels)
        assert [r["index"] for r in rows] == [float(i) for i in range(len(labels))]
        assert {r.total for r in rows} == {sum(r.n for r in rows)} == {skewed.filter(F.col(column).isNotNull()).count()}


@pytest.mark.parametrize("invalid", ["keep", "skip"])
def test_join_gives_the_same_indices_as_the_indexer(skewed, table, invalid):
    expected = cw.string_index(skewed, ["w", "c"], invalid=invalid).select("id", "w", "c", "w_idx", "c_idx")
    found = cw.index_by_table(skewed, table, ["w", "c"], invalid=invalid)
    assert found.columns == expected.columns
    assert found.exceptAll(expected).count() == 0 and expected.exceptAll(found).count() == 0


def test_unseen_values(spark, skewed, table):
    later = skewed.limit(3).unionAll(spark.createDataFrame([(-1, "new", "one"), (-2, None, "two")], skewed.schema))
    kept = {r.id: r.w_idx for r in cw.index_by_table(later, table, ["w"]).collect()}
    n_values = float(table.filter("column = 'w'").count())
    assert kept[-1] == kept[-2] == n_values and len(kept) == 5
    skipped = {r.id for r in cw.index_by_table(later, table, ["w"], invalid="skip").collect()}
    assert not skipped & {-1, -2}
    with pytest.raises(Exception, match="unseen"):
        cw.index_by_table(later, table, ["w"], invalid="error").collect()
    with pytest.raises(ValueError, match="invalid"):
        cw.index_by_table(later, table, ["w"], invalid="drop")


def test_rows_of_frequent_values_are_not_shuffled(spark, skewed, table, tmp_path):
    path = str(tmp_path / "rows")
    skewed.write.parquet(path)
    rows = spark.read.parquet(path)
    found = cw.index_by_table(rows, table, ["w", "c"])
    # Two scans of the rows whatever the number of columns, each with one broadcast per column.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=broadcast") == 4
    assert plan.count("Relation [id") == 2
    settled = found.filter("w = 'hot'")
    assert settled.count() == 10_000 and settled.select("w_idx").distinct().count() == 1


def test_columns_that_need_quoting(spark, skewed, tmp_path):
    rows = skewed.withColumnRenamed("w", "a.b").withColumnRenamed("c", "d`e")
    table = cw.write_category_table(rows, ["a.b", "d`e"], str(tmp_path / "t"))
    found = cw.index_by_table(rows, table, ["a.b", "d`e"], ["i", "j"], invalid="skip")
    assert found.columns == ["id", "a.b", "d`e", "i", "j"] and found.count() == 18_000
