import os
from types import SimpleNamespace

import pytest

from pyspark.sql import functions as F

import classweave as cw
from classweave import sources
from classweave.sources import files, staging


def test_csv_types_are_inferred_or_given(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("id,x,word,t\n1,1.5,a,Yes\n2,,,No\n")
    inferred = cw.read_csv(spark, str(path))
    assert inferred.dtypes == [("id", "int"), ("x", "double"), ("word", "string"), ("t", "string")]
    assert [tuple(r) for r in inferred.collect()] == [(1, 1.5, "a", "Yes"), (2, None, None, "No")]
    given = cw.read_csv(spark, str(path), schema="id bigint, x double, word string, t string")
    assert given.dtypes[0] == ("id", "bigint")


def test_parquet_is_replaced_but_never_over_its_own_input(spark, tmp_path):
    path = str(tmp_path / "a table")
    cw.write_parquet(spark.range(5), path)
    cw.write_parquet(spark.range(3), path)
    assert cw.read_parquet(spark, path).count() == 3
    for other in (path, path + "/", "file://" + path):
        with pytest.raises(ValueError, match="elsewhere"):
            cw.write_parquet(cw.read_parquet(spark, path).join(spark.range(9), "id"), other)
    assert cw.read_parquet(spark, path).count() == 3
    cw.write_parquet(cw.read_parquet(spark, path), path + "2")


def test_staged_table_lives_as_long_as_its_block(spark):
    with cw.staged(spark.range(10).withColumn("part", spark.range(1).select("id").scalar())) as table:
        path = table.inputFiles()[0].removeprefix("file://")
        assert os.path.exists(path) and table.count() == 10
    assert not os.path.exists(path)
    with pytest.raises(RuntimeError, match="inside"), cw.staged(spark.range(10)) as table:
        path = table.inputFiles()[0].removeprefix("file://")
        raise RuntimeError("inside")
    assert not os.path.exists(path)


def test_staging_keeps_category_metadata(spark):
    df = cw.string_index(spark.createDataFrame([("a",), ("b",)], "s string"), ["s"])
    with cw.staged(df) as table:
        assert table.schema["s_idx"].metadata == df.schema["s_idx"].metadata != {}


def test_shared_folder_is_the_one_the_session_names(spark):
    def session(folder, master):
        conf = SimpleNamespace(get=lambda name, default: {"spark.checkpoint.dir": folder}.get(name, default))
        context = SimpleNamespace(master=master, applicationId="app", getCheckpointDir=lambda: given)
        return SimpleNamespace(conf=conf, sparkContext=context)

    given = "hdfs://given/folder/"
    assert staging.shared_folder(session(None, "yarn")) == "hdfs://given/folder"
    given = None

    assert staging.shared_folder(session("hdfs://shared/folder/", "yarn")) == "hdfs://shared/folder"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.shared_folder(session(None, "yarn"))
    assert staging.shared_folder(spark) == staging.shared_folder(spark)
    assert spark.sparkContext.getCheckpointDir()


def test_a_table_read_in_a_subquery_is_not_overwritten(spark, tmp_path):
    path, inner = str(tmp_path / "a"), str(tmp_path / "a" / "b")
    cw.write_parquet(spark.range(3), path)
    most = cw.read_parquet(spark, path).agg(F.max("id")).scalar()
    with pytest.raises(ValueError, match="elsewhere"):
        cw.write_parquet(spark.range(5).filter(F.col("id") <= most), path)
    spark.range(2).write.parquet(inner)
    with pytest.raises(ValueError, match="elsewhere"):
        cw.write_parquet(cw.read_parquet(spark, inner), path)


def test_a_write_that_fails_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "table")
    cw.write_parquet(spark.range(5), path)
    half = spark.range(100, numPartitions=4).select(F.when(F.col("id") > 90, F.raise_error(F.lit("half-way")).cast("bigint")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="half-way"):
        cw.write_parquet(half, path)
    assert cw.read_parquet(spark, path).count() == 5
    assert os.listdir(tmp_path) == ["table"]
    with pytest.raises(Exception, match="half-way"):
        cw.write_parquet(half, str(tmp_path / "deep" / "new"))
    assert not os.path.exists(tmp_path / "deep" / "new")
    cw.write_parquet(spark.range(7), str(tmp_path / "deep" / "new"))
    assert cw.read_parquet(spark, str(tmp_path / "deep" / "new")).count() == 7


def test_a_table_moved_aside_comes_back(spark, tmp_path):
    path = str(tmp_path / "table")
    cw.write_parquet(spark.range(5), path)
    os.rename(path, tmp_path / "_table-old-0123")  # as if the driver died between both renames
    assert sources.recover(spark, path) and not sources.recover(spark, path)
    assert cw.read_parquet(spark, path).count() == 5
    os.rename(path, tmp_path / "_table-old-0123")
    cw.write_parquet(spark.range(3), path)
    assert cw.read_parquet(spark, path).count() == 3 and os.listdir(tmp_path) == ["table"]


def test_a_table_that_cannot_be_replaced_comes_back(spark, tmp_path):
    path = str(tmp_path / "table")
    cw.write_parquet(spark.range(5), path)
    with pytest.raises(Exception):
        files.swap_in(spark, str(tmp_path / "nothing"), path)
    assert cw.read_parquet(spark, path).count() == 5 and os.listdir(tmp_path) == ["table"]


def test_versions_are_published_whole_and_old_ones_can_be_read(spark, tmp_path):
    path = str(tmp_path / "versions")
    with pytest.raises(ValueError, match="0 versions"):
        cw.read_version(spark, path)
    for n in (1, 2, 3):
        reader = cw.read_version(spark, path) if n > 1 else None
        cw.write_version(spark.range(n), path)
        assert reader is None or reader.count() == n - 1
    assert [cw.read_version(spark, path, back).count() for back in (0, 1)] == [3, 2]
    with pytest.raises(ValueError, match="2 versions"):
        cw.read_version(spark, path, 2)
    half = spark.range(10).select(F.raise_error(F.lit("half-way")).alias("x"))
    with pytest.raises(Exception, match="half-way"):
        cw.write_version(half, path)
    assert cw.read_version(spark, path).count() == 3 and len(sources.version_names(spark, path)) == 2
    # The list of a writer that died half-way is passed over, and the next one begins beyond it.
    (tmp_path / "versions" / "_versions-000000000004").write_text('{"versions": ["ver')
    assert cw.read_version(spark, path).count() == 3
    assert sum(n.startswith("version-") for n in os.listdir(path)) == 2


def test_records_that_do_not_fit_are_kept_apart(spark, tmp_path):
    path = tmp_path / "t.csv"
    good = ["1,1.5,a,Yes", "2,,,No", '6,3.5,"a,b",Yes']
    bad = ["3,abc,b,No", "4,1.0,c", "5,2.0,d,Yes,extra", "q,1,2,3"]
    path.write_text("\n".join(["id,x,word,_record", *good, *bad]) + "\n\n")
    schema = "id bigint not null, x double, word string, _record string"
    table, rejected = cw.read_csv_checked(spark, str(path), schema)
    assert table.dtypes == [("id", "bigint"), ("x", "double"), ("word", "string"), ("_record", "string")]
    assert sorted(r.id for r in table.collect()) == [1, 2, 6]
    assert sorted(r.record for r in rejected.collect()) == bad and {r.file for r in rejected.collect()} == {f"file://{path}"}
    # Whatever is selected, every record is on its side.
    for name in table.columns:
        assert table.select(name).count() == len(table.select(name).collect()) == 3
    assert rejected.count() == len(rejected.select("file").collect()) == 4
    everything = tmp_path / "fits.csv"
    everything.write_text("\n".join(["id,x,word,t", *good]))
    table, rejected = cw.read_csv_checked(spark, str(everything), sampling_ratio=1.0)
    assert table.count() == 3 and rejected.count() == 0 and dict(table.dtypes)["id"] == "int"
