import datetime as dt

import pytest
from pyspark.sql import Row

import classweave as cw

SCHEMA = "id int, x double, f float, s string, `a.b` string, flag boolean, day date, seen timestamp, name_idx int"


@pytest.fixture(scope="module")
def gaps(spark):
    nan, day, seen = float("nan"), dt.date(2024, 1, 31), dt.datetime(2024, 1, 31, 12)
    rows = [
        (1, 1.0, 1.0, "word", "1.5", True, day, seen, 1),
        (2, nan, nan, "NaN", None, None, None, None, None),
        (3, None, None, None, "nan", False, day, seen, 3),
        (4, float("inf"), 0.0, "", "x", True, day, None, 4),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def _dict(df):
    return {row[0]: row[1] for row in df.collect()}


def test_missing_is_null_nan_and_text_that_reads_as_nan(gaps):
    assert _dict(cw.missing_counts(gaps)) == {
        "id": 0, "x": 2, "f": 2, "s": 2, "a.b": 2, "flag": 1, "day": 1, "seen": 2, "name_idx": 1,
    }


def test_every_spelling_that_casts_to_nan_is_missing(spark):
    words = ["NaN", "nan", " NAN ", "+NaN", "-NaN", "\tnan\n", "nano", "n a n", "banana", "1", "", "inf", "-nan"]
    df = spark.createDataFrame([(w,) for w in words], "s string")
    expected = df.filter("isnan(try_cast(s AS double))").count()
    assert _dict(cw.missing_counts(df)) == {"s": expected} and expected >= 5


def test_missing_columns_is_empty_for_a_complete_table(spark, gaps):
    assert "id" not in _dict(cw.missing_columns(gaps))
    assert cw.missing_columns(gaps.select("id")).count() == 0


def test_missing_counts_take_one_scan(gaps, spark, tmp_path):
    path = str(tmp_path / "gaps")
    gaps.write.parquet(path)
    plan = cw.missing_counts(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_shape_and_schema(gaps):
    assert cw.dataset_shape(gaps).collect() == [Row(n_rows=4, n_columns=9)]
    report = {row.column: row for row in cw.schema_report(gaps, count_values=True).collect()}
    assert report["x"].type == "double" and report["x"].n_values == 3
    assert report["a.b"].position == 4 and report["a.b"].n_values == 3


def test_schema_report_reads_metadata_only(gaps):
    report = cw.schema_report(gaps)
    assert report.columns == ["position", "column", "type", "nullable"]
    assert [r.column for r in report.orderBy("position").collect()] == gaps.columns
    present = cw.columns_present(gaps, ["x", "X", "a.b", "none"])
    assert [tuple(r) for r in present.collect()] == [("x", True), ("X", False), ("a.b", True), ("none", False)]


def test_column_profile_holds_all_column_reports(gaps):
    profile = {r.column: r for r in cw.column_profile(gaps).collect()}
    assert {c: r.n_missing for c, r in profile.items()} == _dict(cw.missing_counts(gaps))
    assert {c: r.n_values for c, r in profile.items()} == {
        r.column: r.n_values for r in cw.schema_report(gaps, count_values=True).collect()
    }
    assert {r.n_rows for r in profile.values()} == {4}


def test_shape_of_an_empty_table(gaps):
    assert cw.dataset_shape(gaps.filter("id < 0")).first().n_rows == 0
    assert _dict(cw.missing_counts(gaps.filter("id < 0")))["x"] == 0


def test_class_balance_orders_by_count_then_label_and_keeps_null(spark):
    rows = [("No",)] * 5 + [("Yes",)] * 2 + [(None,)] * 2 + [("Maybe",)]
    balance = cw.class_balance(spark.createDataFrame(rows, "HadHeartAttack string"))
    assert [tuple(r) for r in balance.collect()] == [
        ("Maybe", 1, 10.0), (None, 2, 20.0), ("Yes", 2, 20.0), ("No", 5, 50.0),
    ]


@pytest.mark.parametrize("n_yes, severe", [(14, True), (15, False), (16, False)])
def test_imbalance_is_strictly_below_the_threshold(spark, n_yes, severe):
    df = spark.createDataFrame([("Yes",)] * n_yes + [("No",)] * (100 - n_yes), "t string")
    flag = cw.imbalance_flag(df, "t").first()
    assert flag.minority_percent == n_yes and flag.severe is severe
    assert cw.imbalance_flag(df, "t", threshold=n_yes + 0.5).first().severe


def test_absent_target_is_an_error(gaps):
    for report in (cw.class_balance, cw.imbalance_flag, cw.class_ratio, cw.with_class_weight):
        with pytest.raises(ValueError, match="HadHeartAttack"):
            report(gaps)
