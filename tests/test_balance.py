import pytest

import classweave as cw


@pytest.fixture(scope="module")
def votes(spark):
    return spark.createDataFrame([("Yes",)] * 2 + [("No",)] * 7 + [(None,), ("Maybe",)], "t string")


def test_ratio_counts_only_the_two_classes(votes):
    assert tuple(cw.class_ratio(votes, "t").first()) == (2, 7, 3.5)


@pytest.mark.parametrize("lazy", [False, True])
def test_weight_is_the_ratio_for_positives_and_one_for_all_else(votes, lazy):
    weights = cw.with_class_weight(votes, "t", lazy=lazy).distinct().collect()
    assert {tuple(r) for r in weights} == {("Yes", 3.5), ("No", 1.0), (None, 1.0), ("Maybe", 1.0)}


def test_both_classes_weigh_the_same(votes):
    totals = {r.t: r.total_weight for r in cw.weight_totals(cw.with_class_weight(votes, "t"), "t").collect()}
    assert totals["Yes"] == totals["No"] == 7.0


def test_without_positives_there_is_no_ratio(votes):
    none = votes.filter("t = 'No'")
    with pytest.raises(ValueError, match="undefined"):
        cw.with_class_weight(none, "t")
    for lazy in (cw.class_ratio(none, "t"), cw.with_class_weight(none, "t", lazy=True)):
        with pytest.raises(Exception, match="undefined"):
            lazy.filter("t = 'Yes' or t = 'No'").collect() if "t" in lazy.columns else lazy.collect()


def test_weighting_replaces_an_older_weight(votes):
    twice = cw.with_class_weight(cw.with_class_weight(votes, "t"), "t", positive="No", negative="Yes")
    assert twice.columns == ["t", "classWeight"]
    assert twice.filter("t = 'No'").first().classWeight == pytest.approx(2 / 7)
