import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

import classweave as cw

SCHEMA = "g int, label double, prediction double, score double"


def brute_force(rows):
    """Metrics of (label, prediction, score) rows by their definitions."""
    n = len(rows)
    result = {"accuracy": sum(l == p for l, p, _ in rows) / n, "precision": 0.0, "recall": 0.0, "f1": 0.0}
    for c in (0.0, 1.0):
        support = sum(l == c for l, _, _ in rows)
        said = sum(p == c for _, p, _ in rows)
        right = sum(l == p == c for l, p, _ in rows)
        precision = right / said if said else 0.0
        recall = right / support if support else 0.0
        result["precision"] += support / n * precision
        result["recall"] += support / n * recall
        result["f1"] += support / n * (2 * precision * recall / (precision + recall) if right else 0.0)
    pairs = [(a, b) for l, _, a in rows if l == 1 for k, _, b in rows if k == 0]
    result["auc"] = sum((a > b) + (a == b) / 2 for a, b in pairs) / len(pairs) if pairs else None
    return result


binary = st.sampled_from([0.0, 1.0])
groups = st.lists(
    st.lists(st.tuples(binary, binary, st.sampled_from([-2.5, 0.0, -0.0, 0.25, 0.5, 1e9])), min_size=1, max_size=12),
    min_size=1,
    max_size=40,
)


@settings(max_examples=8, deadline=None)
@given(groups)
def test_metrics_equal_their_definitions(spark, drawn):
    rows = [(g, *row) for g, group in enumerate(drawn) for row in group]
    table = cw.metrics_table(spark.createDataFrame(rows, SCHEMA), by=["g"])
    found = {r.g: r for r in table.collect()}
    assert found.keys() == set(range(len(drawn)))
    for g, group in enumerate(drawn):
        assert found[g].n_rows == len(group)
        for metric, value in brute_force(group).items():
            assert (found[g][metric] is None) == (value is None)
            assert value is None or found[g][metric] == pytest.approx(value, abs=1e-12)


@pytest.fixture(scope="module")
def scored(spark):
    draw = random.Random(3)
    rows = []
    for i in range(6_000):
        label = float(draw.random() < 0.1)
        # A third of all rows share one score.
        score = 0.4 if i % 3 == 0 else draw.gauss(0.4 + 0.2 * label, 0.2)
        rows.append((i % 4, label, float(score > 0.5), score))
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def test_metrics_equal_the_evaluators(scored):
    found = cw.metrics_table(scored).first()
    names = {"accuracy": "accuracy", "precision": "weightedPrecision", "recall": "weightedRecall", "f1": "f1"}
    for metric, name in names.items():
        assert found[metric] == pytest.approx(MulticlassClassificationEvaluator(metricName=name).evaluate(scored))
    exact = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(scored)
    assert found.auc == pytest.approx(exact, abs=1e-12)
    assert found.recall == found.accuracy


def test_exact_and_binned_area(scored):
    exact = cw.roc_auc(scored).first().auc
    binned = cw.roc_auc(scored, num_bins=1000).first().auc
    assert exact != binned and exact == pytest.approx(binned, abs=1e-3)
    by_group = {r.g: r.auc for r in cw.roc_auc(scored, by=["g"]).collect()}
    assert by_group[2] == pytest.approx(cw.roc_auc(scored.filter("g = 2")).first().auc, abs=1e-12)
    # Over one partition, the evaluator's chunks are those of the whole order.
    evaluator = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score")
    for bins in (2, 7, 100, 1000):
        found = {r.g: r.auc for r in cw.roc_auc(scored.repartition(5), by=["g"], num_bins=bins).collect()}
        assert found.keys() == by_group.keys()
        for g, auc in found.items():
            own = scored.filter(F.col("g") == g).coalesce(1)
            if auc is not None:
                assert auc == pytest.approx(evaluator.setNumBins(bins).evaluate(own), abs=1e-12)
        table = {r.g: r.auc for r in cw.metrics_table(scored, by=["g"], num_bins=bins).collect()}
        assert table == found


def test_area_does_not_depend_on_the_number_of_partitions(spark, scored):
    areas = set()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    # Forbid merging, so that the running sums do cross partitions.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for n in ("1", "3", "40"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            areas.add(round(cw.roc_auc(scored.select("label", F.col("score").alias("s")), score="s").first().auc, 13))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(areas) == 1


def test_confusion_matrix_and_positive_class(scored):
    cells = {(r.label, r.prediction): r.n for r in cw.confusion_matrix(scored).collect()}
    assert sum(cells.values()) == 6_000
    one = cw.positive_class_metrics(scored).first()
    assert one.positive_recall == pytest.approx(cells[1, 1] / (cells[1, 1] + cells[1, 0]))
    assert one.positive_precision == pytest.approx(cells[1, 1] / (cells[1, 1] + cells[0, 1]))


@pytest.mark.parametrize("label, prediction", [(2.0, 0.0), (None, 0.0), (0.0, None)])
def test_other_labels_are_refused_not_dropped(spark, label, prediction):
    rows = spark.createDataFrame([(0, label, prediction, 0.5), (0, 1.0, 1.0, 0.7)], SCHEMA)
    with pytest.raises(Exception, match="0 or 1"):
        cw.metrics_table(rows).collect()


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert cw.metrics_table(empty).first().auc is None
    assert cw.metrics_table(empty, by=["g"]).count() == 0
