import pytest

import classweave as cw
from classweave.__main__ import main
from classweave.plans import audit, score_table, select_features, train_model, view_predictions, weigh_table
from workload import tables

KEY = "o_orderkey"


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """The planted table as a CSV file with the default target."""
    path = str(tmp_path_factory.mktemp("raw") / "raw.csv")
    rows = tables.planted(spark, "/root/testdata/sf0.001").withColumnRenamed("target", "HadHeartAttack")
    rows.coalesce(1).write.csv(path, header=True)
    return path


def test_stages_hand_over_through_files(spark, raw, tmp_path):
    weighted, final, model, scored = (str(tmp_path / n) for n in ("weighted", "final", "model", "scored"))
    table = cw.read_csv(spark, raw)
    reports = audit(table)
    assert reports["missing"].count() == 0 and reports["imbalance"].first().severe
    assert tuple(reports["shape"].first()) == (1_500, 8)
    assert reports["balance"].first()["HadHeartAttack"] == "Yes"

    weigh_table(table, weighted)
    ranking = select_features(cw.read_parquet(spark, weighted), final, k=3, keep_cols=[KEY])
    chosen = cw.read_parquet(spark, final)
    assert chosen.columns == [KEY, "HadHeartAttack", "classWeight", *cw.top_names(ranking, 3)]

    _, metrics, summary = train_model(chosen, "gbt", model, key=[KEY], k=3, parallelism=3, maxIter=3, maxDepth=3)
    assert metrics.count() == 15
    assert {r.metric: r for r in summary.collect()}["auc"].mean > 0.99

    score_table(chosen, model, scored, [KEY])
    views = view_predictions(spark, scored, model, keep_cols=[KEY])
    assert views["view"].columns == [KEY, "Heart_Attack_Probability", "Predicted_Class"]
    assert views["sample"].count() == 20
    assert sum(r["count"] for r in views["distribution"].collect()) == 1_500
    joined = views["view"].join(chosen, KEY)
    assert joined.filter("(Predicted_Class = 1) <> (HadHeartAttack = 'Yes')").count() < 30


def test_scored_table_without_a_key(spark, raw, tmp_path):
    weighted, model, scored = (str(tmp_path / n) for n in ("weighted", "model", "scored"))
    weigh_table(cw.read_csv(spark, raw).drop(KEY), weighted)
    table = cw.read_parquet(spark, weighted)
    _, metrics, _ = train_model(table, "lr", model, k=2)
    assert metrics.filter("metric = 'auc' AND value > 0.9").count() == 2
    score_table(table, model, scored)
    assert cw.read_parquet(spark, scored).columns == ["prediction", "probability"]
    assert view_predictions(spark, scored)["view"].count() == 1_500


def test_command_line(spark, raw, tmp_path, capsys):
    weighted, final, model, scored = (str(tmp_path / n) for n in ("weighted", "final", "model", "scored"))
    main(["audit", "--input", raw])
    assert "minority_percent" in capsys.readouterr().out
    main(["weigh", "--input", raw, "--output", weighted])
    main(["select", "--input", weighted, "--output", final, "-k", "2", "--key", KEY])
    assert "o_totalprice" in capsys.readouterr().out
    main(["train", "--input", final, "--model", model, "--kind", "lr", "--folds", "2", "--key", KEY,
          "--set", "maxIter=20", "regParam=0.1"])
    assert "accuracy" in capsys.readouterr().out
    main(["score", "--input", final, "--model", model, "--output", scored, "--key", KEY])
    main(["view", "--input", scored, "--model", model, "--key", KEY])
    assert "Predicted_Class" in capsys.readouterr().out


def test_command_line_with_schema_format_and_wide_columns(spark, raw, tmp_path, capsys):
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cw.read_csv(spark, raw).schema.fields)
    main(["audit", "--input", raw, "--format", "csv", "--schema", types])
    assert "minority_percent" in capsys.readouterr().out
    weighted, model = str(tmp_path / "weighted"), str(tmp_path / "model")
    main(["weigh", "--input", raw, "--output", weighted, "--schema", types])
    main(["train", "--input", weighted, "--format", "parquet", "--model", model, "--kind", "lr", "--folds", "2",
          "--key", KEY, "--wide", "c_mktsegment", "--set", "maxIter=5"])
    assert "accuracy" in capsys.readouterr().out
    assert "c_mktsegment_idx" in cw.load_model(model).transform(cw.read_parquet(spark, weighted)).columns
