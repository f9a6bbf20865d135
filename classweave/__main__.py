"""Run one stage on files: python -m classweave STAGE --input ... --output ...

With spark-submit, pass this file as the application and the package as
--py-files.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession

from classweave.operators.balance import TARGET
from classweave.plans import audit, score_table, select_features, train_model, view_predictions, weigh_table
from classweave.plans.stages import ESTIMATORS
from classweave.sources import read_csv, read_parquet


def _read(spark: SparkSession, path: str, form: str | None, schema: str | None) -> DataFrame:
    """The input table; where no format is given, the path's ending tells it."""
    if form == "csv" or (form is None and (schema or path.endswith((".csv", ".csv.gz")))):
        return read_csv(spark, path, schema)
    return read_parquet(spark, path)


def _show(tables: dict[str, DataFrame]) -> None:
    for name, table in tables.items():
        print(name)
        table.show(truncate=False)


def parser() -> argparse.ArgumentParser:
    result = argparse.ArgumentParser(prog="classweave")
    stages = result.add_subparsers(dest="stage", required=True)

    def stage(name: str, text: str, *paths: str) -> argparse.ArgumentParser:
        sub = stages.add_parser(name, help=text)
        for path in ("--input", *paths):
            sub.add_argument(path, required=True)
        sub.add_argument("--format", choices=["csv", "parquet"], help="of the input; by default its ending tells")
        sub.add_argument("--schema", help="of a CSV input, e.g. 'id bigint, price double'; saves the pass that infers it")
        sub.add_argument("--target", default=TARGET)
        sub.add_argument("--positive", default="Yes")
        sub.add_argument("--key", nargs="*", default=[], help="key columns: kept, but no features")
        return sub

    stage("audit", "shape, schema, missing values and class balance")
    stage("weigh", "add class weights", "--output").add_argument("--negative", default="No")
    select = stage("select", "keep the best features", "--output")
    select.add_argument("-k", type=int, default=15)
    train = stage("train", "cross-validate, refit and save a model", "--model")
    train.add_argument("--kind", choices=sorted(ESTIMATORS), required=True)
    train.add_argument("--folds", type=int, default=10)
    train.add_argument("--parallelism", type=int, default=1)
    train.add_argument("--auc-bins", type=int, help="binned instead of exact AUC, e.g. 1000")
    for sub in (select, train):
        sub.add_argument("--wide", nargs="*", default=[], help="string columns with very many values: joined with a table")
    train.add_argument("--set", nargs="*", default=[], metavar="PARAM=VALUE", help="e.g. maxBins=64 maxIter=20")
    stage("score", "score a table", "--model", "--output")
    stage("view", "show scored rows").add_argument("--model")
    return result


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = SparkSession.builder.appName(f"classweave-{args.stage}").getOrCreate()
    if args.stage == "view":
        tables = view_predictions(spark, args.input, args.model, args.positive, args.key)
        _show({name: tables[name] for name in ("sample", "distribution")})
        return
    df = _read(spark, args.input, args.format, args.schema)
    if args.stage == "audit":
        _show(audit(df, args.target))
    elif args.stage == "weigh":
        weigh_table(df, args.output, args.target, args.positive, args.negative)
    elif args.stage == "select":
        ranking = select_features(df, args.output, args.target, args.k, args.key, wide=args.wide)
        _show({"ranking": ranking.orderBy("rank")})
    elif args.stage == "train":
        params = {name: json.loads(value) for name, value in (pair.split("=", 1) for pair in args.set)}
        _, metrics, summary = train_model(
            df,
            args.kind,
            args.model,
            args.target,
            args.key,
            args.folds,
            parallelism=args.parallelism,
            auc_bins=args.auc_bins,
            wide=args.wide,
            **params,
        )
        _show({"folds": metrics, "summary": summary})
    else:
        score_table(df, args.model, args.output, args.key)


if __name__ == "__main__":
    main()
