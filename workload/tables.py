"""Tables that the queries share, once for Spark and once as SQL.

They are derived from the given Parquet tables; every `*_SQL` is a common table
expression with the rows of the function of the same name.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from classweave import with_class_weight


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with customer features and a target that two of them decide."""
    orders, customer = given(spark, sf_dir, "orders"), given(spark, sf_dir, "customer")
    positive = (F.col("o_totalprice") > 400000) & F.col("c_mktsegment").isin("BUILDING", "MACHINERY")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey",
        "o_orderstatus",
        "o_orderpriority",
        "c_mktsegment",
        "c_nationkey",
        "c_acctbal",
        "o_totalprice",
        F.when(positive, "Yes").otherwise("No").alias("target"),
    )


PLANTED_SQL = """planted AS (
  SELECT o_orderkey, o_orderstatus, o_orderpriority, c_mktsegment, c_nationkey, c_acctbal, o_totalprice,
         CASE WHEN o_totalprice > 400000 AND c_mktsegment IN ('BUILDING', 'MACHINERY')
              THEN 'Yes' ELSE 'No' END AS target
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


def weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_class_weight(planted(spark, sf_dir), "target", lazy=True)


WEIGHTED_SQL = f"""{PLANTED_SQL},
ratio AS (
  SELECT count(*) FILTER (target = 'No') / count(*) FILTER (target = 'Yes') AS r FROM planted),
weighted AS (
  SELECT planted.*, CASE WHEN target = 'Yes' THEN r ELSE 1.0 END AS "classWeight" FROM planted, ratio)"""


def with_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels where they have any, and gaps of every type."""
    documents, labels = given(spark, sf_dir, "documents"), given(spark, sf_dir, "labels")
    rows = documents.select("doc_id", "lang", "source", "n_chars").join(labels, "doc_id", "left")
    toxic, quality = F.col("toxic") == 1, F.col("quality") == 1
    return rows.select(
        "doc_id",
        "lang",
        "source",
        "n_chars",
        "quality",
        "toxic",
        F.when(toxic, F.lit(float("nan"))).when(~toxic, F.col("n_chars").cast("double")).alias("length"),
        F.when(toxic, "NaN").when(~quality, F.lit(None)).otherwise(F.col("lang")).alias("note"),
        F.nullif("lang", F.lit("de")).alias("lang_known"),
        quality.alias("good"),
        F.when(quality, F.lit("2024-01-31").cast("date")).alias("day"),
        F.when(toxic, F.lit("2024-01-31 12:00:00").cast("timestamp")).alias("seen"),
    )


MISSING_SQL = """with_missing AS (
  SELECT doc_id, lang, source, n_chars, quality, toxic,
         CASE WHEN toxic = 1 THEN 'NaN'::DOUBLE WHEN toxic <> 1 THEN n_chars::DOUBLE END AS length,
         CASE WHEN toxic = 1 THEN 'NaN' WHEN quality <> 1 THEN NULL ELSE lang END AS note,
         nullif(lang, 'de') AS lang_known,
         quality = 1 AS good,
         CASE WHEN quality = 1 THEN DATE '2024-01-31' END AS day,
         CASE WHEN toxic = 1 THEN TIMESTAMP '2024-01-31 12:00:00' END AS seen
  FROM documents LEFT JOIN labels USING (doc_id))"""


def banded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One binary string feature, for which small models have a closed form."""
    return weighted(spark, sf_dir).select(
        "o_orderkey",
        F.when(F.col("o_totalprice") > 450000, "high").otherwise("low").alias("price_band"),
        "target",
        "classWeight",
    )


BANDED_SQL = f"""{WEIGHTED_SQL},
banded AS (
  SELECT o_orderkey, CASE WHEN o_totalprice > 450000 THEN 'high' ELSE 'low' END AS price_band,
         target, "classWeight" AS w
  FROM weighted)"""


def three_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three binary string features, to be ranked by one small tree."""
    return weighted(spark, sf_dir).select(
        "o_orderkey",
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "soon").otherwise("later").alias("haste"),
        F.when(F.col("o_totalprice") > 350000, "high").otherwise("low").alias("price"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "in").otherwise("out").alias("segment"),
        "target",
        "classWeight",
    )


THREE_BANDS_SQL = f"""{WEIGHTED_SQL},
three_bands AS (
  SELECT o_orderkey,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'soon' ELSE 'later' END AS haste,
         CASE WHEN o_totalprice > 350000 THEN 'high' ELSE 'low' END AS price,
         CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'in' ELSE 'out' END AS segment,
         (target = 'Yes')::INTEGER AS y, "classWeight" AS w
  FROM weighted)"""


def _logistic(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def fixed_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of a fixed formula, in the form a fitted model gives them."""
    p = _logistic(F.col("o_totalprice") / 100000 - 2)
    return (
        planted(spark, sf_dir)
        .select("o_orderkey", (F.col("target") == "Yes").cast("double").alias("label"), p.alias("score"))
        .select(
            "*",
            (F.col("score") > 0.5).cast("double").alias("prediction"),
            array_to_vector(F.array(1 - F.col("score"), F.col("score"))).alias("probability"),
        )
    )


FIXED_SCORES_SQL = f"""{PLANTED_SQL},
scores AS (
  SELECT o_orderkey, (target = 'Yes')::DOUBLE AS label, 1 / (1 + exp(-(o_totalprice / 100000 - 2))) AS score
  FROM planted),
fixed_scores AS (SELECT *, (score > 0.5)::DOUBLE AS prediction FROM scores)"""


def rival_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three fixed formulas for the same target, as rows of (model, o_orderkey, label, prediction, score)."""
    in_segment = F.col("c_mktsegment").isin("BUILDING", "MACHINERY").cast("double")
    formulas = {
        "balance": _logistic(F.col("c_acctbal") / 5000 - 1),
        "price": _logistic(F.col("o_totalprice") / 100000 - 2),
        "price_in_segment": _logistic(F.col("o_totalprice") / 100000 - 4.5 + in_segment),
    }
    rivals = F.array(*[F.struct(F.lit(m).alias("model"), s.alias("score")) for m, s in formulas.items()])
    return (
        planted(spark, sf_dir)
        .select("o_orderkey", (F.col("target") == "Yes").cast("double").alias("label"), F.inline(rivals))
        .withColumn("prediction", (F.col("score") > 0.5).cast("double"))
    )


RIVAL_SCORES_SQL = f"""{PLANTED_SQL},
rivals AS (
  SELECT 'balance' AS model, o_orderkey, target, 1 / (1 + exp(-(c_acctbal / 5000 - 1))) AS score FROM planted
  UNION ALL
  SELECT 'price', o_orderkey, target, 1 / (1 + exp(-(o_totalprice / 100000 - 2))) FROM planted
  UNION ALL
  SELECT 'price_in_segment', o_orderkey, target,
         1 / (1 + exp(-(o_totalprice / 100000 - 4.5
                        + (c_mktsegment IN ('BUILDING', 'MACHINERY'))::DOUBLE))) FROM planted),
rival_scores AS (
  SELECT model, o_orderkey, (target = 'Yes')::DOUBLE AS label, score, (score > 0.5)::DOUBLE AS prediction
  FROM rivals)"""


def fold_sql(key: str, k: int, seed: int = 42) -> str:
    """Fold number of a row, as SQL."""
    return f"CAST(('0x' || substr(md5('{seed}:' || {key}), 1, 8))::BIGINT % {k} AS INTEGER)"


def metrics_sql(relation: str, by: str = "") -> str:
    """SQL for the metrics of (by..., label, prediction, score) rows, as CTE `measured`."""
    keys, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    part = f"PARTITION BY {by} " if by else ""
    return f"""by_score AS (
  SELECT {keys}score, count(*) AS n,
         count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
         count(*) FILTER (label = 0 AND prediction = 0) AS tn, count(*) FILTER (label = 1 AND prediction = 0) AS fn
  FROM {relation} GROUP BY {keys}score),
below AS (
  SELECT *, sum(fp + tn) OVER ({part}ORDER BY score) - (fp + tn) AS lower FROM by_score),
cells AS (
  SELECT {keys}sum(n)::DOUBLE AS n, sum(tp)::DOUBLE AS tp, sum(fp)::DOUBLE AS fp,
         sum(tn)::DOUBLE AS tn, sum(fn)::DOUBLE AS fn,
         sum((tp + fn) * (lower + (fp + tn) / 2.0))::DOUBLE AS wins
  FROM below {group}),
measured AS (
  SELECT {keys}CAST(n AS BIGINT) AS n_rows, (tp + tn) / n AS accuracy,
         ((tp + fn) * CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END
          + (tn + fp) * CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0 END) / n AS precision,
         (tp + tn) / n AS recall,
         ((tp + fn) * CASE WHEN tp > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END
          + (tn + fp) * CASE WHEN tn > 0 THEN 2 * tn / (2 * tn + fp + fn) ELSE 0 END) / n AS f1,
         CASE WHEN (tp + fn) * (fp + tn) > 0 THEN wins / ((tp + fn) * (fp + tn)) END AS auc
  FROM cells)"""


def long_metrics_sql(by: str = "") -> str:
    """SQL for one row per metric of `measured`, as CTE `long_metrics`."""
    keys = f"{by}, " if by else ""
    parts = [
        f"SELECT {keys}n_rows, '{metric}' AS metric, {metric} AS value FROM measured"
        for metric in ("accuracy", "precision", "recall", "f1", "auc")
    ]
    return "long_metrics AS (\n  " + "\n  UNION ALL ".join(parts) + ")"
