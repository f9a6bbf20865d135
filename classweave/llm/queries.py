"""One query per operator: it applies the operator to its whole table and derives the agreed columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from classweave.llm import alignment, decontaminate, html, jaccard, language, neighbours, packing, periods, repeats, secrets, tokens, toxicity, urls
from classweave.llm.frames import table


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of each document, with how many of them look live."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    scanned = secrets.scan_secrets(docs)
    spans = F.col("spans")
    kind = lambda k: F.size(F.filter(spans, lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter(spans, lambda x: x["kind"].isin(*secrets.BASE))
    return scanned.select(
        "doc_id", *[kind(k) for k in secrets.BASE], F.sha2(secrets.spans_text(base), 256).alias("base_sha256"),
        secrets.spans_text(spans).alias("spans"), "n_live", "n_example",
    )


#: The public tokenizer whose ids are stored and packed.
TOKENIZER = "byte_bpe_50k.json"


def op2_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of each document, as read back from directly addressable codes."""
    path = tokens.store_tokens(table(spark, sf_dir, "documents"), TOKENIZER)
    return tokens.token_digests(spark, path)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on each page's address."""
    return urls.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of each document in sequences along the curve."""
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of each document, learnt from those that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit_language(docs, may_learn=~language.held_out())
    judged = language.identify(docs.select("doc_id", "text"), model)
    return judged.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector's links, component and whether it stays, at a cosine of 0.95."""
    found = neighbours.near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return found.select("vec_id", "n_links", "component_id", "kept")


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of each page."""
    extracted = html.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return extracted.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's class, number of links and component under five-word shingles and a similarity of 0.8."""
    return jaccard.similar_documents(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without its repeated passages."""
    cut = repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of each document stands in a test item."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return judged.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        decontaminate.items_digest(F.col("items")).alias("items_sha256"), "contaminated",
    )


#: The public sentence piece model that is aligned with it.
PIECES = "piece_bpe_32k.model"


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How two tokenizers cut each document, and how usual its links are in the corpus."""
    aligned = alignment.align_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), TOKENIZER, PIECES, keep=["doc_id"])
    return aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps")


def op12_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of each document's words, and what is left without their repetitions."""
    docs = periods.planted(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periods.collapse_runs(docs, keep=["doc_id"])
    best = periods.strongest(F.col("runs"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[n].cast("string") for n in ("start", "length", "period")]), F.lit("\n")))
    found = found.select("doc_id", "n_words", "runs", best.alias("best"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *[F.col(f"best.{n}").alias(n) for n in ("start", "length", "period")],
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256", "n_words",
    )


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of each document, learnt from the labels of those that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"), may_learn=~toxicity.held_out("id"))
    judged = toxicity.score_toxicity(docs, model, keep=["doc_id"])
    return judged.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secrets": op1_secrets,
    "op2_token_codes": op2_token_codes,
    "op3_url_filter": op3_url_filter,
    "op4_packing": op4_packing,
    "op5_language": op5_language,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_main_text": op7_main_text,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_repeats": op9_repeats,
    "op10_decontamination": op10_decontamination,
    "op11_alignment": op11_alignment,
    "op12_periods": op12_periods,
    "op13_toxicity": op13_toxicity,
}
