import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from classweave.llm import language, queries


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(1)
    a, b = ["the", "and", "thing", "with", "what"], ["der", "und", "ding", "mit", "nicht"]
    texts = [" ".join(rng.choice(w, 30)) for _ in range(60) for w in (a, b)]
    return language.train(texts, ["en", "de"] * 60)


def test_subwords_are_parts_of_words():
    data = np.frombuffer("Ab 1c".encode() + b"d", dtype=np.uint8)
    slots, texts = language.subwords(data, np.array([0, 5, 6]))
    two = [s for s, t in zip(slots.tolist(), texts.tolist()) if s < language.SLOTS]
    pairs = {bytes([s >> 8, s & 255]).decode() for s in two}
    assert pairs == {" a", "ab", "b ", " c", "c ", " d", "d "}
    assert sorted(set(texts.tolist())) == [0, 1]


def test_nulls_letters_long_texts_and_clashing_names(spark, model):
    rows = [(0, None, 1.0), (1, "", 1.0), (2, "12 !?", 1.0), (3, "the thing with", 1.0), (4, "und " * 300_000, 1.0), (4, "nicht der", 1.0), (5, "日本", 1.0)]
    df = spark.createDataFrame(rows, "k int, text string, score double")
    out = language.identify(df, model)
    assert out.columns == ["k", "text", "score", "lang_pred", "score_", "rejected"]
    got = sorted((r["k"], r["lang_pred"]) for r in out.collect())
    assert got[:6] == [(0, "und"), (1, "und"), (2, "und"), (3, "en"), (4, "de"), (4, "de")]
    assert got[6][1] in ("de", "en")
    for r in out.collect():
        assert 0 <= r["score_"] <= 1 and (r["lang_pred"] != "und" or (r["rejected"] and r["score_"] == 0))
    kept = language.keep_identified(df, model)
    assert kept.columns == df.columns and {r["k"] for r in kept.collect()} >= {3, 4}
    assert language.identify(df.where("false"), model).collect() == []


def test_without_labels_nothing_is_known(spark):
    df = spark.createDataFrame([(0, "text", None), (1, None, "en")], "doc_id long, text string, lang string")
    unknown = language.fit_language(df)
    assert [(r["lang_pred"], r["score"], r["rejected"]) for r in language.identify(df, unknown).collect()] == [("und", 0.0, True)] * 2
    empty = language.fit_language(df.where("false"))
    assert empty.languages == []


def test_the_sample_is_bounded_and_leaves_out_what_may_not_be_learnt(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("number "), F.col("id").cast("string")).alias("text"), F.when(F.col("id") % 10 == 0, "xx").otherwise("yy").alias("lang"))
    sample = language.labelled_sample(df, "doc_id", "text", "lang", ~language.held_out(), per_language=200)
    used = [int(t.split()[1]) for t, _ in sample]
    assert all(zlib.crc32(str(k).encode()) % 4 != 2 for k in used)
    counts = {lang: sum(x == lang for _, x in sample) for lang in ("xx", "yy")}
    assert all(120 < n < 280 for n in counts.values())


def test_held_out_accuracy_on_the_given_table(spark, sf_dir):
    rows = queries.QUERIES["op5_language"](spark, sf_dir).collect()
    lang = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang").collect())
    assert len(rows) == len(lang)
    for held in (True, False):
        own = [r for r in rows if r["held_out"] == held]
        assert all((zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) == held for r in own)
        assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in own]) >= 0.98
    assert np.mean([r["rejected"] for r in rows]) <= 0.01


def test_scores_are_calibrated(model):
    assert 0 < model.temperature and 0 <= model.threshold <= language.REJECTED_BELOW
    logits, count = model.logits(*language._as_bytes(["der mit", ""]))
    assert count.tolist()[1] == 0 and np.isfinite(logits).all()
    assert pa.array(model.languages).to_pylist() == ["de", "en"]


@pytest.mark.parametrize("doc_id", ["id", "CAST(NULL AS BIGINT)", "7", "id % 3"])
def test_the_sample_is_bounded_whatever_ids_repeat(spark, doc_id):
    df = spark.range(20_000).select(F.expr(f"{doc_id} AS doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.when(F.col("id") % 4 == 0, "xx").otherwise("yy").alias("lang"))
    sample = language.labelled_sample(df, "doc_id", "text", "lang", F.lit(True), per_language=300)
    counts = {lang: sum(x == lang for _, x in sample) for lang in ("xx", "yy")}
    assert all(200 < n <= 330 for n in counts.values())
    assert language.labelled_sample(df.repartition(7), "doc_id", "text", "lang", F.lit(True), per_language=300) == sample
    same = spark.range(20_000).selectExpr("1 AS doc_id", "'one text' AS text", "'xx' AS lang")
    assert len(language.labelled_sample(same, "doc_id", "text", "lang", F.lit(True), per_language=300)) <= 330


def plain_prediction(model, text):
    """The language and score of one text, subword by subword."""
    spaced, out = b" ", np.zeros(len(model.languages))
    for c in text.encode():
        letter = 65 <= c <= 90 or 97 <= c <= 122 or c >= 128
        spaced += bytes([c + 32 if 65 <= c <= 90 else c]) if letter else b" "
    spaced += b" "
    count = 0
    for k, size in enumerate(language.GRAMS):
        for i in range(len(spaced) - size + 1):
            gram = spaced[i : i + size]
            if 32 in gram[1:-1] or gram[0] == gram[-1] == 32:
                continue
            code = np.array([int.from_bytes(gram, "big")], dtype=np.uint64)
            slot = code if size == 2 else language.tb.mix(code) >> np.uint64(48)
            out += model.weights[int(slot[0]) + k * language.SLOTS].astype(np.float64)
            count += 1
    logits = (out / max(count, 1) + model.bias) / model.temperature
    p = np.exp(logits - logits.max())
    return model.languages[int(p.argmax())], float(p.max() / p.sum())


def test_predictions_against_a_plain_version(spark, model, sf_dir):
    small = sf_dir.replace("sf0.01", "sf0.001")
    texts = ["the und", "Der! THE 12 thing", "é", "日本 with", "nicht"] + [r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect() if r["text"]]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    rows = {r["k"]: r for r in language.identify(df, model).collect()}
    assert len(rows) == len(texts)
    for k, text in enumerate(texts):
        if any(c.isalpha() for c in text):
            lang, score = plain_prediction(model, text)
            assert rows[k]["lang_pred"] == lang and rows[k]["score"] == pytest.approx(score, abs=1e-6)
            assert rows[k]["rejected"] == (rows[k]["score"] < model.threshold)
        else:
            assert (rows[k]["lang_pred"], rows[k]["score"], rows[k]["rejected"]) == ("und", 0.0, True)
