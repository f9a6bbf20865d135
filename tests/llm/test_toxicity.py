import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from classweave.llm import queries, toxicity
from classweave.llm import textbytes as tb

RUDE, KIND = ["idiot", "moron", "worthless"], ["garden", "river", "window", "paper", "music", "bread", "street", "cloud"]


def some_texts(n, seed=1, rude=RUDE):
    rng = np.random.default_rng(seed)
    texts, labels = [], []
    for k in range(n):
        words = rng.choice(KIND, int(rng.integers(20, 80))).tolist()
        if k % 4 == 0:
            for at in rng.choice(len(words), max(1, len(words) // 30), replace=False):
                words[at] = str(rng.choice(rude))
        texts.append(" ".join(words))
        labels.append(int(k % 4 == 0))
    return texts, labels


@pytest.fixture(scope="module")
def model():
    return toxicity.train(*some_texts(800))


def scores(model, texts):
    return 1 / (1 + np.exp(-model.logits(toxicity.read_words(*toxicity._as_bytes(texts)))))


def test_labels_are_learnt_and_unseen_misspellings_share_subwords(model):
    texts, labels = some_texts(300, seed=5)
    assert np.mean((scores(model, texts) >= 0.5) == np.array(labels)) > 0.98
    calm = " ".join(KIND * 3)
    low, high, spelt = scores(model, [calm, calm + " idiot", calm + " idiott"])
    strange = scores(model, [calm + " umbrella"])[0]
    assert low < 0.5 < high and spelt > max(low, strange) + 0.1


def plain_score(model, text):
    """The score of one text, word by word and n-gram by n-gram."""
    raw = text.encode()
    words, now = [], b""
    for c in [*raw, 32]:
        if tb.IS_WORD[c]:
            now += bytes([tb.LOWER[c]])
        elif now:
            words.append(now)
            now = b""
    total = 0.0
    for word in words:
        marked = b" " + word + b" "
        codes = tb.byte_codes(np.frombuffer(marked, dtype=np.uint8))
        whole = tb.span_hash(tb.prefix_hash(codes), np.array([0]), np.array([len(marked)]))
        slots = [int(whole[0] >> np.uint64(32)) % toxicity.SLOTS]
        for k, size in enumerate(toxicity.GRAMS, 1):
            for i in range(len(marked) - size + 1):
                code = np.array([int.from_bytes(marked[i : i + size], "big")], dtype=np.uint64)
                slots.append(int(tb.mix(code)[0] % np.uint64(toxicity.SLOTS)) + k * toxicity.SLOTS)
        total += model.weights[slots].mean()
    return 1 / (1 + np.exp(-(model.scale * total / max(len(words), 1) + model.shift)))


def test_scores_against_a_plain_version(model):
    texts = ["", "a", "Idiot!! IDIOT, idiot.", "café 日本 12 x", "- - -", "river bread moron " * 50]
    assert np.allclose(scores(model, texts), [plain_score(model, t) for t in texts], atol=1e-12)


def test_nulls_long_texts_repeated_rows_and_clashing_names(spark, model):
    rows = [(1, None, 0.5), (2, "", 0.5), (3, "!!!", 0.5), (4, "river " * 300_000 + "idiot", 0.5), (5, "idiot", 0.5), (5, "idiot", 0.5)]
    out = toxicity.score_toxicity(spark.createDataFrame(rows, "k long, text string, score double"), model)
    assert out.columns == ["k", "text", "score", "score_", "predicted"]
    got = {r["k"]: (r["score_"], r["predicted"]) for r in out.collect()}
    assert got[1] == got[2] == got[3] and got[5][1] == 1 and got[4][1] == 0
    assert all(0 <= s <= 1 and p == (s >= 0.5) for s, p in got.values())
    assert toxicity.score_toxicity(spark.createDataFrame([], "text string"), model).collect() == []


def test_without_both_labels_the_score_is_their_share(spark):
    docs = spark.createDataFrame([(k, "some words") for k in range(10)], "doc_id long, text string")
    none = toxicity.fit_toxicity(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    calm = toxicity.fit_toxicity(docs, spark.createDataFrame([(k, 0) for k in range(10)] + [(3, None), (None, 1)], "doc_id long, toxic int"))
    for fitted in (none, calm):
        rows = toxicity.score_toxicity(docs, fitted).collect()
        assert all(r["predicted"] == 0 and r["score"] < 0.01 for r in rows)


@pytest.mark.parametrize("doc_id", ["id", "CASE WHEN id % 2 = 0 THEN id END", "7", "id % 3"])
def test_the_sample_is_bounded_whatever_ids_repeat(spark, doc_id):
    docs = spark.range(4000).select(F.expr(f"CAST({doc_id} AS BIGINT)").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    labels = docs.select("doc_id", (F.crc32(F.col("text").cast("binary")) % 2).cast("int").alias("toxic"))
    sample, share = toxicity.labelled_sample(docs, labels, "doc_id", "text", "toxic", F.lit(True), per_label=100)
    assert 0 < len(sample) <= 200 and 0.4 < share < 0.6
    again, _ = toxicity.labelled_sample(docs.repartition(5), labels.repartition(3), "doc_id", "text", "toxic", F.lit(True), per_label=100)
    assert again == sample


def test_held_out_rows_teach_nothing(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.concat(F.lit("number "), "id").alias("text"))
    sample, _ = toxicity.labelled_sample(docs, docs.select("doc_id", F.lit(1).alias("toxic")), "doc_id", "text", "toxic", ~toxicity.held_out("id"), per_label=500)
    used = {int(t.split()[1]) for t, _ in sample}
    assert used == {k for k in range(500) if zlib.crc32(str(k).encode()) % 5}


def test_held_out_documents_of_the_given_table(spark, sf_dir):
    large = sf_dir.replace("sf0.01", "sf0.1")
    rows = {r["doc_id"]: r for r in queries.QUERIES["op13_toxicity"](spark, large).collect()}
    docs = spark.read.parquet(f"{large}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    held = [r for r in docs if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert all(rows[r["doc_id"]]["held_out"] for r in held) and sum(r["held_out"] for r in rows.values()) == len(held)
    toxic = dict(spark.read.parquet(f"{large}/labels.parquet").select("doc_id", "toxic").collect())
    words = ("idiot", "moron", "worthless", "trash", "scum", "loser")
    rude = [any(w in (r["text"] or "").lower() for w in words) for r in held]
    judged = [rows[r["doc_id"]]["predicted"] for r in held]
    assert np.mean([p for p, x in zip(judged, rude) if x]) > 0.95
    assert np.mean([rows[r["doc_id"]]["predicted"] for r in held if toxic.get(r["doc_id"]) == 0]) < 0.03
