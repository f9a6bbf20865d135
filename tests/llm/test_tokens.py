import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from classweave.llm import dac, tokens
from classweave.sources.staging import fresh_path

NAME = "byte_bpe_50k.json"


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(tokens.tokenizer_file(NAME))
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_pieces_give_the_ids_of_whole_texts(plain):
    rng = random.Random(5)
    parts = ["a", "it's", "I'll", "don't,", " ", "  ", "\n", "\n\n", "\t", " ", "é", "ß", "日本", "𝒳", "1", "42.", "²", "...", "--", "'s", "'", "_", "<|endoftext|>", "word,", "WORD!!", "x%%%", "\r\n", "ʰ", "́", "٣", "\x00", "\x1c", "\x85", ")", "Á."]
    texts = ["", " ", "\n"] + ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(1, 30))) for _ in range(3000)]
    found = tokens.encoder(tokens.tokenizer_file(NAME)).encode(pa.array(texts))
    for text, ids in zip(texts, found):
        assert np.frombuffer(ids, "<u4").tolist() == plain(text)


def test_added_tokens_are_read_as_by_the_plain_call(plain):
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y z", "<|endoftext| >", "plain words", "two <|endoftext|><|endoftext|>\nlines"]
    found = tokens.encoder(tokens.tokenizer_file(NAME)).encode(pa.array(texts))
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == [plain(t) for t in texts]
    assert 50256 in plain(texts[0])


def test_a_full_cache_changes_nothing(plain, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_PIECES", 3)
    encoder = tokens.Encoder(tokens.tokenizer_file(NAME))
    texts = ["one two, three four five. six", "two, six seven\neight one", "nine ten eleven"] * 2
    for text, ids in zip(texts, encoder.encode(pa.array(texts))):
        assert np.frombuffer(ids, "<u4").tolist() == plain(text)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=1500), st.sampled_from([(8, 8, 16), (4, 4, 8, 16), (16, 16), (32,)]))
def test_codes_round_trip_and_answer_any_place(values, bits):
    ids = np.array(values, dtype=np.uint32)
    block = dac.Block(dac.encode(ids, bits))
    assert len(block) == len(ids)
    assert block.slice(0, len(ids)).tolist() == values
    for i in range(0, len(ids), max(1, len(ids) // 7)):
        assert block[i] == values[i]
        assert block.slice(i, min(len(ids), i + 9)).tolist() == values[i : i + 9]
    with pytest.raises(IndexError):
        block[len(ids)]


def test_ids_beyond_the_levels_are_refused():
    with pytest.raises(ValueError):
        dac.encode(np.array([1 << 20]), (8, 8))


def test_written_documents_come_back_in_order(spark, plain):
    texts = {3: "hello world", 1: None, 2: "", 9: "long " * 50_000, 5: "tie", None: "no id"}
    rows = [(k, t, f"x{k}") for k, t in texts.items()] + [(5, "tie", "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(3)
    path = fresh_path(spark, "tokens")
    tokens.write_tokens(df, path, NAME, shards=3)
    got = sorted(tokens.read_tokens(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, 1, 2, 3, 5, 5, 9]
    at = 0
    for r in got:
        ids = np.array([*plain(texts[r["doc_id"]]), 0], dtype="<u4").tobytes()
        assert (r["start"], r["n_tokens"], r["ids_crc32"], bytes(r["ids"])) == (at, len(ids) // 4, zlib.crc32(ids), ids)
        at += r["n_tokens"]
    assert [tuple(r) for r in tokens.token_digests(spark, path).orderBy("start").collect()] == [tuple(r)[:4] for r in got]
    asked = spark.createDataFrame([(3, 0, "a"), (3, 1, "b"), (3, 2, "c"), (3, 3, "d"), (9, 40_000, "e"), (9, -1, "f"), (77, 0, "g")], "doc_id long, position long, token string")
    answers = {r["token"]: r["token_"] for r in tokens.tokens_at(spark, path, asked).collect()}
    assert answers == {"a": plain("hello world")[0], "b": plain("hello world")[1], "c": 0, "d": None, "e": plain("long " * 50_000)[40_000], "f": None}
    clashing = asked.select(F.col("doc_id").alias("block"), F.col("position").alias("shard"), F.col("token").alias("_place"), F.lit(1).alias("_i"))
    again = {r["_place"]: r["token"] for r in tokens.tokens_at(spark, path, clashing, "block", "shard").collect()}
    assert again == answers


def test_an_empty_table(spark):
    path = fresh_path(spark, "tokens")
    tokens.write_tokens(spark.createDataFrame([], "doc_id long, text string"), path, NAME)
    assert tokens.token_digests(spark, path).collect() == []
