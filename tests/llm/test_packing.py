import zlib
from functools import cache

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from classweave.llm import packing, tokens

NAME = "byte_bpe_50k.json"


@cache
def plain():
    tokenizer = Tokenizer.from_file(tokens.tokenizer_file(NAME))
    return tokenizer


@cache
def encoded(text):
    return np.array([*plain().encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")


def test_the_curve_visits_every_cell_by_single_steps():
    for dimensions, bits in ((2, 4), (3, 3)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions, indexing="ij"), -1).reshape(-1, dimensions)
        keys = packing.hilbert_key(grid, bits)
        assert sorted(keys.tolist()) == list(range(len(grid)))
        assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_like_texts_lie_near_each_other():
    a, b = "red apple green pear blue plum " * 20, "stone iron copper zinc tin lead " * 20
    keys = packing.curve_keys(pa.array([a, a + "kiwi", b, a, None, ""]))
    assert keys[0] == keys[3] and keys[4] == keys[5]
    assert abs(int(keys[0]) - int(keys[1])) < abs(int(keys[0]) - int(keys[2]))


def check(rows, texts, length):
    cover, sequences = {}, {}
    for r in rows:
        ids = encoded(texts[r["doc_id"]])
        piece = ids[r["start"] : r["start"] + r["length"]]
        assert 0 < r["length"] == len(piece) and r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(piece.tobytes())
        cover.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for group in (*cover.values(), *sequences.values()):
        at = 0
        for start, n in sorted(group):
            assert start == at
            at += n
    assert {k: sum(n for _, n in v) for k, v in cover.items()} == {k: len(encoded(t)) for k, t in texts.items()}
    for pieces in sequences.values():
        size = sum(n for _, n in pieces)
        assert size <= length and size & (size - 1) == 0
    return sequences


def test_every_id_lies_in_one_piece_and_nothing_is_padded(spark):
    texts = {k: f"text number {k} of many, " * (k * 7 % 40) for k in range(60)} | {60: None, 61: "", 62: "word " * 20_000, None: "without id"}
    df = spark.createDataFrame([(k, t, 1) for k, t in texts.items()], "doc_id long, text string, offset int").repartition(5)
    out = packing.pack(df, NAME, sequence_tokens=64, partitions=3)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    check(out.collect(), texts, 64)
    with_ids = packing.pack(df, NAME, sequence_tokens=64, partitions=3, with_ids=True).where("doc_id = 62").collect()
    assert b"".join(bytes(r["ids"]) for r in sorted(with_ids, key=lambda r: r["start"])) == encoded(texts[62]).tobytes()


def test_copies_and_empty_tables(spark):
    df = spark.createDataFrame([(k, "the same text again and again") for k in range(300)], "doc_id long, text string")
    rows = packing.pack(df, NAME, sequence_tokens=16, partitions=4).collect()
    check(rows, {k: "the same text again and again" for k in range(300)}, 16)
    assert len({r["sequence_id"] >> 32 for r in rows}) > 1
    assert packing.pack(df.where("false"), NAME).collect() == []


def test_the_query_on_the_given_table(spark, sf_dir):
    from classweave.llm.queries import QUERIES

    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    check(QUERIES["op4_packing"](spark, sf_dir).collect(), texts, 1024)
