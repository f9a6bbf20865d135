import hashlib
import random

import numpy as np
import pytest

from classweave.llm import queries, repeats


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    count = {}
    for b in data:
        for k in range(len(b) - length + 1):
            count[b[k : k + length]] = count.get(b[k : k + length], 0) + 1
    out = []
    for b in data:
        gone = np.zeros(len(b), dtype=bool)
        for k in range(len(b) - length + 1):
            if count[b[k : k + length]] > 1:
                gone[k : k + length] = True
        edge = np.diff(np.concatenate([[0], gone.astype(int)])) == 1
        out.append((len(b), int(gone.sum()), int(edge.sum()), np.frombuffer(b, np.uint8)[~gone].tobytes()))
    return out


def check(spark, texts, length, gram, ids=None):
    rows = [(k if ids is None else ids[k], t, "x") for k, t in enumerate(texts)]
    out = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string, kept string").repartition(3), length=length, gram=gram)
    assert out.columns == ["doc_id", "text", "kept", "n_bytes", "n_removed", "n_spans", "kept_"]
    got = sorted(((r["text"] or "", r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept_"])) for r in out.collect()), key=repr)
    assert got == sorted(((t or "", *e) for t, e in zip(texts, brute(texts, length))), key=repr)


def test_shared_passages_edits_copies_and_runs(spark):
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    passage, other = word(90), word(60)
    texts = [word(rng.randint(0, 120)) + passage[rng.randint(0, 30) : 90 - rng.randint(0, 30)] + word(rng.randint(0, 80)) for _ in range(120)]
    texts += [word(50) + other + word(20) + other, "a" * 500, "ab" * 200, "ab" * 150 + "b", None, "", "short", passage, passage, word(30) + passage + passage]
    texts += ["日本語" * 40, "x" + "日本語" * 40]
    check(spark, texts, 40, 16)


def test_large_groups_are_counted_by_hash(spark, monkeypatch):
    monkeypatch.setattr(repeats, "COMPARED", 2)
    rng = random.Random(9)
    passage = "".join(rng.choice("abcdef") for _ in range(70))
    texts = ["".join(rng.choice("abcdef") for _ in range(60)) + passage[k % 9 : 70 - k % 7] + "".join(rng.choice("abcdef") for _ in range(60)) for k in range(60)]
    check(spark, texts, 50, 20)


def test_long_texts_are_looked_at_in_stretches(spark, monkeypatch):
    rng = random.Random(10)
    long = "".join(rng.choice("abcdefgh") for _ in range(900))
    monkeypatch.setattr(repeats, "RUN_STARTS", 100)
    monkeypatch.setattr(repeats, "_PLACE_BITS", 8)
    import pyarrow as pa

    column = pa.array([long, long[200:420] + "zz" + long[500:700], "tiny"])
    seen = {}
    for first, data, offsets, begin in repeats._stretches(column, 40):
        text, at, n, lead, grams, spans = repeats.anchors(data, offsets, 40, 16)
        for t, a, c in zip(text.tolist(), at.tolist(), n.tolist()):
            for k in range(a + begin, a + begin + c):
                assert (first + t, k) not in seen
                seen[first + t, k] = True
    assert len(seen) == sum(max(0, len(x) - 39) for x in column.to_pylist())


def test_repeated_ids_and_empty_tables(spark):
    text = "0123456789" * 6
    check(spark, [text, text, "another one", text + "!"], 40, 10, [1, 1, 1, None])
    assert repeats.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    with pytest.raises(ValueError):
        repeats.remove_repeats(spark.createDataFrame([], "doc_id long, text string"), length=4, gram=10)


def test_the_query_on_the_given_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    data = {i: (t or "").encode() for i, t in rows}
    count = {}
    for b in data.values():
        for k in range(len(b) - 399):
            h = hash(b[k : k + 400])
            count[h] = count.get(h, 0) + 1
    got = {r["doc_id"]: r for r in queries.QUERIES["op9_repeats"](spark, sf_dir).collect()}
    assert len(got) == len(rows)
    for i, b in data.items():
        change = np.zeros(len(b) + 1, dtype=int)
        for k in range(len(b) - 399):
            if count[hash(b[k : k + 400])] > 1:
                change[k] += 1
                change[k + 400] -= 1
        gone = np.cumsum(change[:-1]) > 0
        left = np.frombuffer(b, np.uint8)[~gone].tobytes()
        r = got[i]
        assert (r["n_bytes"], r["n_removed"], r["kept_sha256"]) == (len(b), int(gone.sum()), hashlib.sha256(left).hexdigest())
        assert r["n_spans"] == int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
