import random

import pytest

from classweave.llm import decontaminate
from tests.llm.test_textbytes import words

VOCABULARY = ["alpha", "Beta", "gamma", "delta", "épée", "9", "x"]


def brute(texts, items, window=13):
    out = []
    known = {}
    for item, text in items:
        w = words(text or "")
        for k in range(max(1, len(w) - window + 1) if w else 0):
            known.setdefault(tuple(w[k : k + window]), set()).add(item)
    for text in texts:
        w = words(text or "")
        hit, found = set(), set()
        for n in {len(k) for k in known}:
            for k in range(len(w) - n + 1):
                if (own := tuple(w[k : k + n])) in known:
                    hit.update(range(k, k + n))
                    found |= known[own]
        out.append((len(w), len(hit), sorted(str(x) for x in found if x is not None), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def example():
    rng = random.Random(6)
    text = lambda n: " ".join(rng.choice(VOCABULARY) for _ in range(n))
    items = [(k, text(rng.choice([3, 13, 20, 30]))) for k in range(12)] + [(20, None), (21, ""), (22, "..."), (3, "one more text of item three"), (None, "nameless item")]
    texts = [text(rng.randint(0, 60)) for _ in range(60)] + [text(10) + ", " + (items[k][1] or "").upper().replace(" ", "! ") + text(400) for k in range(12)]
    return texts + [None, "", "a nameless item", "one more text of item three " * 3000, items[2][1], items[2][1]], items


@pytest.mark.parametrize("limit", [decontaminate.MAX_WINDOWS, 0])
def test_hits_as_by_brute_force(spark, limit):
    texts, items = example()
    docs = spark.createDataFrame([(k, t, 7) for k, t in enumerate(texts)], "doc_id long, text string, n_hit int").repartition(3)
    bench = spark.createDataFrame(items, "item_id int, text string")
    out = decontaminate.contamination(docs, bench, max_windows=limit)
    assert out.columns == ["doc_id", "text", "n_hit", "n_words", "n_hit_", "items", "contaminated"]
    got = {r["doc_id"]: (r["n_words"], r["n_hit_"], r["items"], r["contaminated"]) for r in out.collect()}
    assert [got[k] for k in range(len(texts))] == brute(texts, items)


@pytest.mark.parametrize("limit", [decontaminate.MAX_WINDOWS, 0])
def test_documents_or_spans_are_removed(spark, limit):
    passage = " ".join(f"w{k}" for k in range(15))
    rows = [(1, f"Before it, {passage.upper()}! After.", "a"), (2, "clean", "b"), (None, None, None), (3, "far " * 400 + passage, "c"), (1, passage, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, items string")
    bench = spark.createDataFrame([("q", passage)], "item_id string, text string")
    kept = decontaminate.decontaminate(docs, bench, max_windows=limit)
    assert kept.columns == docs.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["2", "3", "None"]
    cut = decontaminate.decontaminate(docs, bench, mode="spans", max_windows=limit)
    assert sorted(((r["doc_id"] or 0, r["text"]) for r in cut.collect()), key=repr) == sorted([(1, "Before it, ! After."), (2, "clean"), (0, None), (3, rows[3][1]), (1, "")], key=repr)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id int, text string")
    assert [(r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in decontaminate.contamination(docs, none).collect()] == [(2, 0, [], False)]
    assert decontaminate.contamination(docs.where("false"), none).collect() == []
    assert [r["cleaned"] for r in decontaminate.contamination(docs, spark.createDataFrame([(1, "some")], "item_id int, text string"), cleaned=True, max_windows=0).collect()] == [" words"]


@pytest.mark.parametrize("limit", [decontaminate.MAX_WINDOWS, 0])
def test_null_and_repeated_ids_on_both_paths(spark, limit):
    passage, other = (" ".join(f"{p}{k}" for k in range(15)) for p in "wv")
    texts = [(None, passage), (None, "clean words"), (1, passage), (1, other), (1, "x " + passage), (1, passage), (2, "a b c")]
    bench = [("q", passage), ("r", other)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    out = decontaminate.contamination(docs, spark.createDataFrame(bench, "item_id string, text string"), max_windows=limit)
    got = sorted(((r["doc_id"], r["text"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in out.collect()), key=repr)
    assert got == sorted(((*row, *judged) for row, judged in zip(texts, brute([t for _, t in texts], bench))), key=repr)


def test_a_window_that_only_has_the_hash_is_no_hit(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b c"), (2, "d e f")], "doc_id long, text string")
    windows = decontaminate.item_windows(spark.createDataFrame([(1, "a b c")], "item_id int, text string"))
    index = decontaminate._Index(windows.withColumn("verify", windows["verify"] + 1).toArrow())
    column = docs.toArrow().column("text").combine_chunks()
    assert decontaminate._judged(column, False, decontaminate._broadcast_hits(index))["n_hit"] == [0, 0]
    index = decontaminate._Index(windows.toArrow())
    assert decontaminate._judged(column, False, decontaminate._broadcast_hits(index))["n_hit"] == [3, 0]


@pytest.mark.parametrize("limit", [decontaminate.MAX_WINDOWS, 0])
def test_a_long_text_full_of_hits(spark, limit):
    passage = " ".join(f"w{k}" for k in range(20))
    docs = spark.createDataFrame([(1, (passage + " ") * 5000), (2, "clean " * 100_000)], "doc_id long, text string")
    out = decontaminate.contamination(docs, spark.createDataFrame([("q", passage)], "item_id string, text string"), max_windows=limit)
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in out.drop("text").collect()} == {1: (100_000, 100_000, ["q"]), 2: (100_000, 0, [])}
