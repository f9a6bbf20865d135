import random

import numpy as np
import pytest

import corpus_pipeline
from classweave.llm import jaccard, queries
from tests.llm.test_textbytes import words


def brute(texts):
    """Per position: class and component as sets of positions, and the linked positions, by comparing all."""
    sets = []
    for t in texts:
        w = words(t or "")
        sets.append(frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset())
    holders = {}
    for k, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(k)
    links = []
    for k, s in enumerate(sets):
        near = {j for x in s for j in holders[x]} - {k}
        links.append([j for j in near if 5 * len(s & sets[j]) >= 4 * len(s | sets[j])])
    group = {}
    for k in range(len(texts)):
        if k not in group:
            own, todo = {k}, [k]
            while todo:
                for j in links[todo.pop()]:
                    if j not in own:
                        own.add(j)
                        todo.append(j)
            for j in own:
                group[j] = own
    same = [[j for j in range(len(texts)) if sets[j] == sets[k]] if sets[k] else [k] for k in range(len(texts))]
    return same, links, group


def edited(rng, text, share):
    w = text.split()
    return " ".join(rng.choice(VOCABULARY) if rng.random() < share else x for x in w)


VOCABULARY = [a + b for a in ("ba", "ko", "li", "mu", "ne", "po", "ra") for b in ("da", "fe", "gi", "ho", "ju", "ka", "s", "t", "v")]


def test_classes_links_and_components(spark):
    rng = random.Random(4)
    base = [" ".join(rng.choices(VOCABULARY, k=rng.choice([30, 80, 150]))) for _ in range(40)]
    shared = " ".join(rng.choices(VOCABULARY, k=60))
    texts = list(base) + [edited(rng, b, s) for b in base[:15] for s in (0.01, 0.02, 0.04)] + [shared + " " + " ".join(rng.choices(VOCABULARY, k=200)) for _ in range(200)]
    hot = " ".join(rng.choices(VOCABULARY, k=100))
    texts += [edited(rng, hot, 0.012) for _ in range(200)] + [base[3].upper() + "!"] * 3 + [None, "", "...", "one two", "One, two", "one two three four five", "x " * 30_000]
    rows = [(1000 - k, t, "en") for k, t in enumerate(texts)]
    out = jaccard.similar_documents(spark.createDataFrame(rows, "doc_id long, text string, kept string").repartition(4))
    assert out.columns == ["doc_id", "text", "kept", "class_id", "n_links", "component_id", "kept_"]
    same, links, group = brute(texts)
    got = {r["doc_id"]: r for r in out.collect()}
    assert len(got) == len(rows)
    for k, (i, _, _) in enumerate(rows):
        ids = lambda places: min(rows[j][0] for j in places)
        assert (got[i]["class_id"], got[i]["n_links"], got[i]["component_id"]) == (ids(same[k]), len(links[k]), ids(group[k])), texts[k]
        assert got[i]["kept_"] == (i == ids(group[k]))


def test_ids_that_are_null_or_repeated_and_empty_tables(spark):
    text = "a text of more than five words that stands here several times"
    df = spark.createDataFrame([(1, text), (1, text), (1, "another text altogether with some words"), (None, text), (None, "alone, without any id at all"), (2, None)], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["text"], r["n_links"], r["kept"]) for r in jaccard.similar_documents(df).collect()), key=repr)
    assert got == sorted([(1, text, 2, True), (1, text, 2, True), (1, "another text altogether with some words", 0, True), (None, text, 2, False), (None, "alone, without any id at all", 0, True), (2, None, 0, True)], key=repr)
    assert jaccard.similar_documents(df.where("false")).collect() == []
    kept = jaccard.one_of_each(df)
    assert kept.columns == df.columns and kept.count() == 5


def test_products_count_what_sets_share():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 3000, rng.integers(1, 900)).astype(np.uint64)) for _ in range(20)]
    a, b = np.triu_indices(20, 1)
    expected = [len(np.intersect1d(sets[i], sets[j])) for i, j in zip(a, b)]
    assert jaccard._shared_counts(sets, a, b).tolist() == expected
    assert jaccard._shared_counts(sets, a[:5], b[:5]).tolist() == expected[:5]


def test_more_runs_for_more_recall():
    assert jaccard.runs_needed(0.9) < jaccard.runs_needed(0.999) < jaccard.runs_needed(0.999999)
    with pytest.raises(ValueError):
        jaccard.similar_documents(None, target_recall=1 - 1e-16, similarity=(1, 10))


def test_the_query_on_the_given_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    same, links, group = brute([t for _, t in rows])
    got = {r["doc_id"]: r for r in queries.QUERIES["op8_jaccard_join"](spark, sf_dir).collect()}
    assert len(got) == len(rows)
    for k, (i, _) in enumerate(rows):
        assert (got[i]["class_id"], got[i]["n_links"], got[i]["component_id"]) == (min(rows[j][0] for j in same[k]), len(links[k]), min(rows[j][0] for j in group[k]))


def test_the_pipeline_keeps_one_of_repeated_rows(spark, sf_dir):
    text = "a text of more than five words that stands here several times"
    alone = "alone, without any id at all"
    rows = [(1, text, "en")] * 40 + [(2, text, "en"), (3, "another text altogether with some words", "en"), (None, alone, "en"), (None, alone, "en"), (1, "same id, other words, which are kept too", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    kept = corpus_pipeline.one_of_each_group(spark, df, sf_dir)
    assert kept.columns == df.columns
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted({r for r in rows if r[0] != 2}, key=repr)


def test_the_screen_loses_no_more_than_the_recall_leaves():
    from math import comb

    for target in (0.99, 0.99999, 0.9999999):
        least = jaccard.least_equal(target)
        lost = sum(comb(64, m) * 0.8**m * 0.2 ** (64 - m) for m in range(least))
        assert lost <= (1 - target) / 10 < lost + comb(64, least) * 0.8**least * 0.2 ** (64 - least)
