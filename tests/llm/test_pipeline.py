import pytest

import corpus_pipeline
from classweave.llm.frames import written
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_jaccard import brute as alike
from tests.llm.test_packing import check as packed
from tests.llm.test_secrets import expected as base_spans


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """The rows that each stage was given and returned."""
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        made = written(stage(spark, docs, sf_dir))
        out.append((name, docs, made))
        docs = made
    return out


def rows(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_the_stages_are_the_agreed_ones(stages):
    assert [name for name, _, _ in stages] == ["language ID", "n-gram Jaccard join", "benchmark decontamination", "secret scans", "packing"]
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_language_rejects_what_has_none(stages, spark, sf_dir):
    _, before, after = stages[0]
    assert len(rows(after)) >= 0.99 * before.count()
    odd = spark.createDataFrame([(-1, None, None, "s", 0), (-2, "12 34", "en", "s", 5)], before.schema)
    again = corpus_pipeline.known_language(spark, before.union(odd), sf_dir)
    assert not set(rows(again)) & {-1, -2}


def test_one_of_each_group_stays(stages):
    _, before, after = stages[1]
    texts = sorted(rows(before).items())
    _, _, groups = alike([t for _, t in texts])
    expected = {min(texts[j][0] for j in groups[k]) for k in range(len(texts))}
    assert set(rows(after)) == expected


def test_contaminated_documents_go_and_others_stay(stages, spark, sf_dir):
    _, before, after = stages[2]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    texts = sorted(rows(before).items())
    expected = {i: t for (i, t), judged in zip(texts, contaminated([t for _, t in texts], items)) if not judged[3]}
    assert rows(after) == expected


def test_no_secret_is_left_and_the_rest_is(stages):
    _, before, after = stages[3]
    old, new = rows(before), rows(after)
    assert old.keys() == new.keys()
    changed = [i for i in old if old[i] != new[i]]
    assert set(changed) == {i for i in old if base_spans(old[i])}
    assert not any(base_spans(t) for t in new.values())


def test_packing_holds_every_token_once(stages):
    _, before, after = stages[4]
    packed(after.collect(), rows(before), 1024)


def test_run_gives_the_last_stage(stages, spark, sf_dir):
    _, _, last = stages[-1]
    made = corpus_pipeline.run(spark, sf_dir)
    assert made.columns == last.columns
    total = lambda df: {(r["doc_id"], r["doc_tokens"]) for r in df.collect()}
    assert total(made) == total(last)


def test_nothing_in_nothing_out(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).collect() == []
