import numpy as np
import pytest

from classweave.llm import neighbours, queries
from classweave.llm.components import components


def brute(rows, cosine=0.95):
    """{position: (links, smallest position reachable)} by comparing all."""
    unit = {}
    for k, (_, v) in enumerate(rows):
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            unit[k] = np.array(v, float) / np.linalg.norm(np.array(v, float))
    links = {k: [j for j in unit if j != k and len(unit[j]) == len(unit[k]) and unit[k] @ unit[j] >= cosine] if k in unit else [] for k in range(len(rows))}
    seen = {}
    for k in range(len(rows)):
        if k not in seen:
            group, todo = {k}, [k]
            while todo:
                for j in links[todo.pop()]:
                    if j not in group:
                        group.add(j)
                        todo.append(j)
            for j in group:
                seen[j] = group
    return links, seen


def check(spark, rows, extra="int"):
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, kept int")
    out = neighbours.near_duplicates(df)
    assert out.columns == ["vec_id", "embedding", "kept", "n_links", "component_id", "kept_"]
    links, groups = brute(rows)
    expected = sorted(((rows[k][0], len(links[k]), min((rows[j][0] for j in groups[k] if rows[j][0] is not None), default=rows[k][0])) for k in range(len(rows))), key=repr)
    got = out.collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=repr) == expected
    for r in got:
        assert r["kept_"] == (r["vec_id"] == r["component_id"])


def test_clusters_copies_and_invalid_vectors(spark):
    rng = np.random.default_rng(2)
    rows, k = [], 0
    for size, spread in ((40, 0.01), (25, 0.035), (3, 0.02), (2, 0.02)):
        centre = rng.standard_normal(16)
        for _ in range(size):
            rows.append((k, (centre + spread * 4 * rng.standard_normal(16)).astype(np.float32).tolist()))
            k += 1
    rows += [(k + j, rng.standard_normal(16).astype(np.float32).tolist()) for j in range(150)]
    same = rows[-1][1]
    rows += [(1000 + j, same) for j in range(30)]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [float("nan")] * 16), (2004, [None] + [1.0] * 15), (2005, [float("inf")] + [1.0] * 15), (2006, same[:8]), (2007, [2 * x for x in same])]
    rows += [(None, same), (5, rows[0][1]), (2010, [1e38] * 16), (2011, [1e-38] * 16)]
    order = rng.permutation(len(rows))
    check(spark, [rows[i] for i in order])


def test_an_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert neighbours.near_duplicates(df).collect() == []


def test_the_query_on_the_given_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    links, groups = brute(rows)
    got = {r["vec_id"]: r for r in queries.QUERIES["op6_near_duplicates"](spark, sf_dir).collect()}
    assert len(got) == len(rows)
    for k, (i, _) in enumerate(rows):
        assert got[i]["n_links"] == len(links[k]) and got[i]["component_id"] == min(rows[j][0] for j in groups[k])


@pytest.mark.parametrize("edges", [[(3, 1), (1, 3), (1, 2), (2, 2), (9, 8)], [(k, k + 1) for k in range(40)], [(0, k) for k in range(1, 60)]])
def test_components(spark, edges):
    got = dict(tuple(r) for r in components(spark.createDataFrame([*edges, (None, 5)], "a long, b long")).collect())
    root = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in root:
        for a, b in edges:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    assert got == root


def test_the_audit_sees_lost_pairs_beside_a_dense_group(spark):
    rng = np.random.default_rng(5)
    centre, others = rng.standard_normal(32), rng.standard_normal((200, 32))
    vectors = [centre + 0.01 * rng.standard_normal(32) for _ in range(400)] + [v + 0.01 * rng.standard_normal(32) for v in others for _ in range(2)]
    nodes = spark.createDataFrame([(k, bytearray((v / np.linalg.norm(v)).astype("<f8").tobytes())) for k, v in enumerate(vectors)], "key long, vector binary")
    dense = [(a, b) for a in range(400) for b in range(400) if a != b]
    pairs = [p for k in range(400, 800, 2) for p in ((k, k + 1), (k + 1, k))]
    recall = lambda found: neighbours.recall_of_links(nodes, spark.createDataFrame(found, "a long, b long"))
    assert recall(dense + pairs) == 1
    assert 0.3 < recall(dense + pairs[:200]) < 0.7  # half of the pairs are lost, a thousandth of all links


def test_more_tables_for_more_bits():
    assert neighbours.tables_needed(10) == neighbours.TABLES
    for bits in (12, 18, 24):
        met = (1 - np.arccos(0.95) / np.pi) ** bits
        assert 1 - (1 - met) ** neighbours.tables_needed(bits) >= 0.985


def test_a_recall_too_low_raises_after_the_last_forest(spark, monkeypatch):
    df = spark.createDataFrame([(k, [1.0, k / 100]) for k in range(5)], "vec_id long, embedding array<double>")
    seen = []
    monkeypatch.setattr(neighbours, "AUDITS", 2)
    monkeypatch.setattr(neighbours, "recall_of_links", lambda *a: seen.append(a) or 0.5)
    with pytest.raises(RuntimeError, match="0.5"):
        neighbours.near_duplicates(df)
    assert len(seen) == 2
