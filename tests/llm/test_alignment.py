import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from classweave.llm import alignment, queries
from classweave.llm.tokens import tokenizer_file

A, B = queries.TOKENIZER, queries.PIECES


@pytest.fixture(scope="module")
def plain():
    """Ids and byte ends of both sides by the plain calls of the libraries."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    from tokenizers.decoders import ByteLevel

    first = Tokenizer.from_file(tokenizer_file(A))
    first.encode_special_tokens = True
    second = SentencePieceProcessor(model_file=tokenizer_file(B))
    hidden = iter(range(256, 512))
    bytes_of = {chr(b if 33 <= b < 127 or 161 <= b < 256 and b != 173 else next(hidden)): b for b in range(256)}
    assert ByteLevel().decode([c for c, b in bytes_of.items() if b == 65]) == "A"

    def a_bytes(i):
        return bytes(bytes_of[c] for c in first.id_to_token(i))

    def b_bytes(i):
        p = second.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode()

    def tokens(text):
        if not text:
            return [], []
        a = [(i, a_bytes(i)) for i in first.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, b_bytes(i)) for i in second.encode(text)]
        raw = b" " + text.encode()
        return (a, b) if b"".join(x for _, x in a) == raw == b"".join(x for _, x in b) else ([], [])

    return tokens


def spans(tokens):
    out, at = [], 0
    for i, raw in tokens:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def brute(texts, tokens):
    """(n_a, n_b, n_groups, n_links, n_overlaps, n_best, count_sum, groups) of each text, every pair of tokens compared."""
    per_text, counts = [], Counter()
    for text in texts:
        a, b = map(spans, tokens(text))
        links = [(x[0], y[0]) for x in a for y in b if x[2] == y[2]]
        shared = sum(max(x[1], y[1]) < min(x[2], y[2]) for x in a for y in b)
        ends = sorted({x[2] for x in a} & {y[2] for y in b})
        cuts = list(zip([0, *ends], ends))
        part = lambda side, s, e: ",".join(str(x[0]) for x in side if s < x[2] <= e)
        groups = ";".join(f"{part(a, s, e)}|{part(b, s, e)}" for s, e in cuts)
        per_text.append((len(a), len(b), len(cuts), len(links), shared, links, groups))
        counts.update(links)
    most = Counter()
    for (_, j), n in counts.items():
        most[j] = max(most[j], n)
    return [(*x[:5], sum(counts[p] == most[p[1]] for p in x[5]), sum(counts[p] for p in x[5]), x[6]) for x in per_text]


ODD = [None, "", " ", "  ", "a", " a", "a ", "a  b", "tab\tand\nline", "\n\n x \n", "café 日本語 \U0001f600\U0001f468‍\U0001f469", "<|endoftext|> <s></s> <unk>",
    "▁ under ▁", "nul\x00inside", "é ﬁ  nbsp   em", "1234567890 3.14 $$$ it's we'll", "x" * 700, "don't  stop", "same same", "same same", "<0x41> A", "\x85a b\u2028c d\x1c e\u3000 f",
    "▁", "a▁b c", "end▁ x▁y"]


def test_odd_texts_against_every_pair(spark, plain):
    df = spark.createDataFrame([(k, t, 1) for k, t in enumerate(ODD)], "k long, text string, n_a int").repartition(3)
    out = alignment.align_tokens(df, A, B, with_groups=True)
    assert out.columns == ["k", "text", "n_a", "n_a_", "n_b", "n_groups", "n_links", "n_overlaps", "n_best", "count_sum", "groups_sha256", "groups"]
    want = brute(ODD, plain)
    got = {r["k"]: r for r in out.collect()}
    assert len(got) == len(ODD) and all(r["text"] == ODD[k] and r["n_a"] == 1 for k, r in got.items())
    for k, (n_a, n_b, n_groups, n_links, shared, best, total, groups) in enumerate(want):
        r = got[k]
        assert (r["n_a_"], r["n_b"], r["n_groups"], r["n_links"], r["n_overlaps"], r["n_best"], r["count_sum"], r["groups"]) == (n_a, n_b, n_groups, n_links, shared, best, total, groups), ODD[k]
        assert r["groups_sha256"] == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")
        assert n_overlaps_fit(n_a, n_b, n_groups, shared)
    assert got[0]["n_b"] == got[1]["n_b"] == 0 and got[12]["n_b"] == 0  # null, empty, and a sign that the other side reads as a space


def n_overlaps_fit(n_a, n_b, n_groups, shared):
    """Within a group, tokens chain: each further token adds one pair."""
    return shared == n_a + n_b - n_groups


def test_the_whole_small_table_against_every_end(spark, sf_dir, plain):
    small = sf_dir.replace("sf0.01", "sf0.001")
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()}
    rows = queries.QUERIES["op11_alignment"](spark, small).collect()
    assert len(rows) == len(texts)
    counts, ends = Counter(), {}
    for k, text in texts.items():
        a, b = map(spans, plain(text))
        at = {e: i for i, _, e in b}
        ends[k] = (len(a), len(b), [(i, at[e]) for i, _, e in a if e in at])
        counts.update(ends[k][2])
    most = Counter()
    for (_, j), n in counts.items():
        most[j] = max(most[j], n)
    for r in rows:
        n_a, n_b, links = ends[r["doc_id"]]
        want = (n_a, n_b, len(links), len(links), sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links))
        assert (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"]) == want


def test_many_blocks_long_texts_and_empty_tables(spark, plain, monkeypatch):
    long = " ".join(f"w{k % 997} x{k}" for k in range(60_000))
    df = spark.createDataFrame([(k, t) for k, t in enumerate([long, "a b", long, None] + ["the same words again"] * 50)], "k long, text string").coalesce(1)
    whole = {r["k"]: r for r in alignment.align_tokens(df, A, B, keep=["k"]).collect()}
    monkeypatch.setattr(alignment, "BLOCK_LINKS", 10)
    blocks = {r["k"]: r for r in alignment.align_tokens(df.repartition(9, "k"), A, B, keep=["k"]).collect()}
    assert whole == blocks and len(whole) == 54
    a, b = plain(long)
    assert (whole[0]["n_a"], whole[0]["n_b"]) == (len(a), len(b)) and whole[0].asDict() | {"k": 2} == whole[2].asDict()
    assert alignment.align_tokens(df.where("false"), A, B).collect() == []


def test_pairs_are_counted_over_all_texts(spark, plain):
    texts = ["a b", "a b c", None, "a"]
    counts = Counter(p for t in texts for a, b in [tuple(map(spans, plain(t)))] for p in [(x[0], y[0]) for x in a for y in b if x[2] == y[2]])
    got = alignment.link_counts(spark.createDataFrame([(t,) for t in texts], "text string"), A, B)
    assert {(r["a"], r["b"]): r["n"] for r in got.collect()} == dict(counts)
    assert got.where(F.col("n") > 2).count() == 1
