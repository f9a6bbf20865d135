import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from classweave.llm import periods, queries


def brute(words):
    """Every maximal stretch of every period, the shortest period of each stretch."""
    found = []
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if length >= max(24, 3 * q) and not any((s, n) == (start, length) and q % p == 0 for s, n, p in found):
                found.append((start, length, q))
    return sorted(found)


def some_words(rnd):
    letters, n = rnd.choice([1, 2, 3, 50]), rnd.choice([0, 1, 23, 24, 25, 72, 150, 500])
    words = [rnd.randrange(letters) for _ in range(n)]
    for _ in range(rnd.randint(0, 3) if n > 30 else 0):
        q, a = rnd.randint(1, n // 3), rnd.randrange(n)
        for i in range(a + q, min(n, a + q * rnd.randint(2, 6) + rnd.randint(0, q))):
            words[i] = words[i - q]
    return words


@pytest.mark.parametrize("seed", range(8))
def test_runs_against_brute_force(seed):
    rnd = random.Random(seed)
    for _ in range(30):
        texts = [some_words(rnd) for _ in range(rnd.randint(1, 6))]
        first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        codes = np.array([w for t in texts for w in t], dtype=np.int64)
        assert periods.find_runs(codes, first) == [brute(t) for t in texts]


def test_shortest_runs_of_each_period_at_each_place():
    for q in range(1, 40):
        for before in range(0, 40, 7):
            length = max(24, 3 * q)
            words = [1000 + i for i in range(before)] + [i % q for i in range(length)] + [5000 + i for i in range(30)]
            assert periods.find_runs(np.array(words), np.array([0, len(words)])) == [[(before, length, q)]]
            short = np.delete(words, before + length - 1)
            assert periods.find_runs(short, np.array([0, len(short)])) == [brute(short.tolist())] == [[]]


def test_transforms_are_exact_for_both_primes(monkeypatch):
    rng = np.random.default_rng(1)
    for prime in (periods._SMALL, periods._LARGE):
        for size in (1, 2, 64, 4096):
            x = rng.integers(0, prime[0], (size, 3))
            assert ((periods.inverse(periods.transform(x, prime), prime) - x) % prime[0] == 0).all()
    words = rng.integers(0, 2, 3000)
    words[500:1400] = np.tile(words[500:800], 3)
    want = periods.find_runs(words, np.array([0, 3000]))
    assert (500, 900, 300) in [(s, n, q) for s, n, q in want[0] if q == 300] or any(q == 300 and s <= 500 for s, n, q in want[0])
    monkeypatch.setattr(periods, "_SMALL", (17, 3))  # every block is too long for the small prime
    assert periods.find_runs(words, np.array([0, 3000])) == want == [brute(words.tolist())]


def test_numbers_that_only_look_alike_modulo_the_prime():
    words = np.array([(i % 5) + 65537 * (i // 5 % 7) for i in range(400)])
    assert periods.find_runs(words, np.array([0, 400])) == [brute(words.tolist())]


def test_a_long_text_of_one_word_and_one_with_a_long_period():
    assert periods.find_runs(np.zeros(50_000, dtype=np.int64), np.array([0, 50_000])) == [[(0, 50_000, 1)]]
    words = np.concatenate([np.arange(10), np.tile(np.arange(9000) + 100, 4)])
    assert periods.find_runs(words, np.array([0, len(words)])) == [[(10, 36_000, 9000)]]


def plain(doc_id, text):
    """The agreed result of one document, in plain Python."""
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + length for s, length, q in runs)]
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return (len(runs), *best, milli, digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)), digest(" ".join(kept)))


COLUMNS = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_the_query_against_plain_python(spark, sf_dir):
    small = sf_dir.replace("sf0.01", "sf0.001")
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()}
    rows = queries.QUERIES["op12_periods"](spark, small).collect()
    assert len(rows) == len(texts) and sum(r["n_runs"] > 0 for r in rows) > 10
    for r in rows:
        if len((texts[r["doc_id"]] or "").split()) <= 4000:  # the plain version takes time with the square of a text
            assert tuple(r[c] for c in COLUMNS) == plain(r["doc_id"], texts[r["doc_id"]]), r["doc_id"]


def test_nulls_white_space_repeated_rows_and_clashing_names(spark):
    lap = " ".join(["one two\tthree"] * 10)
    rows = [(None, None, 1), (1, "", 2), (2, " \n\t ", 3), (3, lap, 4), (3, lap, 4), (4, "x y z " * 30, 5), (None, lap, 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    out = periods.collapse_runs(df)
    assert out.columns == ["doc_id", "text", "runs", "n_words", "runs_", "collapsed"]
    got = {r["runs"]: (r["n_words"], [tuple(x) for x in r["runs_"]], r["collapsed"]) for r in out.collect()}
    assert got[1] == got[2] == got[3] == (0, [], "")
    assert got[4] == got[6] == (30, [(0, 30, 3)], "one two three")
    assert got[5] == (30, [(0, 30, 1)], "x y z")
    assert periods.collapse_runs(df.where("false")).collect() == []
    moved = {r["runs"]: r["text"] for r in periods.planted(df).collect()}
    assert moved[1] is None and moved[6] == lap
    ids = spark.range(400).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(0, 40 + id % 7), i -> concat('w', i))) AS text")
    best = {r["doc_id"]: tuple(r[c] for c in COLUMNS[1:4]) for r in periods.collapse_runs(periods.planted(ids)).select("doc_id", "text", periods.strongest("runs").alias("b")).select("doc_id", "b.*").collect()}
    for r in ids.collect():
        assert best[r["doc_id"]] == plain(r["doc_id"], r["text"])[1:4]


def test_the_strongest_run_is_compared_exactly(spark):
    runs = [(0, 3_000_000_001, 1_000_000_000), (5, 3_000_000_004, 1_000_000_001), (9, 30, 10)]
    df = spark.createDataFrame([(runs,), (runs[::-1],), ([],)], "runs array<struct<start:bigint,length:bigint,period:bigint>>")
    want = max(runs, key=lambda r: Fraction(r[1], r[2]))
    got = [r["b"] and tuple(r["b"]) for r in df.select(periods.strongest("runs").alias("b")).collect()]
    assert got == [want, want, None]
