import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from classweave.llm import textbytes as tb

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text.translate(LOWER))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB1 é.\n_ß日\0", max_size=30), max_size=8), st.integers(1, 40))
def test_words_and_windows_as_by_regex(texts, run_bytes):
    column = pa.array(texts, pa.string())
    seen = 0
    for first, end, data, offsets in tb.text_runs(column, run_bytes):
        starts, ends, at = tb.word_spans(data, offsets)
        raw = tb.LOWER[data].tobytes()
        for k in range(end - first):
            own = [raw[s:e].decode() for s, e in zip(starts[at[k] : at[k + 1]], ends[at[k] : at[k + 1]])]
            assert own == words(texts[first + k])
        hashes = tb.word_hashes(data, starts, ends)
        index, text = tb.windows_within(at, 2)
        pairs = tb.window_hash(hashes, 2)[index] if len(index) else []
        expected = [tuple(w[i : i + 2]) for t in texts[first:end] for w in [words(t)] for i in range(len(w) - 1)]
        assert len(pairs) == len(expected) == len(text)
        assert len(set(map(int, pairs))) == len(set(expected))
        seen = end
    assert seen == len(texts)


def test_equal_spans_have_equal_hashes_anywhere():
    data = np.frombuffer(b"xxabcyyyyabczabd", dtype=np.uint8)
    prefix = tb.prefix_hash(tb.byte_codes(data))
    a, b, c = tb.span_hash(prefix, np.array([2, 9, 13]), np.array([5, 12, 16]))
    assert a == b != c


def test_nulls_are_empty_and_slices_keep_their_place():
    column = pa.array(["one two", None, "", "three"]).slice(1)
    (first, end, data, offsets), *rest = tb.text_runs(column)
    assert (first, end, data.tobytes(), offsets.tolist(), rest) == (0, 3, b"three", [0, 0, 0, 5], [])
    assert list(tb.text_runs(pa.array([], pa.string()))) == []


@pytest.mark.parametrize("size", [10, tb.RUN_BYTES + 5])
def test_hashes_do_not_depend_on_the_size_of_the_run(size):
    data = np.frombuffer(b"ab" * (size // 2), dtype=np.uint8)
    prefix = tb.prefix_hash(tb.byte_codes(data))
    first, last = tb.span_hash(prefix, np.array([0, len(data) - 2]), np.array([2, len(data)]))
    assert first == last
