"""Words and rolling hashes of many texts at once, as numpy arrays over their UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are processed in runs of whole texts of about this many bytes; a longer text is a run of its own.
RUN_BYTES = 1 << 21

_BYTE = np.arange(256, dtype=np.uint8)
#: A-Z lower-cased, every other byte as it is.
LOWER = np.where((_BYTE >= 65) & (_BYTE <= 90), _BYTE + 32, _BYTE).astype(np.uint8)
#: Bytes of words: digits, letters, and all bytes of characters beyond ASCII.
IS_WORD = ((_BYTE >= 48) & (_BYTE <= 57)) | ((LOWER >= 97) & (LOWER <= 122)) | (_BYTE >= 128)

_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_LOWER_CODE = _BYTE_CODE[LOWER]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and base ** -i modulo 2 ** 64 for i up to n."""
    size = max(RUN_BYTES + 1, n + 1)
    if n <= RUN_BYTES:
        if RUN_BYTES not in _POWERS:
            _POWERS[RUN_BYTES] = _power_tables(size)
        return _POWERS[RUN_BYTES]
    return _power_tables(size)


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    tables = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        tables.append(np.cumprod(steps))
    return tables[0], tables[1]


def prefix_hash(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums from which `span_hash` takes the hash of any span."""
    up, down = _powers(len(codes))
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(codes * up[: len(codes)], out=sums[1:])
    return sums, down


def span_hash(prefix: tuple[np.ndarray, np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the spans [start, end): equal spans have equal hashes wherever they lie."""
    sums, down = prefix
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def window_hash(codes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all windows of n consecutive codes."""
    count = len(codes) - n + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    sums, down = prefix_hash(codes)
    return mix((sums[n:] - sums[:count]) * down[:count] + np.uint64(n))


def text_runs(column: pa.Array, run_bytes: int = RUN_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into runs: first row, end row, bytes, and the offsets of the rows within them; null is empty."""
    column = column.cast(pa.large_string()) if column.type != pa.large_string() else column
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < len(column):
        end = int(np.searchsorted(offsets, offsets[first] + run_bytes, side="right")) - 1
        end = min(max(end, first + 1), len(column))
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words in bytes, and for each text the index of its first word (one more at the end)."""
    inside = IS_WORD[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(len(data), dtype=bool)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(len(data), dtype=bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the words with A-Z lower-cased."""
    return span_hash(prefix_hash(_LOWER_CODE[data]), starts, ends)


def windows_within(first_word: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word of every window of n words that lies in one text, and that text's number."""
    counts = np.maximum(np.diff(first_word) - n + 1, 0)
    text = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts) + first_word[:-1][text]
    return at, text


def byte_codes(data: np.ndarray) -> np.ndarray:
    """A 64-bit code for every byte, case kept."""
    return _BYTE_CODE[data]
