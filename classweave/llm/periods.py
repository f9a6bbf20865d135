"""Periodic runs of words: block convolution at dyadic scales finds distances, extensions make them maximal runs."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from classweave.functions import quoted
from classweave.llm import textbytes as tb
from classweave.llm.frames import free_name, map_batches

# A run has at least so many words and so many periods; white space that parts words.
MIN_WORDS, MIN_PERIODS = 24, 3
_IS_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])
#: The least scale. A run of MIN_WORDS holds an aligned block of so many words and its next occurrence.
LEAST_BLOCK = 8
#: Numbers that are transformed together.
CHUNK = 1 << 18
# Primes of the transforms with a generator of their units: one with a cheap remainder, and one for blocks too long for it.
_SMALL, _LARGE = (65537, 3), (2013265921, 31)


def _remainder(x: np.ndarray, p: int) -> np.ndarray:
    """A number equal to x modulo p and small enough to be multiplied: for 2**16 + 1, high bits count negative."""
    if p != _SMALL[0]:
        return x % p
    x = (x & 0xFFFF) - (x >> 16)
    return (x & 0xFFFF) - (x >> 16)


@lru_cache(maxsize=64)
def _roots(p: int, generator: int, size: int, inverse: bool) -> list[np.ndarray]:
    """Powers of the root of unity for each step of a transform, by falling half size."""
    root = pow(generator, (p - 1) // size, p)
    root = pow(root, -1, p) if inverse else root
    powers = np.ones(size // 2, dtype=np.int64)
    done = 1
    while done < size // 2:
        powers[done : 2 * done] = powers[: min(done, size // 2 - done)] * pow(root, done, p) % p
        done *= 2
    return [powers[:: size // 2 // half, None] for half in (size >> k for k in range(1, size.bit_length()))]


def transform(x: np.ndarray, prime: tuple[int, int]) -> np.ndarray:
    """The number-theoretic transform down the columns of `x`, whose length is a power of two; rows in bit-reversed order."""
    p, generator = prime
    size, columns = x.shape
    half = size // 2
    for root in _roots(p, generator, size, False) if size > 1 else []:
        pairs = x.reshape(-1, 2, half, columns)
        out = np.empty_like(pairs)
        upper, lower = pairs[:, 0], pairs[:, 1]
        out[:, 0] = upper + lower if p == _SMALL[0] else (upper + lower) % p
        out[:, 1] = _remainder((upper - lower) * root, p)
        x, half = out.reshape(size, columns), half // 2
    return _remainder(x, p)


def inverse(x: np.ndarray, prime: tuple[int, int]) -> np.ndarray:
    """What `transform` made `x` of."""
    p, generator = prime
    size, columns = x.shape
    half = 1
    for root in reversed(_roots(p, generator, size, True)) if size > 1 else []:
        pairs = x.reshape(-1, 2, half, columns)
        out = np.empty_like(pairs)
        lower = _remainder(pairs[:, 1] * root, p)
        out[:, 0] = pairs[:, 0] + lower if p == _SMALL[0] else (pairs[:, 0] + lower) % p
        out[:, 1] = pairs[:, 0] - lower if p == _SMALL[0] else (pairs[:, 0] - lower) % p
        x, half = out.reshape(size, columns), half * 2
    return _remainder(_remainder(x, p) * pow(size, -1, p), p)


def block_occurrences(codes: np.ndarray, starts: np.ndarray, block: int, least: int, distances: int) -> tuple[np.ndarray, np.ndarray]:
    """(block's number, distance): where the block of words at each start may occur again, `least` to `least + distances - 1` words on.

    The sum of squared differences of block and window is Σx² + Σy² - 2 Σxy, and Σxy for all distances at once is one
    cyclic correlation by exact integer transforms modulo a prime. A place without a mismatch has the sum 0, so none is
    lost; another sum that is 0 modulo the prime is told apart when the words are compared. `codes` must reach
    `least + distances + block` beyond the last start.
    """
    size = 1 << (distances + block - 2).bit_length()
    prime = _SMALL if size < _SMALL[0] else _LARGE
    p = prime[0]
    values = codes % p
    squares = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values * values % p, out=squares[1:])
    numbers, found = [], []
    step = max(1, CHUNK // size)
    for first in range(0, len(starts), step):
        own = starts[first : first + step]
        window = np.zeros((size, len(own)), dtype=np.int64)
        window[: distances + block - 1] = values[own + (least + np.arange(distances + block - 1))[:, None]]
        pattern = np.zeros((size, len(own)), dtype=np.int64)
        pattern[-np.arange(block) % size] = values[own + np.arange(block)[:, None]]
        product = _remainder(transform(window, prime) * transform(pattern, prime), p)
        cross = inverse(product, prime)[:distances]
        at = own + (least + np.arange(distances))[:, None]
        total = squares[own + block] - squares[own] + squares[at + block] - squares[at] - 2 * cross
        lag, number = np.nonzero(total % p == 0)
        numbers.append(number + first)
        found.append(lag + least)
    return (np.concatenate(numbers), np.concatenate(found)) if numbers else (np.zeros(0, dtype=np.int64),) * 2


def _scales(longest: int) -> Iterator[tuple[int, int, int]]:
    """(block, least distance, number of distances) of each scale, for texts of up to so many words.

    A run of period q has at least 3 q words. Among its first `block` places one is a multiple of `block`; from there it
    holds the block and its occurrence q further if 2 block - 1 + q words are enough, so the block may be as long as q.
    The least scale takes all shorter periods too, as 2 * 8 - 1 + q is at most 24 for q up to 8.
    """
    if longest >= MIN_WORDS:
        yield LEAST_BLOCK, 1, 2 * LEAST_BLOCK - 1
    block = 2 * LEAST_BLOCK
    while MIN_PERIODS * block <= longest:
        yield block, block, block
        block *= 2


def _reach(words: np.ndarray, at: int, distance: int, block: int) -> tuple[int, int]:
    """The longest stretch of places around a block whose words stand again `distance` words on; empty if the block's don't."""
    n = len(words) - distance
    if not np.array_equal(words[at : at + block], words[at + distance : at + distance + block]):
        return at, at
    start, end, step = at, at + block, 64
    while end < n:
        stop = min(end + step, n)
        differ = words[end:stop] != words[end + distance : stop + distance]
        if differ.any():
            end += int(differ.argmax())
            break
        end, step = stop, step * 2
    step = 64
    while start > 0:
        stop = max(start - step, 0)
        differ = words[stop:start] != words[stop + distance : start + distance]
        if differ.any():
            start -= int(differ[::-1].argmax())
            break
        start, step = stop, step * 2
    return start, end


def _extend(words: np.ndarray, runs: list[tuple[int, int, int]], block: int, at: np.ndarray, distance: np.ndarray) -> None:
    """Append the maximal runs (start, end, period) of one scale, seeded by blocks that occur again.

    Blocks inside a known run whose period divides the distance would only show that run again (any stretch as long as
    the distance repeats the shorter period, and so does all that repeats the stretch), so they are put aside first.
    """
    order = np.argsort(at, kind="stable")
    at, distance = at[order], distance[order]
    keep = np.ones(len(at), dtype=bool)
    for start, end, period in runs:
        here = slice(*np.searchsorted(at, [start, end]))
        keep[here] &= (distance[here] % period != 0) | (at[here] + distance[here] + block > end)
    at, distance = at[keep], distance[keep]
    order = np.lexsort((at, distance))
    at, distance = at[order], distance[order]
    cuts = [0, *(np.flatnonzero(np.diff(distance)) + 1).tolist(), len(at)]
    old = len(runs)
    for first, last in zip(cuts, cuts[1:]):
        if first == last:
            continue
        d, places = int(distance[first]), at[first:last]
        k = 0
        while k < len(places):
            b = int(places[k])
            if any(d % q == 0 and s <= b and b + d + block <= e for s, e, q in runs[old:]):
                k += 1
                continue
            start, end = _reach(words, b, d, block)
            whole = (start, end + d, d)
            if end + d - start >= max(MIN_WORDS, MIN_PERIODS * d) and not any(s == start and e == end + d and d % q == 0 for s, e, q in runs):
                runs.append(whole)
            # Further blocks of the stretch have the same one.
            k = max(k + 1, int(np.searchsorted(places, end - block, side="right")))


def find_runs(codes: np.ndarray, first: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """The maximal periodic runs (start, length, period) of each text, by start and period.

    `codes` has a number for each word of all texts, one behind the other, equal where the words are; `first` has where
    each text begins, and the end. A run is a stretch of words with smallest period q, of at least MIN_PERIODS periods and
    MIN_WORDS words, that no neighbouring word extends.
    """
    n = np.diff(first)
    found: dict[int, list[tuple[int, int, int]]] = {}
    for block, least, distances in _scales(int(n.max(initial=0))):
        # Blocks lie at multiples of their length, and end a distance or more before the text does.
        count = np.maximum((n - least) // block, 0) * (n >= max(MIN_WORDS, MIN_PERIODS * least))
        text = np.repeat(np.arange(len(n)), count)
        at = (np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)) * block
        beyond = np.zeros(least + distances + block, dtype=np.int64)
        number, distance = block_occurrences(np.concatenate([codes, beyond]), first[text] + at, block, least, distances)
        inside = at[number] + block + distance <= n[text[number]]
        number, distance = number[inside], distance[inside]
        order = np.argsort(text[number], kind="stable")
        number, distance = number[order], distance[order]
        owner = text[number]
        cuts = [0, *(np.flatnonzero(np.diff(owner)) + 1).tolist(), len(owner)]
        for a, z in zip(cuts, cuts[1:]):
            if a < z:
                k = int(owner[a])
                _extend(codes[first[k] : first[k + 1]], found.setdefault(k, []), block, at[number[a:z]], distance[a:z])
    return [sorted((s, e - s, q) for s, e, q in found.get(k, [])) for k in range(len(n))]


def split_words(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(words, first): the words of texts in one array of bytes, and where each text's words begin, one more at the end."""
    space = _IS_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    begins = ~space & (np.concatenate([[True], space[:-1]])[: len(data)] | edge[:-1])
    starts = np.flatnonzero(begins)
    packed = np.cumsum(~space)
    ends = np.concatenate([packed[starts] - 1, packed[-1:]]).astype(np.int32)
    ends = ends if len(ends) else np.zeros(1, dtype=np.int32)
    words = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data[~space].tobytes())])
    return words, np.searchsorted(starts, offsets)


RUN_TYPE = T.ArrayType(T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")]), False)


def collapse_runs(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """All columns of `docs` (or those in `keep`), and behind them n_words, runs and collapsed (underscores appended where taken).

    Words are what white space parts (space, tab, line feed, vertical tab, form feed, carriage return). `runs` has
    (start, length, period) of every maximal periodic run, in words, by start and period; `collapsed` is the text's words
    joined by one space, without those that some run holds behind its first period. A null or empty text has no words, no
    runs and an empty `collapsed`. Runs may overlap; a word goes if any run drops it. The whole text is read, however
    long; its words take some 200 bytes each while they are searched. Rows neither move nor meet.
    """
    names = [free_name(docs.columns, n) for n in ("n_words", "runs", "collapsed")]
    fields = [T.StructField(names[0], T.LongType()), T.StructField(names[1], RUN_TYPE), T.StructField(names[2], T.StringType())]
    at = docs.columns.index(text_col)

    def search(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        counts, runs, texts = [], [], []
        for _, _, data, offsets in tb.text_runs(batch.column(at), 1 << 20):
            words, first = split_words(data, offsets)
            codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
            found = find_runs(codes, first)
            kept = np.ones(len(words), dtype=bool)
            for k, own in enumerate(found):
                for start, length, period in own:
                    kept[first[k] + start + period : first[k] + start + length] = False
            left = words if kept.all() else words.filter(pa.array(kept))
            cuts = np.concatenate([[0], np.cumsum(kept)])[first].astype(np.int32)
            texts.append(pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts), left), " "))
            counts.append(np.diff(first))
            runs += found
        flat = [run for own in runs for run in own]
        ends = np.concatenate([[0], np.cumsum([len(own) for own in runs])]).astype(np.int32)
        parts = [pa.array([run[i] for run in flat], pa.int64()) for i in range(3)]
        kind = pa.struct([pa.field(n, pa.int64(), False) for n in ("start", "length", "period")])
        structs = pa.StructArray.from_arrays(parts, fields=list(kind))
        lists = pa.ListArray.from_arrays(pa.array(ends), structs, type=pa.list_(pa.field("element", kind, False)))
        joined = pa.concat_arrays(texts) if texts else pa.array([], pa.string())
        return dict(zip(names, [pa.array(np.concatenate([np.zeros(0, dtype=np.int64), *counts])), lists, joined]))

    return map_batches(docs, search, fields, keep)


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; of equal ones the first by start, then period. Null if none."""

    def better(best: Column, x: Column) -> Column:
        more = x["length"] * best["period"] > best["length"] * x["period"]
        return F.when(best.isNull() | more, x).otherwise(best)

    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate(runs, none, better)


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with a period put into the text of every tenth document by the crc32 of its id: a rule to test with.

    Let h be the crc32 of the id as text, g = h div 10, n the number of words. Where h mod 10 is 0 and n > 0, each word i
    from a = g mod n on becomes the word a + (i - a) mod p with p = 1 + (n - a) div (3 + g mod 8), and words are joined by
    one space. Other texts, and rows with a null id, stay as they are.
    """
    h = F.crc32(F.col(quoted(id_col)).cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
        return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(words, place(i).cast("int"))), " ")

    # The outer array binds the words, which are split once.
    split = F.filter(F.split(F.col(quoted(text_col)), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    texts = F.transform(F.array(split), lambda words: F.when(F.size(words) > 0, repeated(words)).otherwise(F.col(quoted(text_col))))
    new = F.when((h % 10 == 0) & F.col(quoted(text_col)).isNotNull(), F.get(texts, F.lit(0))).otherwise(F.col(quoted(text_col)))
    return docs.withColumn(text_col, new)
