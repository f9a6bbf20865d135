"""Benchmark decontamination: find the passages of test items in training documents."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from classweave.llm import textbytes as tb
from classweave.llm.frames import bound_batches, columns, free_name, map_batches, release_memory, written

WINDOW = 13
#: Share of hit words from which a document counts as contaminated, as a fraction.
MIN_SHARE = (1, 20)
#: Windows of the test set, one per window and item, that are broadcast, some 30 bytes each; more of them are joined.
MAX_WINDOWS = 2_000_000
#: Bits of the table that lets few other windows through to the join.
FILTER_BITS = 26


def _check(words: bytes) -> int:
    """A second hash of a window, of its very words: hits of the first one are told by it."""
    return int.from_bytes(hashlib.blake2b(words, digest_size=8).digest(), "little", signed=True)


def _window_bytes(lowered: bytes, starts: list[int], ends: list[int]) -> bytes:
    return b" ".join([lowered[s:e] for s, e in zip(starts, ends)])


def item_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(n, hash, verify, item): the windows of n words of each item, once each. An item of fewer words is one window."""
    bound_batches(benchmark.sparkSession)
    items = benchmark.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, _, data, offsets in tb.text_runs(batch.column(1)):
                starts, ends, first = tb.word_spans(data, offsets)
                hashes, lowered = tb.word_hashes(data, starts, ends), tb.LOWER[data].tobytes()
                found: list[tuple[int, int, int, int]] = []
                for n in sorted(set(np.minimum(np.diff(first), window).tolist()) - {0}):
                    at, text = tb.windows_within(first, n)
                    own = np.flatnonzero(np.minimum(np.diff(first), window)[text] == n)
                    keys = tb.window_hash(hashes, n)[at[own]].view(np.int64).tolist()
                    for i, k, key in zip(at[own].tolist(), text[own].tolist(), keys):
                        found.append((n, key, _check(_window_bytes(lowered, starts[i : i + n].tolist(), ends[i : i + n].tolist())), row + k))
                n, key, verify, owner = (list(x) for x in zip(*found)) if found else ([], [], [], [])
                names = batch.column(0).take(pa.array(owner, pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(n, pa.int32()), pa.array(key, pa.int64()), pa.array(verify, pa.int64()), names], names=["n", "hash", "verify", "item"])

    return items.mapInArrow(cut, "n int, hash bigint, verify bigint, item string").distinct()


class _Index:
    """Hashes of a test set's windows by number of words, sorted, with a table of bits in front that few other windows pass."""

    def __init__(self, windows: pa.Table):
        self.items, item = self._names(windows.column("item").combine_chunks() if windows.num_rows else pa.array([], pa.string()))
        n, keys, checks = (windows.column(c).to_numpy() for c in ("n", "hash", "verify"))
        self.lengths = np.unique(n).tolist()
        self.by_length = {}
        for length in self.lengths:
            own = np.flatnonzero(n == length)
            own = own[np.argsort(keys[own].view(np.uint64), kind="stable")]
            hashes = keys[own].view(np.uint64)
            bits = np.zeros(1 << 20, dtype=bool)
            bits[(hashes >> np.uint64(44)).astype(np.int64)] = True
            self.by_length[length] = (hashes, checks[own], item[own], bits)

    @staticmethod
    def _names(items: pa.Array) -> tuple[list[str], np.ndarray]:
        """The ids of the items, and for each window the place of its item's; -1 for an item without an id."""
        coded = items.dictionary_encode()
        return coded.dictionary.to_pylist(), coded.indices.fill_null(-1).to_numpy().astype(np.int32)

    def hits(self, n: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position among `hashes`, second hash, item) of all windows with the hash of an entry."""
        known, checks, items, bits = self.by_length[n]
        at = np.flatnonzero(bits[(hashes >> np.uint64(44)).astype(np.int64)])
        low, high = (np.searchsorted(known, hashes[at], side=s) for s in ("left", "right"))
        found = high > low
        at, low, high = at[found], low[found], high[found]
        counts = high - low
        entry = np.repeat(low - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        return np.repeat(at, counts), checks[entry], items[entry]


def _judged(column: pa.Array, cleaned: bool, find) -> dict[str, list]:
    """n_words, n_hit, items and cleaned of each text; `find` yields (row, place of a word, n, item or None) of each hit in a run of texts.

    It gets the first row of the run, the lower-cased bytes, starts and ends of the words, and each text's first word.
    """
    out: dict[str, list] = {"n_words": [], "n_hit": [], "items": [], "cleaned": []}
    for row, _, data, offsets in tb.text_runs(column):
        starts, ends, first = tb.word_spans(data, offsets)
        change = np.zeros(len(starts) + 1, dtype=np.int64)
        items: dict[int, set] = {}
        for text, i, n, item in find(row, data, starts, ends, first):
            change[i] += 1
            change[i + n] -= 1
            items.setdefault(text, set()).update(() if item is None else (item,))
        hit = np.cumsum(change[:-1]) > 0
        total = np.concatenate([[0], np.cumsum(hit)])
        out["n_words"] += np.diff(first).tolist()
        out["n_hit"] += (total[first[1:]] - total[first[:-1]]).tolist()
        out["items"] += [sorted(items.get(k, ())) for k in range(len(offsets) - 1)]
        if cleaned:
            raw = data.tobytes()
            for k in range(len(offsets) - 1):
                own_hits = np.flatnonzero(hit[first[k] : first[k + 1]]) + first[k] if k in items else ()
                pieces, at = [], int(offsets[k])
                for i in own_hits:
                    joined = i > first[k] and hit[i - 1]  # what stands between two hit words goes as well
                    pieces.append(b"" if joined else raw[at : starts[i]])
                    at = int(ends[i])
                pieces.append(raw[at : offsets[k + 1]])
                out["cleaned"].append(b"".join(pieces).decode())
    return out


def _broadcast_hits(index: _Index):
    """Finds hits by the broadcast index."""

    def find(row, data, starts, ends, first):
        hashes = tb.word_hashes(data, starts, ends)
        lowered, seen = None, {}
        for n in index.lengths:
            own = tb.window_hash(hashes, n)
            at, text = tb.windows_within(first, n)
            where, checks, items = index.hits(n, own[at])
            if len(where) and lowered is None:
                lowered = tb.LOWER[data].tobytes()
            for k, check, item in zip(where.tolist(), checks.tolist(), items.tolist()):
                i = int(at[k])
                if (i, n) not in seen:
                    seen[i, n] = _check(_window_bytes(lowered, starts[i : i + n].tolist(), ends[i : i + n].tolist()))
                if seen[i, n] == check:
                    yield int(text[k]), i, n, index.items[item] if item >= 0 else None

    return find


def _bit_table(windows: DataFrame) -> np.ndarray:
    """A table of 2 ** FILTER_BITS bits as bytes, set where a window's hash begins; put together on the executors."""
    place = F.shiftrightunsigned("hash", 64 - FILTER_BITS) + 1
    parts = windows.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    table = np.zeros((1 << FILTER_BITS) // 8, dtype=np.uint8)
    for part in parts.toLocalIterator():
        bits = np.frombuffer(part["bits"], dtype=np.uint8)
        table[(part["bucket"] - 1) * len(bits) : part["bucket"] * len(bits)] = bits
    return table


def _joined(docs: DataFrame, windows: DataFrame, key_col: str, text_col: str) -> DataFrame:
    """(key, hits): places, lengths and items of every row's hits, by joining hashes, for test sets of any size.

    Of the documents' windows only those move that a table of bits lets through, as two hashes and a place.
    """
    spark = docs.sparkSession
    lengths = sorted(r[0] for r in windows.select("n").distinct().collect())
    bits = spark.sparkContext.broadcast(_bit_table(windows))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, _, data, offsets in tb.text_runs(batch.column(1)):
                starts, ends, first = tb.word_spans(data, offsets)
                hashes, lowered = tb.word_hashes(data, starts, ends), tb.LOWER[data].tobytes()
                for n in lengths:
                    at, text = tb.windows_within(first, n)
                    own = tb.window_hash(hashes, n)[at]
                    place = (own >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
                    may = np.flatnonzero(bits.value[place >> 3] >> (place & 7).astype(np.uint8) & 1)
                    checks = [_check(_window_bytes(lowered, starts[i : i + n].tolist(), ends[i : i + n].tolist())) for i in at[may].tolist()]
                    keys = batch.column(0).take(pa.array(row + text[may]))
                    yield pa.RecordBatch.from_arrays(
                        [keys, pa.array(at[may] - first[text[may]], pa.int32()), pa.array(np.full(len(may), n), pa.int32()), pa.array(own[may].view(np.int64)), pa.array(checks, pa.int64())],
                        names=["key", "at", "n", "hash", "verify"],
                    )
        release_memory()

    slim = docs.select(F.col(key_col).cast("long").alias("key"), F.col(text_col).alias("text"))
    found = slim.mapInArrow(candidates, "key bigint, at int, n int, hash bigint, verify bigint").join(windows, ["n", "hash", "verify"])
    # A row has at most one hit per place and length, and for each the items that hold the window.
    per_place = found.groupBy("key", "at", "n").agg(F.collect_set("item").alias("items"))
    return per_place.groupBy("key").agg(F.collect_list(F.struct("at", "n", "items")).alias("hits"))


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    share: tuple[int, int] = MIN_SHARE,
    cleaned: bool = False,
    max_windows: int = MAX_WINDOWS,
) -> DataFrame:
    """All columns of `docs`, and behind them what of each text also stands in a test item.

    A broadcast hash set of the items' normalised windows is scanned over each text's windows, and every hit is verified
    by a second hash of its words. New columns (with underscores appended where `docs` has the name): n_words and n_hit, long;
    items, the sorted ids of the items found; contaminated, true if some words are hit and their share is at least
    `share`; with `cleaned` also that text without the hit passages. A null or empty text has no words and is clean, as
    is every text where the test set is empty. Repeated rows are judged one by one; an item without words never occurs;
    an item whose id is null is found but not named. Rows neither move nor get lost.

    The index takes some 30 bytes per window and item on the driver and in each worker. Test sets with more than
    `max_windows` are joined with the documents' windows instead, by hash and behind a table of bits of 8 MB, so that the
    driver holds no more however large they are; the rows are the same, `cleaned` too.
    """
    names = {n: free_name(docs.columns, n) for n in ("n_words", "n_hit", "items", "contaminated", "cleaned")}
    num, den = share
    # Written once: they are counted, and then collected or joined.
    windows = written(item_windows(benchmark, item_col, item_text, window), "windows")
    fields = [T.StructField(names[n], T.LongType()) for n in ("n_words", "n_hit")] + [T.StructField(names["items"], T.ArrayType(T.StringType()))]
    if cleaned:
        fields.append(T.StructField(names["cleaned"], T.StringType()))
    kinds = {"n_words": pa.int64(), "n_hit": pa.int64(), "items": pa.list_(pa.string()), "cleaned": pa.string()}
    at = docs.columns.index(text_col)
    arrays = lambda found: {names[n]: pa.array(v, kinds[n]) for n, v in found.items() if cleaned or n != "cleaned"}
    if windows.count() <= max_windows:
        index = docs.sparkSession.sparkContext.broadcast(_Index(windows.toArrow()))
        out = map_batches(docs, lambda batch: arrays(_judged(batch.column(at), cleaned, _broadcast_hits(index.value))), fields)
    else:
        # A key of the rows' own, written once: ids may be null or repeated.
        own, key, hits = (free_name([*docs.columns, *names.values()], n) for n in ("_row", "_doc", "_hits"))
        keyed = written(docs.withColumn(own, F.monotonically_increasing_id()), "rows")
        found = _joined(keyed, windows, own, text_col).select(F.col("key").alias(key), F.col("hits").alias(hits))
        behind = len(docs.columns)
        met = keyed.join(found, F.col(own) == F.col(key), "left").select(*columns(docs.columns), hits)

        def judge(batch: pa.RecordBatch) -> dict[str, pa.Array]:
            lists = batch.column(behind)

            def find(row, data, starts, ends, first):
                for text in range(len(first) - 1):
                    for h in lists[row + text].as_py() or ():
                        for item in h["items"] or (None,):
                            yield text, int(first[text]) + h["at"], h["n"], item

            return arrays(_judged(batch.column(at), cleaned, find))

        out = map_batches(met, judge, fields, docs.columns)
    hit = F.col(names["n_hit"])
    return out.withColumn(names["contaminated"], (hit > 0) & (den * hit >= num * F.col(names["n_words"])))


def decontaminate(docs: DataFrame, benchmark: DataFrame, mode: str = "documents", text_col: str = "text", **options) -> DataFrame:
    """`docs` without contaminated documents, or, with mode="spans", with the hit passages cut from their texts.

    Same columns as `docs`. Only contaminated documents change; a text that merely shares a few words with an item stays.
    """
    judged = contamination(docs, benchmark, text_col, cleaned=mode == "spans", **options)
    flag = judged.columns[-1]
    if mode == "documents":
        return judged.where(~F.col(flag)).select(*columns(docs.columns))
    clean_text = F.when(F.col(flag), F.col(judged.columns[-2])).otherwise(F.col(text_col)).alias(text_col)
    return judged.select(*[clean_text if c == text_col else x for c, x in zip(docs.columns, columns(docs.columns))])


def items_digest(items: Column) -> Column:
    """SHA-256 of item ids, sorted as strings and comma-joined."""
    return F.sha2(F.array_join(items, ","), 256)
